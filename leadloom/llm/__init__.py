"""Operators for training-data pipelines: secrets, quality, decontamination, deduplication, PII, tokenizing, HTML."""

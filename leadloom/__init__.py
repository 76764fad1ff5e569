"""Spark-native record hygiene: scalar rules, entity resolution, gates and enrichment on DataFrames."""

"""The queries of the corpus operators, one of each, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import OP3_SQL, op3_decontamination
from .filter_audit import OP12_SQL, op12_filter_audit
from .html_extraction import op9_html_extraction
from .jaccard_join import OP7_SQL, op7_jaccard_join
from .language_id import op11_language_id
from .line_dedup import OP5_SQL, op5_line_dedup
from .merge_dropout import op8_sentencepiece
from .personal_data import op6_personal_data
from .quality_classifier import op2_quality_classifier
from .quality_rules import op10_quality_rules
from .secret_scan import op1_secret_scan
from .source_divergence import OP13_SQL, op13_source_divergence
from .suffix_dedup import op4_suffix_dedup

OPERATORS = (op1_secret_scan, op2_quality_classifier, op3_decontamination, op4_suffix_dedup, op5_line_dedup, op6_personal_data, op7_jaccard_join, op8_sentencepiece, op9_html_extraction, op10_quality_rules, op11_language_id, op12_filter_audit, op13_source_divergence)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3_SQL, "op5_line_dedup": OP5_SQL, "op7_jaccard_join": OP7_SQL, "op12_filter_audit": OP12_SQL, "op13_source_divergence": OP13_SQL}

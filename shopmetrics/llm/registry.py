"""Queries of the document operators, and their DuckDB twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_pii,
    op2_decontamination,
    op3_langid,
    op4_suffix_dedup,
    op5_quality_classifier,
    op6_quality_rules,
    op7_secrets,
    op8_jaccard_join,
    op9_html,
    op10_mixing,
    op11_spelling,
    op12_vector_codes,
    op13_warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii.op1_pii,
    "op2_decontamination": op2_decontamination.op2_decontamination,
    "op3_langid": op3_langid.op3_langid,
    "op4_suffix_dedup": op4_suffix_dedup.op4_suffix_dedup,
    "op5_quality_classifier": op5_quality_classifier.op5_quality_classifier,
    "op6_quality_rules": op6_quality_rules.op6_quality_rules,
    "op7_secrets": op7_secrets.op7_secrets,
    "op8_jaccard_join": op8_jaccard_join.op8_jaccard_join,
    "op9_html": op9_html.op9_html,
    "op10_mixing": op10_mixing.op10_mixing,
    "op11_spelling": op11_spelling.op11_spelling,
    "op12_vector_codes": op12_vector_codes.op12_vector_codes,
    "op13_warc": op13_warc.op13_warc,
}

ORACLES: dict[str, str] = {
    "op1_pii": op1_pii.ORACLE,
    "op2_decontamination": op2_decontamination.ORACLE,
    "op7_secrets": op7_secrets.ORACLE,
    "op8_jaccard_join": op8_jaccard_join.ORACLE,
    "op11_spelling": op11_spelling.ORACLE,
    "op12_vector_codes": op12_vector_codes.ORACLE,
    "op13_warc": op13_warc.ORACLE,
}

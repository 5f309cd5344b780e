"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, fingerprint, language, license_scan, line_dedup, mixing, ngram_join, personal, prefix_trie,
               repair, secrets, token_output, toxicity)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": lambda spark, sf: line_dedup.dedup_lines(read(spark, sf, "documents")),
    "op2_toxicity": lambda spark, sf: toxicity.query(read(spark, sf, "documents"), read(spark, sf, "labels")),
    "op3_language": lambda spark, sf: language.query(read(spark, sf, "documents")),
    "op4_fingerprint": lambda spark, sf: fingerprint.report(fingerprint.fingerprints(read(spark, sf, "documents"))),
    "op5_mixing": lambda spark, sf: mixing.query(read(spark, sf, "documents")),
    "op6_secret_scan": lambda spark, sf: secrets.report(secrets.scan(read(spark, sf, "documents"))),
    "op7_ngram_join": lambda spark, sf: ngram_join.query(read(spark, sf, "documents")),
    "op8_decontaminate": lambda spark, sf: decontaminate.flag(
        read(spark, sf, "documents"), read(spark, sf, "benchmark")).drop("k"),
    "op9_token_output": lambda spark, sf: token_output.query(read(spark, sf, "documents")),
    "op10_personal_data": lambda spark, sf: personal.report(personal.find_personal(read(spark, sf, "documents"))),
    "op11_conversation_repair": lambda spark, sf: repair.query(read(spark, sf, "conversations")),
    "op12_prefix_trie": lambda spark, sf: prefix_trie.query(read(spark, sf, "conversations")),
    "op13_license_scan": lambda spark, sf: license_scan.scan(read(spark, sf, "documents")),
}

ORACLE: dict[str, str] = {  # the others are tested against brute force, exact round trips or held-out rows
    "op1_line_dedup": line_dedup.ORACLE,
    "op8_decontaminate": decontaminate.ORACLE,
}

"""Queries of the corpus operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm import (decontaminate, fill_middle, ngram_join, packing, periodic_runs, pitman_yor, quality_rules, repair_grammar, secret_forest,
                           suffix_groups, token_counts, toxicity, wrapper)
from fieldlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_ngram_join": lambda spark, sf: ngram_join.op1(table(spark, sf, "documents")),
    "op2_secret_scan": lambda spark, sf: secret_forest.op2(table(spark, sf, "documents")),
    "op3_pitman_yor": lambda spark, sf: pitman_yor.op3(table(spark, sf, "documents")),
    "op4_token_counts": lambda spark, sf: token_counts.op4(table(spark, sf, "documents")),
    "op5_repair_ids": lambda spark, sf: repair_grammar.op5(table(spark, sf, "documents")),
    "op6_suffix_groups": lambda spark, sf: suffix_groups.op6(table(spark, sf, "documents")),
    "op7_decontamination": lambda spark, sf: decontaminate.op7(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op8_quality_rules": lambda spark, sf: quality_rules.op8(table(spark, sf, "documents")),
    "op9_packing": lambda spark, sf: packing.op9(table(spark, sf, "documents")),
    "op10_wrapper_induction": lambda spark, sf: wrapper.op10(table(spark, sf, "pages")),
    "op11_periodic_runs": lambda spark, sf: periodic_runs.op11(table(spark, sf, "documents")),
    "op12_toxicity": lambda spark, sf: toxicity.op12(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op13_fill_middle": lambda spark, sf: fill_middle.op13(table(spark, sf, "documents")),
}

ORACLES: dict[str, str] = {
    "op8_quality_rules": quality_rules.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op13_fill_middle": fill_middle.SQL,
}

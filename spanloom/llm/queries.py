"""The queries of this subpackage, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import bpe, fim, language, licenses, merkle, mixing, neighbours, quality, sharding, simhash, spotsigs, suffix, tokencounts

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_lpt_sharding": sharding.op1,
        "op2_rank_order_language": language.op2,
        "op3_line_field_quality": quality.op3,
        "op4_covering_simhash": simhash.op4,
        "op5_nn_descent": neighbours.op5,
        "op6_fair_queue_mixing": mixing.op6,
        "op7_spotsigs": spotsigs.op7,
        "op8_suffix_levels_dedup": suffix.op8,
        "op9_tree_bpe": bpe.op9,
        "op10_separator_scan": tokencounts.op10,
        "op11_license_rules": licenses.op11,
        "op12_distinct_text_fim": fim.op12,
        "op13_superblock_merkle": merkle.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_fair_queue_mixing": mixing.OP6_SQL, "op11_license_rules": licenses.OP11_SQL, "op12_distinct_text_fim": fim.OP12_SQL, "op13_superblock_merkle": merkle.OP13_SQL}

"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import (
    bpe, decontaminate, lines, minhash, nearest, passages, quality, ranking, rendering, shards, tokenfiles, toxicity, variants,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": tokenfiles.query,
        "op2_decontaminate": decontaminate.query,
        "op3_lines": lines.query,
        "op4_rendering": rendering.query,
        "op5_passages": passages.query,
        "op6_shards": shards.query,
        "op7_minhash": minhash.query,
        "op8_toxicity": toxicity.query,
        "op9_nearest": nearest.query,
        "op10_bpe": bpe.query,
        "op11_variants": variants.query,
        "op12_quality": quality.query,
        "op13_ranking": ranking.query,
    }


def statements() -> dict[str, str]:
    return {
        "op9_nearest": nearest.ORACLE,
        "op13_ranking": ranking.ORACLE,
    }

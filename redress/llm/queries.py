"""Registered queries of the package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from redress.llm import (
    chat,
    counts,
    decontaminate,
    hard_negatives,
    language,
    lines,
    near_duplicates,
    nearest,
    pieces,
    pitman_yor,
    prefix_trie,
    quality,
    weak_quality,
)
from redress.llm.oracles import oracle_sql as oracle_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(build: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: build(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": _documents(lines.line_dedup_digest),
        "op2_quality_rules": _documents(quality.quality_digest),
        "op3_token_counts": _documents(counts.token_count_table),
        "op4_decontamination": lambda s, d: decontaminate.leak_table(
            _table(s, d, "documents"), _table(s, d, "benchmark")
        ),
        "op5_near_duplicates": _documents(near_duplicates.near_duplicate_table),
        "op6_quality_classifier": lambda s, d: weak_quality.quality_table(
            _table(s, d, "documents"), _table(s, d, "labels")
        ),
        "op7_language_id": _documents(language.language_table),
        "op8_pieces": _documents(pieces.pieces_digest),
        "op9_chat_format": lambda s, d: chat.chat_digest(s, _table(s, d, "conversations")),
        "op10_lm_scores": _documents(pitman_yor.score_table),
        "op11_nearest": lambda s, d: nearest.nearest_table(_table(s, d, "embeddings")),
        "op12_hard_negatives": lambda s, d: hard_negatives.negatives_table(
            _table(s, d, "embeddings")
        ),
        "op13_prefix_trie": lambda s, d: prefix_trie.trie_table(_table(s, d, "conversations")),
    }

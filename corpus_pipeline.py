"""A corpus pipeline: five stages over documents, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from redress.llm.common import SPACES
from redress.llm.decontaminate import drop_leaks
from redress.llm.language import UNDETERMINED, fit_languages, identify
from redress.llm.lines import dedup_lines
from redress.llm.near_duplicates import drop_near_duplicates
from redress.llm.pieces import encode_pieces
from redress.sources.scratch import new_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language is accepted if it has this share of the likelihood.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those of no clear language.

    ``lang`` becomes the predicted language.
    """
    found = identify(docs, fit_languages(docs.select("doc_id", "text", "lang")))
    accepted = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(accepted).withColumn("lang", F.col("lang_pred")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves lines that ten documents share in the first of them only.

    A document that has lost all its lines goes, so of copies the first stays. Blank
    lines are never dropped; one that has nothing else left goes too.
    """
    kept = dedup_lines(docs, keep_first=True)
    holds_text = F.btrim("kept_text", F.lit(SPACES)) != ""
    left = kept.where(holds_text | (F.col("n_dropped") == 0))
    length = F.length("kept_text").cast("long")
    return left.withColumns({"text": F.col("kept_text"), "n_chars": length}).select(docs.columns)


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document with the smallest id of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text; those whose ids don't give back the text are marked."""
    encoded = encode_pieces(docs)
    return encoded.withColumn(
        "round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))
    ).drop("decoded", "n_differing")


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", tokenization),
]

#: No SQL for models and tokenizers; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each one's table written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

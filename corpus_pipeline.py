"""A corpus pipeline out of five of the operators: quality rules, line dedup, SimHash near-dedup,
source mixing, SentencePiece. Each stage reads all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import line_dedup, mixing, pieces, quality, simhash
from domus.llm.queries import tokenizer_path
from domus.session import ensure_checkpoint_dir, scratch_path

#: SQL can't express the votes' EM, the components of near-duplicates and the tokenizer.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.keep_good(docs)


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without line chunks that stand elsewhere before; n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.lay_out(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether the ids decode to the text."""
    rows = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    done = pieces.encode_documents(rows, tokenizer_path(), decoded="decoded")
    return done.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("decodes"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("line_dedup", line_chunks),
    ("near_dedup", near_duplicates),
    ("mix", source_mix),
    ("pieces", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs

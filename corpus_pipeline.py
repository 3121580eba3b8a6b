"""The corpus pipeline: language, exact copies, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that the driver of the pipeline writes as
Parquet and reads again as the next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordwell.llm import bloom, common, pieces, ppm, simhash, tiling
from recordwell.llm.queries import PIECES_PATH, table
from recordwell.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without any letter, whose language cannot be told. Learns from the stage's own rows.

    Where no row names a language there is nothing to learn, and every row stays.
    """
    trees = ppm.train(docs.filter(~common.is_held_out("doc_id")))
    if not trees.languages:
        return docs
    found = docs.select(*[docs[c] for c in docs.columns], ppm.languages(docs["text"], trees, spark).alias("_found_lang"))
    return found.filter(F.col("_found_lang.lang") != ppm.UNKNOWN).drop("_found_lang")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return bloom.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked at three or fewer differing bits the row with the smallest id stays."""
    return simhash.one_per_component(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that contain a benchmark item."""
    return tiling.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text that is left."""
    coded = docs.select("doc_id", pieces.encode(F.col("text"), pieces.read_model(spark, PIECES_PATH)).alias("coded"))
    return coded.select("doc_id", "coded.ids", F.size("coded.ids").alias("n_ids"), "coded.lossless")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]

#: Fingerprints, tilings and merges have no SQL form; the tests run the stages in plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/recordwell/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

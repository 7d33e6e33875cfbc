"""The training-data pipeline over ``documents``.

Five stages, each on everything its predecessor kept: language identification
and the quality classifier drop what they reject, near-duplicate detection
keeps the smallest id of each group, mixing repeats or drops documents
towards the source targets, and the last stage encodes what is left.  Every
stage is written as Parquet and read back, so no stage recomputes another and
a lost executor costs one stage's tasks.

Rows with a null id cannot be named by a decision and stay until mixing.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetzone.llm import bpe, language, mixing, near_dedup, quality
from fleetzone.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents that a stage did not reject."""
    gone = decided.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents without a known language go."""
    return _without(docs, language.identify(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents of low quality or likely toxic go."""
    return _without(docs, quality.score_documents(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each near-duplicate group stays."""
    return _without(docs, near_dedup.near_duplicates(docs, words=5, percent=80))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: every document as often as the mix takes it."""
    copies = mixing.mix(docs).groupBy("doc_id").agg(F.max("copies").alias("copies")).where("copies > 0")
    rows = docs.join(copies, docs["doc_id"].eqNullSafe(copies["doc_id"])).drop(copies["doc_id"])
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*COLUMNS)


def _emit(ids, tokens, offsets, path: str) -> pd.DataFrame:
    arrays = bpe.emit_arrays(ids, tokens, offsets, path)
    return arrays.assign(decoded_sha256=bpe.emit_digests(ids, tokens, offsets, path)["decoded_sha256"])


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token ids of every document, with the digest of their decoded bytes."""
    return bpe.encode(docs, emit=_emit, schema=bpe.ARRAYS + ", decoded_sha256 string")


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: The classifiers and the registers are not SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None

"""Shared Spark helpers of the operators: table reads, written tables, sizes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetzone.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of ``sf_dir`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared work folder."""
    return work_path(spark, "tables", f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared work folder and read back.

    Cuts the lineage and fixes the rows: later steps read files that outlive
    a lost executor.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Select the named input columns, cast, dropping every other column.

    Extra columns with any name therefore never clash with an operator's own.
    """
    return df.select(*[F.col(f"`{k}`").cast(t).alias(k) for k, t in wanted.items()])

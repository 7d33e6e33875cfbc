"""File sources and sinks: dated CSV extracts, newest-run choice, JDBC.

Extracts are written as one dataset per name, with the run date in a
``run_date=YYYY-MM-DD`` folder and, where asked, folders per value of a
column (the landing year) below it, so readers prune by date and year and
pick the newest run without opening a file.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_dropped, write_table

NA = "NA"
#: Rows of a compressed file at most.
FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, base: str, name: str, run_date: str,
              mode: str = "overwrite", partition_by: list[str] | None = None, rebalance: bool = True,
              compression: str | None = None) -> str:
    """Write ``df`` as header CSV (missing values as ``NA``) under
    ``{base}/{name}/run_date={run_date}`` and return that path.

    With ``partition_by`` there is one folder per value below it; the columns
    are kept in the folder names only.  The rows are first rebalanced by them:
    few files per folder, and the rows of a large value over several tasks.
    Without ``rebalance`` every task writes a file for each value it has, and the
    rows are not shuffled.

    ``compression`` (``"gzip"``) is for extracts that count in disk space.  Such a
    file is read by one task, so each ends after ``FILE_ROWS`` rows.
    """
    path = f"{base}/{name}/run_date={run_date}"
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).partitionBy(*partition_by or []).option("header", True).option("nullValue", NA)
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", FILE_ROWS)
    with shuffles_dropped(df.sparkSession):
        writer.option("emptyValue", "").csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             row_number_column: bool = False, partitions: str | None = None) -> DataFrame:
    """Read a header CSV extract with a fixed schema.

    ``partitions`` names and types the columns kept in folder names (as in
    ``"LANDING_YEAR INT"``); filters on them decide which folders are read.
    ``NA`` reads as missing.  With ``row_number_column`` the file has a
    leading unnamed row-number column (as written by tools that add row
    names); it is read by position and dropped.
    """
    columns = [x.name for x in schema.fields]
    if row_number_column:
        schema = T.StructType([T.StructField("_c0", T.StringType(), True)] + list(schema.fields))
    if partitions:
        folders = T.StructType.fromDDL(partitions).fields
        columns += [f.name for f in folders if f.name not in columns]
        schema = T.StructType([x for x in schema.fields if x.name not in {f.name for f in folders}] + folders)
    df = (spark.read.schema(schema).option("header", True).option("nullValue", NA)
               .option("mode", "FAILFAST").csv(path))
    return df.select(*[F.col(f"`{c}`") for c in columns])


# Where a file's path names its run folder, dataset and run date.
_RUN_PATH = r"^(.*?/([^/]+)/run_date=(\d{4}-\d{2}-\d{2}))/"


def latest_runs(spark: SparkSession, base: str, pattern: str = ".*") -> DataFrame:
    """(dataset, run_date, path) of the newest run of every dataset under
    ``base`` whose name matches ``pattern``.

    One scan of file metadata (the content column is pruned, so no file is
    opened), aggregated on the cluster.  Stamps are compared as dates, so
    adding an older run changes nothing.  A run without any file, or a folder
    without a valid stamp, is no run.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path")
    runs = listed.select(F.regexp_extract("path", _RUN_PATH, 2).alias("dataset"),
                         F.try_to_date(F.regexp_extract("path", _RUN_PATH, 3), "yyyy-MM-dd").alias("run_date"),
                         F.regexp_extract("path", _RUN_PATH, 1).alias("path"))
    runs = runs.where(F.col("dataset").rlike(pattern) & F.col("run_date").isNotNull())
    return (runs.groupBy("dataset").agg(F.max(F.struct("run_date", "path")).alias("r"))
                .select("dataset", "r.run_date", "r.path"))


def latest_datasets(spark: SparkSession, base: str, pattern: str = ".*") -> dict[str, str]:
    """``latest_runs`` as ``{dataset: path of its newest run folder}`` (one
    entry per dataset)."""
    return {r.dataset: r.path for r in latest_runs(spark, base, pattern).collect()}


def read_latest(spark: SparkSession, base: str, name: str, schema: T.StructType) -> DataFrame:
    """The newest run of one dataset, chosen while the query runs.

    ``run_date`` is a partition column and the newest one a scalar subquery
    over file metadata, so only that run's files are opened.
    """
    runs = read_csv(spark, f"{base}/{name}", schema, partitions="run_date DATE")
    newest = latest_runs(spark, base, f"^{re.escape(name)}$").agg(F.max("run_date"))
    return runs.where(F.col("run_date") == newest.scalar()).drop("run_date")


def keep_partitions(df: DataFrame, column: str, keys: DataFrame, test: str) -> DataFrame:
    """The rows of a partitioned extract whose ``column`` is among the
    ``keys`` that pass ``test``.

    The keys are written first: Spark then knows their size, broadcasts them
    only while they are small, and reads only the folders that the passing
    keys name (dynamic pruning).
    """
    passing = write_table(keys, "partition-keys").where(test).select(F.col(column))
    return df.join(passing, column, "left_semi").select(*df.columns)


def jdbc_extract(spark: SparkSession, url: str, query: str | None = None,
                 table: str | None = None, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """Read from a database over JDBC.

    Small extracts pass a ``query``.  Big tables pass ``table`` plus a
    numeric ``partition_column`` with bounds so each executor reads one
    range in parallel; filters and column lists applied afterwards are
    pushed into the database query by Spark.  Credentials come from
    ``properties`` (the cluster's secret store), never from code.
    """
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        return r.option("query", query).load()
    r = r.option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()

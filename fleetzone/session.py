"""Session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  ANSI stays on (Spark 4 default): ids are
# STRING so string/number comparisons never need an implicit cast.
_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Spark's own setting for ``shuffles_dropped``.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Largest table Spark may broadcast, on a cluster and in the benchmark alike.
BROADCAST_BYTES = "1m"


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "fleetzone", broadcast_bytes: str = BROADCAST_BYTES) -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on).

    Broadcast joins follow the same threshold as ``cluster_conf``, so the
    plans measured here are the ones a cluster would choose for tables of
    these sizes.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="fleetzone-"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.autoBroadcastJoinThreshold", broadcast_bytes)
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast_bytes)
    )
    for k, v in _SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_work_dir(spark)
    return spark


def ensure_work_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); executors could not see a folder of the driver's own disk,
    so an unset folder is an error there.  Only a local session (tests) gets
    a fresh local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current.removeprefix("file:")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="fleetzone-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under this application's own folder in the shared work folder."""
    return os.path.join(ensure_work_dir(spark), f"fleetzone-{spark.sparkContext.applicationId}", *parts)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs that write something inside the block delete their shuffle files as they end.

    Without it the files stay until the driver happens to collect its garbage,
    those of one written table beside those of the next.
    """
    kept = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROP_SHUFFLES) if kept is None else spark.conf.set(_DROP_SHUFFLES, kept)


def write_table(df: DataFrame | list[DataFrame], label: str, folder: str | None = None) -> DataFrame:
    """``df`` written under the shared work folder and read back.

    Cuts the lineage; later plans know the table's size, and its files
    outlive a lost executor.  ``remove_work_tables`` deletes them.  Parts of a
    table (a list of frames with the same columns) are written one after another, so
    that only one part's shuffle files are on disk at a time.  ``folder`` is one of
    ``passing_tables``.
    """
    parts = df if isinstance(df, list) else [df]
    spark, schema = parts[0].sparkSession, parts[0].schema
    path = os.path.join(folder or work_path(spark, "tables"), f"{label}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        for part in parts:
            part.select(*[f"`{c}`" for c in schema.names]).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def passing_tables(spark: SparkSession) -> Iterator[str]:
    """A folder for written tables that only the block reads; deleted at its end."""
    path = work_path(spark, "tables", f"passing-{uuid.uuid4().hex}")
    try:
        yield path
    finally:
        _delete(spark, path)


def remove_work_tables(spark: SparkSession) -> None:
    """Delete what this application wrote under the shared work folder.

    For the end of a job: results that still read a written table must have
    been saved.  Other applications' folders are left alone.
    """
    _delete(spark, work_path(spark))


def cluster_conf(input_bytes: int, shuffle_fraction: float = 0.5,
                 partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings for a cluster run, sized from the bytes the jobs read.

    Shuffle partitions are sized so that the largest shuffle (taken as
    ``shuffle_fraction`` of the input) lands near ``partition_bytes`` per
    partition; AQE then coalesces small partitions and splits skewed ones.
    Scan splits use the same target.  The checkpoint folder is left to the
    cluster (``spark.checkpoint.dir``).
    """
    parts = max(200, int(input_bytes * shuffle_fraction // partition_bytes) + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": BROADCAST_BYTES,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_BYTES,
        "spark.sql.session.timeZone": "UTC",
    }

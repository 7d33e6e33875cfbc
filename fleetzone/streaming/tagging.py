"""Structured Streaming: tag set positions of new extract files as they land.

Per-row flags (``in_zone``, ``within``, ``zones_in``) need no state: each
micro-batch joins its rows to the written edge-cell
tables, a stream-static join.  Key-grain flags and reports span batches, so
they run as batch jobs over the tagged table this stream writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import geo
from ..plans import jobs


def tagged_stream(spark: SparkSession, source: str, schema: T.StructType,
                  cells: geo.EdgeCells, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of extract rows with positions and zone flags."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("nullValue", "NA")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return jobs.classify_sets(r.load(source), cells)


def start_tagging(spark: SparkSession, source: str, schema: T.StructType, cells: geo.EdgeCells,
                  sink: str, checkpoint: str, fmt: str = "parquet",
                  available_now: bool = False) -> StreamingQuery:
    """Start writing tagged rows to ``sink`` (parquet, append).

    ``checkpoint`` is a folder of this stream's own on the shared file system,
    so a restarted driver or lost executor resumes where the stream stopped.
    """
    df = tagged_stream(spark, source, schema, cells, fmt).drop("zones_in")
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("path", sink)
           .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()

"""The streaming tagger gives the batch tagger's flags."""

from pyspark.sql import functions as F

from fleetzone.operators import geo
from fleetzone.plans import jobs
from fleetzone.session import work_path
from fleetzone.sources.testbed import StandIns
from fleetzone.sources.zones import zones_from_rows
from fleetzone.streaming.tagging import start_tagging

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    tb = StandIns(spark, SF)
    rows = tb.activities().select("ORIGINAL_BATCH_SEQUENCE_NUMBER", "LATITUDE_DEGREES", "LATITUDE_MINUTES",
                                  "LATITUDE_HEMISPHERE", "LONGITUDE_DEGREES", "LONGITUDE_MINUTES",
                                  "LONGITUDE_HEMISPHERE")
    src = work_path(spark, "stream-src")
    sink = work_path(spark, "stream-sink")
    # two files arrive: the rows split by a column value
    rows.where(F.col("LATITUDE_DEGREES") < 40).write.mode("overwrite").parquet(src + "/part=1")
    rows.where(F.col("LATITUDE_DEGREES") >= 40).write.mode("overwrite").parquet(src + "/part=2")
    cells = geo.edge_cells(geo.zone_edges(zones_from_rows(spark)))
    q = start_tagging(spark, src + "/*", rows.schema, cells, sink,
                      checkpoint=work_path(spark, "stream-ckpt"), available_now=True)
    q.awaitTermination(300)
    streamed = spark.read.parquet(sink).select("ORIGINAL_BATCH_SEQUENCE_NUMBER", "lat_dd", "lon_dd", "within")
    batch = jobs.classify_sets(rows, cells).select("ORIGINAL_BATCH_SEQUENCE_NUMBER", "lat_dd", "lon_dd", "within")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0

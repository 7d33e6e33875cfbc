"""What the set, ledger and extract queries shuffle and write, on rows built here."""

import os
import re
import time

from pyspark.sql import functions as F

from fleetzone.operators import extract, rollup
from fleetzone.plans import jobs, registry
from fleetzone.session import passing_tables, work_path, write_table
from fleetzone.sources import files

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _set(spark, conf):
    kept = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return kept


def _exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def _chain(spark):
    trips = spark.createDataFrame([("t1", "v1"), ("t2", "v2"), ("t3", "v3"), (None, "v4"), ("t1", "v5")], "o string, v string")
    acts = spark.createDataFrame([("t1", "a1", 1), ("t1", "a1", 1), ("t1", "a2", 2), ("t2", "a1", 3), ("t2", None, 4), (None, "a3", 5),
                                  ("t9", "a2", 6)], "o string, k string, x int")
    gears = spark.createDataFrame([("a1", "g1"), ("a1", "g1"), ("a1", None), ("a2", "g7"), (None, "g1"), ("a3", "g1")],
                                  "k string, code string")
    codes = spark.createDataFrame([("g1", "one"), ("g1", "uno"), (None, "none")], "code string, name string")
    return trips, acts, gears, codes


def test_left_join_under_equals_left_joins_under_distinct(spark):
    """Repeated and missing keys, an activity of two trips, a code with two names and one without."""
    trips, acts, gears, codes = _chain(spark)
    columns = ["o", "v", "x", "code", "name"]
    want = trips.join(acts.join(gears.join(codes, "code", "left"), "k", "left"), "o", "left").select(*columns).distinct()
    got = trips.join(extract.left_join_under(acts, gears, "k", "o", codes, "code"), "o", "left").select(*columns).distinct()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_wide_rows_are_shuffled_once(spark):
    """Pairs, gears, codes twice, the union by owner and the trips: the trips' join and the DISTINCT add no shuffle of the sets."""
    trips, acts, gears, codes = _chain(spark)
    kept = _set(spark, NO_BROADCAST)
    try:
        got = trips.join(extract.left_join_under(acts, gears, "k", "o", codes, "code"), "o", "left").select("o", "v", "x", "code", "name").distinct()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        _set(spark, kept)
    wide = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_COL" in line]
    assert len(wide) == 2 and _exchanges(got) == 6, plan


def _logbook(spark):
    """150 trips with two sets each; every other column is one value."""
    def table(n, **columns):
        names = {"activities": jobs.TRIP_SET_COLUMNS[6:], "none": []}
        out = spark.range(n).select(*[F.expr(e).alias(k) for k, e in columns.items()])
        return out, names
    trips, _ = table(150, LOGBOOK_KEY="CAST(id AS STRING)", BATCH_NUMBER="'1'", SCHEDULE_NUMBER="CAST(id AS STRING)",
                     VESSEL_ID="CAST(id % 50 AS STRING)", LANDING_DATE="DATE'2020-01-01'")
    key = "concat('a', CAST(id AS STRING))"
    acts, names = table(300, LOGBOOK_KEY="CAST(id % 150 AS STRING)", FISHING_ACTIVITY_KEY=key, ORIGINAL_BATCH_SEQUENCE_NUMBER="CAST(id AS STRING)")
    acts = acts.select("*", *[F.lit("x").alias(c) for c in names["activities"]])
    gears, _ = table(300, FISHING_ACTIVITY_KEY=key, GEAR_FISHED_KEY="concat('g', CAST(id AS STRING))", GEAR_CODE_NMFS="'1'")
    catches, _ = table(300, GEAR_FISHED_KEY="concat('g', CAST(id AS STRING))", CATCH_KEY="concat('c', CAST(id AS STRING))",
                       AREA_FISHED="'x'", SPECIES_CODE_NMFS="'1'", TOTAL_WHOLE_POUNDS="1.0D")
    details, _ = table(300, CATCH_KEY="concat('c', CAST(id AS STRING))", NUMBER_OF_INDIVIDUALS="id", DISPOSITION_STATUS="'K'")
    codes, _ = table(1, GEAR_CODE_NMFS="'1'", GEAR_NAME="'line'", GEAR_CLASS="'l'")
    species, _ = table(1, SPECIES_CODE_NMFS="'1'", NMFS_COMMON="'f'", SCIENTIFIC_NAME="'F'", SPECIES_ITIS="'9'")
    qc, _ = table(150, SCHEDULE_NUMBER="CAST(id AS STRING)", DELETED_DATE="CAST(NULL AS DATE)")
    return {"trips": trips, "activities": acts, "gears": gears, "catches": catches, "catch_details": details, "gear_codes": codes,
            "species_codes": species, "trip_qc": qc}


def test_few_trips_read_written_levels(spark):
    """The rows of a fleet equal those of the whole extract; the lower tables are worked out once, not once per level below."""
    tables = _logbook(spark)
    whole = jobs.logbook_rows(tables, "01-JAN-2000").where("VESSEL_ID in ('3', '7')").distinct()
    few = jobs.logbook_rows(tables, "01-JAN-2000", fleet=["3", "7"])
    assert few.distinct().count() == whole.count() == 12
    assert few.distinct().exceptAll(whole).isEmpty()
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and not re.search(r"Range \(0, (150|300)", plan), plan


def test_split_counts_make_two_rows_of_one(spark):
    """Trips and sets with a flag: missing keys count as one, and no Expand by distinct column."""
    rows = [("v", "2020", t, s, f) for t, s, f in [("t1", "s1", "Y"), ("t1", "s2", "N"), (None, "s1", None), ("t2", None, "Y"), (None, None, "N")]]
    df = spark.createDataFrame(rows, "v string, d string, t string, s string, f string")
    got = rollup.trips_sets_counts(df, "v", "d", "t", "s", "f")
    assert [tuple(r) for r in got.collect()] == [("v", "2020", 3, 3, 2, 2, 1)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_compressed_csv_without_rebalance(spark):
    base = work_path(spark, "t-gzip")
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("n"), "id")).alias("s"),
                                 (F.col("id") % 4).cast("int").alias("y"))
    path = files.write_csv(df, base, "sets", "2022-12-05", partition_by=["y"], rebalance=False, compression="gzip")
    back = files.read_csv(spark, path, df.schema, partitions="y INT")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())


def test_left_chain_filtered_equals_left_joins_from_the_top(spark):
    """Repeated, missing and unmatched keys on every level."""
    trips, acts, gears, codes = _chain(spark)
    tables, keys = [trips, acts, gears, codes], ["o", "k", "code"]
    want = trips.join(acts.join(gears.join(codes, "code", "left"), "k", "left"), "o", "left")
    got = extract.left_chain_filtered(tables, keys).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_ordered_extract_shuffles_whole_rows_once_for_distinct_and_order(spark, monkeypatch):
    """Equal rows meet in the ranges of the order: no range shuffle after one for the DISTINCT, same rows in order."""
    rows = spark.range(300).selectExpr("cast(id % 7 as string) BATCH_NUMBER", "if(id % 5 = 0, null, cast(id % 11 as string)) SCHEDULE_NUMBER",
                                       "id % 3 x")
    monkeypatch.setattr(jobs, "logbook_rows", lambda *a, **k: rows)
    kept = _set(spark, NO_BROADCAST | {"spark.sql.shuffle.partitions": "4"})
    try:
        out = jobs.extract_logbook({}, "31-DEC-1995")
        assert _exchanges(out) == 0
        got = [tuple(r) for r in out.collect()]
    finally:
        _set(spark, kept)
    order = [(r[0], r[1] is not None, r[1] or "") for r in got]
    assert order == sorted(order)
    assert len(got) == len(set(got)) and set(got) == {tuple(r) for r in rows.collect()}


def test_wide_rows_of_a_left_join_once_are_shuffled_once(spark):
    _, acts, gears, _ = _chain(spark)
    kept = _set(spark, NO_BROADCAST | {"spark.sql.adaptive.enabled": "false"})
    try:
        plan = extract.left_join_once(acts.repartition(3), gears, "k", acts, gears)._jdf.queryExecution().executedPlan().toString()
    finally:
        _set(spark, kept)
    assert len(re.findall(r"Exchange hashpartitioning\(k#", plan)) == 4      # both sides' rows and both sides' keys


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", blocks.getAllFiles().mkString(" ")))


def _passing(spark):
    tables = work_path(spark, "tables")
    return [d for d in os.listdir(tables) if d.startswith("passing-")] if os.path.isdir(tables) else []


def _left_over(spark, before):
    """Shuffle files since ``before``, once Spark had time to delete them."""
    for _ in range(50):
        if not (now := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return now


def test_written_tables_leave_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = _shuffle_files(spark)
    out = write_table([df.where("k < 3"), df.where("k >= 3").select("count", "k")], "t-parts")
    path = files.write_csv(df, work_path(spark, "t-dropped"), "counts", "2022-12-05")
    assert not _left_over(spark, before)
    want = sorted(map(tuple, df.collect()))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, files.read_csv(spark, path, df.schema).collect())) == want


def test_left_chain_filtered_writes_level_by_level(spark):
    """What is left to do is to read the result: the levels' tables and shuffles are gone; only named columns are kept."""
    trips, acts, gears, codes = _chain(spark)
    before = _shuffle_files(spark)
    got = extract.left_chain_filtered([trips, acts, gears, codes], ["o", "k", "code"], ["o", "v", "x", "name"])
    assert sorted(got.columns) == ["name", "o", "v", "x"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan, plan
    assert not _left_over(spark, before) and not _passing(spark)


def test_set_parts_are_the_sets(spark):
    """Every distinct set in one part: repeated rows, trips without a set or without a key, sets without a gear."""
    tables = _logbook(spark)
    date = "DATE'2020-01-01'"
    tables["trips"] = tables["trips"].unionByName(tables["trips"].limit(9)).unionByName(
        spark.sql(f"SELECT k LOGBOOK_KEY, '1' BATCH_NUMBER, 's' SCHEDULE_NUMBER, 'v' VESSEL_ID, {date} LANDING_DATE FROM VALUES ('lone'), (null) t(k)"))
    acts = tables["activities"]
    tables["activities"] = acts.unionByName(acts.limit(9)).unionByName(acts.limit(5).withColumns(
        {"FISHING_ACTIVITY_KEY": F.lit(None).cast("string"), "ORIGINAL_BATCH_SEQUENCE_NUMBER": F.lit("no gear")}))
    want = jobs.set_level(jobs.logbook_rows(tables, "01-JAN-2000", level="gears"))
    with passing_tables(spark) as folder:
        parts = jobs.set_parts(tables, "01-JAN-2000", folder)
        assert len(parts) > 1 and all(0 < p.count() < want.count() for p in parts)
        got = write_table(parts, "t-sets")
    assert got.columns == want.columns and got.count() == want.count() == 307
    assert got.exceptAll(want).isEmpty() and not _passing(spark)


def test_queries_write_sets_in_parts(spark, tmp_path):
    """csv_roundtrip, extract_by_year and tag_sets write part after part and keep all of them."""
    tables, seen = _logbook(spark), []
    tables["activities"] = tables["activities"].withColumns(
        {f"{x}_{y}": F.lit(40.0) for x in ("LATITUDE", "LONGITUDE") for y in ("DEGREES", "MINUTES")})
    c = registry.Ctx(spark, str(tmp_path))
    c.set_parts = lambda folder: seen.append(folder) or jobs.set_parts(tables, "01-JAN-2000", folder)
    c.sets = c.classified = None
    c.second = lambda: spark.sql("SELECT 2020 LANDING_YEAR, DATE'2020-12-31' LANDING_DATE")
    assert registry.q_csv_roundtrip(c).count() == registry.q_extract_by_year(c).count() == registry.q_tag_sets(c).count() == 300
    assert len(seen) == 3 and not _passing(spark)

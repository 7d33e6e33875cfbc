"""Matching, extracts, reshaping, files (fixture rows with NULLs)."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from fleetzone.operators import extract, match, profile, reshape, rollup
from fleetzone.plans import jobs
from fleetzone.session import work_path
from fleetzone.sources import files


def test_null_keys_match_in_existence_flags(spark):
    df = spark.createDataFrame([(None, "d1"), ("v1", "d1"), ("v2", "d2")], "v string, d string")
    keys = spark.createDataFrame([(None, "d1"), ("v2", "d9")], "v string, d string")
    out = match.exists_flag(df, keys, ["v", "d"], "hit").orderBy("v", "d").collect()
    assert [(r.v, r.hit) for r in out] == [(None, True), ("v1", False), ("v2", False)]


def test_either_key_cases(spark):
    dealer = spark.createDataFrame(
        [("1", "t1", "v1", "2020-01-01"), ("2", "t9", "v2", "2020-02-02"), ("3", "t3", "v3", "2020-03-03"),
         ("4", "t8", "v8", "2020-08-08"), ("5", None, "v9", "2020-09-09")],
        "id string, trip string, v string, d string")
    keys = spark.createDataFrame(
        [("t1", "v0", "2000-01-01"), ("t7", "v2", "2020-02-02"), ("t3", "v3", "2020-03-03")],
        "trip string, v string, d string")
    out = match.either_flag(dealer, keys.select("v", "d"), ["v", "d"], keys.select("trip"), "trip", "m")
    got = {r.id: r.m for r in out.collect()}
    assert got == {"1": True, "2": True, "3": True, "4": False, "5": False}


def test_flags_plan_without_nested_loop(spark):
    dealer = spark.range(100).select(F.col("id").cast("string").alias("trip"),
                                     (F.col("id") % 7).cast("string").alias("v"))
    keys = spark.range(50).select(F.col("id").cast("string").alias("trip"),
                                  (F.col("id") % 5).cast("string").alias("v"))
    out = match.either_flag(dealer, keys.select("v"), "v", keys.select("trip"), "trip", "m")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_override_with_null_trip(spark):
    keys = spark.createDataFrame([("7", dt.date(2020, 1, 1)), ("8", dt.date(2020, 1, 2)),
                                  (None, dt.date(2020, 1, 3))], "SCHEDULE_NUMBER string, LANDING_DATE date")
    ov = spark.createDataFrame([("7", dt.date(2021, 8, 30))], "SCHEDULE_NUMBER string, d date")
    got = {r.SCHEDULE_NUMBER: r.dealer_date for r in jobs.with_dealer_date(keys, ov).collect()}
    assert got == {"7": dt.date(2021, 8, 30), "8": dt.date(2020, 1, 2), None: None}


def test_conflicting_overrides_keep_one_row(spark):
    keys = spark.createDataFrame([("7", dt.date(2020, 1, 1))], "SCHEDULE_NUMBER string, LANDING_DATE date")
    ov = spark.createDataFrame([("7", dt.date(2021, 8, 30)), ("7", dt.date(2021, 9, 1)), (None, dt.date(2022, 1, 1))],
                               "SCHEDULE_NUMBER string, d date")
    assert [r.dealer_date for r in jobs.with_dealer_date(keys, ov).collect()] == [dt.date(2021, 9, 1)]


def test_pivot_keeps_every_given_year(spark):
    counts = spark.createDataFrame([("v", "1996", 1), ("v", "2002", 5), ("w", None, 2)],
                                   "VESSEL_ID string, YEAR string, n int")
    got = {r.VESSEL_ID: r.asDict() for r in jobs.wide_by_year(counts, "n", ["1996", "2002"]).collect()}
    assert got["v"]["2002"] == 5 and got["v"]["1996"] == 1 and got["w"]["2002"] is None


def test_work_folder_must_be_set_off_a_local_master(monkeypatch):
    import pytest
    from fleetzone import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(RuntimeError):
        session.ensure_work_dir(Fake)


def test_match_tally(spark):
    audit = spark.createDataFrame([("x", None, "x"), (None, None, "x")],
                                  "sch_in_edlr string, ves_date_in_edlr string, ves_date_in_bft string")
    assert sorted(tuple(r) for r in jobs.match_tally(audit).collect()) == [
        ("sch_in_edlr", False, 1), ("sch_in_edlr", True, 1), ("ves_date_in_bft", True, 2), ("ves_date_in_edlr", False, 2)]


def test_left_join_isnull_cases(spark):
    trips = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    qc = spark.createDataFrame([("b", None), ("c", "x"), ("d", None), ("d", "x")], "k string, deleted string")
    literal = extract.left_join_isnull(trips, qc, "k", "deleted").distinct()
    rewritten = extract.drop_all_flagged(trips, qc, "k", "deleted").distinct()
    assert sorted(r.k for r in literal.collect()) == ["a", "b", "d"]
    assert sorted(r.k for r in rewritten.collect()) == ["a", "b", "d"]


def test_string_ids_side_by_side(spark):
    df = spark.createDataFrame([("QX0001ZZ",), ("1000001",), ("42",)], "VESSEL_ID string")
    assert sorted(r.VESSEL_ID for r in extract.keep_ids(df, "VESSEL_ID", ["QX0001ZZ", 1000001]).collect()) == \
        ["1000001", "QX0001ZZ"]
    ids = spark.createDataFrame([("QX0001ZZ",)], "x string")
    assert [r.VESSEL_ID for r in extract.keep_ids(df, "VESSEL_ID", ids).collect()] == ["QX0001ZZ"]
    u = reshape.union_by_name(df, spark.createDataFrame([(1000001,)], "VESSEL_ID long"),
                              string_cols=["VESSEL_ID"])
    assert sorted(r.VESSEL_ID for r in u.collect()) == ["1000001", "1000001", "42", "QX0001ZZ"]


def test_semi_join_plans_as_left_semi(spark):
    h = spark.range(20).select(F.col("id").cast("string").alias("TRIP_NUMBER"))
    k = spark.range(5).select(F.col("id").cast("string").alias("TRIP_NUMBER"))
    plan = extract.semi_join(h, k, "TRIP_NUMBER")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


LEDGER = "v string, d string, y int, sp string, f int, dw decimal(18,2), rev decimal(18,2)"


def _parts(spark, rows, skip):
    """Partial sums of ledger rows; the flag follows from the date, as after a match."""
    df = spark.createDataFrame(rows, LEDGER)
    keys = {"VESSEL_ID": F.col("v"), "LANDED": F.col("d"), "YEAR": F.col("y"), "COMMON_NAME": F.col("sp"), "in_area": F.col("f")}
    return rollup.partial_sums(df, keys, F.col("dw"), F.col("rev"), skip_revenue=skip).withColumn("ledger", F.lit(1))


def test_pivot_fill_absent_zero_present_null_stays(spark):
    rows = [("v1", "a", 1, "s", 1, Decimal("5.00"), Decimal("1.00")),      # only flag 1 present
            ("v2", "a", 1, "s", 0, None, Decimal("2.00")), ("v2", "b", 1, "s", 1, Decimal("3.00"), Decimal("4.00")),
            ("v3", "a", 1, "s", 0, None, None), ("v3", "b", 1, "s", 0, Decimal("1.00"), Decimal("7.00"))]
    for skip in (True, False):
        out = rollup.landings(_parts(spark, rows, skip), ["VESSEL_ID"]).collect()
        got = {r.VESSEL_ID: (r.DW_LBS_OUT, r.DW_LBS_IN, r.REVENUE_OUT, r.REVENUE_IN) for r in out}
        assert got["v1"] == (0, Decimal("5.00"), 0, Decimal("1.00"))
        assert got["v2"] == (None, Decimal("3.00"), Decimal("2.00"), Decimal("4.00"))
        assert got["v3"] == (None, 0, Decimal("7.00") if skip else None, 0)


def test_landings_grains_equal_their_single_passes(spark):
    """NULL keys, missing amounts, two ledgers under one species name."""
    rnd = random.Random(4)
    rows = [(rnd.choice(["v1", "v2", None]), rnd.choice("abcd"), rnd.choice([2019, 2020, None]), rnd.choice(["s", "t", None]),
             rnd.randint(0, 1), rnd.choice([None] + [Decimal(k) for k in range(9)]), Decimal(rnd.randint(0, 99))) for _ in range(300)]
    parts = _parts(spark, rows[:200], True).unionByName(_parts(spark, rows[200:], False).withColumn("ledger", F.lit(2)))
    sheets = {}
    for r in rollup.landings_grains(parts).collect():
        sheets.setdefault(r.sheet, []).append(tuple(r)[1:])
    for name, keys in rollup.GRAINS.items():
        single = rollup.landings(parts, [*keys, "ledger"] if len(keys) == 3 else keys)
        blank = [F.lit(None).alias(c) for c in ("YEAR", "COMMON_NAME") if c not in keys]
        want = single.select("*", *blank).select("VESSEL_ID", "YEAR", "COMMON_NAME", "DW_LBS_OUT", "DW_LBS_IN", "REVENUE_OUT", "REVENUE_IN")
        assert sorted(map(repr, sheets[name])) == sorted(repr(tuple(r)) for r in want.collect())
    total = sum(r[6] for r in rows)
    assert sum(r[5] + r[6] for r in sheets["Vessel"]) == total


def test_ledger_rows_meet_the_match_as_partial_sums(spark):
    """Below the join against the trip keys the ledger is aggregated before its one exchange."""
    d = spark.createDataFrame([], "SUPPLIER_VESSEL_ID string, DATE_LANDED date, YEAR_OF_LANDING int, COMMON_NAME_AS_REPORTED string, "
                                  "converted_dw decimal(18,2), TOTAL_DOLLARS decimal(18,2), not_included string")
    plan = jobs.dealer_parts(d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_sum")        # printed from the top: summed below the exchange


def test_pivot_then_sum_equals_plain_sum(spark):
    rows = [(str(i % 7), "abc"[i % 3], 2020, "s", i % 2, Decimal(i * 3), Decimal(i)) for i in range(200)]
    p = rollup.landings(_parts(spark, rows, False), ["VESSEL_ID"])
    total = p.agg(F.sum(F.col("DW_LBS_OUT") + F.col("DW_LBS_IN"))).first()[0]
    assert total == sum(i * 3 for i in range(200))


def test_unpivot_drops_incomplete_pairs(spark):
    df = spark.createDataFrame([("h1", 1.0, 2.0, 3.0, None, None, None)],
                               "k string, a_lat double, a_lon double, b_lat double, b_lon double, "
                               "c_lat double, c_lon double")
    long = reshape.unpivot_positions(df, "k", {"a": ("a_lat", "a_lon"), "b": ("b_lat", "b_lon"),
                                               "c": ("c_lat", "c_lon")})
    assert long.count() == 3
    assert [tuple(r) for r in long.na.drop("any").collect()] == [("h1", 1.0, 2.0, "a")]


def test_frequency_and_null_profile(spark):
    df = spark.createDataFrame([("N", 1.0), ("N", None), (None, float("nan"))], "h string, x double")
    assert {r.h: r.n for r in profile.frequency_table(df, "h").collect()} == {"N": 2}
    prof = {r.column_name: (r.n_missing, r.n_present) for r in profile.null_profile(df, ["h", "x"]).collect()}
    assert prof == {"h": (1, 2), "x": (2, 1)}


def test_preview_orders_before_limit(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("x"))
    assert [r.x for r in profile.preview(df, ["x"], 3).collect()] == [0, 1, 2]


def test_csv_roundtrip_and_newest_file(spark):
    base = work_path(spark, "t-files")
    df = spark.createDataFrame([("a", None, dt.date(2020, 1, 2)), ("b", 1.5, None)], "k string, x double, d date")
    files.write_csv(df.limit(1), base, "obs_hauls", "2022-12-01")
    files.write_csv(df, base, "obs_hauls", "2022-12-05")
    files.write_csv(df, base, "obs_trips", "2022-12-07")
    files.write_csv(df, base, "other", "2022-12-09")
    found = files.latest_datasets(spark, base, r"^obs_")
    assert sorted(found) == ["obs_hauls", "obs_trips"]
    assert found["obs_hauls"].endswith("run_date=2022-12-05")
    back = files.read_csv(spark, found["obs_hauls"], df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_left_join_split_equals_left_join(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, tv int")
    a = spark.createDataFrame([("a", 10), ("a", 11), ("c", 30), ("z", 99), (None, 0)], "k string, av int")
    want = sorted(map(tuple, t.join(a, "k", "left").select("k", "tv", "av").collect()), key=str)
    got = sorted(map(tuple, extract.left_join_split(t, a, "k").select("k", "tv", "av").collect()), key=str)
    assert got == want


def test_literal_table_is_jvm_side(spark):
    from fleetzone.sources.literal import literal_table
    df = literal_table(spark, "k string, d date, xs array<double>",
                       [("a", dt.date(2020, 1, 2), [1.0, 2.0]), (None, None, None)])
    assert [tuple(r) for r in df.collect()] == [("a", dt.date(2020, 1, 2), [1.0, 2.0]), (None, None, None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonRDD" not in plan and "ExistingRDD" not in plan


def _chain_tables(spark):
    """3,000 trips of which 30% are lonely, sets without gears, gears without catches, one set with a third of all gears."""
    n, hot = 3000, 4000
    trips = spark.range(n).select(F.col("id").cast("string").alias("LOGBOOK_KEY"), (F.col("id") % 7).cast("string").alias("VESSEL_ID"))
    acts = spark.range(n).where("id % 10 >= 3").select(F.col("id").cast("string").alias("LOGBOOK_KEY"),
                                                       F.concat(F.lit("a"), "id").alias("FISHING_ACTIVITY_KEY"))
    gears = spark.range(2 * n + hot).where("id % 5 > 0 or id >= 6000").select(
        F.when(F.col("id") >= 2 * n, F.lit("a13")).otherwise(F.concat(F.lit("a"), (F.col("id") % n).cast("string"))).alias("FISHING_ACTIVITY_KEY"),
        F.concat(F.lit("g"), "id").alias("GEAR_FISHED_KEY"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    catches = spark.range(2 * n + hot).where("id % 4 > 0").select(F.concat(F.lit("g"), "id").alias("GEAR_FISHED_KEY"),
                                                                  F.col("id").alias("pounds"))
    return [trips, acts, gears, catches], ["LOGBOOK_KEY", "FISHING_ACTIVITY_KEY", "GEAR_FISHED_KEY"]


def test_left_chain_equals_left_joins_from_the_top(spark):
    tables, keys = _chain_tables(spark)
    nulls = [t.unionByName(spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema]))
             for t in tables]                                                                    # NULL keys match nothing
    want = nulls[0]
    for t, k in zip(nulls[1:], keys):
        want = want.join(t, k, "left")
    got = extract.left_chain(nulls, keys).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_left_chain_is_balanced(spark):
    """Neither the rows without a match nor the hot set meet in one task."""
    tables, keys = _chain_tables(spark)
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    kept = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    # Written in many files, so that a hot partition has many map outputs to be split by.
    tables = [spark.read.parquet(_saved(t.repartition(8), f"chain-{i}", spark)) for i, t in enumerate(tables)]
    try:
        rows = extract.left_chain(tables, keys)
        sizes = _rows_a_task(rows)
        below = extract.left_join_split(tables[2], tables[3], keys[2])
        from_top = tables[0].join(tables[1], keys[0], "left").join(below, keys[1], "left")
        before = _rows_a_task(from_top)
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == sum(before)
    assert max(before) > 4000 and max(sizes) < 2000


def _rows_a_task(df):
    """Rows of each task, all columns read (pruned rows would be too small to be split)."""
    rows = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns))).collect()
    return [r.n for r in rows]


def _saved(df, name, spark):
    path = work_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path


def test_match_audit_reads_each_ledger_once_and_spreads_missing_keys(spark):
    """A third of the trips without an id; NULL keys match NULL keys; repeated ledger rows."""
    d = dt.date
    trips = [("v1", d(2020, 1, 1), "t1"), ("v2", d(2020, 1, 2), "t2"), (None, d(2020, 1, 3), "t3"), ("v4", None, "t4")]
    trips += [(f"v{i % 9}", d(2020, 2, 1 + i % 28), None if i % 3 == 0 else f"s{i}") for i in range(300)]
    dealer = [("t1", "x", d(2020, 1, 1)), ("t1", "v2", d(2020, 1, 2)), ("q", None, d(2020, 1, 3)), (None, "v1", d(2020, 2, 3))] * 3
    dealer += [(f"s{i}", f"v{i % 5}", d(2020, 2, 1 + i % 14)) for i in range(0, 300, 7)]
    second = [("v4", None), (None, d(2020, 1, 3)), ("t1", d(2020, 1, 1))] + [(f"v{i % 4}", d(2020, 2, 1 + i % 28)) for i in range(40)]
    t = spark.createDataFrame(trips, "VESSEL_ID string, LANDING_DATE date, SCHEDULE_NUMBER string").distinct()
    dl = spark.createDataFrame(dealer, "TRIP_ID string, SUPPLIER_VESSEL_ID string, DATE_LANDED date")
    sl = spark.createDataFrame(second, "COAST_GUARD_NBR string, LANDING_DATE date")
    ids, pairs, spairs = {r[0] for r in dealer}, {r[1:] for r in dealer}, set(second)
    for ledger in (dl, dl.where("TRIP_ID is not null")):            # with and without a NULL id to match
        known = ids if ledger is dl else ids - {None}
        seen = pairs if ledger is dl else {r[1:] for r in dealer if r[0] is not None}
        out = jobs.match_audit(t, ledger, sl)
        want = {(v, x, s): (s in known, (v, x) in seen, (v, x) in spairs) for v, x, s in trips}
        got = {tuple(r)[:3]: tuple(c is not None for c in tuple(r)[3:]) for r in out.collect()}
        assert got == want
    for name, frame in (("d", dl), ("s", sl)):
        path = _saved(frame, f"audit-{name}", spark)
        frame = spark.read.parquet(path)
        dl, sl = (frame, sl) if name == "d" else (dl, frame)
    plan = jobs.match_audit(t, dl, sl)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "NestedLoop" not in plan


def test_exists_flag_spreads_missing_keys(spark):
    """Half the rows have no key: they are flagged alike and spread over the join's tasks."""
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("n"))
    for keys, hit in (([("4",), (None,)], True), ([("4",)], False)):
        rows = match.exists_flag(df, spark.createDataFrame(keys, "k string"), "k", "f").collect()
        assert len(rows) == 2000
        assert all(r.f == (hit if r.k is None else r.k == "4") for r in rows)
    salts = df.where("k is null").select(match._row_salt(match._missing(["k"]), df.columns).alias("p")).distinct().count()
    assert salts == match.NULL_SPREAD


def test_leading_row_number_column_is_read_by_position_and_dropped(spark):
    """Extracts written with row names: an unnamed first column, quoted names, NA as missing."""
    base = work_path(spark, "row-numbers")
    text = ['"","VESSEL_ID","QUANTITY","NOTE"', '"1","QX0001ZZ",12.5,"a, b"', '"2",NA,NA,NA', '"10","1000001",0,"x"']
    spark.createDataFrame([(x,) for x in text], "value string").coalesce(1).write.mode("overwrite").text(base)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("VESSEL_ID", T.StringType()), T.StructField("QUANTITY", T.DoubleType()),
                           T.StructField("NOTE", T.StringType())])
    back = files.read_csv(spark, base, schema, row_number_column=True)
    assert back.columns == ["VESSEL_ID", "QUANTITY", "NOTE"] and len(back.columns) == len(schema.fields)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [("QX0001ZZ", 12.5, "a, b"), (None, None, None), ("1000001", 0.0, "x")], key=str)


def test_work_tables_of_other_applications_are_left_alone(spark):
    import os
    from fleetzone.session import ensure_work_dir, remove_work_tables, write_table
    other = os.path.join(ensure_work_dir(spark), "fleetzone-other", "tables", "t")
    spark.range(3).write.mode("overwrite").parquet(other)
    mine = write_table(spark.range(5).toDF("n"), "mine")
    assert mine.count() == 5 and f"fleetzone-{spark.sparkContext.applicationId}" in mine.inputFiles()[0]
    probe = work_path(spark)
    assert os.path.isdir(probe) and spark.read.parquet(other).count() == 3
    assert os.path.commonpath([probe, other]) == ensure_work_dir(spark)
    assert callable(remove_work_tables)


def test_newest_run_is_chosen_in_the_scan(spark):
    """Three stamps, two datasets, a spoilt stamp and an empty folder: only the newest run's files are opened."""
    import os
    base = work_path(spark, "t-newest")
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    for n, stamp in enumerate(["2022-12-05", "2021-01-09", "2022-11-30"]):
        files.write_csv(df.withColumn("n", F.lit(n)), base, "obs hauls", stamp)
    files.write_csv(df, base, "obs_trips", "2022-12-09")
    files.write_csv(df, base, "obs_trips", "2022-13-40")
    os.makedirs(f"{base}/obs_trips/run_date=2023-01-01")
    got = {r.dataset: (str(r.run_date), r.path.split("/t-newest/")[1]) for r in files.latest_runs(spark, base).collect()}
    assert got == {"obs hauls": ("2022-12-05", "obs hauls/run_date=2022-12-05"),
                   "obs_trips": ("2022-12-09", "obs_trips/run_date=2022-12-09")}
    assert list(files.latest_datasets(spark, base, "hauls")) == ["obs hauls"]
    back = files.read_latest(spark, base, "obs hauls", df.schema)
    assert [tuple(r) for r in back.collect()] == [("a", 0)]
    plan = back._jdf.queryExecution().explainString(back._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "subquery" in plan.split("PartitionFilters")[1].split("\n")[0].lower()
    nothing = work_path(spark, "t-newest-none")
    os.makedirs(nothing)
    assert files.latest_datasets(spark, nothing) == {}


def _metrics(df, name):
    """Sum of a metric over the scans of the run plan."""
    def walk(node):
        out = [node]
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return out + walk(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return out + walk(node.plan())
        for i in range(node.children().size()):
            out += walk(node.children().apply(i))
        return out
    return [n.metrics().apply(name).value() for n in walk(df._jdf.queryExecution().executedPlan())
            if n.nodeName().startswith("Scan csv")]


def test_extract_by_year_reads_only_the_folders_it_needs(spark):
    """Filters on the year prune folders when planned; a semi join with a small written table while running."""
    base = work_path(spark, "t-by-year")
    df = spark.range(600).select(F.col("id").cast("string").alias("k"), (F.col("id") % 6 + 1990).cast("int").alias("YEAR"),
                                 F.lit(2.5).alias("x"))
    df = df.unionByName(spark.createDataFrame([("none", None, None)], "k string, YEAR int, x double"))
    path = files.write_csv(df, base, "sets", "2022-12-05", partition_by=["YEAR"])
    back = files.read_csv(spark, path, df.schema, partitions="YEAR INT")
    assert back.columns == df.columns
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    static = back.where("YEAR >= 1993")
    assert static.count() == 300
    static.collect()
    assert _metrics(static, "numPartitions") == [3]
    keys = spark.createDataFrame([(1991, 12), (1993, 8), (1994, 12), (1995, 3), (None, 12)], "YEAR int, last int")
    dynamic = files.keep_partitions(static, "YEAR", keys, "last = 12")
    assert {r.YEAR for r in dynamic.collect()} == {1994} and dynamic.columns == df.columns
    assert _metrics(dynamic, "numPartitions") == [1]


def test_unproject_is_the_inverse_of_project(spark):
    from fleetzone.operators import geo
    p = spark.range(0, 4000).select((F.lit(-130.0) + F.col("id") % 80 * 0.91).alias("lon"),
                                    (F.lit(18.0) + F.floor(F.col("id") / 80) * 0.77).alias("lat"))
    x, y = geo.project("lon", "lat")
    lon, lat = geo.unproject("x", "y")
    worst = p.withColumns({"x": x, "y": y}).agg(F.max(F.abs(lon - F.col("lon"))).alias("a"), F.max(F.abs(lat - F.col("lat"))).alias("b")).first()
    assert worst.a < 1e-9 and worst.b < 1e-9
    assert spark.range(1).select(*geo.unproject(F.lit(None).cast("double"), F.lit(1.0))).first()[1] is None

"""

Usage: python tools/bench_variants.py [sf_dir] [section ...]   (default: all sections)

1. trips-and-sets report: fused aggregate vs four aggregates + three merges
2. zone tagging of every logbook set row: 2 / 100 / 1,000 zones, cells
   broadcast vs shuffle-joined; longest edge list of a cell
3. either-key flag: two existence joins vs one join on ``a OR b``
4. the logbook extract without and with the two unused joins

Prints one line per measurement (best of ``$BENCH_RUNS``, default two, warm runs, ``noop`` sink; what a
query writes while it is built is part of its time).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fleetzone.operators import geo, match  # noqa: E402
from fleetzone.plans import jobs  # noqa: E402
from fleetzone.plans import registry as R  # noqa: E402
from fleetzone.session import local_session  # noqa: E402
from fleetzone.sources.zones import TEST_ZONES, ZONE_SCHEMA  # noqa: E402


def grid_zones(n: int) -> list:
    """``n`` square zones (0.2 degree) on a regular grid over the survey box."""
    out = list(TEST_ZONES)
    side = int(n ** 0.5) + 1
    for i in range(max(n - len(out), 0)):
        x0 = -71.0 + (i % side) * (9.0 / side)
        y0 = 37.5 + (i // side) * (5.0 / side)
        out.append((f"G{i}", f"grid {i}", [(x0, y0), (x0 + 0.2, y0), (x0 + 0.2, y0 + 0.2), (x0, y0 + 0.2)]))
    return out[:n]


RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def timed(make, runs: int = RUNS) -> float:
    """Least time to build and run the query that ``make`` returns."""
    best = float("inf")
    for _ in range(runs):
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - t0)
    return round(best, 2)


def reports(spark, c: R.Ctx, sf_dir: str) -> None:
    qs = R.queries()
    print("report fused (final_trips_sets)", timed(lambda: qs["final_trips_sets"](spark, sf_dir)), "s")
    print("report literal merges (merge_full_outer)", timed(lambda: qs["merge_full_outer"](spark, sf_dir)), "s")


def tagging(spark, c: R.Ctx, sf_dir: str) -> None:
    rows = jobs.with_positions(c.logbook_rows("sets"))
    n_rows = rows.count()
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for n in (2, 100, 1000):
        edges = geo.zone_edges(spark.createDataFrame(grid_zones(n), ZONE_SCHEMA))
        t0 = time.perf_counter()
        cells = geo.edge_cells(edges)
        build = time.perf_counter() - t0
        longest = cells.dist_cells.agg(F.max(F.size("d_edges"))).first()[0]
        rays = cells.ray_cells.agg(F.max(F.aggregate("r_zones", F.lit(0), lambda k, z: k + F.size(z["edges"])))).first()[0]
        for label, limit in (("by size", None), ("shuffled", "-1")):
            before = {k: spark.conf.get(k) for k in names}
            for k in names:
                spark.conf.set(k, limit or before[k])
            run = timed(lambda: geo.classify(rows, "lon_dd", "lat_dd", cells).select("within", "zones_in"))
            print(f"tagging {n_rows} rows, {n} zones, cells joined {label}: build {build:.2f} s, "
                  f"run {run} s, longest distance list {longest}, ray list {rays}", flush=True)
            for k in names:
                spark.conf.set(k, before[k])


def unused_joins(spark, c: R.Ctx, sf_dir: str) -> None:
    def without():
        return c.logbook_rows().distinct()

    def joined():
        wide = c.logbook_rows(keep_gear_key=True).join(c.tb.gear_descriptions(), "GEAR_FISHED_KEY", "left")
        return wide.join(c.tb.gear_parameters(), "GEAR_PARAMETER_CODE", "left").select(*without().columns).distinct()
    print("logbook extract without the two unused joins", timed(without), "s", flush=True)
    print("logbook extract with the two unused joins", timed(joined), "s", flush=True)


def either_key(spark, c: R.Ctx, sf_dir: str) -> None:
    dealer, keys = c.dealer(), c.trip_keys()

    def two():
        return match.either_flag(dealer, keys.select("VESSEL_ID", "LANDING_DATE"),
                                 [("SUPPLIER_VESSEL_ID", "VESSEL_ID"), ("DATE_LANDED", "LANDING_DATE")],
                                 keys.select("SCHEDULE_NUMBER"), [("TRIP_ID", "SCHEDULE_NUMBER")], "m")
    k = keys.distinct().withColumn("__hit", F.lit(True))
    cond = ((dealer.SUPPLIER_VESSEL_ID.eqNullSafe(k.VESSEL_ID) & dealer.DATE_LANDED.eqNullSafe(k.LANDING_DATE))
            | dealer.TRIP_ID.eqNullSafe(k.SCHEDULE_NUMBER))
    one = (dealer.join(k, cond, "left").groupBy(*[dealer[x] for x in dealer.columns])
                 .agg(F.max(F.coalesce("__hit", F.lit(False))).alias("m")))
    print("either-key: two existence joins", timed(two), "s", flush=True)
    plan = one._jdf.queryExecution().executedPlan().toString()
    kind = "nested loop" if "NestedLoop" in plan else "equi-join"
    print(f"either-key: one OR join ({kind})", timed(lambda: one, 1), "s")


SECTIONS = {"reports": reports, "tagging": tagging, "unused_joins": unused_joins, "either_key": either_key}


def main() -> None:
    args = sys.argv[1:]
    sf_dir = next((a for a in args if "/" in a), "/root/testdata/sf0.1")
    spark = local_session(shuffle_partitions=16)
    timed(lambda: R.queries()["final_trips_sets"](spark, sf_dir), 1)        # warm-up
    for name in [a for a in args if a in SECTIONS] or SECTIONS:
        SECTIONS[name](spark, R.Ctx(spark, sf_dir), sf_dir)


if __name__ == "__main__":
    main()

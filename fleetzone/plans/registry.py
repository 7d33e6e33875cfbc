"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver's tables through ``StandIns`` (whole tables)
and the two test zones.  Counts are returned as BIGINT and money as
DOUBLE so results compare across engines; keys are STRING.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import na
from ..functions.coords import lat_dd, lon_dd
from ..functions.text import clean_column_names, first_part, label, year_text
from ..operators import extract, geo, match, profile, reshape, rollup
from ..session import passing_tables, work_path, write_table
from ..sources import files
from ..sources.literal import literal_table
from ..sources.testbed import StandIns
from ..sources.zones import zone_names, zones_from_rows
from . import jobs

# Fixed run parameters of the registered queries.
LANDED_AFTER = "31-DEC-1995"
VIEW_AFTER_YEAR = 1995
SECOND_AFTER_YEAR = 1995
REREAD_FROM_YEAR = 1997
FLEET = ["11", "23", "37", "101", "233", "997", "QX0001ZZ"]
OBS_VESSEL = "BUILDING"
OVERRIDES = [("7", "1996-02-01"), ("100", "1997-03-04"), ("2021", "1999-09-09")]


_CELLS: dict = {}


class Ctx:
    """Lazily built, shared intermediate plans for one (spark, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tb = StandIns(spark, sf_dir)
        self._keys = None

    # zones -----------------------------------------------------------
    def zones(self) -> DataFrame:
        return zones_from_rows(self.spark)

    def cells(self) -> geo.EdgeCells:
        """Edge cells of the zone layer, built and written once per session
        (the layer is fixed)."""
        key = (self.spark.sparkContext.applicationId, id(self.spark))
        if key not in _CELLS:
            _CELLS[key] = geo.edge_cells(geo.zone_edges(self.zones()))
        return _CELLS[key]

    # logbook -----------------------------------------------------------
    def logbook_rows(self, level: str = "catches", **kw) -> DataFrame:
        return jobs.logbook_rows(self.tb.logbook_tables(), LANDED_AFTER, level=level, **kw)

    def sets(self) -> DataFrame:
        return jobs.set_level(self.logbook_rows("gears"))

    def set_parts(self, folder: str) -> list[DataFrame]:
        """``sets`` in parts, for queries that write them."""
        return jobs.set_parts(self.tb.logbook_tables(), LANDED_AFTER, folder)

    def classified(self) -> DataFrame:
        return jobs.classify_sets(self.sets(), self.cells())

    def narrow(self) -> DataFrame:
        """Trip and set rows with zone flags: no lookups, no set-level
        DISTINCT, which no distinct count or "any row" needs."""
        return jobs.classify_sets(self.logbook_rows("sets"), self.cells())

    def tagged(self, columns: list[str]) -> DataFrame:
        """Classified sets tagged by key; written once, since the hit keys
        come from the same rows."""
        with passing_tables(self.spark) as folder:
            parts = [jobs.classify_sets(p, self.cells()).select(*columns, "within") for p in self.set_parts(folder)]
            rows = write_table(parts, "classified")
        return jobs.tag_by_key(rows, rows)

    def years(self) -> list[str]:
        """Landing years of the extracted trips (narrow columns of the trips
        and their QC rows only)."""
        t = self.tb.trips().where(F.col("LANDING_DATE") > F.to_date(F.lit(LANDED_AFTER), "dd-MMM-yyyy"))
        t = extract.drop_all_flagged(t, self.tb.trip_qc(), "SCHEDULE_NUMBER", "DELETED_DATE")
        return sorted(r[0] for r in t.select(year_text("LANDING_DATE").alias("y")).distinct().collect() if r[0])

    def trip_keys(self) -> DataFrame:
        """Trips with a set within the buffer, from the narrow logbook rows:
        the distinct (vessel, landing date, trip) of the rows within is the
        same."""
        return jobs.trip_keys(self.narrow())

    def written_keys(self) -> DataFrame:
        """``trip_keys`` for the queries that match against them more than
        once: written once to the shared folder and read back from there."""
        if self._keys is None:
            self._keys = write_table(self.trip_keys(), "trip-keys")
        return self._keys

    def overrides(self) -> DataFrame:
        return literal_table(self.spark, "SCHEDULE_NUMBER string, dealer_date date",
                             [(k, dt.date.fromisoformat(d)) for k, d in OVERRIDES])

    def dated_keys(self) -> DataFrame:
        """In-zone trips with their ledger date."""
        return jobs.with_dealer_date(self.trip_keys(), self.overrides())

    # ledgers -----------------------------------------------------------
    def dealer(self) -> DataFrame:
        return self.tb.dealer_ledger()

    def second(self) -> DataFrame:
        return jobs.second_ledger_since(self.tb.second_ledger(), SECOND_AFTER_YEAR)

    def landing_parts(self) -> DataFrame:
        """Both ledgers as partial sums, flagged by one match against the trip keys."""
        parts = jobs.dealer_parts(self.dealer()).unionByName(jobs.second_parts(self.second()))
        return jobs.attributed(parts, self.dated_keys())

    def landings_sp(self) -> DataFrame:
        return rollup.with_shares(jobs.landings_union(self.landing_parts()))

    # observer ----------------------------------------------------------
    def observer(self, write_keys: bool = False) -> dict[str, DataFrame]:
        tb = self.tb
        return jobs.extract_observer(tb.obs_trip_log(), tb.obs_trip_summary(), tb.obs_hauls(),
                                     tb.obs_animals(), OBS_VESSEL, write_keys)


def _money(df: DataFrame) -> DataFrame:
    return rollup.money_to_double(df)


# ----------------------------------------------------------------------------
# Query functions
# ----------------------------------------------------------------------------

def q_final_trips_sets(c: Ctx) -> DataFrame:
    return jobs.final_trips_sets(c.narrow())


def q_extract_logbook(c: Ctx) -> DataFrame:
    return jobs.extract_logbook(c.tb.logbook_tables(), LANDED_AFTER)


def q_extract_logbook_fleet(c: Ctx) -> DataFrame:
    return jobs.extract_logbook(c.tb.logbook_tables(), LANDED_AFTER, fleet=FLEET)


def q_extract_logbook_view(c: Ctx) -> DataFrame:
    v = c.tb.logbook_view().select("*")
    v = v.where(F.col("SET_YEAR") > VIEW_AFTER_YEAR)
    return extract.keep_ids(v, "VESSEL_ID_NUMBER", FLEET)


def q_extract_trips(c: Ctx) -> DataFrame:
    return c.observer()["trip"]


def q_extract_hauls(c: Ctx) -> DataFrame:
    return c.observer()["haul"]


def q_extract_animals(c: Ctx) -> DataFrame:
    return c.observer(write_keys=True)["animal"]


def q_key_list(c: Ctx) -> DataFrame:
    return extract.distinct_keys(c.observer()["haul"], "HAUL_LOG_KEY")


def q_left_join_isnull(c: Ctx) -> DataFrame:
    t = c.tb.trips().select("SCHEDULE_NUMBER", "VESSEL_ID", "LANDING_DATE")
    return extract.left_join_isnull(t, c.tb.trip_qc(), "SCHEDULE_NUMBER", "DELETED_DATE")


def q_set_level(c: Ctx) -> DataFrame:
    return c.sets()


def q_dms_to_decimal(c: Ctx) -> DataFrame:
    a = c.tb.activities()
    return a.select("LOGBOOK_KEY", jobs.SET_KEY,
                    lat_dd("LATITUDE_DEGREES", "LATITUDE_MINUTES", "LATITUDE_HEMISPHERE").alias("lat_dd"),
                    lon_dd("LONGITUDE_DEGREES", "LONGITUDE_MINUTES", "LONGITUDE_HEMISPHERE").alias("lon_dd"))


def q_project_points(c: Ctx) -> DataFrame:
    p = jobs.with_positions(c.tb.activities()).select("lon_dd", "lat_dd").na.drop().distinct()
    x, y = geo.project("lon_dd", "lat_dd")
    return p.select("lon_dd", "lat_dd", F.round(x, 0).cast("bigint").alias("x_m"),
                    F.round(y, 0).cast("bigint").alias("y_m"))


def q_unproject_points(c: Ctx) -> DataFrame:
    """Projected positions in whole metres back to degrees."""
    p = q_project_points(c).select("x_m", "y_m").distinct()
    lon, lat = geo.unproject(F.col("x_m").cast("double"), F.col("y_m").cast("double"))
    return p.select("x_m", "y_m", F.round(lon, 6).alias("lon_dd"), F.round(lat, 6).alias("lat_dd"))


def _set_points(c: Ctx) -> DataFrame:
    return c.classified().select(jobs.SET_KEY, "VESSEL_ID", "SET_DATE", "lon_dd", "lat_dd",
                                 "zones_in", "in_zone", "within")


def q_points_in_zone(c: Ctx) -> DataFrame:
    p = _set_points(c)
    rows = p.select(jobs.SET_KEY, "lon_dd", "lat_dd", F.explode("zones_in").alias("zone_id"))
    return rows.join(zone_names(c.zones()), "zone_id").select(jobs.SET_KEY, "lon_dd", "lat_dd", "zone_id", "name")


def q_points_within_distance(c: Ctx) -> DataFrame:
    return _set_points(c).where("within").select(jobs.SET_KEY, "VESSEL_ID", "lon_dd", "lat_dd")


def q_points_outside(c: Ctx) -> DataFrame:
    p = _set_points(c)
    return (p.where(geo.position_ok("lon_dd", "lat_dd") & ~F.col("within"))
             .select(jobs.SET_KEY, "VESSEL_ID", "lon_dd", "lat_dd"))


def q_tag_sets(c: Ctx) -> DataFrame:
    columns = [jobs.SET_KEY, "SCHEDULE_NUMBER", "VESSEL_ID", "LANDING_DATE", "lon_dd", "lat_dd"]
    return c.tagged(columns).drop("within")


def q_map_markers(c: Ctx) -> DataFrame:
    return jobs.map_markers(c.classified())


def q_trips_per_vessel_year(c: Ctx) -> DataFrame:
    return jobs.counts_by_year(c.logbook_rows("sets"), "SCHEDULE_NUMBER", "n_trips")


def q_sets_per_vessel_year(c: Ctx) -> DataFrame:
    return jobs.counts_by_year(c.logbook_rows("sets"), jobs.SET_KEY, "n_sets")


def q_trips_sets_in_zone(c: Ctx) -> DataFrame:
    g = rollup.trips_sets_counts(rollup.flagged_sets(c.narrow()), "VESSEL_ID", "YEAR", "__t", "__s", "in_buffer")
    return g.where(F.col("__any_in") == 1).select("VESSEL_ID", "YEAR", "n_trips_in", "n_sets_in")


def q_pivot_trips_by_year(c: Ctx) -> DataFrame:
    return jobs.wide_by_year(jobs.counts_by_year(c.logbook_rows("sets"), "SCHEDULE_NUMBER", "n_trips"), "n_trips", c.years())


def q_pivot_sets_by_year(c: Ctx) -> DataFrame:
    return jobs.wide_by_year(jobs.counts_by_year(c.logbook_rows("sets"), jobs.SET_KEY, "n_sets"), "n_sets", c.years())


def q_merge_full_outer(c: Ctx) -> DataFrame:
    return jobs.merge_counts(write_table(rollup.flagged_sets(c.narrow()), "flagged-sets"))


def q_share_percent(c: Ctx) -> DataFrame:
    o = c.tb.table("orders").select(F.col("o_custkey").cast("string").alias("VESSEL_ID"), "o_orderstatus")
    g = o.groupBy("VESSEL_ID").agg(
        F.count(F.when(F.col("o_orderstatus") == "F", F.lit(1))).alias("n_in"),
        F.count(F.lit(1)).alias("n_all"))
    return g.select("VESSEL_ID", g.n_in.cast("bigint").alias("n_in"), g.n_all.cast("bigint").alias("n_all"),
                    na.share("n_in", "n_all").alias("share_in"))


def q_frequency_table(c: Ctx) -> DataFrame:
    return profile.frequency_table(c.dealer(), "not_included")


def q_null_profile(c: Ctx) -> DataFrame:
    h = c.tb.obs_hauls()
    return profile.null_profile(h, profile.columns_matching(h, "LAT|LON"))


def q_hemisphere_tally(c: Ctx) -> DataFrame:
    h = c.tb.obs_hauls()
    return profile.value_tally(h, profile.columns_matching(h, "HEMISPHER"))


def q_unit_conversion(c: Ctx) -> DataFrame:
    s = c.second()
    return _money(s.select("DEALER_RPT_ID", "UNIT", "REPORTED_QUANTITY",
                           jobs.dressed_weight().alias("dw_lb")))


def q_trip_keys(c: Ctx) -> DataFrame:
    return c.trip_keys()


def q_flag_single_key(c: Ctx) -> DataFrame:
    k = c.trip_keys()
    d = c.dealer().select(F.col("TRIP_ID").alias("SCHEDULE_NUMBER"))
    out = match.exists_flag(k, d, "SCHEDULE_NUMBER", "sch_in_edlr")
    return out.withColumn("sch_in_edlr", match.as_int("sch_in_edlr"))


def q_flag_composite_key(c: Ctx) -> DataFrame:
    out = jobs.area_flag(c.dealer(), "SUPPLIER_VESSEL_ID", "DATE_LANDED", c.dated_keys())
    return out.select("unique_report_no", "SUPPLIER_VESSEL_ID", "DATE_LANDED", "in_area")


def q_flag_either_key(c: Ctx) -> DataFrame:
    # Only the named columns go through the matches (rows without a key are spread by a hash of all columns they have).
    rows = c.dealer().select("unique_report_no", "SUPPLIER_VESSEL_ID", "DATE_LANDED", "TRIP_ID")
    return jobs.dealer_activity_flag(rows, c.written_keys())


def q_flagged_trip_ids(c: Ctx) -> DataFrame:
    # Rows alike in all three keys are alike in their flag: one of them is matched.
    rows = c.dealer().select("SUPPLIER_VESSEL_ID", "DATE_LANDED", "TRIP_ID").distinct()
    out = jobs.dealer_activity_flag(rows, c.written_keys())
    return out.where(F.col("area_activity") == 1).select("TRIP_ID").distinct()


def q_match_audit(c: Ctx) -> DataFrame:
    return jobs.match_audit(c.trip_keys(), c.dealer(), c.second())


def q_match_tally(c: Ctx) -> DataFrame:
    return jobs.match_tally(jobs.match_audit(c.trip_keys(), c.dealer(), c.second()))


def q_date_override(c: Ctx) -> DataFrame:
    return c.dated_keys()


def q_trip_lookup(c: Ctx) -> DataFrame:
    d = c.dealer()
    o = c.overrides().select(F.col("SCHEDULE_NUMBER").alias("TRIP_ID"))
    return _money(extract.semi_join(d, o, "TRIP_ID"))


def _dealer_parts(c: Ctx) -> DataFrame:
    return jobs.attributed(jobs.dealer_parts(c.dealer()), c.dated_keys())


def q_landings_dealer(c: Ctx) -> DataFrame:
    g = _dealer_parts(c).groupBy(F.col("VESSEL_ID").alias("SUPPLIER_VESSEL_ID"), F.col("YEAR").alias("YEAR_OF_LANDING"),
                                 F.col("COMMON_NAME").alias("COMMON_NAME_AS_REPORTED"), "in_area").agg(
        rollup.merged("dw", F.lit(True)).alias("dw_lb"), rollup.merged("revenue", F.lit(True)).alias("revenue"))
    return _money(g)


def q_pivot_in_out(c: Ctx) -> DataFrame:
    return _money(rollup.landings(_dealer_parts(c), rollup.GRAINS["VesselYearSpecies"]))


def q_landings_union(c: Ctx) -> DataFrame:
    return _money(jobs.landings_union(c.landing_parts()))


def q_rollup_vessel_year_species(c: Ctx) -> DataFrame:
    return _money(c.landings_sp())


def q_rollup_vessel_year(c: Ctx) -> DataFrame:
    return _money(rollup.with_shares(rollup.landings(c.landing_parts(), rollup.GRAINS["VesselYear"])))


def q_rollup_vessel(c: Ctx) -> DataFrame:
    return _money(rollup.with_shares(rollup.landings(c.landing_parts(), rollup.GRAINS["Vessel"])))


def q_dealer_totals(c: Ctx) -> DataFrame:
    return _money(jobs.dealer_totals(c.dealer()))


def q_second_ledger_totals(c: Ctx) -> DataFrame:
    return _money(jobs.second_totals(c.second()))


def q_chart_series(c: Ctx) -> DataFrame:
    d = jobs.dealer_totals(c.dealer())
    s = jobs.second_totals(c.second())
    pounds = d.select(F.lit("dealer_pounds").alias("chart"),
                      F.col("SUPPLIER_VESSEL_ID").cast("string").alias("x"),
                      F.col("COMMON_NAME_AS_REPORTED").alias("series"),
                      F.col("Dealer_Landings").cast("double").alias("y"))
    dollars = d.select(F.lit("dealer_dollars").alias("chart"),
                       F.col("SUPPLIER_VESSEL_ID").cast("string").alias("x"),
                       F.col("COMMON_NAME_AS_REPORTED").alias("series"),
                       F.col("Total_Dollars").cast("double").alias("y"))
    yearly = s.select(F.col("COAST_GUARD_NBR").alias("vessel"), F.col("LANDING_YEAR").cast("string").alias("x"),
                      F.stack(F.lit(2), F.lit("pounds"), F.col("BFT_Landings").cast("double"),
                              F.lit("dollars"), F.col("Total_Dollars").cast("double")).alias("series", "y"))
    yearly = yearly.select(F.concat(F.lit("second_"), F.col("vessel")).alias("chart"), "x", "series", "y")
    return pounds.unionByName(dollars).unionByName(yearly)


def q_animals_by_disposition(c: Ctx) -> DataFrame:
    # The picked trips are read by the trip filter of every branch of the extract: written once.
    picked = write_table(jobs.unmatched_trips(c.trip_keys(), c.second()), "unmatched-trips")
    tables = c.tb.logbook_tables()
    tables["trips"] = jobs.trips_of(tables["trips"], picked)
    return jobs.catch_by_disposition(jobs.logbook_rows(tables, LANDED_AFTER, few_trips=True))


def q_haul_key(c: Ctx) -> DataFrame:
    h = c.tb.obs_hauls()
    th = label(F.col("TRIP_NUMBER"), ".", F.col("HAUL_NUMBER"))
    return h.select("HAUL_LOG_KEY", th.alias("trip_haul"), first_part(th, ".").alias("trip"))


def q_positions_long(c: Ctx) -> DataFrame:
    return jobs.positions_long(c.tb.obs_hauls())


def q_inside_outside_counts(c: Ctx) -> DataFrame:
    return jobs.inside_outside_counts(jobs.positions_long(c.tb.obs_hauls()), c.cells())


def q_reconcile_counts(c: Ctx) -> DataFrame:
    rows = c.logbook_rows("sets")
    a = rows.groupBy("VESSEL_ID").agg(na.n_distinct("SCHEDULE_NUMBER").alias("trip_count"),
                                      na.n_distinct(jobs.SET_KEY).alias("set_count"))
    v = c.tb.logbook_view().where(F.col("SET_YEAR") > VIEW_AFTER_YEAR)
    b = v.groupBy(F.col("VESSEL_ID_NUMBER").alias("VESSEL_ID")).agg(
        na.n_distinct("TRIP_NUMBER").alias("trip_count"),
        na.n_distinct("BATCH_SEQUENCE_NUMBER").alias("set_count"))
    return profile.reconcile(a, b, "VESSEL_ID", ["trip_count", "set_count"])


def q_preview_head(c: Ctx) -> DataFrame:
    s = c.sets()
    return profile.preview(s, [jobs.SET_KEY] + [x for x in s.columns if x != jobs.SET_KEY], 6)


def _scratch(c: Ctx, name: str) -> str:
    return work_path(c.spark, "queries", f"{name}-{uuid.uuid4().hex[:8]}")


def q_csv_roundtrip(c: Ctx) -> DataFrame:
    base = _scratch(c, "csv_roundtrip")
    with passing_tables(c.spark) as folder:
        for n, sets in enumerate(c.set_parts(folder)):
            path = files.write_csv(sets, base, "logbook_sets", run_date="2022-12-05", mode="append" if n else "overwrite",
                                   compression="gzip")
    return files.read_csv(c.spark, path, sets.schema)


def q_latest_extract(c: Ctx) -> DataFrame:
    base = _scratch(c, "latest_extract")
    h = c.tb.obs_hauls().select("HAUL_LOG_KEY", "TRIP_NUMBER", "HAUL_NUMBER", "GEAR_CODE")
    for days, stamp in ((2, "2022-11-30"), (1, "2022-12-01"), (0, "2022-12-05")):
        files.write_csv(h.withColumn("HAUL_NUMBER", F.col("HAUL_NUMBER") + days), base, "obs_hauls", run_date=stamp)
    files.write_csv(c.tb.obs_trip_log(), base, "obs_trips", run_date="2022-12-07")
    return files.read_latest(c.spark, base, "obs_hauls", h.schema)


def q_extract_by_year(c: Ctx) -> DataFrame:
    """The set extract written by landing year and read back: only years from
    ``REREAD_FROM_YEAR`` on that the second ledger covers to December."""
    base = _scratch(c, "extract_by_year")
    # Written from the tasks of the DISTINCT, a file per task and year: no second shuffle of whole set rows.
    with passing_tables(c.spark) as folder:
        for n, part in enumerate(c.set_parts(folder)):
            sets = part.withColumn("LANDING_YEAR", F.year("LANDING_DATE"))
            path = files.write_csv(sets, base, "logbook_sets", run_date="2022-12-05", mode="append" if n else "overwrite",
                                   partition_by=["LANDING_YEAR"], rebalance=False, compression="gzip")
    back = files.read_csv(c.spark, path, sets.schema, partitions="LANDING_YEAR INT")
    covered = c.second().groupBy("LANDING_YEAR").agg(F.max(F.month("LANDING_DATE")).alias("last_month"))
    return files.keep_partitions(back.where(F.col("LANDING_YEAR") >= REREAD_FROM_YEAR), "LANDING_YEAR",
                                 covered, "last_month = 12")


def q_clean_column_names(c: Ctx) -> DataFrame:
    base = _scratch(c, "clean_names")
    raw = c.tb.table("orders").select(
        F.col("o_custkey").cast("string").alias("coast guard nbr"),
        F.to_date("o_orderdate").alias("Landing Date"),
        F.year("o_orderdate").alias("landing.year"),
        F.col("o_orderpriority").alias("dealer name"),
        F.col("o_totalprice").alias("1st price"),
        F.col("o_orderstatus").alias("na"))
    path = files.write_csv(raw, base, "second_ledger_sheet", run_date="2022-12-05")
    return clean_column_names(files.read_csv(c.spark, path, raw.schema))


def _sheets(c: Ctx, rows: DataFrame, name: str) -> DataFrame:
    """A report written in one job and read back."""
    return c.spark.read.parquet(jobs.write_sheets(rows, _scratch(c, name), run_date="2022-12-05"))


def q_report_tables(c: Ctx) -> DataFrame:
    """The landings report: the three grains of one pass, written as sheets and read back."""
    return _sheets(c, _money(rollup.with_shares(rollup.landings_grains(c.landing_parts()))), "report")


def q_report_totals(c: Ctx) -> DataFrame:
    """The plain totals report: both ledgers' totals written as sheets and read back."""
    d = jobs.dealer_totals(c.dealer()).withColumnsRenamed(
        {"SUPPLIER_VESSEL_ID": "VESSEL_ID", "COMMON_NAME_AS_REPORTED": "COMMON_NAME", "Dealer_Landings": "Landings"})
    s = jobs.second_totals(c.second()).withColumnsRenamed(
        {"COAST_GUARD_NBR": "VESSEL_ID", "LANDING_YEAR": "YEAR", "BFT_Landings": "Landings"})
    # The sheet names of the report.
    rows = reshape.union_by_name(_money(d).withColumn("sheet", F.lit("Dealer Landings")),
                                 _money(s).withColumn("sheet", F.lit("BFT Landings")))
    return _sheets(c, rows, "report_totals")


def q_report_wide(c: Ctx) -> DataFrame:
    """The wide totals report: trips and sets by year, counted in one pass over
    the logbook, written as sheets and read back."""
    counts = rollup.trips_sets_counts(c.logbook_rows("sets"), "VESSEL_ID", "LANDING_DATE", "SCHEDULE_NUMBER", jobs.SET_KEY)
    # The sheet names of the report.
    rows = counts.select("VESSEL_ID", "YEAR", F.stack(F.lit(2), F.lit("TotTrips"), F.col("n_trips"), F.lit("TotSets"),
                                                      F.col("n_sets")).alias("sheet", "n"))
    return _sheets(c, reshape.pivot_wide(rows, ["sheet", "VESSEL_ID"], "YEAR", "n", c.years()), "report_wide")


QUERIES: dict[str, Callable[[Ctx], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def normalise_types(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, DECIMAL and FLOAT as DOUBLE, dates as ISO text
    (one final projection), so results compare the same in any checker."""
    def conv(f):
        t = f.dataType
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(f"`{f.name}`").cast("string").alias(f.name)
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(f"`{f.name}`").cast("bigint").alias(f.name)
        if isinstance(t, (T.DecimalType, T.FloatType)):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        return F.col(f"`{f.name}`")
    return df.select(*[conv(f) for f in df.schema.fields])


# Integer columns that can be missing by construction (strict sums, counts
# after full outer joins, pivot cells) are returned as DOUBLE, like the
# numbers of a data frame, so a missing count compares the same in any
# checker (pandas turns a NULL-bearing BIGINT column into floats).
# Queries whose every column but the named ones is such a count.
WIDE_OUTPUTS = {"pivot_trips_by_year": ["VESSEL_ID"], "pivot_sets_by_year": ["VESSEL_ID"],
                "report_wide": ["VESSEL_ID", "sheet"]}
DOUBLE_OUTPUTS = {
    "animals_by_disposition": ["n_animals"],
    "extract_logbook": ["NUMBER_OF_INDIVIDUALS"],
    "extract_logbook_fleet": ["NUMBER_OF_INDIVIDUALS"],
    "merge_full_outer": ["n_trips", "n_sets", "n_trips_in", "n_sets_in"],
    "report_totals": ["YEAR"],
    "report_tables": ["YEAR"],
    "reconcile_counts": ["trip_count_a", "trip_count_b", "trip_count_diff",
                         "set_count_a", "set_count_b", "set_count_diff"],
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name, fn):
        def run(spark, sf_dir):
            out = normalise_types(fn(Ctx(spark, sf_dir)))
            cols = [c for c in DOUBLE_OUTPUTS.get(name, []) if c in out.columns]
            cols += [c for c in out.columns if name in WIDE_OUTPUTS and c not in WIDE_OUTPUTS[name]]
            return out.withColumns({c: F.col(f"`{c}`").cast("double") for c in cols}) if cols else out
        return run
    return {k: bind(k, fn) for k, fn in QUERIES.items()}

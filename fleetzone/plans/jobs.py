"""End-to-end jobs: extracts, set tagging, trip/set reports, landings.

Each function takes DataFrames with the reference-shaped columns (see
``fleetzone.sources.testbed`` for how the test tables provide them) and
returns a lazy DataFrame: nothing runs until the caller acts on it (the
registered queries may run jobs while they are built, for written tables).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coords import lat_dd, lon_dd
from ..functions.na import if_else, n_distinct_where, sum_strict
from ..functions.text import first_part, label, year_text
from ..operators import extract, geo, match, reshape, rollup
from ..session import write_table

SET_KEY = "ORIGINAL_BATCH_SEQUENCE_NUMBER"

# The logbook extract's columns, in their order.
EXTRACT_COLUMNS = [
    "LOGBOOK_KEY", "BATCH_NUMBER", "ORIGINAL_BATCH_SEQUENCE_NUMBER", "SCHEDULE_NUMBER", "VESSEL_ID",
    "LANDING_DATE", "SET_DATE", "BEGIN_SET_TIME", "BEGIN_SET_MERIDIAN", "END_SET_TIME",
    "END_SET_MERIDIAN", "HAULBACK_DATE", "BEGIN_HAULBACK_TIME", "BEGIN_HAULBACK_MERIDIAN",
    "END_HAULBACK_TIME", "END_HAULBACK_MERIDIAN", "LATITUDE_DEGREES", "LATITUDE_MINUTES",
    "LATITUDE_HEMISPHERE", "LONGITUDE_DEGREES", "LONGITUDE_MINUTES", "LONGITUDE_HEMISPHERE",
    "AREA_FISHED", "GEAR_CODE_NMFS", "GEAR_NAME", "GEAR_CLASS", "SPECIES_CODE_NMFS", "NMFS_COMMON",
    "SCIENTIFIC_NAME", "SPECIES_ITIS", "NUMBER_OF_INDIVIDUALS", "TOTAL_WHOLE_POUNDS",
    "DISPOSITION_STATUS"]

# Catch-level columns dropped to get one row per set.
CATCH_COLUMNS = ["NMFS_COMMON", "SPECIES_CODE_NMFS", "SCIENTIFIC_NAME", "SPECIES_ITIS",
                 "NUMBER_OF_INDIVIDUALS", "TOTAL_WHOLE_POUNDS", "DISPOSITION_STATUS",
                 "AREA_FISHED"]

# Parts in which set rows are shuffled and written (each scans the activities again).
SET_PARTS = 2

# Columns of a set record, in their order.
SET_COLUMNS = [c for c in EXTRACT_COLUMNS if c not in CATCH_COLUMNS]

# The observer haul extract's columns, in their order.
HAUL_COLUMNS = """HAUL_LOG_KEY GEAR_LOG_KEY HAUL_NUMBER GEAR_CODE WAS_HAUL_OBSERVED WAS_CATCH GEAR_CONDITION
GEAR_CONDITION_DESC MAINLINE_LENGTH BOTTOM_DEPTH_MINIMUM BOTTOM_DEPTH_MAXIMUM HOOK_DEPTH_MINIMUM
HOOK_DEPTH_MAXIMUM TARGET_SPECIES SOAK_DURATION NUMBER_HOOKS_SET BEGIN_SET_DATE BEGIN_SET_TIME END_SET_DATE
END_SET_TIME BEGIN_HAUL_DATE BEGIN_HAUL_TIME END_HAUL_DATE END_HAUL_TIME BEGIN_SET_LATITUDE
BEGIN_SET_LATITUDE_MINUTES BEGIN_SET_LATITUDE_HEMISPHERE END_SET_LATITUDE END_SET_LATITUDE_MINUTES
END_SET_LATITUDE_HEMISPHERE BEGIN_HAUL_LATITUDE BEGIN_HAUL_LATITUDE_MINUTES BEGIN_HAUL_LATITUDE_HEMISPHERE
END_HAUL_LATITUDE END_HAUL_LATITUDE_MINUTES END_HAUL_LATITUDE_HEMISPHERE BEGIN_SET_LONGITUDE
BEGIN_SET_LONGITUDE_MINUTES BEGIN_SET_LONGITUDE_HEMISPHERE END_SET_LONGITUDE END_SET_LONGITUDE_MINUTES
END_SET_LONGITUDE_HEMISPHERE BEGIN_HAUL_LONGITUDE BEGIN_HAUL_LONGITUDE_MINUTES BEGIN_HAUL_LONGITUDE_HEMISPHER
END_HAUL_LONGITUDE END_HAUL_LONGITUDE_MINUTES END_HAUL_LONGITUDE_HEMISPHERE HAUL_DURATION FISHING_AREA
IS_EXPERIMENT TRIP_NUMBER""".split()

# The observer animal extract's columns, in their order.
ANIMAL_COLUMNS = """ANIMAL_LOG_KEY HAUL_LOG_KEY CARCASS_TAG_NUMBER ALPHA_SPECIES_CODE SPECIES_NAME
LENGTH_MEASUREMENT_ONE LENGTH_TYPE_ONE LENGTH_MEASUREMENT_TAKEN_CODE LENGTH_MEASURE_TAKEN_CODE_D DRESSED_WEIGHT
TAG_NUMBER BOARDING_STATUS BOARDING_STATUS_DESC KEPT_OR_RELEASED KEPT_OR_RELEASED_DESC ESTIMATED_WEIGHT
TRIP_NUMBER HAUL_NUMBER BEGIN_HAUL_DATE""".split()

# Trip and activity columns: those before the first gear or catch column.
TRIP_SET_COLUMNS = EXTRACT_COLUMNS[:EXTRACT_COLUMNS.index("AREA_FISHED")]


# --------------------------------------------------------------------------
# M1 / M2: extracts
# --------------------------------------------------------------------------

def logbook_rows(tables: dict[str, DataFrame], landed_after: str, fleet=None,
                 date_format: str = "dd-MMM-yyyy", level: str = "catches",
                 keep_gear_key: bool = False, few_trips: bool = False) -> DataFrame:
    """The logbook extract before its DISTINCT and ORDER BY.

    trips LEFT JOIN activities LEFT JOIN gears fished (with gear codes) LEFT
    JOIN catches (with species codes) LEFT JOIN catch details, trips whose
    QC rows are all deleted removed, landing date after ``landed_after``
    (text in ``date_format``), vessel in ``fleet`` (a list or a DataFrame of
    ids; ``None`` keeps all).

    ``level`` is how far down the chain goes: "sets" stops at the
    activities, "gears" at the gears, "catches" takes everything.  A left
    join only repeats rows, so consumers that take distinct rows, count
    distinct values or test "any row" of upper columns need no lower table.
    ``few_trips`` (always with a ``fleet``) first reduces each lower table to
    the rows of the trips, by semi joins from the top.  Each reduced table is
    written: the next level reads it instead of working it out again, and its
    known size lets Spark broadcast the keys of a few trips, so the lower table
    is not shuffled.  Without it the whole tables are joined, the trips'
    activities first, level by level into written tables (``extract.left_chain_filtered``); for "gears", whose rows always go through a
    DISTINCT, the wide activities are shuffled once, by their trip
    (``extract.left_join_under``).
    The gear description and parameter tables add no output column and are
    never joined (``keep_gear_key`` leaves the key by which they could be).
    The QC condition ("left join QC, keep QC.DELETED_DATE IS
    NULL") is an anti join on the trips whose QC rows are all deleted, which
    gives the same rows once the caller takes DISTINCT (see
    ``extract.drop_all_flagged``).
    """
    t = kept_trips(tables, landed_after, fleet, date_format)
    keys = ["LOGBOOK_KEY", "FISHING_ACTIVITY_KEY", "GEAR_FISHED_KEY", "CATCH_KEY"]
    names = ["activities", "gears", "catches", "catch_details"][:{"sets": 1, "gears": 2, "catches": 4}[level]]
    few = few_trips or fleet is not None
    chain = [write_table(t, "few-trips") if few else t]
    for name, key in zip(names, keys):
        chain.append(write_table(extract.semi_join(tables[name], chain[-1], key), f"few-{name}") if few else tables[name])
    # The code tables only add columns to a gear or a catch.
    codes = {2: ("gear_codes", "GEAR_CODE_NMFS"), 3: ("species_codes", "SPECIES_CODE_NMFS")}
    if level == "gears":
        under = extract.left_join_under(chain[1], chain[2], keys[1], keys[0], tables[codes[2][0]], codes[2][1])
        j = chain[0].join(under, keys[0], "left")
    else:
        chain = [c.join(tables[codes[i][0]], codes[i][1], "left") if i in codes else c for i, c in enumerate(chain)]
        # Reduced tables hold no other trips' rows: joined from the bottom.  Whole ones: first the trips' activities.
        columns = EXTRACT_COLUMNS + (["GEAR_FISHED_KEY"] if keep_gear_key else [])
        j = extract.left_chain(chain, keys) if few or level == "sets" else extract.left_chain_filtered(chain, keys, columns)
    if level == "sets":
        return j.select(*TRIP_SET_COLUMNS)
    return j.select(*(SET_COLUMNS if level == "gears" else columns))


def kept_trips(tables: dict[str, DataFrame], landed_after: str, fleet=None, date_format: str = "dd-MMM-yyyy") -> DataFrame:
    """The trips of ``logbook_rows``."""
    t = tables["trips"].where(F.col("LANDING_DATE") > F.to_date(F.lit(landed_after), date_format))
    if fleet is not None:
        t = extract.keep_ids(t, "VESSEL_ID", fleet)
    return extract.drop_all_flagged(t, tables["trip_qc"], "SCHEDULE_NUMBER", "DELETED_DATE")


def extract_logbook(tables: dict[str, DataFrame], landed_after: str, fleet=None,
                    order: bool = True) -> DataFrame:
    """The logbook extract: distinct rows, ordered by batch and schedule.

    Equal rows are equal in the order's columns: ranges of these serve the
    DISTINCT and the ORDER BY with one shuffle of the wide rows.
    """
    by = ["BATCH_NUMBER", "SCHEDULE_NUMBER"]
    rows = logbook_rows(tables, landed_after, fleet)
    return rows.repartitionByRange(*by).distinct().orderBy(*by) if order else rows.distinct()


def extract_observer(trip_log: DataFrame, trip_summary: DataFrame, hauls: DataFrame,
                     animals: DataFrame, vessel: str, write_keys: bool = False) -> dict[str, DataFrame]:
    """Trips, hauls and animals of one vessel's observed trips.

    Trip and haul rows are kept by a semi join on the vessel's trip numbers;
    animals by a semi join on the extracted hauls' keys (the key set stays on
    the cluster, however many keys there are).  Hauls and animals come out
    with their named columns, so a wide source is pruned at the scan.
    ``write_keys`` writes the hauls' keys first: while that table is under the
    broadcast threshold the animals are then not shuffled.
    """
    keys = trip_summary.where(F.col("VESSEL_ID") == vessel).select("TRIP_NUMBER")
    t = extract.semi_join(trip_log, keys, "TRIP_NUMBER")
    h = extract.semi_join(hauls.select(*HAUL_COLUMNS), keys, "TRIP_NUMBER")
    haul_keys = extract.distinct_keys(h, "HAUL_LOG_KEY")
    haul_keys = write_table(haul_keys, "haul-keys") if write_keys else haul_keys
    a = extract.semi_join(animals.select(*ANIMAL_COLUMNS), haul_keys, "HAUL_LOG_KEY")
    return {"trip": t, "haul": h, "animal": a}


# --------------------------------------------------------------------------
# M3: set tagging
# --------------------------------------------------------------------------

def with_positions(df: DataFrame) -> DataFrame:
    """Add ``lat_dd`` and ``lon_dd`` from degrees, minutes and hemispheres."""
    return df.withColumns({
        "lat_dd": lat_dd("LATITUDE_DEGREES", "LATITUDE_MINUTES", "LATITUDE_HEMISPHERE"),
        "lon_dd": lon_dd("LONGITUDE_DEGREES", "LONGITUDE_MINUTES", "LONGITUDE_HEMISPHERE")})


def set_level(extract_rows: DataFrame) -> DataFrame:
    """One row per distinct set record: catch columns dropped, DISTINCT.

    Rows of ``logbook_rows(level="gears")`` give the same sets without the
    catch tables.
    """
    return extract_rows.drop(*CATCH_COLUMNS).distinct()


def set_parts(tables: dict[str, DataFrame], landed_after: str, folder: str) -> list[DataFrame]:
    """``set_level`` of ``logbook_rows(level="gears")`` in parts by trip key, for writing one after another.

    Equal sets are of one trip key, so the parts' rows are all distinct.  The trips
    and the gears by trip are written first, to ``folder`` (``passing_tables``): a part shuffles its
    share of the wide activities and of these, and nothing else.
    """
    acts, (key, owner) = tables["activities"], ("FISHING_ACTIVITY_KEY", "LOGBOOK_KEY")
    trips = write_table(kept_trips(tables, landed_after), "trips", folder)
    owned = write_table(extract.owned_rows(acts, tables["gears"], key, owner, tables["gear_codes"], "GEAR_CODE_NMFS"), "owned-gears", folder)
    parts = []
    for n in range(SET_PARTS):
        t, a, g = (extract.part_of(df, owner, n, SET_PARTS) for df in (trips, acts, owned))
        parts.append(set_level(t.join(extract.spread_under(a, g, key, owner), owner, "left").select(*SET_COLUMNS)))
    return parts


def classify_sets(sets: DataFrame, cells: geo.EdgeCells) -> DataFrame:
    """Set rows with positions and per-row zone flags."""
    return geo.classify(with_positions(sets), "lon_dd", "lat_dd", cells)


def tag_by_key(classified: DataFrame, hits: DataFrame, key: str = SET_KEY,
               flag: str = "in_buffer") -> DataFrame:
    """``flag = "Y"`` for every row whose key is in ``hits``.

    ``hits`` are the rows of any extract of the same sets that are within
    the buffer; the narrow one (trips and activities only) is enough.
    Tagging is at key grain: a key seen both inside and outside is "Y" on
    all its rows.
    """
    hits = hits.where("within").select(key)
    out = match.exists_flag(classified, hits, key, "__hit")
    return out.withColumn(flag, F.when(F.col("__hit"), F.lit("Y")).otherwise(F.lit("N"))).drop("__hit")


# --------------------------------------------------------------------------
# M4 / M5: trips and sets reports
# --------------------------------------------------------------------------

def final_trips_sets(classified_rows: DataFrame) -> DataFrame:
    """The trips-and-sets report from per-row zone flags (rows need not be
    DISTINCT: see ``rollup.trips_sets_report_from_rows``)."""
    return rollup.trips_sets_report_from_rows(classified_rows)


def counts_by_year(sets: DataFrame, col: str, name: str) -> DataFrame:
    """``n_distinct(col)`` per (VESSEL_ID, YEAR)."""
    return rollup.distinct_count_by(sets, ["VESSEL_ID", year_text("LANDING_DATE").alias("YEAR")],
                                    col, name)


def wide_by_year(counts: DataFrame, name: str, years: list[str]) -> DataFrame:
    """One row per vessel, one column per year (missing stays NULL)."""
    return reshape.pivot_wide(counts, ["VESSEL_ID"], "YEAR", name, years)


def merge_counts(flagged: DataFrame) -> DataFrame:
    """Four count tables merged by three full outer joins on (VESSEL_ID, YEAR),
    keys matched null-safely, ordered by key.  (``final_trips_sets`` fuses
    the same counts into one aggregate; this is the literal merge.)

    ``flagged`` is one row per (vessel, year, trip, set) with its flag
    (``rollup.flagged_sets``), a written table since it is read four times.
    """
    inside = flagged.where(F.col("in_buffer") == "Y")
    keys = ["VESSEL_ID", "YEAR"]
    parts = [
        rollup.distinct_count_by(flagged, keys, "__t", "n_trips"),
        rollup.distinct_count_by(flagged, keys, "__s", "n_sets"),
        rollup.distinct_count_by(inside, keys, "__t", "n_trips_in"),
        rollup.distinct_count_by(inside, keys, "__s", "n_sets_in"),
    ]
    out = parts[0]
    for p in parts[1:]:
        r = p.withColumnsRenamed({"VESSEL_ID": "__v", "YEAR": "__y"})
        j = out.join(r, out["VESSEL_ID"].eqNullSafe(r["__v"]) & out["YEAR"].eqNullSafe(r["__y"]),
                     "full_outer")
        keep = [c for c in out.columns if c not in ("VESSEL_ID", "YEAR")]
        new = [c for c in r.columns if c not in ("__v", "__y")]
        out = j.select(F.coalesce("VESSEL_ID", "__v").alias("VESSEL_ID"),
                       F.coalesce("YEAR", "__y").alias("YEAR"), *keep, *new)
    return out.orderBy(F.col("VESSEL_ID").asc_nulls_last(), F.col("YEAR").asc_nulls_last())


# --------------------------------------------------------------------------
# M6 / M7 / M9: landings
# --------------------------------------------------------------------------

def trip_keys(tagged_within: DataFrame) -> DataFrame:
    """Distinct (VESSEL_ID, LANDING_DATE, SCHEDULE_NUMBER) of the sets
    within the buffer."""
    return tagged_within.where("within").select("VESSEL_ID", "LANDING_DATE", "SCHEDULE_NUMBER").distinct()


def with_dealer_date(keys: DataFrame, overrides: DataFrame) -> DataFrame:
    """Trip keys plus ``dealer_date``: the ledger's date where a correction
    is recorded, the logbook landing date otherwise."""
    return match.apply_override(keys, overrides, "SCHEDULE_NUMBER", "LANDING_DATE", "dealer_date")


def match_audit(keys: DataFrame, dealer: DataFrame, second: DataFrame) -> DataFrame:
    """Per distinct trip: "x" where the dealer ledger has the trip id, where it
    has the (vessel, date), where the second ledger has the (vessel, date).
    Each ledger is read once (``match.flags_by_keys``)."""
    out = match.flags_by_keys(
        keys.select("VESSEL_ID", "LANDING_DATE", "SCHEDULE_NUMBER"),
        {"trip": ["SCHEDULE_NUMBER"], "landing": ["VESSEL_ID", "LANDING_DATE"]},
        {"dealer": (dealer, {"trip": ["TRIP_ID"], "landing": ["SUPPLIER_VESSEL_ID", "DATE_LANDED"]}),
         "second": (second, {"landing": ["COAST_GUARD_NBR", "LANDING_DATE"]})})
    return out.select("VESSEL_ID", "LANDING_DATE", "SCHEDULE_NUMBER",
                      match.marker("dealer_trip").alias("sch_in_edlr"),
                      match.marker("dealer_landing").alias("ves_date_in_edlr"),
                      match.marker("second_landing").alias("ves_date_in_bft"))


def dealer_activity_flag(dealer: DataFrame, keys: DataFrame) -> DataFrame:
    """Dealer rows with ``area_activity`` (1/0): matched by (vessel, landing
    date) or by trip id, using the uncorrected dates."""
    vd = keys.select("VESSEL_ID", "LANDING_DATE")
    tid = keys.select("SCHEDULE_NUMBER")
    out = match.either_flag(dealer, vd, [("SUPPLIER_VESSEL_ID", "VESSEL_ID"),
                                         ("DATE_LANDED", "LANDING_DATE")],
                            tid, [("TRIP_ID", "SCHEDULE_NUMBER")], "__m")
    return out.withColumn("area_activity", F.col("__m").cast("int")).drop("__m")


def area_flag(ledger: DataFrame, vessel: str, date: str, dated_keys: DataFrame) -> DataFrame:
    """Ledger rows with ``in_area`` (1/0): (vessel, date) matches a trip's
    (VESSEL_ID, dealer_date)."""
    k = dated_keys.select("VESSEL_ID", "dealer_date")
    out = match.exists_flag(ledger, k, [(vessel, "VESSEL_ID"), (date, "dealer_date")], "__m")
    return out.withColumn("in_area", F.col("__m").cast("int")).drop("__m")


def dressed_weight(quantity: str = "REPORTED_QUANTITY", unit: str = "UNIT",
                   factor: str = "0.8") -> Column:
    """Dressed weight: round weight times ``factor``; others unchanged; a
    missing unit gives a missing weight."""
    q = F.col(quantity)
    return if_else(F.col(unit) == "ROUND", q * F.lit(factor).cast("decimal(2,1)"), q)


def second_ledger_since(second: DataFrame, after_year: int) -> DataFrame:
    return second.where(F.col("LANDING_YEAR") > after_year)


def dealer_parts(dealer: DataFrame) -> DataFrame:
    """Dealer pounds (strict) and dollars (missing skipped) as partial sums by
    vessel, date landed, year and species; rows marked as duplicates
    (``not_included`` present) are left out.

    This is the only shuffle of the ledger's rows: everything after it works on
    these sums, of which a trip has a few.
    """
    keys = {"VESSEL_ID": F.col("SUPPLIER_VESSEL_ID"), "LANDED": F.col("DATE_LANDED"), "YEAR": F.col("YEAR_OF_LANDING"),
            "COMMON_NAME": F.col("COMMON_NAME_AS_REPORTED")}
    d = dealer.where(F.col("not_included").isNull())
    return rollup.partial_sums(d, keys, F.col("converted_dw"), F.col("TOTAL_DOLLARS"), skip_revenue=True) \
                 .withColumn("ledger", F.lit(1))


def second_parts(second: DataFrame, species: str = "Bluefin") -> DataFrame:
    """Second-ledger dressed pounds and dollars (both strict) as partial sums,
    under one species name."""
    keys = {"VESSEL_ID": F.col("COAST_GUARD_NBR").cast("string"), "LANDED": F.col("LANDING_DATE"),
            "YEAR": F.col("LANDING_YEAR"), "COMMON_NAME": F.lit(species)}
    return rollup.partial_sums(second, keys, dressed_weight(), F.col("DOLLARS")).withColumn("ledger", F.lit(2))


def attributed(parts: DataFrame, dated_keys: DataFrame) -> DataFrame:
    """Partial sums with ``in_area``: the (vessel, date) is a tagged trip's."""
    return area_flag(parts, "VESSEL_ID", "LANDED", dated_keys)


def landings_union(parts: DataFrame) -> DataFrame:
    """Both ledgers' landings by vessel, year and species, in and out of the
    area, one below the other, ordered by vessel, year, species."""
    keys = rollup.GRAINS["VesselYearSpecies"]
    return rollup.landings(parts, [*keys, "ledger"]).drop("ledger").orderBy(*[F.col(c).asc_nulls_last() for c in keys])


def dealer_totals(dealer: DataFrame) -> DataFrame:
    """Dealer quantity and value (quantity x price) by vessel and species."""
    d = dealer.where(F.col("not_included").isNull())
    return d.groupBy("SUPPLIER_VESSEL_ID", "COMMON_NAME_AS_REPORTED").agg(
        sum_strict("REPORTED_QUANTITY").alias("Dealer_Landings"),
        sum_strict(F.col("REPORTED_QUANTITY") * F.col("PURCHASE_PRICE")).alias("Total_Dollars"))


def second_totals(second: DataFrame) -> DataFrame:
    """Second-ledger quantity and dollars by vessel and year."""
    return second.groupBy("COAST_GUARD_NBR", "LANDING_YEAR").agg(
        sum_strict("REPORTED_QUANTITY").alias("BFT_Landings"),
        sum_strict("DOLLARS").alias("Total_Dollars"))


def match_tally(audit: DataFrame) -> DataFrame:
    """(test, matched, n): how many trips each test of ``match_audit`` found or not."""
    tests = ["sch_in_edlr", "ves_date_in_edlr", "ves_date_in_bft"]
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("test"), F.col(t).isNotNull().alias("matched")) for t in tests]))
    return audit.select(pairs.alias("x")).groupBy("x.test", "x.matched").agg(F.count(F.lit(1)).alias("n"))


def unmatched_trips(keys: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct (VESSEL_ID, LANDING_DATE) of the in-zone trips that the
    second ledger does not have."""
    s_vd = second.select(F.col("COAST_GUARD_NBR").alias("VESSEL_ID"), "LANDING_DATE")
    flagged = match.exists_flag(keys.select("VESSEL_ID", "LANDING_DATE"), s_vd,
                                ["VESSEL_ID", "LANDING_DATE"], "__in_second")
    return flagged.where(~F.col("__in_second")).select("VESSEL_ID", "LANDING_DATE").distinct()


def trips_of(trips: DataFrame, picked: DataFrame) -> DataFrame:
    """The trips whose (vessel, landing date) is picked, null-safely (a semi
    join on the narrow trips, before anything is joined to them)."""
    p = picked.select(F.col("VESSEL_ID").alias("__v"), F.col("LANDING_DATE").alias("__d"))
    return trips.join(p, trips["VESSEL_ID"].eqNullSafe(p["__v"]) & trips["LANDING_DATE"].eqNullSafe(p["__d"]),
                      "left_semi")


def catch_by_disposition(logbook: DataFrame) -> DataFrame:
    """Individuals by trip, species and disposition over distinct logbook rows."""
    return (logbook.distinct().groupBy("SCHEDULE_NUMBER", "NMFS_COMMON", "DISPOSITION_STATUS")
                   .agg(sum_strict("NUMBER_OF_INDIVIDUALS").alias("n_animals")))


# --------------------------------------------------------------------------
# M8: observer positions
# --------------------------------------------------------------------------

POSITION_KINDS = ["begin_set", "end_set", "begin_haul", "end_haul"]


def haul_positions(hauls: DataFrame) -> DataFrame:
    """Per haul: ``trip_haul`` key and the four positions in decimal degrees."""
    cols = [label(F.col("TRIP_NUMBER"), ".", F.col("HAUL_NUMBER")).alias("trip_haul")]
    for kind in POSITION_KINDS:
        stem = kind.upper()
        lon_h = f"{stem}_LONGITUDE_HEMISPHER" if kind == "begin_haul" else f"{stem}_LONGITUDE_HEMISPHERE"
        cols += [lat_dd(f"{stem}_LATITUDE", f"{stem}_LATITUDE_MINUTES",
                        f"{stem}_LATITUDE_HEMISPHERE").alias(f"{kind}_lat_dd"),
                 lon_dd(f"{stem}_LONGITUDE", f"{stem}_LONGITUDE_MINUTES", lon_h).alias(f"{kind}_lon_dd")]
    return hauls.select(*cols)


def positions_long(hauls: DataFrame) -> DataFrame:
    """Long form ``(trip_haul, lat_dd, lon_dd, location_type)``, rows with
    any missing value dropped."""
    wide = haul_positions(hauls)
    pairs = {k: (f"{k}_lat_dd", f"{k}_lon_dd") for k in POSITION_KINDS}
    return reshape.unpivot_positions(wide, "trip_haul", pairs).na.drop("any")


def inside_outside_counts(positions: DataFrame, cells: geo.EdgeCells) -> DataFrame:
    """Distinct hauls and trips with a position inside / outside the buffer.

    A haul with positions on both sides counts on both sides.
    """
    c = geo.classify(positions, "lon_dd", "lat_dd", cells)
    trip = first_part("trip_haul", ".")
    inside, outside = F.col("within"), ~F.col("within")
    return c.agg(
        n_distinct_where(inside, "trip_haul").alias("n_hauls_in"),
        n_distinct_where(inside, trip).alias("n_trips_in"),
        n_distinct_where(outside, "trip_haul").alias("n_hauls_out"),
        n_distinct_where(outside, trip).alias("n_trips_out"))


# --------------------------------------------------------------------------
# Reports
# --------------------------------------------------------------------------

def map_markers(classified: DataFrame) -> DataFrame:
    """Marker table: green inside the buffer, red outside, with a label."""
    ok = classified.where(F.col("lon_dd").isNotNull() & F.col("lat_dd").isNotNull())
    return ok.select(
        F.col("lon_dd").alias("lon"), F.col("lat_dd").alias("lat"),
        F.when(F.col("within"), F.lit("green")).otherwise(F.lit("red")).alias("colour"),
        label("Vessel ID:", F.col("VESSEL_ID"), "; Set Date:", F.col("SET_DATE"), sep=" ").alias("label"))


def write_sheets(rows: DataFrame, base: str, run_date: str | None = None) -> str:
    """Write a report whose sheets are told apart by the column ``sheet`` in
    one job, one folder per sheet: ``{base}/run_date={d}/sheet={name}``."""
    path = f"{base}/run_date={run_date or dt.date.today().isoformat()}"
    rows.write.mode("overwrite").partitionBy("sheet").parquet(path)
    return path


def write_report(tables: dict[str, DataFrame], base: str, run_date: str | None = None,
                 fmt: str = "parquet") -> dict[str, str]:
    """Write each table as its own dataset ``{base}/{name}/run_date={d}``."""
    d = run_date or dt.date.today().isoformat()
    paths = {}
    for name, df in tables.items():
        path = f"{base}/{name}/run_date={d}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w = w.option("header", True).option("nullValue", "NA")
        w.format(fmt).save(path)
        paths[name] = path
    return paths

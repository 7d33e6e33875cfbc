"""Aggregates: distinct counts, in/out splits, landings rollups, totals.

All sums of pounds and dollars run in DECIMAL, so they are exact and do
not depend on row order; callers cast to DOUBLE only at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.na import fill_missing, n_distinct, share, sum_strict
from ..functions.text import year_text
from ..session import write_table

# Join keys that rows without a set key are spread over.
NULL_SPREAD = 64


def distinct_count_by(df: DataFrame, keys: list, col: str, name: str) -> DataFrame:
    """``group_by(keys) |> summarize(name = n_distinct(col))``."""
    return df.groupBy(*keys).agg(n_distinct(col).alias(name))


def trips_sets_counts(df: DataFrame, vessel: str, date: str, trip: str, set_key: str,
                      flag: str | None = None) -> DataFrame:
    """Trips and sets per (vessel, year), optionally split by an in-zone flag.

    Without a flag one aggregate computes both distinct counts (Spark expands the
    rows once per distinct column).  With it, each row gives its trip and its set;
    these are first made distinct with "any row in", then counted: two rows in the
    shuffle for one, not one for each of four distinct counts and one more.
    """
    y = year_text(date).alias("YEAR")
    if flag is None:
        return df.groupBy(F.col(vessel).alias("VESSEL_ID"), y).agg(n_distinct(trip).alias("n_trips"),
                                                                   n_distinct(set_key).alias("n_sets"))
    is_in = F.coalesce(F.col(flag) == "Y", F.lit(False)).cast("int").alias("__in")
    one = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("key"))
                              for kind, c in enumerate((trip, set_key))])).alias("__one")
    each = df.select(F.col(vessel).alias("VESSEL_ID"), y, is_in, one).groupBy("VESSEL_ID", "YEAR", "__one.kind", "__one.key").agg(
        F.max("__in").alias("__in"))
    trips, sets, within = F.col("kind") == 0, F.col("kind") == 1, F.col("__in") == 1
    return each.groupBy("VESSEL_ID", "YEAR").agg(
        F.count_if(trips).alias("n_trips"), F.count_if(sets).alias("n_sets"), F.count_if(trips & within).alias("n_trips_in"),
        F.count_if(sets & within).alias("n_sets_in"), F.max("__in").alias("__any_in"))


def trips_sets_report(tagged: DataFrame, vessel: str = "VESSEL_ID", date: str = "LANDING_DATE",
                      trip: str = "SCHEDULE_NUMBER",
                      set_key: str = "ORIGINAL_BATCH_SEQUENCE_NUMBER",
                      flag: str = "in_buffer") -> DataFrame:
    """Trips and sets by vessel and year, in-zone counts and shares.

    Columns: VESSEL_ID, YEAR, n_trips, n_sets, n_trips_in, n_sets_in,
    perc_trips_in, perc_sets_in.  Shares are rounded half-even to two
    places; every missing value (keys included) becomes 0 / "0".
    """
    g = trips_sets_counts(tagged, vessel, date, trip, set_key, flag)
    out = g.select(
        "VESSEL_ID", "YEAR", "n_trips", "n_sets", "n_trips_in", "n_sets_in",
        share("n_trips_in", "n_trips").alias("perc_trips_in"),
        share("n_sets_in", "n_sets").alias("perc_sets_in"))
    return fill_missing(out)


def flagged_sets(rows: DataFrame, vessel: str = "VESSEL_ID", date: str = "LANDING_DATE",
                 trip: str = "SCHEDULE_NUMBER", set_key: str = "ORIGINAL_BATCH_SEQUENCE_NUMBER",
                 within: str = "within") -> DataFrame:
    """One row per (VESSEL_ID, YEAR, trip ``__t``, set ``__s``) with ``in_buffer``.

    ``in_buffer`` is "Y" when any row of the set key is within the buffer,
    on every row of that key; a missing key is one key.

    1. "any row within" per (vessel, year, trip, set): partial aggregation
       collapses repeated rows, hot keys included, before the shuffle; written,
       since both later steps read it, so the logbook is read once;
    2. the hit keys: a map-side-combined maximum per set key over step 1,
       of which only the keys with a hit are kept;
    3. step 1 left-joined to the hit keys, null-safely.  A set key shared by
       many vessels is a skewed left side, which AQE splits; rows without a
       set key are spread over ``NULL_SPREAD`` join keys and the one hit row
       of the missing key is repeated for each.
    """
    g1 = rows.groupBy(F.col(vessel).alias("VESSEL_ID"), year_text(date).alias("YEAR"),
                      F.col(trip).alias("__t"), F.col(set_key).alias("__s")).agg(
        F.max(F.coalesce(F.col(within), F.lit(False)).cast("int")).alias("__w"))
    g1 = write_table(g1, "set-rows")
    hits = (g1.groupBy("__s").agg(F.max("__w").alias("__w")).where("__w = 1")
              .select(F.col("__s").alias("__k"), F.explode(
                  F.when(F.col("__s").isNull(), F.sequence(F.lit(0), F.lit(NULL_SPREAD - 1)))
                   .otherwise(F.array(F.lit(0)))).alias("__n"), F.lit(True).alias("__hit")))
    spread = F.when(F.col("__s").isNull(), F.pmod(F.hash("VESSEL_ID", "YEAR", "__t"), F.lit(NULL_SPREAD))
                    ).otherwise(F.lit(0))
    g1 = g1.withColumn("__p", spread)
    j = g1.join(hits, g1["__s"].eqNullSafe(hits["__k"]) & (g1["__p"] == hits["__n"]), "left")
    return j.select("VESSEL_ID", "YEAR", "__t", "__s",
                    F.when(F.col("__hit"), F.lit("Y")).otherwise(F.lit("N")).alias("in_buffer"))


def trips_sets_report_from_rows(rows: DataFrame, vessel: str = "VESSEL_ID",
                                date: str = "LANDING_DATE", trip: str = "SCHEDULE_NUMBER",
                                set_key: str = "ORIGINAL_BATCH_SEQUENCE_NUMBER",
                                within: str = "within") -> DataFrame:
    """``trips_sets_report`` straight from per-row zone flags.

    Same result as tagging every row at set-key grain and then reporting,
    with less data moved (see ``flagged_sets``).  Duplicate rows never
    change a distinct count or an "any" flag, so the input need not be
    DISTINCT.
    """
    return trips_sets_report(flagged_sets(rows, vessel, date, trip, set_key, within), vessel="VESSEL_ID",
                             date="YEAR", trip="__t", set_key="__s", flag="in_buffer")


# Partial sums of pounds and dollars: wide enough for any table, three decimals.
PARTIAL = "decimal(28,3)"
MEASURES = ["dw", "revenue"]
# The landings report's sheets and their keys.
GRAINS = {"VesselYearSpecies": ["VESSEL_ID", "YEAR", "COMMON_NAME"], "VesselYear": ["VESSEL_ID", "YEAR"],
          "Vessel": ["VESSEL_ID"]}


def partial_sums(rows: DataFrame, keys: dict[str, Column], dw: Column, revenue: Column,
                 skip_revenue: bool = False) -> DataFrame:
    """Mergeable sums by ``keys``: per measure the sum of the present amounts
    and how many are missing (``dw``, ``dw_missing``, ``revenue``, ...).

    Merging is plain addition, so these can be split, flagged and summed again
    to any coarser keys; ``skip_revenue`` leaves missing dollars uncounted.
    """
    def missing(c: Column, skip: bool) -> Column:
        return F.lit(0).cast("long") if skip else F.count(F.when(c.isNull(), F.lit(1)))

    return rows.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.sum(dw).cast(PARTIAL).alias("dw"), missing(dw, False).alias("dw_missing"),
        F.sum(revenue).cast(PARTIAL).alias("revenue"), missing(revenue, skip_revenue).alias("revenue_missing"))


def merged(measure: str, test: Column) -> Column:
    """A measure's sum over the partial rows where ``test`` holds: 0 without
    rows, NULL when an amount is missing."""
    missing = F.coalesce(F.sum(F.when(test, F.col(f"{measure}_missing"))), F.lit(0))
    return F.when(missing == 0, F.coalesce(F.sum(F.when(test, F.col(measure))), F.lit(0)))


def _sides() -> list[Column]:
    return [merged(m, F.col("in_area") == level).alias(f"{name}_{side}")
            for m, name in zip(MEASURES, ("DW_LBS", "REVENUE")) for level, side in enumerate(("OUT", "IN"))]


def landings(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Flagged partial sums to one row per ``keys``: pounds and dollars out and in."""
    return parts.groupBy(*keys).agg(*_sides()).select(*keys, "DW_LBS_OUT", "DW_LBS_IN", "REVENUE_OUT", "REVENUE_IN")


def landings_grains(parts: DataFrame) -> DataFrame:
    """All ``GRAINS`` in one pass (grouping sets, told apart by their id): ``sheet``, keys and measures.

    Within the finest grain rows of the two ledgers stay apart, as in an append
    of their summaries.
    """
    finest = [*GRAINS["VesselYearSpecies"], "ledger"]
    sets = [[F.col(c) for c in (finest if len(keys) == 3 else keys)] for keys in GRAINS.values()]
    out = parts.groupingSets(sets, *finest).agg(F.grouping_id().alias("gid"), *_sides())
    # A key that a grain sums over has its bit set in the id, the last key the lowest one.
    sheet = F.when(F.col("gid") == 0, F.lit("VesselYearSpecies")).when(F.col("gid") == 3, F.lit("VesselYear")).otherwise(F.lit("Vessel"))
    return out.select(sheet.alias("sheet"), *GRAINS["VesselYearSpecies"], "DW_LBS_OUT", "DW_LBS_IN", "REVENUE_OUT", "REVENUE_IN")


def with_shares(df: DataFrame) -> DataFrame:
    """Add totals and in-shares to a landings summary (per row)."""
    return df.select(
        "*",
        (F.col("DW_LBS_OUT") + F.col("DW_LBS_IN")).alias("TOT_DW_LBS"),
        share("DW_LBS_IN", F.col("DW_LBS_OUT") + F.col("DW_LBS_IN"), scale=3).alias("DW_LBS_IN_PERC"),
        (F.col("REVENUE_IN") + F.col("REVENUE_OUT")).alias("TOT_REV"),
        share("REVENUE_IN", F.col("REVENUE_IN") + F.col("REVENUE_OUT"), scale=3).alias("REVENUE_IN_PERC"))


def money_to_double(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (report edge only)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])

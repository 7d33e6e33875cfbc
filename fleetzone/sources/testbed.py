"""Reference-shaped tables derived from the driver's TPC-style tables.

The analyses read a fisheries logbook, two dealer ledgers and an observer
haul log.  The test data holds TPC-style tables instead, so each role is a
plain projection of one (or, for the dealer ledger, two) of those tables.
Every stand-in reads whole tables: no row cap, no id subset.  Values that
need a missing case get one with ``nullif``/``CASE`` so every
missing-value rule is exercised.

==========================  ===============================================
role                        derived from
==========================  ===============================================
logbook trips               orders (trip = order, vessel = customer)
logbook activities          lineitem (set = order + line number)
gears, catches, details     lineitem, 0 to 2 rows per set, gear and catch
gear codes                  supplier
species codes               part
trip QC                     lineitem, deleted when the return flag is R
logbook view                lineitem joined to orders
dealer ledger               lineitem joined to orders
second ledger               orders
observer trips / summary    customer (vessel = market segment)
observer hauls              events (four positions per haul)
observer animals            lineitem (haul = order key)
==========================  ===============================================

The SQL twins of these projections live in ``fleetzone.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(col: str) -> Column:
    return F.col(col).cast("string")


def _d(col: str) -> Column:
    return F.to_date(F.col(col))


def _dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _set_key() -> Column:
    return F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"))


def _activity_key() -> Column:
    """Unique for (nearly) every set row, so the lower tables fan out by their own counts only."""
    return F.concat_ws("-", _set_key(), _s("l_partkey"), _s("l_suppkey"))


def _repeated(df: DataFrame, twice: str) -> DataFrame:
    """Each row once with ``n`` = 1, and again with ``n`` = 2 where ``twice`` holds."""
    return df.withColumn("n", F.explode(F.expr(f"CASE WHEN {twice} THEN array(1, 2) ELSE array(1) END")))


def _clock(hour: str, minute: str) -> str:
    return f"lpad(CAST(1 + {hour} % 12 AS STRING), 2, '0') || ':' || lpad(CAST({minute} % 60 AS STRING), 2, '0')"


def _day(n: str) -> str:
    return (f"'2019-' || lpad(CAST(1 + {n} % 12 AS STRING), 2, '0') || '-' || "
            f"lpad(CAST(1 + {n} % 28 AS STRING), 2, '0')")


# Invented values in SQL that Spark and DuckDB read alike: the twins use the
# same definitions of the test data.
ACTIVITY_TIMES = {
    "BEGIN_SET_TIME": _clock("l_partkey", "l_suppkey"),
    "BEGIN_SET_MERIDIAN": "CASE WHEN l_partkey % 2 = 0 THEN 'AM' ELSE 'PM' END",
    "END_SET_TIME": _clock("(l_partkey + 3)", "(l_suppkey + 20)"),
    "END_SET_MERIDIAN": "CASE WHEN l_partkey % 3 = 0 THEN 'AM' WHEN l_partkey % 3 = 1 THEN 'PM' END",
    "HAULBACK_DATE": "CAST(l_shipdate AS DATE) + 1",
    "BEGIN_HAULBACK_TIME": _clock("(l_partkey + 5)", "(l_suppkey + 7)"),
    "BEGIN_HAULBACK_MERIDIAN": "CASE WHEN l_suppkey % 2 = 0 THEN 'AM' ELSE 'PM' END",
    "END_HAULBACK_TIME": _clock("(l_partkey + 9)", "(l_suppkey + 41)"),
    "END_HAULBACK_MERIDIAN": "CASE WHEN l_suppkey % 2 = 0 THEN 'PM' ELSE 'AM' END",
}
HAUL_EXTRA = {
    "GEAR_LOG_KEY": "CAST(event_id % 97 AS STRING)",
    "WAS_HAUL_OBSERVED": "CASE WHEN event_id % 5 = 0 THEN 'N' ELSE 'Y' END",
    "WAS_CATCH": "CASE WHEN event_id % 6 = 0 THEN 'N' ELSE 'Y' END",
    "GEAR_CONDITION": "CAST(event_id % 4 AS STRING)",
    "GEAR_CONDITION_DESC": "'condition ' || CAST(event_id % 4 AS STRING)",
    "MAINLINE_LENGTH": "CAST(event_id % 40 AS DOUBLE)",
    "BOTTOM_DEPTH_MINIMUM": "CAST(event_id % 300 AS DOUBLE)",
    "BOTTOM_DEPTH_MAXIMUM": "CAST(event_id % 300 + 50 AS DOUBLE)",
    "HOOK_DEPTH_MINIMUM": "CAST(user_id % 30 AS DOUBLE)",
    "HOOK_DEPTH_MAXIMUM": "CAST(user_id % 30 + 10 AS DOUBLE)",
    "TARGET_SPECIES": "CASE WHEN user_id % 8 <> 0 THEN 'SP' || CAST(user_id % 8 AS STRING) END",
    "NUMBER_HOOKS_SET": "CAST(event_id % 900 AS BIGINT)",
    "BEGIN_SET_DATE": _day("event_id"), "BEGIN_SET_TIME": _clock("event_id", "user_id"),
    "END_SET_DATE": _day("event_id"), "END_SET_TIME": _clock("(event_id + 2)", "user_id"),
    "BEGIN_HAUL_DATE": _day("(event_id + 1)"), "BEGIN_HAUL_TIME": _clock("(event_id + 5)", "user_id"),
    "END_HAUL_DATE": _day("(event_id + 1)"), "END_HAUL_TIME": _clock("(event_id + 8)", "user_id"),
    "HAUL_DURATION": "CAST(event_id % 12 AS DOUBLE)",
    "IS_EXPERIMENT": "CASE WHEN event_id % 50 = 0 THEN 'Y' ELSE 'N' END",
}
ANIMAL_EXTRA = {
    "CARCASS_TAG_NUMBER": "CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS STRING) END",
    "SPECIES_NAME": "'SP' || CAST(l_partkey % 6 AS STRING)",
    "LENGTH_MEASUREMENT_ONE": "CASE WHEN l_tax > 0 THEN l_quantity * 2 END",
    "LENGTH_TYPE_ONE": "CASE WHEN l_tax > 0 THEN 'FL' END",
    "LENGTH_MEASUREMENT_TAKEN_CODE": "CAST(l_linenumber % 3 AS STRING)",
    "LENGTH_MEASURE_TAKEN_CODE_D": "'taken ' || CAST(l_linenumber % 3 AS STRING)",
    "DRESSED_WEIGHT": "CASE WHEN l_discount > 0 THEN l_quantity / 2 END",
    "BOARDING_STATUS": "l_returnflag",
    "BOARDING_STATUS_DESC": "'status ' || l_returnflag",
    "KEPT_OR_RELEASED_DESC": "CASE WHEN l_linestatus = 'F' THEN 'kept' ELSE 'released' END",
    "TRIP_NUMBER": "CAST(l_suppkey AS STRING)",
    "HAUL_NUMBER": "CAST(l_linenumber AS BIGINT)",
    "BEGIN_HAUL_DATE": _day("l_orderkey"),
}


class StandIns:
    """Lazily built stand-in tables over one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return _read(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------ logbook
    def trips(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            _s("o_orderkey").alias("LOGBOOK_KEY"),
            F.date_format("o_orderdate", "yyyyMM").alias("BATCH_NUMBER"),
            _s("o_orderkey").alias("SCHEDULE_NUMBER"),
            _s("o_custkey").alias("VESSEL_ID"),
            _d("o_orderdate").alias("LANDING_DATE"))

    def activities(self) -> DataFrame:
        """One row per set; positions in degrees+minutes."""
        li = self.table("lineitem")
        return li.select(
            _s("l_orderkey").alias("LOGBOOK_KEY"), _activity_key().alias("FISHING_ACTIVITY_KEY"),
            _set_key().alias("ORIGINAL_BATCH_SEQUENCE_NUMBER"),
            _d("l_shipdate").alias("SET_DATE"),
            *[F.expr(e).alias(c) for c, e in ACTIVITY_TIMES.items()],
            (F.lit(38) + F.col("l_orderkey") % 4).cast("double").alias("LATITUDE_DEGREES"),
            F.nullif((F.col("l_partkey") * 7) % 60, F.lit(0)).cast("double").alias("LATITUDE_MINUTES"),
            F.when(F.col("l_suppkey") % 13 == 0, F.lit(None).cast("string"))
             .otherwise(F.lit("N")).alias("LATITUDE_HEMISPHERE"),
            (F.lit(64) + F.col("l_linenumber")).cast("double").alias("LONGITUDE_DEGREES"),
            ((F.col("l_suppkey") * 13) % 60).cast("double").alias("LONGITUDE_MINUTES"),
            F.when(F.col("l_partkey") % 17 == 0, F.lit(None).cast("string"))
             .otherwise(F.lit("W")).alias("LONGITUDE_HEMISPHERE"))

    def gears(self) -> DataFrame:
        """Gears fished: none, one or two per set."""
        return _repeated(self.table("lineitem").where("l_suppkey % 11 <> 3"), "l_suppkey % 10 = 0").select(
            _activity_key().alias("FISHING_ACTIVITY_KEY"),
            F.concat_ws("-", _activity_key(), _s("n")).alias("GEAR_FISHED_KEY"),
            (F.col("l_suppkey") + F.col("n") - 1).cast("string").alias("GEAR_CODE_NMFS"))

    def catches(self) -> DataFrame:
        """Catches of a set's first gear: none, one or two."""
        return _repeated(self.table("lineitem").where("l_suppkey % 11 <> 3 and l_partkey % 9 <> 4"),
                         "l_partkey % 10 = 0").select(
            F.concat_ws("-", _activity_key(), F.lit("1")).alias("GEAR_FISHED_KEY"),
            F.concat_ws("-", _activity_key(), F.lit("1"), _s("n")).alias("CATCH_KEY"),
            F.col("l_returnflag").alias("AREA_FISHED"),
            (F.col("l_partkey") + F.col("n") - 1).cast("string").alias("SPECIES_CODE_NMFS"),
            F.col("l_quantity").alias("TOTAL_WHOLE_POUNDS"))

    def catch_details(self) -> DataFrame:
        """Details of a set's first catch: one or two dispositions."""
        return _repeated(self.table("lineitem"), "l_partkey % 7 = 0").select(
            F.concat_ws("-", _activity_key(), F.lit("1"), F.lit("1")).alias("CATCH_KEY"),
            (F.nullif(F.col("l_partkey") % 5, F.lit(0)) + F.col("n") - 1).cast("bigint").alias("NUMBER_OF_INDIVIDUALS"),
            F.when(F.col("n") == 1, F.col("l_linestatus")).otherwise(F.lit("X")).alias("DISPOSITION_STATUS"))

    def gear_descriptions(self) -> DataFrame:
        """Two parameters per gear (joined by no output column)."""
        return _repeated(self.table("lineitem"), "true").select(
            F.concat_ws("-", _activity_key(), F.lit("1")).alias("GEAR_FISHED_KEY"),
            ((F.col("l_partkey") + F.col("n")) % 5).cast("string").alias("GEAR_PARAMETER_CODE"))

    def gear_parameters(self) -> DataFrame:
        return self.table("region").select(_s("r_regionkey").alias("GEAR_PARAMETER_CODE"))

    def logbook_tables(self) -> dict[str, DataFrame]:
        """The tables of the logbook extract by role."""
        return {"trips": self.trips(), "activities": self.activities(), "gears": self.gears(),
                "catches": self.catches(), "catch_details": self.catch_details(),
                "gear_codes": self.gear_codes(), "species_codes": self.species_codes(),
                "trip_qc": self.trip_qc()}

    def gear_codes(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(_s("s_suppkey").alias("GEAR_CODE_NMFS"),
                        F.col("s_name").alias("GEAR_NAME"),
                        _s("s_nationkey").alias("GEAR_CLASS"))

    def species_codes(self) -> DataFrame:
        p = self.table("part")
        return p.select(_s("p_partkey").alias("SPECIES_CODE_NMFS"),
                        F.col("p_type").alias("NMFS_COMMON"),
                        F.col("p_name").alias("SCIENTIFIC_NAME"),
                        F.col("p_brand").alias("SPECIES_ITIS"))

    def trip_qc(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(_s("l_orderkey").alias("SCHEDULE_NUMBER"),
                         F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("DELETED_DATE"))

    def logbook_view(self) -> DataFrame:
        """Flat logbook view: one row per catch, with trip and set ids."""
        li = self.table("lineitem")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        return j.select(
            F.year("l_shipdate").alias("SET_YEAR"),
            _s("o_custkey").alias("VESSEL_ID_NUMBER"),
            _s("l_orderkey").alias("TRIP_NUMBER"),
            F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("BATCH_SEQUENCE_NUMBER"),
            _s("l_partkey").alias("SPECIES_CODE"),
            F.col("l_quantity").alias("POUNDS"))

    # ------------------------------------------------------------ ledgers
    def dealer_ledger(self) -> DataFrame:
        li = self.table("lineitem")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        landed = _d("o_orderdate")
        return j.select(
            _s("o_custkey").alias("SUPPLIER_VESSEL_ID"),
            F.when(F.col("l_linenumber") == 3, F.date_add(landed, 1)).otherwise(landed).alias("DATE_LANDED"),
            F.concat(F.lit("Dealer "), _s("l_suppkey")).alias("CORPORATE_NAME"),
            F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("unique_report_no"),
            F.when(F.col("l_linenumber") == 2, F.lit(None).cast("string"))
             .otherwise(_s("l_orderkey")).alias("TRIP_ID"),
            F.nullif(F.col("l_returnflag"), F.lit("N")).alias("not_included"),
            F.year("o_orderdate").alias("YEAR_OF_LANDING"),
            F.concat(F.lit("SP"), (F.col("l_partkey") % 6).cast("string")).alias("COMMON_NAME_AS_REPORTED"),
            F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(_dec(F.col("l_quantity")))
             .cast("decimal(18,2)").alias("converted_dw"),
            F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(_dec(F.col("l_extendedprice")))
             .cast("decimal(18,2)").alias("TOTAL_DOLLARS"),
            _dec(F.col("l_quantity")).alias("REPORTED_QUANTITY"),
            _dec(F.col("l_discount") * 100).alias("PURCHASE_PRICE"))

    def second_ledger(self) -> DataFrame:
        """The second (annual) ledger, names already cleaned."""
        o = self.table("orders")
        landed = _d("o_orderdate")
        unit = (F.when(F.col("o_orderstatus") == "F", F.lit("ROUND"))
                 .when(F.col("o_orderstatus") == "O", F.lit("DRESSED"))
                 .when(F.col("o_orderkey") % 50 == 0, F.lit(None).cast("string"))
                 .otherwise(F.lit("DRESSED")))
        return o.select(
            _s("o_custkey").alias("COAST_GUARD_NBR"),
            F.when(F.col("o_orderkey") % 9 == 0, F.date_add(landed, 2)).otherwise(landed).alias("LANDING_DATE"),
            F.year("o_orderdate").alias("LANDING_YEAR"),
            F.col("o_orderpriority").alias("DEALER_NAME"),
            _s("o_orderkey").alias("DEALER_RPT_ID"),
            _dec(F.col("o_custkey") % 300 + 100).alias("REPORTED_QUANTITY"),
            _dec(F.col("o_totalprice")).alias("DOLLARS"),
            unit.alias("UNIT"))

    # ------------------------------------------------------------ observer
    def obs_trip_summary(self) -> DataFrame:
        c = self.table("customer")
        return c.select(_s("c_custkey").alias("TRIP_NUMBER"), F.col("c_mktsegment").alias("VESSEL_ID"))

    def obs_trip_log(self) -> DataFrame:
        c = self.table("customer")
        return c.select(_s("c_custkey").alias("TRIP_NUMBER"), F.col("c_name").alias("TRIP_NAME"),
                        _s("c_nationkey").alias("PORT_CODE"), F.col("c_acctbal").alias("TRIP_COST"))

    def obs_hauls(self) -> DataFrame:
        """Observer haul log: four positions per haul in degrees+minutes."""
        ev = self.table("events")
        e, u = F.col("event_id"), F.col("user_id")

        def deg(base, c):
            return (F.lit(base) + c).cast("double")

        return ev.select(
            _s("event_id").alias("HAUL_LOG_KEY"),
            F.col("event_type").alias("GEAR_CODE"),
            e.alias("HAUL_NUMBER"),
            F.col("value").alias("SOAK_DURATION"),
            deg(36, e % 7).alias("BEGIN_SET_LATITUDE"),
            ((e * 7) % 60).cast("double").alias("BEGIN_SET_LATITUDE_MINUTES"),
            F.lit("N").alias("BEGIN_SET_LATITUDE_HEMISPHERE"),
            deg(62, u % 9).alias("BEGIN_SET_LONGITUDE"),
            ((e * 13) % 60).cast("double").alias("BEGIN_SET_LONGITUDE_MINUTES"),
            F.lit("W").alias("BEGIN_SET_LONGITUDE_HEMISPHERE"),
            deg(37, e % 5).alias("END_SET_LATITUDE"),
            (F.nullif(e % 11, F.lit(0)) * 5).cast("double").alias("END_SET_LATITUDE_MINUTES"),
            F.lit("N").alias("END_SET_LATITUDE_HEMISPHERE"),
            deg(63, u % 7).alias("END_SET_LONGITUDE"),
            ((e * 17) % 60).cast("double").alias("END_SET_LONGITUDE_MINUTES"),
            F.lit("W").alias("END_SET_LONGITUDE_HEMISPHERE"),
            deg(38, u % 4).alias("BEGIN_HAUL_LATITUDE"),
            ((e * 11) % 60).cast("double").alias("BEGIN_HAUL_LATITUDE_MINUTES"),
            F.when(e % 23 == 0, F.lit(None).cast("string")).otherwise(F.lit("N"))
             .alias("BEGIN_HAUL_LATITUDE_HEMISPHERE"),
            deg(64, e % 6).alias("BEGIN_HAUL_LONGITUDE"),
            ((u * 7) % 60).cast("double").alias("BEGIN_HAUL_LONGITUDE_MINUTES"),
            F.lit("W").alias("BEGIN_HAUL_LONGITUDE_HEMISPHER"),
            deg(39, e % 3).alias("END_HAUL_LATITUDE"),
            ((e * 19) % 60).cast("double").alias("END_HAUL_LATITUDE_MINUTES"),
            F.lit("N").alias("END_HAUL_LATITUDE_HEMISPHERE"),
            F.when(u % 10 == 0, F.lit(None).cast("double")).otherwise(deg(65, e % 4))
             .alias("END_HAUL_LONGITUDE"),
            ((e * 29) % 60).cast("double").alias("END_HAUL_LONGITUDE_MINUTES"),
            F.lit("W").alias("END_HAUL_LONGITUDE_HEMISPHERE"),
            F.col("props").alias("FISHING_AREA"),
            _s("user_id").alias("TRIP_NUMBER"), *[F.expr(x).alias(c) for c, x in HAUL_EXTRA.items()])

    def obs_animals(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("ANIMAL_LOG_KEY"),
            _s("l_orderkey").alias("HAUL_LOG_KEY"),
            _s("l_partkey").alias("ALPHA_SPECIES_CODE"),
            F.col("l_linestatus").alias("KEPT_OR_RELEASED"),
            F.col("l_quantity").alias("ESTIMATED_WEIGHT"),
            _s("l_suppkey").alias("TAG_NUMBER"), *[F.expr(x).alias(c) for c, x in ANIMAL_EXTRA.items()])

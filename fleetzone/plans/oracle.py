"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL text runs on the driver's tables registered as views.  The SQL is
written the plain way on purpose (literal left join then IS NULL,
separate aggregates merged by full outer joins, points crossed with every
zone edge, correlated EXISTS), so it checks the Spark plans' rewrites
rather than repeating them.
"""

from __future__ import annotations

import math

from ..operators import geo
from ..sources import testbed
from ..sources.zones import TEST_ZONES
from . import registry as R


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def sql_project(lon: str, lat: str) -> tuple[str, str]:
    phi = f"({lat} * {_d(geo.RAD)})"
    arc = (f"({_d(geo.GRS80_A)} * ((({_d(geo.C0)} * {phi} - {_d(geo.C2)} * sin({phi} * {_d(2.0)}))"
           f" + {_d(geo.C4)} * sin({phi} * {_d(4.0)})) - {_d(geo.C6)} * sin({phi} * {_d(6.0)})))")
    rho = f"({_d(geo.A_G)} - {arc})"
    theta = f"({_d(geo.CONE_N)} * (({lon} - {_d(geo.LON_ORIGIN)}) * {_d(geo.RAD)}))"
    return f"({rho} * sin({theta}))", f"({_d(geo.RHO0)} - {rho} * cos({theta}))"


def _unproject(points: str) -> str:
    """Degrees of projected metres, the slow way: the cone's constants anew
    from its definition, the latitude by six Newton steps from the origin's."""
    a, f = 6378137.0, 1 / 298.257222101
    e = f * (2 - f)
    series = [1 - e / 4 - 3 * e ** 2 / 64 - 5 * e ** 3 / 256, -(3 * e / 8 + 3 * e ** 2 / 32 + 45 * e ** 3 / 1024),
              15 * e ** 2 / 256 + 45 * e ** 3 / 1024, -35 * e ** 3 / 3072]

    def arc(phi):
        return a * (series[0] * phi + sum(series[k] * math.sin(2 * k * phi) for k in (1, 2, 3)))

    def radius(phi):
        return a * math.cos(phi) / math.sqrt(1 - e * math.sin(phi) ** 2)
    low, high, origin = (math.radians(d) for d in (33.0, 45.0, 39.0))
    cone = (radius(low) - radius(high)) / (arc(high) - arc(low))
    apex = arc(low) + radius(low) / cone
    sql_arc = f"{_d(a)} * ({_d(series[0])} * phi" + "".join(
        f" + {_d(series[k])} * sin({2 * k} * phi)" for k in (1, 2, 3)) + ")"
    sql_slope = f"{_d(a)} * ({_d(series[0])}" + "".join(
        f" + {_d(2 * k * series[k])} * cos({2 * k} * phi)" for k in (1, 2, 3)) + ")"
    out = (f"SELECT x_m, y_m, {_d(apex)} - sqrt(x_m::DOUBLE * x_m + ({_d(apex - arc(origin))} - y_m) * "
           f"({_d(apex - arc(origin))} - y_m)) AS arc, {_d(origin)} AS phi FROM {points}")
    for _ in range(6):
        out = f"SELECT x_m, y_m, arc, phi - ({sql_arc} - arc) / ({sql_slope}) AS phi FROM ({out})"
    return (f"SELECT x_m, y_m, round(-96.0::DOUBLE + degrees(atan2(x_m::DOUBLE, {_d(apex - arc(origin))} - y_m) / {_d(cone)}), 6) "
            f"AS lon_dd, round(degrees(phi), 6) AS lat_dd FROM ({out})")


def sql_share(m: str, n: str, scale: int = 0) -> str:
    """round(m / n, 2) half-even, exact; NULL when n is 0 or NULL."""
    unit = 10 ** scale
    mm = f"CAST(({m}) * {unit} AS HUGEINT)"
    nn = f"CAST(({n}) * {unit} AS HUGEINT)"
    q = f"(({mm} * 100) // {nn})"
    r = f"(({mm} * 100) % {nn})"
    return (f"(CASE WHEN {nn} = 0 OR {nn} IS NULL THEN NULL ELSE "
            f"CAST({q} + CASE WHEN 2 * {r} > {nn} OR (2 * {r} = {nn} AND {q} % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE)"
            f" / {_d(100.0)} END)")


def nd(col: str) -> str:
    """Distinct count with NULL counted as one value."""
    return f"(count(DISTINCT {col}) + coalesce(max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END), 0))"


def strict_sum(col: str) -> str:
    return f"(CASE WHEN count({col}) = count(*) THEN sum({col}) END)"


def dms(deg: str, mins: str, hemi: str, axis: str) -> str:
    pos, neg, usual = ("N", "S", "N") if axis == "lat" else ("E", "W", "W")
    val = f"({deg} + {mins} / {_d(60.0)})"
    letter = f"CASE WHEN {hemi} IS NULL OR trim({hemi}) = '' THEN '{usual}' ELSE upper(trim({hemi})) END"
    return f"(CASE {letter} WHEN '{neg}' THEN -{val} WHEN '{pos}' THEN {val} END)"


# --------------------------------------------------------------------------
# Stand-in tables
# --------------------------------------------------------------------------

_SET = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
_ACT = f"{_SET} || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)"
_TWICE = "(VALUES (1), (2)) twice(n)"


def _named(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in columns.items())


BASE = {
    "trips": """SELECT CAST(o_orderkey AS VARCHAR) AS LOGBOOK_KEY, strftime(o_orderdate, '%Y%m') AS BATCH_NUMBER,
        CAST(o_orderkey AS VARCHAR) AS SCHEDULE_NUMBER, CAST(o_custkey AS VARCHAR) AS VESSEL_ID,
        CAST(o_orderdate AS DATE) AS LANDING_DATE FROM orders""",
    "activities": f"""SELECT CAST(l_orderkey AS VARCHAR) AS LOGBOOK_KEY,
        {_ACT} AS FISHING_ACTIVITY_KEY, {_SET} AS ORIGINAL_BATCH_SEQUENCE_NUMBER,
        CAST(l_shipdate AS DATE) AS SET_DATE, {_named(testbed.ACTIVITY_TIMES)},
        CAST(38 + l_orderkey % 4 AS DOUBLE) AS LATITUDE_DEGREES,
        CAST(NULLIF((l_partkey * 7) % 60, 0) AS DOUBLE) AS LATITUDE_MINUTES,
        CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE 'N' END AS LATITUDE_HEMISPHERE,
        CAST(64 + l_linenumber AS DOUBLE) AS LONGITUDE_DEGREES,
        CAST((l_suppkey * 13) % 60 AS DOUBLE) AS LONGITUDE_MINUTES,
        CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE 'W' END AS LONGITUDE_HEMISPHERE FROM lineitem""",
    "gears": f"""SELECT {_ACT} AS FISHING_ACTIVITY_KEY, {_ACT} || '-' || CAST(n AS VARCHAR) AS GEAR_FISHED_KEY,
        CAST(l_suppkey + n - 1 AS VARCHAR) AS GEAR_CODE_NMFS FROM lineitem, {_TWICE}
        WHERE l_suppkey % 11 <> 3 AND (n = 1 OR l_suppkey % 10 = 0)""",
    "catches": f"""SELECT {_ACT} || '-1' AS GEAR_FISHED_KEY, {_ACT} || '-1-' || CAST(n AS VARCHAR) AS CATCH_KEY,
        l_returnflag AS AREA_FISHED, CAST(l_partkey + n - 1 AS VARCHAR) AS SPECIES_CODE_NMFS,
        l_quantity AS TOTAL_WHOLE_POUNDS FROM lineitem, {_TWICE}
        WHERE l_suppkey % 11 <> 3 AND l_partkey % 9 <> 4 AND (n = 1 OR l_partkey % 10 = 0)""",
    "catch_details": f"""SELECT {_ACT} || '-1-1' AS CATCH_KEY,
        CAST(NULLIF(l_partkey % 5, 0) + n - 1 AS BIGINT) AS NUMBER_OF_INDIVIDUALS,
        CASE WHEN n = 1 THEN l_linestatus ELSE 'X' END AS DISPOSITION_STATUS FROM lineitem, {_TWICE}
        WHERE n = 1 OR l_partkey % 7 = 0""",
    "gear_codes": """SELECT CAST(s_suppkey AS VARCHAR) AS GEAR_CODE_NMFS, s_name AS GEAR_NAME,
        CAST(s_nationkey AS VARCHAR) AS GEAR_CLASS FROM supplier""",
    "species_codes": """SELECT CAST(p_partkey AS VARCHAR) AS SPECIES_CODE_NMFS, p_type AS NMFS_COMMON,
        p_name AS SCIENTIFIC_NAME, p_brand AS SPECIES_ITIS FROM part""",
    "trip_qc": """SELECT CAST(l_orderkey AS VARCHAR) AS SCHEDULE_NUMBER,
        CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS DELETED_DATE FROM lineitem""",
    "logbook_view": """SELECT year(l_shipdate) AS SET_YEAR, CAST(o_custkey AS VARCHAR) AS VESSEL_ID_NUMBER,
        CAST(l_orderkey AS VARCHAR) AS TRIP_NUMBER,
        CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS BATCH_SEQUENCE_NUMBER,
        CAST(l_partkey AS VARCHAR) AS SPECIES_CODE, l_quantity AS POUNDS
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "dealer": """SELECT CAST(o_custkey AS VARCHAR) AS SUPPLIER_VESSEL_ID,
        CASE WHEN l_linenumber = 3 THEN CAST(o_orderdate AS DATE) + 1 ELSE CAST(o_orderdate AS DATE) END AS DATE_LANDED,
        'Dealer ' || CAST(l_suppkey AS VARCHAR) AS CORPORATE_NAME,
        CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS unique_report_no,
        CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS TRIP_ID,
        NULLIF(l_returnflag, 'N') AS not_included,
        year(o_orderdate) AS YEAR_OF_LANDING,
        'SP' || CAST(l_partkey % 6 AS VARCHAR) AS COMMON_NAME_AS_REPORTED,
        CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS converted_dw,
        CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS TOTAL_DOLLARS,
        CAST(l_quantity AS DECIMAL(18,2)) AS REPORTED_QUANTITY,
        CAST(l_discount * 100 AS DECIMAL(18,2)) AS PURCHASE_PRICE
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ledger2": f"""SELECT * FROM (SELECT CAST(o_custkey AS VARCHAR) AS COAST_GUARD_NBR,
        CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderdate AS DATE) + 2 ELSE CAST(o_orderdate AS DATE) END AS LANDING_DATE,
        year(o_orderdate) AS LANDING_YEAR, o_orderpriority AS DEALER_NAME, CAST(o_orderkey AS VARCHAR) AS DEALER_RPT_ID,
        CAST(o_custkey % 300 + 100 AS DECIMAL(18,2)) AS REPORTED_QUANTITY,
        CAST(o_totalprice AS DECIMAL(18,2)) AS DOLLARS,
        CASE WHEN o_orderstatus = 'F' THEN 'ROUND' WHEN o_orderstatus = 'O' THEN 'DRESSED'
             WHEN o_orderkey % 50 = 0 THEN NULL ELSE 'DRESSED' END AS UNIT FROM orders)
        WHERE LANDING_YEAR > {R.SECOND_AFTER_YEAR}""",
    "obs_trip_log": """SELECT CAST(c_custkey AS VARCHAR) AS TRIP_NUMBER, c_name AS TRIP_NAME,
        CAST(c_nationkey AS VARCHAR) AS PORT_CODE, c_acctbal AS TRIP_COST FROM customer""",
    "obs_trip_summary": """SELECT CAST(c_custkey AS VARCHAR) AS TRIP_NUMBER, c_mktsegment AS VESSEL_ID FROM customer""",
    "obs_hauls": f"""SELECT CAST(event_id AS VARCHAR) AS HAUL_LOG_KEY, event_type AS GEAR_CODE,
        event_id AS HAUL_NUMBER, value AS SOAK_DURATION,
        CAST(36 + event_id % 7 AS DOUBLE) AS BEGIN_SET_LATITUDE,
        CAST((event_id * 7) % 60 AS DOUBLE) AS BEGIN_SET_LATITUDE_MINUTES,
        'N' AS BEGIN_SET_LATITUDE_HEMISPHERE,
        CAST(62 + user_id % 9 AS DOUBLE) AS BEGIN_SET_LONGITUDE,
        CAST((event_id * 13) % 60 AS DOUBLE) AS BEGIN_SET_LONGITUDE_MINUTES,
        'W' AS BEGIN_SET_LONGITUDE_HEMISPHERE,
        CAST(37 + event_id % 5 AS DOUBLE) AS END_SET_LATITUDE,
        CAST(NULLIF(event_id % 11, 0) * 5 AS DOUBLE) AS END_SET_LATITUDE_MINUTES,
        'N' AS END_SET_LATITUDE_HEMISPHERE,
        CAST(63 + user_id % 7 AS DOUBLE) AS END_SET_LONGITUDE,
        CAST((event_id * 17) % 60 AS DOUBLE) AS END_SET_LONGITUDE_MINUTES,
        'W' AS END_SET_LONGITUDE_HEMISPHERE,
        CAST(38 + user_id % 4 AS DOUBLE) AS BEGIN_HAUL_LATITUDE,
        CAST((event_id * 11) % 60 AS DOUBLE) AS BEGIN_HAUL_LATITUDE_MINUTES,
        CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'N' END AS BEGIN_HAUL_LATITUDE_HEMISPHERE,
        CAST(64 + event_id % 6 AS DOUBLE) AS BEGIN_HAUL_LONGITUDE,
        CAST((user_id * 7) % 60 AS DOUBLE) AS BEGIN_HAUL_LONGITUDE_MINUTES,
        'W' AS BEGIN_HAUL_LONGITUDE_HEMISPHER,
        CAST(39 + event_id % 3 AS DOUBLE) AS END_HAUL_LATITUDE,
        CAST((event_id * 19) % 60 AS DOUBLE) AS END_HAUL_LATITUDE_MINUTES,
        'N' AS END_HAUL_LATITUDE_HEMISPHERE,
        CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(65 + event_id % 4 AS DOUBLE) END AS END_HAUL_LONGITUDE,
        CAST((event_id * 29) % 60 AS DOUBLE) AS END_HAUL_LONGITUDE_MINUTES,
        'W' AS END_HAUL_LONGITUDE_HEMISPHERE,
        props AS FISHING_AREA, CAST(user_id AS VARCHAR) AS TRIP_NUMBER, {_named(testbed.HAUL_EXTRA)} FROM events""",
    "obs_animals": f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS ANIMAL_LOG_KEY,
        CAST(l_orderkey AS VARCHAR) AS HAUL_LOG_KEY, CAST(l_partkey AS VARCHAR) AS ALPHA_SPECIES_CODE,
        l_linestatus AS KEPT_OR_RELEASED, l_quantity AS ESTIMATED_WEIGHT,
        CAST(l_suppkey AS VARCHAR) AS TAG_NUMBER, {_named(testbed.ANIMAL_EXTRA)} FROM lineitem""",
}

SET_COLS = [c for c in R.jobs.EXTRACT_COLUMNS if c not in R.jobs.CATCH_COLUMNS]
_SOURCE = {"t": ["LOGBOOK_KEY", "BATCH_NUMBER", "SCHEDULE_NUMBER", "VESSEL_ID", "LANDING_DATE"],
           "g": ["GEAR_CODE_NMFS"], "gc": ["GEAR_NAME", "GEAR_CLASS"],
           "c": ["AREA_FISHED", "SPECIES_CODE_NMFS", "TOTAL_WHOLE_POUNDS"],
           "sc": ["NMFS_COMMON", "SCIENTIFIC_NAME", "SPECIES_ITIS"],
           "cd": ["NUMBER_OF_INDIVIDUALS", "DISPOSITION_STATUS"]}
EXTRACT_SELECT = ", ".join(next((t for t, cols in _SOURCE.items() if c in cols), "a") + "." + c
                           for c in R.jobs.EXTRACT_COLUMNS)
_D, _M, _Y = R.LANDED_AFTER.split("-")
_MONTHS = {m: i + 1 for i, m in enumerate(
    ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"])}
LANDED_AFTER_ISO = f"{_Y}-{_MONTHS[_M.upper()]:02d}-{int(_D):02d}"

DERIVED = {
    "logbook": f"""SELECT DISTINCT {EXTRACT_SELECT}
        FROM trips t LEFT JOIN activities a ON t.LOGBOOK_KEY = a.LOGBOOK_KEY
        LEFT JOIN gears g ON a.FISHING_ACTIVITY_KEY = g.FISHING_ACTIVITY_KEY
        LEFT JOIN catches c ON g.GEAR_FISHED_KEY = c.GEAR_FISHED_KEY
        LEFT JOIN gear_codes gc ON g.GEAR_CODE_NMFS = gc.GEAR_CODE_NMFS
        LEFT JOIN trip_qc qc ON t.SCHEDULE_NUMBER = qc.SCHEDULE_NUMBER
        LEFT JOIN species_codes sc ON c.SPECIES_CODE_NMFS = sc.SPECIES_CODE_NMFS
        LEFT JOIN catch_details cd ON c.CATCH_KEY = cd.CATCH_KEY
        WHERE t.LANDING_DATE > DATE '{LANDED_AFTER_ISO}' AND qc.DELETED_DATE IS NULL""",
    "sets": f"SELECT DISTINCT {', '.join(SET_COLS)} FROM logbook",
    "setpos": f"""SELECT *, {dms('LATITUDE_DEGREES', 'LATITUDE_MINUTES', 'LATITUDE_HEMISPHERE', 'lat')} AS lat_dd,
        {dms('LONGITUDE_DEGREES', 'LONGITUDE_MINUTES', 'LONGITUDE_HEMISPHERE', 'lon')} AS lon_dd FROM sets""",
}


def _edges_values() -> str:
    rows = []
    for zid, name, ring in TEST_ZONES:
        n = len(ring)
        for i in range(n):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
            rows.append(f"('{zid}', '{name}', {i}, {_d(x1)}, {_d(y1)}, {_d(x2)}, {_d(y2)})")
    return ",\n        ".join(rows)


def geo_ctes(src: str, prefix: str = "g") -> dict[str, str]:
    """CTEs classifying the distinct non-NULL (lon_dd, lat_dd) of ``src``.

    Produces ``{prefix}_pz(lon, lat, zone_id, inside)`` and
    ``{prefix}_tag(lon, lat, in_zone, within)``.
    """
    px1, py1 = sql_project("x1", "y1")
    px2, py2 = sql_project("x2", "y2")
    ppx, ppy = sql_project("lon", "lat")
    d2 = _d(geo.BUFFER_M * geo.BUFFER_M)
    return {
        f"{prefix}_e0": f"SELECT * FROM (VALUES {_edges_values()}) v(zone_id, name, edge_id, x1, y1, x2, y2)",
        f"{prefix}_e1": f"SELECT *, {px1} AS px1, {py1} AS py1, {px2} AS px2, {py2} AS py2 FROM {prefix}_e0",
        f"{prefix}_e": f"""SELECT *, px2 - px1 AS dx, py2 - py1 AS dy,
            (px2 - px1) * (px2 - px1) + (py2 - py1) * (py2 - py1) AS len2,
            CASE WHEN (px2 - px1) * (px2 - px1) + (py2 - py1) * (py2 - py1) > 0
                 THEN {_d(1.0)} / ((px2 - px1) * (px2 - px1) + (py2 - py1) * (py2 - py1)) ELSE {_d(0.0)} END AS inv_len2
            FROM {prefix}_e1""",
        f"{prefix}_p": f"""SELECT lon, lat, {ppx} AS px, {ppy} AS py FROM
            (SELECT DISTINCT lon_dd AS lon, lat_dd AS lat FROM {src} WHERE lon_dd IS NOT NULL AND lat_dd IS NOT NULL)""",
        f"{prefix}_pe0": f"""SELECT p.lon, p.lat, e.zone_id,
            CASE WHEN (e.y1 > p.lat) <> (e.y2 > p.lat)
                  AND p.lon < e.x1 + (p.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END AS crosses,
            CASE WHEN (e.x2 - e.x1) * (p.lat - e.y1) - (e.y2 - e.y1) * (p.lon - e.x1) = 0
                  AND p.lon >= least(e.x1, e.x2) AND p.lon <= greatest(e.x1, e.x2)
                  AND p.lat >= least(e.y1, e.y2) AND p.lat <= greatest(e.y1, e.y2) THEN 1 ELSE 0 END AS on_edge,
            p.px - e.px1 AS ax, p.py - e.py1 AS ay, e.dx, e.dy, e.len2, e.inv_len2
            FROM {prefix}_p p CROSS JOIN {prefix}_e e""",
        f"{prefix}_pe": f"""SELECT lon, lat, zone_id, crosses, on_edge,
            CASE WHEN ax * dx + ay * dy <= {_d(0.0)} THEN ax * ax + ay * ay
                 WHEN ax * dx + ay * dy >= len2 THEN (ax - dx) * (ax - dx) + (ay - dy) * (ay - dy)
                 ELSE (ax * dy - ay * dx) * (ax * dy - ay * dx) * inv_len2 END AS d2
            FROM {prefix}_pe0""",
        f"{prefix}_pz": f"""SELECT lon, lat, zone_id, (sum(crosses) % 2 = 1 OR max(on_edge) = 1) AS inside,
            min(d2) AS d2 FROM {prefix}_pe GROUP BY lon, lat, zone_id""",
        f"{prefix}_tag": f"""SELECT lon, lat, bool_or(inside) AS in_zone,
            (bool_or(inside) OR min(d2) <= {d2}) AS within FROM {prefix}_pz GROUP BY lon, lat""",
    }


LANDINGS = {
    "cls": """SELECT p.*, coalesce(g.within, false) AS within, coalesce(g.in_zone, false) AS in_zone
        FROM setpos p LEFT JOIN g_tag g ON p.lon_dd = g.lon AND p.lat_dd = g.lat""",
    "hitkeys": "SELECT DISTINCT ORIGINAL_BATCH_SEQUENCE_NUMBER AS k FROM cls WHERE within",
    "tagged": """SELECT c.*, CASE WHEN EXISTS (SELECT 1 FROM hitkeys h
        WHERE h.k IS NOT DISTINCT FROM c.ORIGINAL_BATCH_SEQUENCE_NUMBER) THEN 'Y' ELSE 'N' END AS in_buffer FROM cls c""",
    "tkeys": "SELECT DISTINCT VESSEL_ID, LANDING_DATE, SCHEDULE_NUMBER FROM cls WHERE within",
    "overrides": "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', DATE '{d}')" for k, d in R.OVERRIDES) + ") v(k, d)",
    "dated_keys": """SELECT ks.VESSEL_ID, ks.LANDING_DATE, ks.SCHEDULE_NUMBER,
        CASE WHEN ks.SCHEDULE_NUMBER IS NULL THEN NULL WHEN o.k IS NOT NULL THEN o.d ELSE ks.LANDING_DATE END AS dealer_date
        FROM tkeys ks LEFT JOIN overrides o ON ks.SCHEDULE_NUMBER = o.k""",
    "dealer_flagged": """SELECT d.*, CAST(CASE WHEN EXISTS (SELECT 1 FROM dated_keys k
        WHERE k.VESSEL_ID IS NOT DISTINCT FROM d.SUPPLIER_VESSEL_ID
          AND k.dealer_date IS NOT DISTINCT FROM d.DATE_LANDED) THEN 1 ELSE 0 END AS BIGINT) AS in_area FROM dealer d""",
    "ledger2_flagged": """SELECT s.*, CAST(CASE WHEN EXISTS (SELECT 1 FROM dated_keys k
        WHERE k.VESSEL_ID IS NOT DISTINCT FROM s.COAST_GUARD_NBR
          AND k.dealer_date IS NOT DISTINCT FROM s.LANDING_DATE) THEN 1 ELSE 0 END AS BIGINT) AS in_area,
        CASE WHEN UNIT IS NULL THEN NULL WHEN UNIT = 'ROUND' THEN REPORTED_QUANTITY * CAST(0.8 AS DECIMAL(2,1))
             ELSE REPORTED_QUANTITY END AS dw_lb FROM ledger2 s""",
    "edlr_g": f"""SELECT SUPPLIER_VESSEL_ID AS VESSEL_ID, YEAR_OF_LANDING AS YEAR,
        COMMON_NAME_AS_REPORTED AS COMMON_NAME, in_area,
        {strict_sum('converted_dw')} AS dw_lb, coalesce(sum(TOTAL_DOLLARS), 0) AS revenue
        FROM dealer_flagged WHERE not_included IS NULL GROUP BY ALL""",
    "bft_g": f"""SELECT COAST_GUARD_NBR AS VESSEL_ID, LANDING_YEAR AS YEAR, 'Bluefin' AS COMMON_NAME, in_area,
        {strict_sum('dw_lb')} AS dw_lb, {strict_sum('DOLLARS')} AS revenue FROM ledger2_flagged GROUP BY ALL""",
}


def _pivot(src: str) -> str:
    def cell(measure, level):
        return (f"CASE WHEN count(*) FILTER (WHERE in_area = {level}) = 0 THEN 0 "
                f"ELSE max({measure}) FILTER (WHERE in_area = {level}) END")
    return (f"SELECT VESSEL_ID, YEAR, COMMON_NAME, {cell('dw_lb', 0)} AS DW_LBS_OUT, {cell('dw_lb', 1)} AS DW_LBS_IN, "
            f"{cell('revenue', 0)} AS REVENUE_OUT, {cell('revenue', 1)} AS REVENUE_IN FROM {src} GROUP BY ALL")


LANDINGS.update({
    "edlr_summary": _pivot("edlr_g"),
    "bft_summary": _pivot("bft_g"),
    "f_summary": "SELECT * FROM edlr_summary UNION ALL BY NAME SELECT * FROM bft_summary",
    "f_summary_sp": f"""SELECT *, DW_LBS_OUT + DW_LBS_IN AS TOT_DW_LBS,
        {sql_share('DW_LBS_IN', 'DW_LBS_OUT + DW_LBS_IN', 3)} AS DW_LBS_IN_PERC,
        REVENUE_IN + REVENUE_OUT AS TOT_REV,
        {sql_share('REVENUE_IN', 'REVENUE_IN + REVENUE_OUT', 3)} AS REVENUE_IN_PERC FROM f_summary""",
})


def _rollup_sql(keys: str) -> str:
    sums = ", ".join(f"{strict_sum(c)} AS {c}" for c in
                     ["DW_LBS_OUT", "DW_LBS_IN", "REVENUE_IN", "REVENUE_OUT", "TOT_DW_LBS", "TOT_REV"])
    return (f"SELECT *, {sql_share('DW_LBS_IN', 'DW_LBS_OUT + DW_LBS_IN', 3)} AS DW_LBS_IN_PERC, "
            f"{sql_share('REVENUE_IN', 'REVENUE_IN + REVENUE_OUT', 3)} AS REVENUE_IN_PERC "
            f"FROM (SELECT {keys}, {sums} FROM f_summary_sp GROUP BY {keys})")


def _money(select_sql: str, money: list[str], others: str) -> str:
    return f"SELECT {others}, " + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in money) + f" FROM ({select_sql})"


POS_KINDS = {"begin_set": "BEGIN_SET", "end_set": "END_SET", "begin_haul": "BEGIN_HAUL", "end_haul": "END_HAUL"}


def _haul_wide() -> str:
    cols = ["coalesce(TRIP_NUMBER, 'NA') || '.' || coalesce(CAST(HAUL_NUMBER AS VARCHAR), 'NA') AS trip_haul"]
    for k, s in POS_KINDS.items():
        lon_h = f"{s}_LONGITUDE_HEMISPHER" if k == "begin_haul" else f"{s}_LONGITUDE_HEMISPHERE"
        cols.append(f"{dms(f'{s}_LATITUDE', f'{s}_LATITUDE_MINUTES', f'{s}_LATITUDE_HEMISPHERE', 'lat')} AS {k}_lat_dd")
        cols.append(f"{dms(f'{s}_LONGITUDE', f'{s}_LONGITUDE_MINUTES', lon_h, 'lon')} AS {k}_lon_dd")
    return "SELECT " + ", ".join(cols) + " FROM obs_hauls"


OBS = {
    "obs_keys": f"SELECT TRIP_NUMBER FROM obs_trip_summary WHERE VESSEL_ID = '{R.OBS_VESSEL}'",
    "x_hauls": "SELECT * FROM obs_hauls WHERE TRIP_NUMBER IN (SELECT TRIP_NUMBER FROM obs_keys)",
    "haul_wide": _haul_wide(),
    "positions": " UNION ALL ".join(
        f"SELECT trip_haul, {k}_lat_dd AS lat_dd, {k}_lon_dd AS lon_dd, '{k}' AS location_type FROM haul_wide"
        for k in POS_KINDS),
    "positions_nn": """SELECT * FROM positions WHERE trip_haul IS NOT NULL AND lat_dd IS NOT NULL
        AND lon_dd IS NOT NULL AND location_type IS NOT NULL""",
}


def with_ctes(body: str, *groups: dict[str, str]) -> str:
    """Assemble ``WITH`` from the CTE groups (only those the text uses,
    plus whatever they use)."""
    allc: dict[str, str] = {}
    for g in groups:
        allc.update(g)
    used: list[str] = []

    def need(text):
        for name, sql in allc.items():
            if name not in used and _mentions(text, name):
                used.append(name)
                need(sql)

    need(body)
    order = [n for n in allc if n in used]
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({allc[n]})" for n in order) + "\n" + body


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", text) is not None


LOGBOOK = {**BASE, **DERIVED, **geo_ctes("setpos"), **LANDINGS}
OBSERVER = {**BASE, **OBS, **geo_ctes("positions_nn", "h")}


def q(body: str) -> str:
    return with_ctes(body, LOGBOOK, OBSERVER)


def _flag_either() -> str:
    return """SELECT unique_report_no, SUPPLIER_VESSEL_ID, DATE_LANDED, TRIP_ID,
        CASE WHEN EXISTS (SELECT 1 FROM tkeys k WHERE k.VESSEL_ID IS NOT DISTINCT FROM d.SUPPLIER_VESSEL_ID
                          AND k.LANDING_DATE IS NOT DISTINCT FROM d.DATE_LANDED)
               OR EXISTS (SELECT 1 FROM tkeys k WHERE k.SCHEDULE_NUMBER IS NOT DISTINCT FROM d.TRIP_ID)
             THEN 1 ELSE 0 END::BIGINT AS area_activity FROM dealer d"""


def _counts(src: str, col: str, name: str, where: str = "") -> str:
    return (f"SELECT VESSEL_ID, substr(CAST(LANDING_DATE AS VARCHAR), 1, 4) AS YEAR, {nd(col)} AS {name} "
            f"FROM {src} {where} GROUP BY ALL")


def _merge() -> str:
    parts = [("f_trips", _counts("sets", "SCHEDULE_NUMBER", "n_trips")),
             ("f_sets", _counts("sets", "ORIGINAL_BATCH_SEQUENCE_NUMBER", "n_sets")),
             ("f_trips_in", _counts("tagged", "SCHEDULE_NUMBER", "n_trips_in", "WHERE in_buffer = 'Y'")),
             ("f_sets_in", _counts("tagged", "ORIGINAL_BATCH_SEQUENCE_NUMBER", "n_sets_in", "WHERE in_buffer = 'Y'"))]
    ctes = ", ".join(f"{n} AS ({s})" for n, s in parts)
    return f"""SELECT * FROM (WITH {ctes},
        m1 AS (SELECT coalesce(a.VESSEL_ID, b.VESSEL_ID) AS VESSEL_ID, coalesce(a.YEAR, b.YEAR) AS YEAR, n_trips, n_sets
               FROM f_trips a FULL OUTER JOIN f_sets b
               ON a.VESSEL_ID IS NOT DISTINCT FROM b.VESSEL_ID AND a.YEAR IS NOT DISTINCT FROM b.YEAR),
        m2 AS (SELECT coalesce(a.VESSEL_ID, b.VESSEL_ID) AS VESSEL_ID, coalesce(a.YEAR, b.YEAR) AS YEAR,
                      n_trips, n_sets, n_trips_in
               FROM m1 a FULL OUTER JOIN f_trips_in b
               ON a.VESSEL_ID IS NOT DISTINCT FROM b.VESSEL_ID AND a.YEAR IS NOT DISTINCT FROM b.YEAR)
        SELECT coalesce(a.VESSEL_ID, b.VESSEL_ID) AS VESSEL_ID, coalesce(a.YEAR, b.YEAR) AS YEAR,
               n_trips, n_sets, n_trips_in, n_sets_in
        FROM m2 a FULL OUTER JOIN f_sets_in b
        ON a.VESSEL_ID IS NOT DISTINCT FROM b.VESSEL_ID AND a.YEAR IS NOT DISTINCT FROM b.YEAR)"""


YEARS = [str(y) for y in range(1996, 2002)]  # landing years of the test tables


def _wide(col: str, name: str) -> str:
    cells = ", ".join(f"max({name}) FILTER (WHERE YEAR = '{y}') AS \"{y}\"" for y in YEARS)
    return f"SELECT VESSEL_ID, {cells} FROM ({_counts('sets', col, name)}) GROUP BY VESSEL_ID"


def _null_profile() -> str:
    cols = []
    for k, s in POS_KINDS.items():
        for axis in ("LATITUDE", "LONGITUDE"):
            base = f"{s}_{axis}"
            hemi = f"{s}_LONGITUDE_HEMISPHER" if (k == "begin_haul" and axis == "LONGITUDE") else f"{base}_HEMISPHERE"
            cols += [(base, True), (f"{base}_MINUTES", True), (hemi, False)]
    parts = []
    for c, is_double in cols:
        miss = f"({c} IS NULL OR isnan({c}))" if is_double else f"({c} IS NULL)"
        parts.append(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {miss}) AS n_missing, "
                     f"count(*) FILTER (WHERE NOT {miss}) AS n_present FROM obs_hauls")
    return " UNION ALL ".join(parts)


def _hemi_tally() -> str:
    cols = []
    for k, s in POS_KINDS.items():
        cols.append(f"{s}_LATITUDE_HEMISPHERE")
        cols.append(f"{s}_LONGITUDE_HEMISPHER" if k == "begin_haul" else f"{s}_LONGITUDE_HEMISPHERE")
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM obs_hauls" for c in cols]
    return f"SELECT column_name, value, count(*) AS n FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL GROUP BY ALL"


_FLEET = ", ".join(f"'{v}'" for v in R.FLEET)
_MARK = "'Vessel ID:' || ' ' || coalesce(VESSEL_ID, 'NA') || ' ' || '; Set Date:' || ' ' || coalesce(CAST(SET_DATE AS VARCHAR), 'NA')"
_DEALER_ALL = ("SUPPLIER_VESSEL_ID, DATE_LANDED, CORPORATE_NAME, unique_report_no, TRIP_ID, not_included, "
               "YEAR_OF_LANDING, COMMON_NAME_AS_REPORTED")
_DEALER_MONEY = ["converted_dw", "TOTAL_DOLLARS", "REPORTED_QUANTITY", "PURCHASE_PRICE"]
_SP_COLS = "VESSEL_ID, YEAR, COMMON_NAME"
_SP_MONEY = ["DW_LBS_OUT", "DW_LBS_IN", "REVENUE_OUT", "REVENUE_IN", "TOT_DW_LBS", "TOT_REV"]


_MATCH_AUDIT = """SELECT VESSEL_ID, LANDING_DATE, SCHEDULE_NUMBER,
        CASE WHEN EXISTS (SELECT 1 FROM dealer d WHERE d.TRIP_ID IS NOT DISTINCT FROM k.SCHEDULE_NUMBER)
             THEN 'x' END AS sch_in_edlr,
        CASE WHEN EXISTS (SELECT 1 FROM dealer d WHERE d.SUPPLIER_VESSEL_ID IS NOT DISTINCT FROM k.VESSEL_ID
                          AND d.DATE_LANDED IS NOT DISTINCT FROM k.LANDING_DATE) THEN 'x' END AS ves_date_in_edlr,
        CASE WHEN EXISTS (SELECT 1 FROM ledger2 s WHERE s.COAST_GUARD_NBR IS NOT DISTINCT FROM k.VESSEL_ID
                          AND s.LANDING_DATE IS NOT DISTINCT FROM k.LANDING_DATE) THEN 'x' END AS ves_date_in_bft
        FROM tkeys k"""


def _report_tables() -> str:
    shares = "DW_LBS_IN_PERC, REVENUE_IN_PERC"
    sheets = {"VesselYearSpecies": ("f_summary_sp", _SP_COLS),
              "VesselYear": (f"({_rollup_sql('VESSEL_ID, YEAR')})", "VESSEL_ID, YEAR"),
              "Vessel": (f"({_rollup_sql('VESSEL_ID')})", "VESSEL_ID")}
    return " UNION ALL BY NAME ".join(
        f"SELECT '{n}' AS sheet, * FROM ({_money('SELECT * FROM ' + src, _SP_MONEY, keys + ', ' + shares)})"
        for n, (src, keys) in sheets.items())


SQL: dict[str, str] = {
    "final_trips_sets": f"""SELECT coalesce(VESSEL_ID, '0') AS VESSEL_ID, coalesce(YEAR, '0') AS YEAR,
        coalesce(n_trips, 0) AS n_trips, coalesce(n_sets, 0) AS n_sets,
        coalesce(n_trips_in, 0) AS n_trips_in, coalesce(n_sets_in, 0) AS n_sets_in,
        coalesce({sql_share('n_trips_in', 'n_trips')}, 0) AS perc_trips_in,
        coalesce({sql_share('n_sets_in', 'n_sets')}, 0) AS perc_sets_in
        FROM ({_merge()})""",
    "merge_full_outer": f"SELECT * FROM ({_merge()}) ORDER BY VESSEL_ID NULLS LAST, YEAR NULLS LAST",
    "extract_logbook": "SELECT * FROM logbook ORDER BY BATCH_NUMBER, SCHEDULE_NUMBER",
    "extract_logbook_fleet": f"""SELECT * FROM logbook WHERE VESSEL_ID IN ({_FLEET})
        ORDER BY BATCH_NUMBER, SCHEDULE_NUMBER""",
    "extract_logbook_view": f"""SELECT * FROM logbook_view WHERE SET_YEAR > {R.VIEW_AFTER_YEAR}
        AND VESSEL_ID_NUMBER IN ({_FLEET})""",
    "extract_trips": "SELECT * FROM obs_trip_log WHERE TRIP_NUMBER IN (SELECT TRIP_NUMBER FROM obs_keys)",
    "extract_hauls": "SELECT * FROM x_hauls",
    "extract_animals": "SELECT * FROM obs_animals WHERE HAUL_LOG_KEY IN (SELECT HAUL_LOG_KEY FROM x_hauls)",
    "key_list": "SELECT DISTINCT HAUL_LOG_KEY FROM x_hauls",
    "left_join_isnull": """SELECT t.SCHEDULE_NUMBER, t.VESSEL_ID, t.LANDING_DATE FROM trips t
        LEFT JOIN trip_qc qc ON t.SCHEDULE_NUMBER = qc.SCHEDULE_NUMBER WHERE qc.DELETED_DATE IS NULL""",
    "set_level": "SELECT * FROM sets",
    "dms_to_decimal": f"""SELECT LOGBOOK_KEY, ORIGINAL_BATCH_SEQUENCE_NUMBER,
        {dms('LATITUDE_DEGREES', 'LATITUDE_MINUTES', 'LATITUDE_HEMISPHERE', 'lat')} AS lat_dd,
        {dms('LONGITUDE_DEGREES', 'LONGITUDE_MINUTES', 'LONGITUDE_HEMISPHERE', 'lon')} AS lon_dd FROM activities""",
    "project_points": "SELECT lon AS lon_dd, lat AS lat_dd, CAST(round(px, 0) AS BIGINT) AS x_m, "
                      "CAST(round(py, 0) AS BIGINT) AS y_m FROM a_p",
    "unproject_points": _unproject("(SELECT DISTINCT CAST(round(px, 0) AS BIGINT) AS x_m, "
                                   "CAST(round(py, 0) AS BIGINT) AS y_m FROM a_p)"),
    "points_in_zone": """SELECT p.ORIGINAL_BATCH_SEQUENCE_NUMBER, p.lon_dd, p.lat_dd, z.zone_id, e.name
        FROM setpos p JOIN g_pz z ON p.lon_dd = z.lon AND p.lat_dd = z.lat AND z.inside
        JOIN (SELECT DISTINCT zone_id, name FROM g_e0) e ON e.zone_id = z.zone_id""",
    "points_within_distance": "SELECT ORIGINAL_BATCH_SEQUENCE_NUMBER, VESSEL_ID, lon_dd, lat_dd FROM cls WHERE within",
    "points_outside": """SELECT ORIGINAL_BATCH_SEQUENCE_NUMBER, VESSEL_ID, lon_dd, lat_dd FROM cls
        WHERE lon_dd IS NOT NULL AND lat_dd IS NOT NULL AND NOT within""",
    "tag_sets": """SELECT ORIGINAL_BATCH_SEQUENCE_NUMBER, SCHEDULE_NUMBER, VESSEL_ID, LANDING_DATE, lon_dd, lat_dd,
        in_buffer FROM tagged""",
    "map_markers": f"""SELECT lon_dd AS lon, lat_dd AS lat, CASE WHEN within THEN 'green' ELSE 'red' END AS colour,
        {_MARK} AS label FROM cls WHERE lon_dd IS NOT NULL AND lat_dd IS NOT NULL""",
    "trips_per_vessel_year": _counts("sets", "SCHEDULE_NUMBER", "n_trips"),
    "sets_per_vessel_year": _counts("sets", "ORIGINAL_BATCH_SEQUENCE_NUMBER", "n_sets"),
    "trips_sets_in_zone": f"""SELECT a.VESSEL_ID, a.YEAR, n_trips_in, n_sets_in FROM
        ({_counts('tagged', 'SCHEDULE_NUMBER', 'n_trips_in', "WHERE in_buffer = 'Y'")}) a JOIN
        ({_counts('tagged', 'ORIGINAL_BATCH_SEQUENCE_NUMBER', 'n_sets_in', "WHERE in_buffer = 'Y'")}) b
        ON a.VESSEL_ID IS NOT DISTINCT FROM b.VESSEL_ID AND a.YEAR IS NOT DISTINCT FROM b.YEAR""",
    "pivot_trips_by_year": _wide("SCHEDULE_NUMBER", "n_trips"),
    "pivot_sets_by_year": _wide("ORIGINAL_BATCH_SEQUENCE_NUMBER", "n_sets"),
    "share_percent": f"""SELECT VESSEL_ID, n_in, n_all, {sql_share('n_in', 'n_all')} AS share_in FROM
        (SELECT CAST(o_custkey AS VARCHAR) AS VESSEL_ID, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_in,
                count(*) AS n_all FROM orders GROUP BY 1)""",
    "frequency_table": "SELECT not_included, count(*) AS n FROM dealer WHERE not_included IS NOT NULL GROUP BY 1",
    "null_profile": _null_profile(),
    "hemisphere_tally": _hemi_tally(),
    "unit_conversion": """SELECT DEALER_RPT_ID, UNIT, CAST(REPORTED_QUANTITY AS DOUBLE) AS REPORTED_QUANTITY,
        CAST(dw_lb AS DOUBLE) AS dw_lb FROM ledger2_flagged""",
    "trip_keys": "SELECT * FROM tkeys",
    "flag_single_key": """SELECT VESSEL_ID, LANDING_DATE, SCHEDULE_NUMBER,
        CASE WHEN EXISTS (SELECT 1 FROM dealer d WHERE d.TRIP_ID IS NOT DISTINCT FROM k.SCHEDULE_NUMBER)
             THEN 1 ELSE 0 END::BIGINT AS sch_in_edlr FROM tkeys k""",
    "flag_composite_key": "SELECT unique_report_no, SUPPLIER_VESSEL_ID, DATE_LANDED, in_area FROM dealer_flagged",
    "flag_either_key": _flag_either(),
    "flagged_trip_ids": f"SELECT DISTINCT TRIP_ID FROM ({_flag_either()}) WHERE area_activity = 1",
    "match_audit": _MATCH_AUDIT,
    "match_tally": " UNION ALL ".join(
        f"SELECT '{t}' AS test, {t} IS NOT NULL AS matched, count(*) AS n FROM ({_MATCH_AUDIT}) GROUP BY ALL"
        for t in ("sch_in_edlr", "ves_date_in_edlr", "ves_date_in_bft")),
    "date_override": "SELECT * FROM dated_keys",
    "trip_lookup": _money(f"SELECT * FROM dealer WHERE TRIP_ID IN ({', '.join(repr(k) for k, _ in R.OVERRIDES)})",
                          _DEALER_MONEY, _DEALER_ALL),
    "landings_dealer": """SELECT SUPPLIER_VESSEL_ID, YEAR_OF_LANDING, COMMON_NAME_AS_REPORTED, in_area,
        CAST(dw_lb AS DOUBLE) AS dw_lb, CAST(revenue AS DOUBLE) AS revenue FROM
        (SELECT SUPPLIER_VESSEL_ID, YEAR_OF_LANDING, COMMON_NAME_AS_REPORTED, in_area,
                CASE WHEN count(converted_dw) = count(*) THEN sum(converted_dw) END AS dw_lb,
                coalesce(sum(TOTAL_DOLLARS), 0) AS revenue
         FROM dealer_flagged WHERE not_included IS NULL GROUP BY ALL)""",
    "pivot_in_out": _money("SELECT * FROM edlr_summary", _SP_MONEY[:4], _SP_COLS),
    "landings_union": _money("SELECT * FROM f_summary", _SP_MONEY[:4], _SP_COLS),
    "rollup_vessel_year_species": _money("SELECT * FROM f_summary_sp", _SP_MONEY,
                                         _SP_COLS + ", DW_LBS_IN_PERC, REVENUE_IN_PERC"),
    "rollup_vessel_year": _money(_rollup_sql("VESSEL_ID, YEAR"), _SP_MONEY,
                                 "VESSEL_ID, YEAR, DW_LBS_IN_PERC, REVENUE_IN_PERC"),
    "rollup_vessel": _money(_rollup_sql("VESSEL_ID"), _SP_MONEY, "VESSEL_ID, DW_LBS_IN_PERC, REVENUE_IN_PERC"),
    "dealer_totals": f"""SELECT SUPPLIER_VESSEL_ID, COMMON_NAME_AS_REPORTED,
        CAST({strict_sum('REPORTED_QUANTITY')} AS DOUBLE) AS Dealer_Landings,
        CAST({strict_sum('REPORTED_QUANTITY * PURCHASE_PRICE')} AS DOUBLE) AS Total_Dollars
        FROM dealer WHERE not_included IS NULL GROUP BY ALL""",
    "second_ledger_totals": f"""SELECT COAST_GUARD_NBR, LANDING_YEAR,
        CAST({strict_sum('REPORTED_QUANTITY')} AS DOUBLE) AS BFT_Landings,
        CAST({strict_sum('DOLLARS')} AS DOUBLE) AS Total_Dollars FROM ledger2 GROUP BY ALL""",
    "animals_by_disposition": f"""SELECT SCHEDULE_NUMBER, NMFS_COMMON, DISPOSITION_STATUS,
        CAST({strict_sum('NUMBER_OF_INDIVIDUALS')} AS BIGINT) AS n_animals FROM logbook l
        WHERE EXISTS (SELECT 1 FROM tkeys k WHERE k.VESSEL_ID IS NOT DISTINCT FROM l.VESSEL_ID
                      AND k.LANDING_DATE IS NOT DISTINCT FROM l.LANDING_DATE
                      AND NOT EXISTS (SELECT 1 FROM ledger2 s WHERE s.COAST_GUARD_NBR IS NOT DISTINCT FROM k.VESSEL_ID
                                      AND s.LANDING_DATE IS NOT DISTINCT FROM k.LANDING_DATE))
        GROUP BY ALL""",
    "haul_key": """SELECT HAUL_LOG_KEY, coalesce(TRIP_NUMBER, 'NA') || '.' || coalesce(CAST(HAUL_NUMBER AS VARCHAR), 'NA')
        AS trip_haul, split_part(coalesce(TRIP_NUMBER, 'NA') || '.' || coalesce(CAST(HAUL_NUMBER AS VARCHAR), 'NA'), '.', 1)
        AS trip FROM obs_hauls""",
    "positions_long": "SELECT * FROM positions_nn",
    "reconcile_counts": f"""SELECT coalesce(a.VESSEL_ID, b.VESSEL_ID) AS VESSEL_ID,
        a.trip_count AS trip_count_a, b.trip_count AS trip_count_b, a.trip_count - b.trip_count AS trip_count_diff,
        a.set_count AS set_count_a, b.set_count AS set_count_b, a.set_count - b.set_count AS set_count_diff
        FROM (SELECT VESSEL_ID, {nd('SCHEDULE_NUMBER')} AS trip_count, {nd('ORIGINAL_BATCH_SEQUENCE_NUMBER')} AS set_count
              FROM logbook GROUP BY VESSEL_ID) a
        FULL OUTER JOIN (SELECT VESSEL_ID_NUMBER AS VESSEL_ID, {nd('TRIP_NUMBER')} AS trip_count,
              {nd('BATCH_SEQUENCE_NUMBER')} AS set_count FROM logbook_view WHERE SET_YEAR > {R.VIEW_AFTER_YEAR}
              GROUP BY 1) b ON a.VESSEL_ID IS NOT DISTINCT FROM b.VESSEL_ID""",
    "preview_head": "SELECT * FROM sets ORDER BY " + ", ".join(
        f"{c} ASC NULLS LAST" for c in ["ORIGINAL_BATCH_SEQUENCE_NUMBER"] +
        [c for c in SET_COLS if c != "ORIGINAL_BATCH_SEQUENCE_NUMBER"]) + " LIMIT 6",
    "csv_roundtrip": "SELECT * FROM sets",
    "extract_by_year": f"""SELECT *, year(LANDING_DATE) AS LANDING_YEAR FROM sets
        WHERE year(LANDING_DATE) >= {R.REREAD_FROM_YEAR} AND EXISTS (SELECT 1 FROM ledger2 s
            WHERE s.LANDING_YEAR = year(sets.LANDING_DATE) AND month(s.LANDING_DATE) = 12)""",
    "latest_extract": "SELECT HAUL_LOG_KEY, TRIP_NUMBER, HAUL_NUMBER, GEAR_CODE FROM obs_hauls",
    "clean_column_names": """SELECT CAST(o_custkey AS VARCHAR) AS COAST_GUARD_NBR, CAST(o_orderdate AS DATE) AS LANDING_DATE,
        year(o_orderdate) AS LANDING_YEAR, o_orderpriority AS DEALER_NAME, o_totalprice AS X1ST_PRICE,
        o_orderstatus AS NA_ FROM orders""",
    "report_tables": _report_tables(),
    "report_totals": f"""SELECT 'Dealer Landings' AS sheet, SUPPLIER_VESSEL_ID AS VESSEL_ID,
            COMMON_NAME_AS_REPORTED AS COMMON_NAME, CAST({strict_sum('REPORTED_QUANTITY')} AS DOUBLE) AS Landings,
            CAST({strict_sum('REPORTED_QUANTITY * PURCHASE_PRICE')} AS DOUBLE) AS Total_Dollars
        FROM dealer WHERE not_included IS NULL GROUP BY ALL
        UNION ALL BY NAME
        SELECT 'BFT Landings' AS sheet, COAST_GUARD_NBR AS VESSEL_ID, LANDING_YEAR AS YEAR,
            CAST({strict_sum('REPORTED_QUANTITY')} AS DOUBLE) AS Landings,
            CAST({strict_sum('DOLLARS')} AS DOUBLE) AS Total_Dollars FROM ledger2 GROUP BY ALL""",
    "report_wide": " UNION ALL ".join(f"SELECT '{n}' AS sheet, * FROM ({_wide(c, m)})" for n, c, m in [
        ("TotTrips", "SCHEDULE_NUMBER", "n_trips"), ("TotSets", "ORIGINAL_BATCH_SEQUENCE_NUMBER", "n_sets")]),
    "chart_series": f"""SELECT 'dealer_pounds' AS chart, SUPPLIER_VESSEL_ID AS x, COMMON_NAME_AS_REPORTED AS series,
            CAST({strict_sum('REPORTED_QUANTITY')} AS DOUBLE) AS y FROM dealer WHERE not_included IS NULL GROUP BY ALL
        UNION ALL
        SELECT 'dealer_dollars', SUPPLIER_VESSEL_ID, COMMON_NAME_AS_REPORTED,
            CAST({strict_sum('REPORTED_QUANTITY * PURCHASE_PRICE')} AS DOUBLE) FROM dealer
            WHERE not_included IS NULL GROUP BY ALL
        UNION ALL
        SELECT 'second_' || COAST_GUARD_NBR, CAST(LANDING_YEAR AS VARCHAR), 'pounds',
            CAST({strict_sum('REPORTED_QUANTITY')} AS DOUBLE) FROM ledger2 GROUP BY ALL
        UNION ALL
        SELECT 'second_' || COAST_GUARD_NBR, CAST(LANDING_YEAR AS VARCHAR), 'dollars',
            CAST({strict_sum('DOLLARS')} AS DOUBLE) FROM ledger2 GROUP BY ALL""",
}

# inside / outside: distinct hauls and trips per side (a haul can be on both).
SQL["inside_outside_counts"] = """SELECT
    count(DISTINCT CASE WHEN within THEN trip_haul END) AS n_hauls_in,
    count(DISTINCT CASE WHEN within THEN split_part(trip_haul, '.', 1) END) AS n_trips_in,
    count(DISTINCT CASE WHEN NOT within THEN trip_haul END) AS n_hauls_out,
    count(DISTINCT CASE WHEN NOT within THEN split_part(trip_haul, '.', 1) END) AS n_trips_out
    FROM (SELECT p.trip_haul, coalesce(t.within, false) AS within FROM positions_nn p
          LEFT JOIN h_tag t ON p.lon_dd = t.lon AND p.lat_dd = t.lat)"""

# project_points uses its own classification inputs: distinct activity positions.
_A_POS = {"a_pos": f"""SELECT {dms('LATITUDE_DEGREES', 'LATITUDE_MINUTES', 'LATITUDE_HEMISPHERE', 'lat')} AS lat_dd,
        {dms('LONGITUDE_DEGREES', 'LONGITUDE_MINUTES', 'LONGITUDE_HEMISPHERE', 'lon')} AS lon_dd FROM activities"""}
_A_POS.update({k: v for k, v in geo_ctes("a_pos", "a").items() if k == "a_p"})


# Date columns in each query's output.  Results carry dates as ISO text
# (Spark side: ``registry.normalise_types``) so they compare the same
# however a checker turns rows into values.
DATE_OUTPUTS = {
    "clean_column_names": ["LANDING_DATE"],
    "csv_roundtrip": ["LANDING_DATE", "SET_DATE", "HAULBACK_DATE"],
    "extract_by_year": ["LANDING_DATE", "SET_DATE", "HAULBACK_DATE"],
    "date_override": ["LANDING_DATE", "dealer_date"],
    "extract_logbook": ["LANDING_DATE", "SET_DATE", "HAULBACK_DATE"],
    "extract_logbook_fleet": ["LANDING_DATE", "SET_DATE", "HAULBACK_DATE"],
    "flag_composite_key": ["DATE_LANDED"],
    "flag_either_key": ["DATE_LANDED"],
    "flag_single_key": ["LANDING_DATE"],
    "left_join_isnull": ["LANDING_DATE"],
    "match_audit": ["LANDING_DATE"],
    "preview_head": ["LANDING_DATE", "SET_DATE", "HAULBACK_DATE"],
    "set_level": ["LANDING_DATE", "SET_DATE", "HAULBACK_DATE"],
    "tag_sets": ["LANDING_DATE"],
    "trip_keys": ["LANDING_DATE"],
    "trip_lookup": ["DATE_LANDED"],
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in SQL.items():
        sql = with_ctes(body, LOGBOOK, OBSERVER, _A_POS)
        repl = [f"CAST({c} AS VARCHAR) AS {c}" for c in DATE_OUTPUTS.get(name, [])]
        repl += [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in R.DOUBLE_OUTPUTS.get(name, [])]
        repl += [f'CAST("{y}" AS DOUBLE) AS "{y}"' for y in YEARS if name in R.WIDE_OUTPUTS]
        if repl:
            sql = f"SELECT * REPLACE ({', '.join(repl)}) FROM ({sql})"
        out[name] = sql
    return out

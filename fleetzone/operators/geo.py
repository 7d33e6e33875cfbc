"""Zone tagging: point in polygon and "within a distance of a zone".

Everything is column maths on plain DOUBLE columns; there is no geometry
type, no Python UDF and no cross join.

Layout
------
* ``zone_edges(zones)``: one row per polygon edge (``zone_id, edge_id,
  x1, y1, x2, y2`` in degrees, plus the projected ends ``px1 .. py2``).
* ``edge_cells(edges, distance_m)``: two small lookup tables keyed by a
  grid cell, each holding the edges a point in that cell has to look at:

  - *distance cells* (projected metres, side ``cell_m``): only cells that the
    rim of the buffer can pass.  A cell inside one edge's buffer carries the
    flag ``all_within`` and no edge, a cell out of reach is not stored, and of
    the others' edges those stay that no other edge is nearer than all over
    the cell;
  - *ray cells* (degrees, side ``band_deg``): per zone the edges that touch
    the cell, and as one number the parity of all that lies east of it.

  A base cell with more than ``MAX_EDGES`` edges in a cell is divided into
  quarters, again and again (``level``), so the lists stay short however
  detailed an outline is.
* ``classify(df, lon, lat, cells)``: joins each row to its base cells' levels
  (only where some base cell is divided) and then to its two cells (Spark
  broadcasts a table while its size is under the session's threshold and
  shuffles beyond) and computes, per row, with higher-order array functions
  over the few candidate edges:

  - ``in_zone``: inside (or on the boundary of) at least one zone;
  - ``zones_in``: the zone ids the point is in;
  - ``within``: inside a zone or within the distance of one.

  Rows are never grouped or shuffled by position, so a position shared by a
  third of all rows costs no more than any other.

Parity as a number
------------------
An eastward ray from a point crosses edges that touch its cell and edges
beyond.  An edge that does not touch the cell lies, within the cell's
latitudes, wholly east or wholly west of it.  Let ``y0`` be the latitude of
the cell's centre.  Moving the ray from ``y0`` to the point's latitude ``y``
changes the parity of the eastern edges only at their vertices between the
two, and as rings are closed these are paired but for those they share with
touching edges.  So the parity at ``y`` is the stored one at ``y0``, plus the
touching edges' own crossings, plus one for each of their ends that lies east
of the cell and between ``y0`` and ``y``: plain comparisons, nothing rounded.

The projection is the equidistant conic used for the contiguous USA
(ESRI:102005) on the GRS80 ellipsoid; the formulas are the published ones
(Snyder, "Map Projections: A Working Manual", USGS PP 1395, ch. 16).
Distances are measured in that projection, as the original analysis did
(it buffered the projected polygon).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_table

# Projection parameters (ESRI:102005, public registry).
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
STD_PARALLEL_1 = 33.0
STD_PARALLEL_2 = 45.0
LAT_ORIGIN = 39.0
LON_ORIGIN = -96.0
# Fixed value: the buffer distance of the original analysis ("50 miles").
BUFFER_M = 80467.0

RAD = math.pi / 180.0
_F = 1.0 / GRS80_INV_F
E2 = 2 * _F - _F * _F
C0 = 1 - E2 / 4 - 3 * E2 ** 2 / 64 - 5 * E2 ** 3 / 256
C2 = 3 * E2 / 8 + 3 * E2 ** 2 / 32 + 45 * E2 ** 3 / 1024
C4 = 15 * E2 ** 2 / 256 + 45 * E2 ** 3 / 1024
C6 = 35 * E2 ** 3 / 3072


def _meridian_arc(phi: float) -> float:
    return GRS80_A * (C0 * phi - C2 * math.sin(2 * phi) + C4 * math.sin(4 * phi)
                      - C6 * math.sin(6 * phi))


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


_P1, _P2, _P0 = STD_PARALLEL_1 * RAD, STD_PARALLEL_2 * RAD, LAT_ORIGIN * RAD
CONE_N = GRS80_A * (_m(_P1) - _m(_P2)) / (_meridian_arc(_P2) - _meridian_arc(_P1))
A_G = GRS80_A * (_m(_P1) / CONE_N + _meridian_arc(_P1) / GRS80_A)
RHO0 = A_G - _meridian_arc(_P0)


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def _lit(x: float) -> Column:
    return F.lit(float(x))


def project(lon, lat) -> tuple[Column, Column]:
    """Projected (x, y) in metres for lon/lat in degrees (NULL in, NULL out)."""
    phi = _c(lat) * _lit(RAD)
    arc = _lit(GRS80_A) * (_lit(C0) * phi - _lit(C2) * F.sin(phi * _lit(2.0))
                           + _lit(C4) * F.sin(phi * _lit(4.0))
                           - _lit(C6) * F.sin(phi * _lit(6.0)))
    rho = _lit(A_G) - arc
    theta = _lit(CONE_N) * ((_c(lon) - _lit(LON_ORIGIN)) * _lit(RAD))
    return rho * F.sin(theta), _lit(RHO0) - rho * F.cos(theta)


# The series of the latitude by meridian arc (Snyder, eq. 3-26).
_E1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
D2 = 3 * _E1 / 2 - 27 * _E1 ** 3 / 32
D4 = 21 * _E1 ** 2 / 16 - 55 * _E1 ** 4 / 32
D6 = 151 * _E1 ** 3 / 96
D8 = 1097 * _E1 ** 4 / 512


def unproject(x, y) -> tuple[Column, Column]:
    """(lon, lat) in degrees for projected metres: the inverse of ``project``.

    The latitude comes from the inverse series of the meridian arc and one
    Newton step on the arc as ``project`` computes it, so a round trip agrees
    to about 1e-12 degrees over the region.  NULL in, NULL out.
    """
    south = _lit(RHO0) - _c(y)
    arc = _lit(A_G) - F.sqrt(_c(x) * _c(x) + south * south)
    mu = arc / _lit(GRS80_A * C0)
    phi = (mu + _lit(D2) * F.sin(mu * _lit(2.0)) + _lit(D4) * F.sin(mu * _lit(4.0))
           + _lit(D6) * F.sin(mu * _lit(6.0)) + _lit(D8) * F.sin(mu * _lit(8.0)))
    at_phi = (_lit(C0) * phi - _lit(C2) * F.sin(phi * _lit(2.0)) + _lit(C4) * F.sin(phi * _lit(4.0))
              - _lit(C6) * F.sin(phi * _lit(6.0)))
    slope = (_lit(C0) - _lit(2 * C2) * F.cos(phi * _lit(2.0)) + _lit(4 * C4) * F.cos(phi * _lit(4.0))
             - _lit(6 * C6) * F.cos(phi * _lit(6.0)))
    lat = (phi - (at_phi - arc / _lit(GRS80_A)) / slope) / _lit(RAD)
    lon = _lit(LON_ORIGIN) + F.atan2(_c(x), south) / _lit(CONE_N) / _lit(RAD)
    return lon, lat


# --------------------------------------------------------------------------
# Zones and edges
# --------------------------------------------------------------------------

def zone_edges(zones: DataFrame) -> DataFrame:
    """Explode ``zones(zone_id, name, ring)`` into one row per edge.

    ``ring`` is an array of ``struct(lon, lat)``; the last vertex connects
    back to the first (a repeated closing vertex only adds a zero-length
    edge, which changes nothing).
    """
    v = zones.select("zone_id", "ring", F.posexplode("ring").alias("edge_id", "v"))
    nxt = F.expr("ring[(edge_id + 1) % size(ring)]")
    e = v.select(
        "zone_id", F.col("edge_id").cast("int").alias("edge_id"),
        F.col("v.lon").cast("double").alias("x1"), F.col("v.lat").cast("double").alias("y1"),
        nxt["lon"].cast("double").alias("x2"), nxt["lat"].cast("double").alias("y2"))
    px1, py1 = project("x1", "y1")
    px2, py2 = project("x2", "y2")
    return e.select("*", px1.alias("px1"), py1.alias("py1"), px2.alias("px2"), py2.alias("py2"))


# Edges of a cell above which its base cell is divided, and how often at most
# (edges that all meet in one point can never be told apart by cells: there the
# list is as long as it must be).
MAX_EDGES = 64
MAX_LEVEL = 8

_CELL = ["bx", "by", "cx", "cy"]


@dataclass
class EdgeCells:
    """The cell lookup tables plus the parameters they were built with.

    ``dist_levels`` and ``ray_levels`` (bx, by, level) name the divided base
    cells; they are None when no base cell is divided.
    """

    dist_cells: DataFrame   # level, cx, cy, all_within, d_edges
    ray_cells: DataFrame    # level, cx, cy, r_zones (per zone: parity and touching edges)
    dist_levels: DataFrame | None
    ray_levels: DataFrame | None
    distance_m: float
    cell_m: float
    band_deg: float


def edge_cells(edges: DataFrame, distance_m: float = BUFFER_M, cell_m: float | None = None,
               band_deg: float = 0.5) -> EdgeCells:
    """Build the distance-cell and ray-cell tables for ``edges``.

    All are written once under the shared work folder, so every plan that
    joins them reads tables of known size: Spark broadcasts them while they
    are under the session's broadcast threshold and shuffles them beyond.
    ``band_deg`` should be a power of two (a cell's bounds are then exact).
    """
    cell_m = float(cell_m or max(distance_m / 4.0, 1000.0))
    edges = write_table(edges, "zone-edges")
    dist_cells, dist_levels = _distance_cells(edges, float(distance_m), cell_m)
    ray_cells, ray_levels = _ray_cells(edges, float(band_deg))
    return EdgeCells(dist_cells, ray_cells, dist_levels, ray_levels, float(distance_m), cell_m, float(band_deg))


def _span(low: Column, high: Column, side: float) -> Column:
    return F.sequence(F.floor(low / _lit(side)), F.floor(high / _lit(side)))


def _quarters(df: DataFrame) -> DataFrame:
    """Every row once for each quarter of its cell."""
    half = F.array(F.lit(0), F.lit(1))
    out = df.withColumn("__i", F.explode(half)).withColumn("__k", F.explode(half))
    return out.withColumns({"cx": F.col("cx") * 2 + F.col("__i"), "cy": F.col("cy") * 2 + F.col("__k")}).drop("__i", "__k")


def _refined(pairs: DataFrame, side: float, divide, counted: Column) -> tuple[DataFrame, DataFrame | None]:
    """Divides the base cells whose longest list is above ``MAX_EDGES``.

    ``pairs`` are (cell, edge) rows of whole base cells; ``divide(rows, side)``
    gives those of their quarters; ``counted`` is NULL for rows that count as no
    edge.  Returns the rows with their ``level`` and the divided base cells.
    """
    done, levels = [], []
    for level in range(MAX_LEVEL + 1):
        pairs = write_table(pairs, f"cells-{level}")
        heavy = (pairs.groupBy(*_CELL).agg(F.count(counted).alias("n")).where(F.col("n") > MAX_EDGES)
                      .select("bx", "by").distinct())
        last = level == MAX_LEVEL or heavy.isEmpty()
        settled = pairs if last else pairs.join(heavy, ["bx", "by"], "left_anti")
        done.append(settled.withColumn("level", F.lit(level)))
        if level:
            levels.append(settled.select("bx", "by", F.lit(level).alias("level")).distinct())
        if last:
            break
        pairs = divide(pairs.join(heavy, ["bx", "by"], "left_semi"), side / 2 ** (level + 1))
    return (reduce(DataFrame.unionByName, done),
            write_table(reduce(DataFrame.unionByName, levels), "cell-levels") if levels else None)


# ------------------------------------------------------------ distance cells

def _distance_cells(edges: DataFrame, distance_m: float, side: float) -> tuple[DataFrame, DataFrame | None]:
    d = _lit(distance_m)
    dx, dy = F.col("px2") - F.col("px1"), F.col("py2") - F.col("py1")
    len2 = dx * dx + dy * dy
    e = F.struct("zone_id", "px1", "py1", dx.alias("dx"), dy.alias("dy"), len2.alias("len2"),
                 F.when(len2 > 0, _lit(1.0) / F.when(len2 > 0, len2)).otherwise(_lit(0.0)).alias("inv_len2"))
    reach = edges.select(e.alias("e"), F.explode(_span(F.least("px1", "px2") - d, F.greatest("px1", "px2") + d, side)).alias("cx"),
                         _span(F.least("py1", "py2") - d, F.greatest("py1", "py2") + d, side).alias("ys"))
    reach = reach.select(F.col("cx").alias("bx"), F.explode("ys").alias("by"), "cx", F.col("by").alias("cy"), "e")

    def divide(rows: DataFrame, part: float) -> DataFrame:
        quarters = _quarters(rows)
        whole = quarters.where("all_within")
        return _rim(quarters.where(~F.col("all_within")).drop("all_within"), distance_m, part).unionByName(whole)

    rows, levels = _refined(_rim(reach, distance_m, side), side, divide, F.col("e"))
    # collect_list leaves the missing edge of an all-within cell out.
    cells = rows.groupBy("level", "cx", "cy").agg(F.max("all_within").alias("all_within"), F.collect_list("e").alias("d_edges"))
    return write_table(cells, "distance-cells"), levels


def _rim(pairs: DataFrame, distance_m: float, side: float) -> DataFrame:
    """(cell, all_within, edge) rows that the points of the cells need.

    * All four corners within (distance - 1 m) of one edge: the cell lies in
      that edge's buffer (the distance to a segment is convex); one row, no edge.
    * Nearest edge out of reach of every point: no row.
    * Else an edge stays unless the edge ``f`` nearest to the centre is nearer
      all over the cell.  Both distances are convex and the edge's curves by at
      most 1 / distance, so over the cell their difference is at least its least
      value at the corners less r^2 / (2 distance), r being half the diagonal.
    """
    r, slack = side * math.sqrt(0.5), 1.0
    x, y = [[(F.col(c) + k) * _lit(side) for k in (0, 1)] for c in ("cx", "cy")]
    corners = [(a, b) for a in x for b in y]
    far = [F.sqrt(_seg_dist2(F.col("e"), a, b)) for a, b in corners]
    centre = F.sqrt(_seg_dist2(F.col("e"), (F.col("cx") + 0.5) * _lit(side), (F.col("cy") + 0.5) * _lit(side)))
    rows = pairs.select("*", F.array(*far).alias("far"), centre.alias("centre"))
    covers = F.array_max("far") <= _lit(max(distance_m - 1.0, 0.0))
    limits = rows.groupBy(*_CELL).agg(F.max(covers).alias("all_within"), F.min("centre").alias("nearest"),
                                      F.min_by("far", "centre").alias("f"))
    limits = limits.where(F.col("all_within") | (F.col("nearest") <= _lit(distance_m + r + slack)))
    closer = F.array_min(F.zip_with("far", "f", lambda a, b: a - b))
    # Only points within the distance matter, so an edge out of their reach goes too.
    needed = (F.col("centre") <= _lit(distance_m + r + slack)) & (
        (F.col("centre") <= _lit(2 * r)) | (closer < _lit(r * r / 2) / F.greatest(F.col("centre") - _lit(r), _lit(r)) + _lit(slack)))
    kept = rows.join(limits.where(~F.col("all_within")), _CELL).where(needed)
    whole = limits.where("all_within").select(*_CELL, F.lit(None).cast(pairs.schema["e"].dataType).alias("e"), "all_within")
    return kept.select(*_CELL, "e", F.lit(False).alias("all_within")).unionByName(whole)


# ----------------------------------------------------------------- ray cells

#: Degrees by which a cell is grown when it is asked which edges touch it.
_TOUCH = 1e-9


def _touching(pairs: DataFrame, side: float) -> DataFrame:
    """The pairs whose segment touches the cell, grown a little."""
    half = _lit(side / 2 + _TOUCH)
    mx, my = (F.col("cx") + 0.5) * _lit(side), (F.col("cy") + 0.5) * _lit(side)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    line = F.abs(dx * (my - F.col("y1")) - dy * (mx - F.col("x1"))) <= (F.abs(dx) + F.abs(dy)) * half
    return pairs.where(line & (F.least("x1", "x2") <= mx + half) & (F.greatest("x1", "x2") >= mx - half)
                       & (F.least("y1", "y2") <= my + half) & (F.greatest("y1", "y2") >= my - half))


def _x_at(e, lat: Column) -> Column:
    """Longitude at which an edge that straddles ``lat`` crosses it."""
    straddles = (e["y1"] > lat) != (e["y2"] > lat)
    return e["x1"] + (lat - e["y1"]) * (e["x2"] - e["x1"]) / F.when(straddles, e["y2"] - e["y1"])


def _ray_cells(edges: DataFrame, side: float) -> tuple[DataFrame, DataFrame | None]:
    ends = ["x1", "y1", "x2", "y2"]
    t = _lit(_TOUCH)
    xs = _span(F.least("x1", "x2") - t, F.greatest("x1", "x2") + t, side)
    ys = _span(F.least("y1", "y2") - t, F.greatest("y1", "y2") + t, side)
    near = edges.select("zone_id", *ends, F.explode(xs).alias("bx"), ys.alias("ys")).select(
        "zone_id", *ends, "bx", F.explode("ys").alias("by")).withColumns({"cx": F.col("bx"), "cy": F.col("by")})
    touching, levels = _refined(_touching(near, side), side, lambda rows, part: _touching(_quarters(rows), part), F.col("x1"))
    touching = touching.groupBy("level", "cx", "cy", "zone_id").agg(F.collect_list(F.struct(*ends)).alias("edges"))

    # Every cell of a zone's box, at the level of its base cell, with the
    # longitude of its eastern side and the latitude of its centre.
    box = edges.groupBy("zone_id").agg(
        F.least(F.min("x1"), F.min("x2")).alias("x0"), F.greatest(F.max("x1"), F.max("x2")).alias("x9"),
        F.least(F.min("y1"), F.min("y2")).alias("y0"), F.greatest(F.max("y1"), F.max("y2")).alias("y9"))
    cells = box.select("zone_id", F.explode(_span(F.col("x0"), F.col("x9"), side)).alias("bx"),
                       _span(F.col("y0"), F.col("y9"), side).alias("ys")).select("zone_id", "bx", F.explode("ys").alias("by"))
    cells = cells.withColumn("level", F.lit(0)) if levels is None else (
        cells.join(levels, ["bx", "by"], "left").withColumn("level", F.coalesce("level", F.lit(0))))
    parts = F.pow(F.lit(2.0), F.col("level")).cast("bigint")
    inner = F.sequence(F.lit(0).cast("bigint"), parts - 1)
    cells = cells.withColumn("i", F.explode(inner)).withColumn("k", F.explode(inner)).select(
        "zone_id", "by", "level", (F.col("bx") * parts + F.col("i")).alias("cx"), (F.col("by") * parts + F.col("k")).alias("cy"))
    size = _lit(side) / F.pow(F.lit(2.0), F.col("level"))
    cells = write_table(cells.select("*", ((F.col("cx") + 1) * size).alias("x_east"), ((F.col("cy") + 0.5) * size).alias("y_mid")),
                        "zone-cells")

    # Edges east of a cell at its centre's latitude: a running count along
    # each row of cells (the cells of one zone, level and row), from the east.
    bands = cells.select("zone_id", "by", "level").distinct()
    rows = edges.withColumn("by", F.explode(_span(F.least("y1", "y2"), F.greatest("y1", "y2"), side))).join(bands, ["zone_id", "by"])
    low = F.greatest(F.floor(F.least("y1", "y2") / size), F.col("by") * parts)
    high = F.least(F.floor(F.greatest("y1", "y2") / size), (F.col("by") + 1) * parts - 1)
    rows = rows.where(low <= high).select("zone_id", "level", *ends, F.explode(F.sequence(low, high)).alias("cy"))
    here = {c: F.col(c) for c in ends}
    crossing = rows.select("zone_id", "level", "cy", _x_at(here, (F.col("cy") + 0.5) * size).alias("x")).where("x is not null")
    line = cells.select("zone_id", "level", "cy", F.col("x_east").alias("x"), "cx", "y_mid", F.lit(0).alias("edge")).unionByName(
        crossing.withColumn("edge", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy("zone_id", "level", "cy").orderBy(F.col("x").desc(), "edge")
    counted = line.withColumn("east", F.sum("edge").over(order)).where("edge = 0").drop("edge")

    # The touching edges' own crossings east of the cell are counted at the point, not here.
    joined = counted.join(touching, ["zone_id", "level", "cx", "cy"], "left")
    none = F.array().cast(touching.schema["edges"].dataType)
    joined = joined.withColumn("edges", F.coalesce("edges", none))
    own = F.size(F.filter("edges", lambda e: F.coalesce(_x_at(e, F.col("y_mid")) > F.col("x"), F.lit(False))))
    zone = F.struct("zone_id", ((F.col("east") + own) % 2).cast("int").alias("odd"), F.col("x").alias("x_east"), "y_mid", "edges")
    cells = joined.select("level", "cx", "cy", zone.alias("z")).where("z.odd = 1 or size(z.edges) > 0")
    return write_table(cells.groupBy("level", "cx", "cy").agg(F.array_sort(F.collect_list("z")).alias("r_zones")), "ray-cells"), levels


# --------------------------------------------------------------------------
# Per-row classification
# --------------------------------------------------------------------------

def _seg_dist2(e, px: Column, py: Column) -> Column:
    """Squared distance from (px, py) to the projected segment of edge ``e``.

    ``e`` carries the edge start (``px1, py1``), its direction (``dx, dy``),
    squared length ``len2`` and ``inv_len2`` (0 for a zero-length edge).
    Before the start or past the end the nearest point is an end point;
    otherwise the distance to the line is |cross| / length.
    """
    ax = px - e["px1"]
    ay = py - e["py1"]
    dot = ax * e["dx"] + ay * e["dy"]
    cross = ax * e["dy"] - ay * e["dx"]
    bx = ax - e["dx"]
    by = ay - e["dy"]
    return (F.when(dot <= _lit(0.0), ax * ax + ay * ay)
             .when(dot >= e["len2"], bx * bx + by * by)
             .otherwise(cross * cross * e["inv_len2"]))


def _crosses(e, lon: Column, lat: Column) -> Column:
    """Eastward ray from (lon, lat) crosses edge ``e`` (half-open rule)."""
    return F.coalesce(lon < _x_at(e, lat), F.lit(False))


def _ends_passed(z, e, lat: Column) -> Column:
    """How many ends of touching edge ``e`` lie east of its cell and between the cell's centre and ``lat``."""
    def passed(x, y):
        return ((x > z["x_east"]) & ((y > lat) != (y > z["y_mid"]))).cast("int")
    return passed(e["x1"], e["y1"]) + passed(e["x2"], e["y2"])


def _on_edge(e, lon: Column, lat: Column) -> Column:
    """(lon, lat) lies on edge ``e`` (collinear and inside its box)."""
    cross = (e["x2"] - e["x1"]) * (lat - e["y1"]) - (e["y2"] - e["y1"]) * (lon - e["x1"])
    return ((cross == 0)
            & (lon >= F.least(e["x1"], e["x2"])) & (lon <= F.greatest(e["x1"], e["x2"]))
            & (lat >= F.least(e["y1"], e["y2"])) & (lat <= F.greatest(e["y1"], e["y2"])))


def _join_cells(df: DataFrame, kind: str, x: Column, y: Column, side: float, levels: DataFrame | None,
                cells: DataFrame) -> DataFrame:
    """Each row with the columns of its cell, named ``__{kind}_...`` (NULL where the cell is not stored)."""
    level = F.lit(0)
    if levels is not None:
        base = levels.toDF("__bx", "__by", "__level")
        df = df.withColumns({"__bx": F.floor(x / _lit(side)), "__by": F.floor(y / _lit(side))}).join(base, ["__bx", "__by"], "left")
        level = F.coalesce("__level", F.lit(0))
    size = _lit(side) if levels is None else _lit(side) / F.pow(F.lit(2.0), level)
    keys = ["__level", "__cx", "__cy"]
    df = df.withColumns(dict(zip(keys, (level, F.floor(x / size), F.floor(y / size)))))
    payload = [c for c in cells.columns if c not in ("level", "cx", "cy")]
    named = cells.select(*[F.col(k[2:]).alias(k) for k in keys], *[F.col(c).alias(f"__{kind}_{c}") for c in payload])
    return df.join(named, keys, "left").drop(*keys, "__bx", "__by")


def classify(df: DataFrame, lon: str, lat: str, cells: EdgeCells,
             prefix: str = "") -> DataFrame:
    """Add ``{prefix}in_zone``, ``{prefix}zones_in`` and ``{prefix}within``.

    Rows with a NULL coordinate get ``in_zone = within = false`` and an
    empty ``zones_in``; use ``position_ok`` to tell them apart.
    """
    lon_c, lat_c = F.col(lon), F.col(lat)
    px, py = project(lon_c, lat_c)
    j = df.select("*", px.alias("__px"), py.alias("__py"))
    j = _join_cells(j, "d", F.col("__px"), F.col("__py"), cells.cell_m, cells.dist_levels, cells.dist_cells)
    j = _join_cells(j, "r", lon_c, lat_c, cells.band_deg, cells.ray_levels, cells.ray_cells)

    pxc, pyc = F.col("__px"), F.col("__py")
    d2 = _lit(cells.distance_m * cells.distance_m)
    near = F.coalesce(F.col("__d_all_within"), F.lit(False)) | F.coalesce(
        F.exists("__d_d_edges", lambda e: _seg_dist2(e, pxc, pyc) <= d2), F.lit(False))

    def inside(z):
        n_cross = F.aggregate(z["edges"], z["odd"], lambda acc, e: (
            acc + _crosses(e, lon_c, lat_c).cast("int") + _ends_passed(z, e, lat_c)))
        return ((n_cross % 2) == 1) | F.exists(z["edges"], lambda e: _on_edge(e, lon_c, lat_c))

    # r_zones is sorted by zone id when built, so zones_in comes out sorted.
    zones_in = F.coalesce(
        F.transform(F.filter("__r_r_zones", inside), lambda z: z["zone_id"]),
        F.array().cast("array<string>"))
    out = j.select(*[F.col(c) for c in df.columns], zones_in.alias(f"{prefix}zones_in"),
                   *[F.col(c) for c in ("__d_all_within", "__d_d_edges", "__px", "__py")])
    out = out.withColumn(f"{prefix}in_zone", F.size(F.col(f"{prefix}zones_in")) > 0)
    # distance tests only for rows not already inside a zone
    out = out.withColumn(f"{prefix}within", F.when(F.col(f"{prefix}in_zone"), F.lit(True)).otherwise(near))
    return out.drop("__d_all_within", "__d_d_edges", "__px", "__py")


def position_ok(lon: str, lat: str) -> Column:
    return F.col(lon).isNotNull() & F.col(lat).isNotNull()

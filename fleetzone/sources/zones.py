"""Zone layers: ``zones(zone_id, name, ring array<struct<lon, lat>>)``.

A polygon layer is stored as a table with one row per zone and its outer
ring as an array of vertices (GeoJSON-like rings exported from a GIS file
read this way).

A feature with several parts or holes is several rows, one per ring, that
**share one zone_id**: insideness is the parity of ring crossings over all
rows of the id, so a point in a hole is outside and parts must not overlap.
``zone_names`` gives one row per zone.  ``layer_rings`` and ``read_layer``
decode such rings from a GeoJSON layer file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .literal import literal_table

ZONE_SCHEMA = T.StructType([
    T.StructField("zone_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("ring", T.ArrayType(T.StructType([
        T.StructField("lon", T.DoubleType(), False),
        T.StructField("lat", T.DoubleType(), False)])), False),
])

# The two invented test zones (lon, lat vertices).
TEST_ZONES = [
    ("A", "zone A", [(-68.0, 40.0), (-67.0, 40.0), (-67.0, 41.0), (-68.0, 41.0)]),
    ("B", "zone B", [(-66.5, 38.7), (-65.2, 39.1), (-65.0, 39.9), (-65.9, 40.2), (-66.4, 39.5)]),
]


def zones_from_rows(spark: SparkSession, rows=None) -> DataFrame:
    """A zones table from ``(zone_id, name, [(lon, lat), ...])`` tuples."""
    rows = TEST_ZONES if rows is None else rows
    data = [(z, n, [(float(x), float(y)) for x, y in ring]) for z, n, ring in rows]
    return literal_table(spark, ZONE_SCHEMA, data)


def zone_names(zones: DataFrame) -> DataFrame:
    """(zone_id, name), one row per zone however many rings it has."""
    return zones.groupBy("zone_id").agg(F.min("name").alias("name"))


def read_zones(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a stored zones table (parquet or JSON lines) with the fixed schema."""
    return spark.read.schema(ZONE_SCHEMA).format(fmt).load(path)


# --------------------------------------------------------------------------
# GeoJSON layers
# --------------------------------------------------------------------------

_PARTS = "type STRING, coordinates STRING"
_FEATURE = (f"id STRING, properties MAP<STRING, STRING>, "
            f"geometry STRUCT<{_PARTS}, geometries ARRAY<STRUCT<{_PARTS}>>>")
_POLYGON = "ARRAY<ARRAY<ARRAY<DOUBLE>>>"


def layer_rings(spark: SparkSession, path: str, id_property: str | None = None,
                name_property: str = "name", lines: bool = False) -> DataFrame:
    """The rings of a GeoJSON layer: one row per ring, good or bad.

    Columns: ``zone_id`` (the property ``id_property``, by default the
    feature's ``id``), ``name``, ``part`` and ``ring_no`` (0 is the outline,
    others are holes), ``ring`` and ``problem`` (NULL for a good ring).

    A file holds one feature collection or one feature, or, with ``lines``,
    one feature a line, which many tasks read.  Polygons, multipolygons and
    geometry collections of these are decoded; a feature of another kind, or
    without a geometry, is one row with a problem.

    * Closing: the repeated last vertex is left out, as ``zone_edges`` joins
      the last vertex to the first; an unclosed ring is closed the same way.
    * Orientation: outlines run counter-clockwise, holes clockwise; a turned
      ring keeps its first vertex.
    * Bad rings: a missing zone id, a vertex without two numbers or off the
      globe, fewer than three different vertices, no area, a bad outline
      around a hole.

    Heights are ignored.  An empty collection gives no row; text that is not
    JSON is an error.
    """
    reader = spark.read.schema(f"{_FEATURE}, features ARRAY<STRUCT<{_FEATURE}>>").option("mode", "FAILFAST")
    docs = reader.option("multiLine", not lines).json(path)
    own = F.struct("id", "properties", "geometry")
    f = docs.select(F.explode(F.coalesce("features", F.array(own))).alias("f"))
    f = f.select(F.col("f.id" if id_property is None else f"f.properties.`{id_property}`").alias("zone_id"),
                 F.col(f"f.properties.`{name_property}`").alias("name"), F.col("f.geometry").alias("g"))
    members = F.when((F.col("g.type") == "GeometryCollection") & (F.size("g.geometries") > 0), F.col("g.geometries")
                     ).otherwise(F.array(F.struct(F.col("g.type").alias("type"),
                                                  F.col("g.coordinates").alias("coordinates"))))
    parts = f.select("zone_id", "name", F.posexplode(F.flatten(F.transform(members, _polygons))).alias("part", "rings"))
    # An outline's fault is its holes' fault as well: they are left out with it.
    rings = parts.select("zone_id", "name", "part", _fault(F.get("rings", F.lit(0))).alias("outline"),
                         F.posexplode_outer("rings").alias("ring_no", "v"))
    ring = _open(F.transform("v", _vertex))
    turned = F.when((F.col("ring_no") == 0) == (_area(ring) < 0),
                    F.concat(F.slice(ring, 1, 1), F.reverse(_rest(ring)))).otherwise(ring)
    problem = F.coalesce(F.when(F.col("zone_id").isNull(), F.lit("no zone id")), _fault(F.col("v")),
                         F.when(F.col("outline").isNotNull(), F.concat(F.lit("outline: "), "outline")))
    return rings.select("zone_id", "name", "part", F.coalesce("ring_no", F.lit(0)).alias("ring_no"),
                        turned.alias("ring"), problem.alias("problem"))


def _polygons(g: Column) -> Column:
    """A geometry's polygons, each an array of rings; one NULL for any other kind."""
    none = F.array(F.lit(None).cast(_POLYGON))
    return (F.when(g["type"] == "Polygon", F.array(F.from_json(g["coordinates"], _POLYGON)))
             .when(g["type"] == "MultiPolygon", F.coalesce(F.from_json(g["coordinates"], f"ARRAY<{_POLYGON}>"), none))
             .otherwise(none))


def _vertex(p: Column) -> Column:
    return F.named_struct(F.lit("lon"), F.get(p, F.lit(0)), F.lit("lat"), F.get(p, F.lit(1)))


def _open(ring: Column) -> Column:
    """A ring without its repeated last vertex."""
    closed = (F.size(ring) > 1) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1))
    return F.when(closed, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)


def _rest(ring: Column) -> Column:
    return F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))


def _area(ring: Column) -> Column:
    """Twice the signed area, taken about the first vertex so that small rings far from 0 keep their digits."""
    first = F.get(ring, F.lit(0))
    ends = F.zip_with(ring, F.concat(_rest(ring), F.array(first)),
                      lambda a, b: (a["lon"] - first["lon"]) * (b["lat"] - first["lat"])
                      - (b["lon"] - first["lon"]) * (a["lat"] - first["lat"]))
    return F.aggregate(ends, F.lit(0.0), lambda total, x: total + x)


def _fault(v: Column) -> Column:
    """What is wrong with a ring of coordinate arrays; NULL for a good one."""
    off = F.exists(v, lambda p: ~F.coalesce((F.size(p) >= 2) & F.get(p, F.lit(0)).between(-180, 180)
                                            & F.get(p, F.lit(1)).between(-90, 90), F.lit(False)))
    ring = _open(F.transform(v, _vertex))
    return (F.when(v.isNull(), F.lit("not a polygon"))
             .when(off, F.lit("a vertex without two numbers or off the globe"))
             .when(F.size(F.array_distinct(ring)) < 3, F.lit("fewer than three different vertices"))
             .when(_area(ring) == 0, F.lit("no area")))


def read_layer(spark: SparkSession, path: str, id_property: str | None = None, name_property: str = "name",
               lines: bool = False, strict: bool = True) -> DataFrame:
    """A GeoJSON layer as a zones table (see ``layer_rings``).

    A bad ring is an error that names its zone; with ``strict=False`` bad
    rings are left out.
    """
    r = layer_rings(spark, path, id_property, name_property, lines)
    if not strict:
        return r.where(F.col("problem").isNull()).select("zone_id", "name", "ring")
    message = F.concat(F.lit("zone "), F.coalesce("zone_id", F.lit("?")), F.lit(": "), F.col("problem"))
    ring = F.when(F.col("problem").isNotNull(), F.raise_error(message)).otherwise(F.col("ring"))
    return r.select("zone_id", "name", ring.alias("ring"))

"""Zone tagging: parity, edges, distance threshold, invariances, brute force."""

import math
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleetzone.operators import geo
from fleetzone.session import work_path
from fleetzone.sources.zones import TEST_ZONES, ZONE_SCHEMA, zone_names, zones_from_rows

ZONE_A = TEST_ZONES[0]


# ---------------------------------------------------------------- brute force
def proj(lon, lat):
    phi = lat * geo.RAD
    arc = geo.GRS80_A * (geo.C0 * phi - geo.C2 * math.sin(phi * 2.0) + geo.C4 * math.sin(phi * 4.0)
                         - geo.C6 * math.sin(phi * 6.0))
    rho = geo.A_G - arc
    th = geo.CONE_N * ((lon - geo.LON_ORIGIN) * geo.RAD)
    return rho * math.sin(th), geo.RHO0 - rho * math.cos(th)


def unproj(x, y):
    rho = math.hypot(x, geo.RHO0 - y)
    th = math.atan2(x, geo.RHO0 - y)
    lon = geo.LON_ORIGIN + th / geo.CONE_N / geo.RAD
    target = geo.A_G - rho
    phi = target / (geo.GRS80_A * geo.C0)
    for _ in range(50):
        m = geo.GRS80_A * (geo.C0 * phi - geo.C2 * math.sin(2 * phi) + geo.C4 * math.sin(4 * phi)
                           - geo.C6 * math.sin(6 * phi))
        dm = geo.GRS80_A * (geo.C0 - 2 * geo.C2 * math.cos(2 * phi) + 4 * geo.C4 * math.cos(4 * phi)
                            - 6 * geo.C6 * math.cos(6 * phi))
        phi -= (m - target) / dm
    return lon, phi / geo.RAD


def seg_dist_old(px, py, a, b):
    (x1, y1), (x2, y2) = a, b
    dx, dy = x2 - x1, y2 - y1
    l2 = dx * dx + dy * dy
    t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / l2))
    return math.hypot(px - x1 - t * dx, py - y1 - t * dy)


def seg_dist(px, py, a, b):
    (x1, y1), (x2, y2) = a, b
    ax, ay, dx, dy = px - x1, py - y1, x2 - x1, y2 - y1
    l2 = dx * dx + dy * dy
    dot = ax * dx + ay * dy
    if dot <= 0:
        return math.sqrt(ax * ax + ay * ay)
    if dot >= l2:
        return math.hypot(ax - dx, ay - dy)
    cross = ax * dy - ay * dx
    return math.sqrt(cross * cross / l2)


def brute(lon, lat, zones, d=geo.BUFFER_M):
    inside = []
    best = math.inf
    px, py = proj(lon, lat)
    for zid, _, ring in zones:
        n, cross, on = len(ring), 0, False
        for i in range(n):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % n]
            if (y1 > lat) != (y2 > lat) and lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1):
                cross += 1
            if ((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1) == 0
                    and min(x1, x2) <= lon <= max(x1, x2) and min(y1, y2) <= lat <= max(y1, y2)):
                on = True
            best = min(best, seg_dist(px, py, proj(x1, y1), proj(x2, y2)))
        if cross % 2 == 1 or on:
            inside.append(zid)
    return sorted(inside), bool(inside) or best <= d


def classify_points(spark, pts, zones=TEST_ZONES, cells=None, **kw):
    cells = cells or geo.edge_cells(geo.zone_edges(zones_from_rows(spark, zones)), **kw)
    df = spark.createDataFrame([(i, lo, la) for i, (lo, la) in enumerate(pts)], "i int, lon double, lat double")
    out = geo.classify(df, "lon", "lat", cells).orderBy("i").collect()
    return [(list(r.zones_in), r.within) for r in out]


def longest_lists(cells):
    """Longest edge list of the distance cells and of the ray cells."""
    return (cells.dist_cells.agg(F.max(F.size("d_edges"))).first()[0],
            cells.ray_cells.agg(F.max(F.aggregate("r_zones", F.lit(0), lambda n, z: n + F.size(z["edges"])))).first()[0])


# ---------------------------------------------------------------- tests
def test_projection_check_point():
    x, y = proj(-67.0, 40.0)
    assert round(x, 2) == 2421863.72 and round(y, 2) == 499329.76


def test_inside_edge_outside_and_null(spark):
    pts = [(-67.5, 40.5), (-67.5, 40.0), (-68.0, 40.3), (-60.0, 30.0), (None, 40.0)]
    got = classify_points(spark, pts)
    assert got[0] == (["A"], True)
    assert got[1] == (["A"], True)      # on the bottom edge
    assert got[2] == (["A"], True)      # on the western edge
    assert got[3] == ([], False)
    assert got[4] == ([], False)        # missing position: neither in nor within


def test_distance_threshold_one_metre_each_side(spark):
    (x1, y1), (x2, y2) = proj(-68.0, 40.0), proj(-67.0, 40.0)
    mx, my = (x1 + x2) / 2, (y1 + y2) / 2
    nx, ny = (y2 - y1), -(x2 - x1)             # normal pointing south (away from A)
    norm = math.hypot(nx, ny)
    nx, ny = nx / norm, ny / norm
    near = unproj(mx + nx * 80466.0, my + ny * 80466.0)
    far = unproj(mx + nx * 80468.0, my + ny * 80468.0)
    got = classify_points(spark, [near, far], zones=[ZONE_A])
    assert got == [([], True), ([], False)]


def test_overlapping_zones_give_one_entry_each(spark):
    zone_c = ("C", "zone C", [(-67.8, 40.2), (-66.0, 40.2), (-66.0, 41.5), (-67.8, 41.5)])
    got = classify_points(spark, [(-67.5, 40.5)], zones=TEST_ZONES + [zone_c])
    assert got == [(["A", "C"], True)]


def test_matches_brute_force_on_random_points(spark):
    rnd = random.Random(7)
    pts = [(round(rnd.uniform(-70, -63), 3), round(rnd.uniform(37.5, 42), 3)) for _ in range(600)]
    pts += [(-67.0, 40.5), (-66.5, 38.7), (-65.0, 39.9)]
    got = classify_points(spark, pts, cell_m=30000.0, band_deg=0.25)
    want = [brute(lo, la, TEST_ZONES) for lo, la in pts]
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 4), st.booleans())
def test_ring_start_and_direction_do_not_matter(spark, shift, reverse):
    zid, name, ring = TEST_ZONES[1]
    ring2 = ring[shift:] + ring[:shift]
    if reverse:
        ring2 = ring2[::-1]
    rnd = random.Random(shift * 2 + reverse)
    pts = [(rnd.uniform(-67.5, -64.0), rnd.uniform(38.0, 41.0)) for _ in range(80)]
    a = classify_points(spark, pts, zones=[(zid, name, ring)])
    b = classify_points(spark, pts, zones=[(zid, name, ring2)])
    assert a == b


def test_in_zone_implies_within(spark):
    rnd = random.Random(3)
    pts = [(rnd.uniform(-69, -64), rnd.uniform(38, 42)) for _ in range(300)]
    for zones_in, within in classify_points(spark, pts):
        assert within or not zones_in


def test_shuffled_cells_give_the_same_as_broadcast_ones(spark):
    rnd = random.Random(11)
    pts = [(round(rnd.uniform(-70, -63), 3), round(rnd.uniform(37.5, 42), 3)) for _ in range(400)]
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    small = classify_points(spark, pts)
    for n in names:
        spark.conf.set(n, "-1")
    try:
        large = classify_points(spark, pts)
    finally:
        for n in names:
            spark.conf.unset(n)
    assert small == large == [brute(lo, la, TEST_ZONES) for lo, la in pts]


def test_parts_and_holes_share_a_zone_id(spark):
    outer = [(-68.0, 40.0), (-66.0, 40.0), (-66.0, 42.0), (-68.0, 42.0)]
    hole = [(-67.5, 40.5), (-66.5, 40.5), (-66.5, 41.5), (-67.5, 41.5)]
    part = [(-64.0, 40.0), (-63.0, 40.0), (-63.0, 41.0), (-64.0, 41.0)]
    rows = [("A", "zone A", outer), ("A", "zone A", hole), ("A", "zone A", part)]
    got = classify_points(spark, [(-67.8, 41.0), (-67.0, 41.0), (-63.5, 40.5), (-65.0, 40.5)], zones=rows)
    assert [z for z, _ in got] == [["A"], [], ["A"], []]
    zones = zones_from_rows(spark, rows)
    assert [tuple(r) for r in zone_names(zones).collect()] == [("A", "zone A")]


def test_read_zones(spark):
    from fleetzone.sources.zones import read_zones
    path = work_path(spark, "zones-file")
    zones_from_rows(spark).write.mode("overwrite").parquet(path)
    assert sorted(r.zone_id for r in read_zones(spark, path).collect()) == ["A", "B"]
    zones_from_rows(spark).write.mode("overwrite").json(path + "-json")
    back = read_zones(spark, path + "-json", "json")
    assert sorted(map(str, back.collect())) == sorted(map(str, zones_from_rows(spark).collect()))


@pytest.mark.parametrize("n", [4000, 20000])
def test_detailed_zone_matches_brute_force(spark, n):
    """However detailed an outline, no cell lists more than MAX_EDGES edges,
    and cells inside the buffer none."""
    ring = [(-66.0 + (1 + 0.05 * math.sin(40 * math.pi * 2 * i / n)) * math.cos(2 * math.pi * i / n),
             40.0 + (1 + 0.05 * math.sin(40 * math.pi * 2 * i / n)) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    zones = [("D", "detailed", ring)]
    cells = geo.edge_cells(geo.zone_edges(spark.createDataFrame(zones, ZONE_SCHEMA)))
    assert max(longest_lists(cells)) <= geo.MAX_EDGES and cells.dist_levels is not None and cells.ray_levels is not None
    assert cells.dist_cells.where("all_within and size(d_edges) > 0").count() == 0
    rnd = random.Random(5)
    pts = [(round(rnd.uniform(-69, -63), 3), round(rnd.uniform(37.5, 42.5), 3)) for _ in range(40)]
    pts += [ring[k] for k in range(0, n, n // 5)]                                   # vertices
    for k in range(0, n, n // 40):                                                  # close to the outline and to the rim
        (x, y), turn = ring[k], 2 * math.pi * k / n
        pts += [(x + s * math.cos(turn), y + s * math.sin(turn)) for s in (-1e-4, 1e-4)]
        px, py = proj(x, y)
        pts.append(unproj(px + rnd.uniform(79000, 82000) * math.cos(turn), py + rnd.uniform(0.9, 1) * 80467 * math.sin(turn)))
    assert classify_points(spark, pts, cells=cells) == [brute(lo, la, zones) for lo, la in pts]


def test_divided_cells_with_vertices_and_edges_on_their_borders(spark, monkeypatch):
    """Vertices on quarter degrees, spikes, shared borders, holes and repeated
    vertices, cells divided as far as they go, points on the same grid."""
    monkeypatch.setattr(geo, "MAX_EDGES", 2)
    monkeypatch.setattr(geo, "MAX_LEVEL", 3)
    rnd = random.Random(8)

    def q(low, high):
        return rnd.randint(int(low * 4), int(high * 4)) / 4
    star = []
    for k in range(24):
        turn, far = 2 * math.pi * k / 24, 2.0 if k % 2 else 0.6
        star.append((round((-66 + far * math.cos(turn)) * 4) / 4, round((40 + far * math.sin(turn)) * 4) / 4))
    zones = [("A", "box", [(-68.0, 40.0), (-66.0, 40.0), (-66.0, 42.0), (-68.0, 42.0), (-68.0, 40.0)]),
             ("A", "hole", [(-67.5, 40.5), (-66.5, 40.5), (-66.5, 41.5), (-67.5, 41.5)]),
             ("B", "neighbour", [(-66.0, 40.0), (-64.5, 40.25), (-65.0, 41.0), (-65.5, 40.5), (-66.0, 42.0)]),
             ("S", "star", star),
             ("T", "random", [(q(-68, -64), q(38, 42)) for _ in range(9)])]
    rings = {}
    for z, _, ring in zones:
        rings.setdefault(z, []).append(ring)

    def want(lo, la):
        inside, within = [], False
        for z, parts in rings.items():
            found = [brute(lo, la, [(z, "", r)]) for r in parts]
            on = any(brute_on(lo, la, r) for r in parts)
            odd = sum(bool(f[0]) and not brute_on(lo, la, r) for f, r in zip(found, parts)) % 2
            inside += [z] if on or odd else []
            within |= any(f[1] for f in found)
        return sorted(inside), within

    def brute_on(lo, la, r):
        return any((x2 - x1) * (la - y1) == (y2 - y1) * (lo - x1) and min(x1, x2) <= lo <= max(x1, x2)
                   and min(y1, y2) <= la <= max(y1, y2) for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]))
    pts = [(x / 8, y / 8) for x in range(-69 * 8, -63 * 8, 3) for y in range(37 * 8, 43 * 8, 3)]
    pts += [(x / 4, y / 4) for x in range(-69 * 4, -63 * 4, 2) for y in range(37 * 4, 43 * 4, 2)]
    pts += [(rnd.uniform(-69, -63), rnd.uniform(37, 43)) for _ in range(400)]
    got = classify_points(spark, pts, zones=zones)
    assert got == [want(lo, la) for lo, la in pts]


def test_classify_plan_has_no_nested_loop_or_cartesian(spark):
    z = zones_from_rows(spark)
    cells = geo.edge_cells(geo.zone_edges(z))
    df = spark.range(10).select((F.lit(-67.5) + F.col("id") / 100).alias("lon"),
                                (F.lit(40.5) + F.col("id") / 100).alias("lat"))
    plan = geo.classify(df, "lon", "lat", cells)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BroadcastHashJoin" in plan      # small written tables: Spark's own size check


def test_hot_position_and_key_give_whole_results(spark):
    """A third of all rows at one position with one set key: same report as
    computing each row on its own (nothing dropped or capped)."""
    from fleetzone.operators import rollup
    n = 3000
    df = spark.range(n).select(
        (F.col("id") % 50).cast("string").alias("VESSEL_ID"),
        F.lit("2020-01-01").alias("LANDING_DATE"),
        F.when(F.col("id") < n // 3, F.lit("HOT")).otherwise((F.col("id") % 400).cast("string")).alias("SCHEDULE_NUMBER"),
        F.when(F.col("id") < n // 3, F.lit("HOT-1")).otherwise(F.col("id").cast("string")).alias("SET"),
        F.when(F.col("id") < n // 3, F.lit(-67.5)).otherwise(F.lit(-70.0) + (F.col("id") % 97) / 10).alias("lon"),
        F.when(F.col("id") < n // 3, F.lit(40.5)).otherwise(F.lit(37.0) + (F.col("id") % 89) / 17).alias("lat"))
    cells = geo.edge_cells(geo.zone_edges(zones_from_rows(spark)))
    cl = geo.classify(df, "lon", "lat", cells)
    assert cl.count() == n
    hot = cl.where(F.col("SET") == "HOT-1").agg(F.min(F.col("within").cast("int"))).first()[0]
    assert hot == 1
    rep = rollup.trips_sets_report_from_rows(cl, set_key="SET")
    total_sets = rep.agg(F.sum("n_sets")).first()[0]
    want = df.select("VESSEL_ID", "SET").distinct().count()
    assert total_sets == want


def test_missing_and_shared_set_keys_without_a_window(spark):
    """30% of rows without a set key, one key shared by many vessels: as computed plainly."""
    from collections import defaultdict
    from fleetzone.operators import rollup
    rows = []
    rnd = random.Random(2)
    for i in range(2000):
        s = None if i % 10 < 3 else "SHARED" if i % 10 == 3 else f"s{i % 300}"
        rows.append((f"v{i % 40}", "2020-01-01" if i % 2 else "2021-05-05", f"t{i % 500}", s, rnd.random() < 0.02))
    df = spark.createDataFrame(rows, "VESSEL_ID string, LANDING_DATE string, SCHEDULE_NUMBER string, k string, within boolean")
    for hit_null in (False, True):
        data = [r[:4] + ((r[4] and r[3] is not None) or (hit_null and r[3] is None and r[2] == "t1"),) for r in rows]
        df = spark.createDataFrame(data, df.schema)
        rep = rollup.trips_sets_report_from_rows(df, set_key="k")
        plan = rep._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "NestedLoop" not in plan
        hits = {r[3] for r in data if r[4]}
        groups = defaultdict(lambda: [set(), set(), set(), set()])
        for v, d, t, s, _ in data:
            g = groups[v, d[:4]]
            g[0].add(t)
            g[1].add(s)
            if s in hits:
                g[2].add(t)
                g[3].add(s)
        want = sorted((v, y, *map(len, g)) for (v, y), g in groups.items())
        assert sorted(tuple(r)[:6] for r in rep.collect()) == want


def _layer(spark, name, texts):
    path = work_path(spark, name)
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def _feature(geometry, **properties):
    return {"type": "Feature", "id": properties.pop("id", None), "properties": properties, "geometry": geometry}


BOX = [[-68.0, 40.0], [-66.0, 40.0], [-66.0, 42.0], [-68.0, 42.0], [-68.0, 40.0]]
HOLE = [[-67.5, 40.5], [-66.5, 40.5], [-66.5, 41.5], [-67.5, 41.5], [-67.5, 40.5]]
FAR = [[-64.0, 40.0, 5.0], [-63.0, 40.0, 5.0], [-63.0, 41.0, 5.0], [-64.0, 41.0, 5.0]]


def test_layer_of_parts_and_holes_feeds_the_zone_edges(spark):
    """A collection, the same as one feature a line, and as geometry collections: the same zones."""
    import json
    from fleetzone.sources.zones import layer_rings, read_layer
    feature = _feature({"type": "MultiPolygon", "coordinates": [[BOX[::-1], HOLE], [FAR]]}, id="A", name="zone A")
    other = _feature({"type": "Polygon", "coordinates": [[[-60, 40], [-59, 40], [-59, 41]]]}, id=7, name=None)
    both = _feature({"type": "GeometryCollection", "geometries": [
        {"type": "Polygon", "coordinates": [BOX, HOLE]}, {"type": "Polygon", "coordinates": [FAR]}]}, id="A", name="zone A")
    whole = _layer(spark, "layer-whole", json.dumps({"type": "FeatureCollection", "features": [feature, other]}, indent=1).split("\n"))
    lined = _layer(spark, "layer-lines", [json.dumps(x) for x in (both, other)])
    got = [sorted(map(str, layer_rings(spark, p, lines=n).collect())) for p, n in ((whole, False), (lined, True))]
    assert got[0] == got[1] and len(got[0]) == 4
    rings = {(r.zone_id, r.part, r.ring_no): [tuple(v) for v in r.ring] for r in layer_rings(spark, whole).collect()}
    assert sorted(rings["A", 0, 1]) == sorted(map(tuple, HOLE[:-1]))

    def area(r):
        return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1]))
    assert {k: area(r) > 0 for k, r in rings.items()} == {("A", 0, 0): True, ("A", 0, 1): False, ("A", 1, 0): True, ("7", 0, 0): True}
    assert all(r[0] != r[-1] for r in rings.values())
    zones = read_layer(spark, whole)
    assert zones.schema.names == ZONE_SCHEMA.names and zones.schema["ring"].dataType.simpleString() == \
        ZONE_SCHEMA["ring"].dataType.simpleString()
    cells = geo.edge_cells(geo.zone_edges(zones))
    assert [z for z, _ in classify_points(spark, [(-67.8, 41.0), (-67.0, 41.0), (-63.5, 40.5), (-59.2, 40.4), (-65.0, 40.5)],
                                          cells=cells)] == [["A"], [], ["A"], ["7"], []]
    assert sorted(map(tuple, zone_names(zones).collect())) == [("7", None), ("A", "zone A")]


def test_layer_with_bad_rings(spark):
    import json
    from fleetzone.sources.zones import layer_rings, read_layer
    shapes = {"line": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}, "none": None,
              "flat": {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [2, 2], [0, 0]]]},
              "two": {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [0, 0]]]},
              "off": {"type": "Polygon", "coordinates": [[[0, 0], [181, 1], [2, 5]], HOLE]},
              "short": {"type": "Polygon", "coordinates": [[[0, 0], [1], [2, 5]]]},
              "empty": {"type": "Polygon", "coordinates": []}, "good": {"type": "Polygon", "coordinates": [BOX, [[0, 0]]]}}
    lines = [json.dumps(_feature(g, key=k)) for k, g in shapes.items()] + [json.dumps(_feature(shapes["good"], name="x"))]
    path = _layer(spark, "layer-bad", lines)
    got = {}
    for r in layer_rings(spark, path, id_property="key", lines=True).collect():
        got.setdefault(r.zone_id, []).append(r.problem)
    vertex, few = "a vertex without two numbers or off the globe", "fewer than three different vertices"
    assert got == {"line": ["not a polygon"], "none": ["not a polygon"], "flat": ["no area"], "two": [few],
                   "off": [vertex, "outline: " + vertex], "short": [vertex], "empty": ["not a polygon"],
                   "good": [None, few], None: ["no zone id", "no zone id"]}
    kept = read_layer(spark, path, id_property="key", lines=True, strict=False).collect()
    assert [(r.zone_id, len(r.ring)) for r in kept] == [("good", 4)]
    with pytest.raises(Exception, match="zone (line|none|flat|two|off|short|empty|good|.): "):
        read_layer(spark, path, id_property="key", lines=True).collect()
    nothing = _layer(spark, "layer-nothing", ['{"type": "FeatureCollection", "features": []}'])
    assert read_layer(spark, nothing).collect() == []

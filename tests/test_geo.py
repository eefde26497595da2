import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landledger.functions import projection as P
from landledger.operators import geo as G
from landledger.session import materialize


def forward(crs, lon, lat):
    """Krueger's series for the forward transverse Mercator: independent of the inverse under test."""
    ell = crs.ellipsoid
    f = 1 - ell.b / ell.a
    n = f / (2 - f)
    big_a = ell.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    e = math.sqrt(ell.e2)

    def northing(phi, lam):
        t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
        xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t**2))
        north = xi + sum(a * np.sin(2 * (j + 1) * xi) * np.cosh(2 * (j + 1) * eta) for j, a in enumerate(alpha))
        east = eta + sum(a * np.cos(2 * (j + 1) * xi) * np.sinh(2 * (j + 1) * eta) for j, a in enumerate(alpha))
        return crs.k0 * big_a * east, crs.k0 * big_a * north

    east, north = northing(np.radians(lat), np.radians(lon - crs.lon0))
    _, origin = northing(np.radians(crs.lat0), 0.0)
    return (east + crs.false_easting) / crs.unit, (north - origin) / crs.unit


@pytest.mark.parametrize("srid", [26796, 102696])
def test_inverse_undoes_forward(srid):
    crs = P.CRS[srid]
    lon, lat = map(np.ravel, np.meshgrid(np.linspace(-92, -89, 31), np.linspace(35.9, 40.6, 31)))
    x, y = forward(crs, lon, lat)
    lon2, lat2 = P.inverse(crs, x, y)
    x2, y2 = forward(crs, lon2, lat2)
    assert max(np.abs(x2 - x).max(), np.abs(y2 - y).max()) < 1e-3
    # The origin has the false easting and no northing.
    assert np.allclose(forward(crs, np.array([crs.lon0]), np.array([crs.lat0])), [[crs.false_easting / crs.unit], [0]], atol=1e-6)


def test_datum_shift_is_tens_of_metres():
    lon, lat = P.shift_datum(P.CLARKE_1866, P.CONUS_1927_SHIFT, np.array([-90.2]), np.array([38.63]))
    north = (lat[0] - 38.63) * 111000
    east = (lon[0] + 90.2) * 111000 * math.cos(math.radians(38.63))
    assert 0 < abs(north) < 30 and 0 < abs(east) < 60


def square(x, y, w=1, h=1, clockwise=False):
    ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    return ring[::-1] if clockwise else ring


def frame(spark, rows):
    """rows: (key, [polygon = [ring, ...]])"""
    data = [(k, [[[(float(a), float(b)) for a, b in ring] for ring in polygon] for polygon in polygons]) for k, polygons in rows]
    return spark.createDataFrame(data, f"k string, geom {G.GEOMETRY}")


def test_reproject_keeps_nesting_and_nulls(spark):
    crs = P.CRS[102696]
    x, y = forward(crs, np.array([-90.2]), np.array([38.6]))
    rows = [("a", [[square(x[0], y[0], 100, 100), square(x[0] + 10, y[0] + 10, 5, 5)], [square(x[0], y[0])]]), ("b", []), ("d", [[square(x[0] + 1, y[0])]])]
    df = frame(spark, rows).unionByName(spark.createDataFrame([("c", None)], f"k string, geom {G.GEOMETRY}"))
    out = {r["k"]: r for r in G.reproject(df.coalesce(1), 102696).collect()}
    assert out["c"]["geom"] is None and out["b"]["geom"] == [] and out["a"]["srid"] == 4326
    assert [len(p) for p in out["a"]["geom"]] == [2, 1]
    first = out["a"]["geom"][0][0][0]
    assert abs(first["x"] + 90.2) < 1e-9 and abs(first["y"] - 38.6) < 1e-9
    assert abs(out["d"]["geom"][0][0][0]["x"] + 90.2) < 1e-5
    shifted = G.reproject(df, 26796, shift=P.CONUS_1927_SHIFT).where("k = 'a'").head()["geom"][0][0][0]
    plain = G.reproject(df, 26796).where("k = 'a'").head()["geom"][0][0][0]
    assert 0 < abs(shifted["y"] - plain["y"]) < 0.001
    with pytest.raises(ValueError):
        G.reproject(df, 3857)


def test_srid(spark):
    df = G.set_srid(frame(spark, [("a", []), ("b", [])]), 26796)
    assert G.srid_of(df) == 26796
    with pytest.raises(ValueError):
        G.srid_of(df.withColumn("srid", F.when(F.col("k") == "a", 1).otherwise(2)))
    with pytest.raises(ValueError):
        G.srid_of(df.withColumn("srid", F.lit(None).cast("int")))


def test_parsing(spark):
    texts = [
        ("POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0), (0.5 0.5,1 0.5,1 1,0.5 1,0.5 0.5))", 3.75, 1),
        ("multipolygon(((0 0,1 0,1 1,0 1,0 0)),((5 5,6 5,6 6.5,5 6.5,5 5)))", 2.5, 2),
        ("POLYGON Z ((0 0 9, 1 0 9, 1 1 9, 0 1 9, 0 0 9))", 1.0, 1),
        ("POINT (1 2)", None, None),
    ]
    df = spark.createDataFrame([(t,) for t, _, _ in texts], "geom string")
    got = G.load_polygons(df).select(G.area("geom").alias("a"), F.size("geom").alias("n"), "srid").collect()
    assert [(r["a"], r["n"] if r["a"] is not None else None) for r in got] == [(a, n) for _, a, n in texts]
    assert got[0]["srid"] == 4326
    json = spark.createDataFrame([('{"type":"Point","coordinates":[1,2]}',), (None,)], "geom string")
    assert [r["geom"] for r in G.load_polygons(json, fmt="geojson").collect()] == [None, None]


def measure(df):
    rows = df.select("k", G.area("geom").alias("area"), F.size("geom").alias("n"), F.expr("transform(geom, p -> size(p))").alias("rings")).collect()
    return {r["k"]: (round(r["area"], 9), r["n"], sorted(r["rings"])) for r in rows}


CASES = [
    ("alone", [[[square(0, 0)]]], (1, 1, [1])),
    ("copies", [[[square(0, 0)]]] * 3, (1, 1, [1])),
    ("neighbours", [[[square(0, 0)]], [[square(1, 0, clockwise=True)]]], (2, 1, [1])),
    ("copies beside", [[[square(0, 0)]], [[square(0, 0)]], [[square(1, 0)]]], (2, 1, [1])),
    ("apart", [[[square(0, 0)]], [[square(5, 0)]]], (2, 2, [1, 1])),
    ("corner", [[[square(0, 0)]], [[square(1, 1)]]], (2, 2, [1, 1])),
    ("hole kept", [[[square(0, 0, 9, 9), square(3, 3, 2, 2)]], [[square(9, 0, 1, 9)]]], None),
    ("hole filled", [[[square(0, 0, 9, 9), square(3, 3, 2, 2)]], [[square(3, 3, 2, 2)]]], (81, 1, [1])),
    ("island in hole", [[[square(0, 0, 9, 9), square(2, 2, 5, 5)]], [[square(4, 4)]]], (57, 2, [1, 2])),
    ("ring of squares", [[[square(x, y)]] for x in range(3) for y in range(3) if (x, y) != (1, 1)], (8, 1, [2])),
    ("holes touch", [[[square(x, y)]] for x in range(4) for y in range(4) if (x, y) not in ((1, 1), (2, 2))], (14, 1, [3])),
    ("hole touches shell", [[[square(x, y)]] for x in range(3) for y in range(3) if (x, y) not in ((1, 1), (0, 0))], (7, 1, [2])),
    ("two rings of squares", [[[square(x + d, y)]] for d in (0, 10) for x in range(3) for y in range(3) if (x, y) != (1, 1)], (16, 2, [2, 2])),
]


@pytest.mark.parametrize("small", [0, 20, 20_000])
def test_dissolve(spark, small):
    rows = [(name, polygons) for name, parts, _ in CASES for polygons in parts]
    merged = G.dissolve(frame(spark, rows), "k", small=small)
    assert merged.where("not dissolved").isEmpty()
    got = measure(merged)
    for name, _, want in CASES:
        if want:
            assert got[name] == want, name
    # The neighbour's long side does not share the vertices of the big square's side: both stay, areas add up.
    assert got["hole kept"][0] == 81 - 4 + 9


@pytest.mark.parametrize("small", [0, 20_000])
def test_dissolve_random_cells(spark, small):
    random.seed(small)
    cells = {(x, y) for x in range(25) for y in range(25) if random.random() < 0.6}
    df = frame(spark, [("k", [[square(x, y)]]) for x, y in cells])
    rings = G.trace_rings(G.boundary_edges(df, "k"), "k", small)
    row = rings.agg(F.sum("signed_area").alias("a"), F.sum(F.size("points") - 1).alias("e"), F.count_if(F.col("signed_area") == 0).alias("z")).head()
    sides = sum((x + dx, y + dy) not in cells for x, y in cells for dx, dy in ((0, 1), (1, 0), (0, -1), (-1, 0)))
    assert (row["a"], row["e"], row["z"]) == (len(cells), sides, 0)
    assert G.dissolve(df, "k").select(G.area("geom").alias("a")).head()["a"] == len(cells)


def test_holes_find_their_shells(spark):
    """Against a plain ray test over all shells: nested frames, a comb whose teeth part the cells, slanted shells, and many holes in one row."""
    def ring(points, hole=False):
        """Counter-clockwise, holes clockwise, from the smallest edge."""
        turn = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))
        points = points[::-1] if (turn > 0) == hole else points
        at = points.index(min(points))
        points = points[at:] + points[:at]
        return points + points[:1]

    def box(x, y, w, h=None):
        return [(x, y), (x + w, y), (x + w, y + (h or w)), (x, y + (h or w))]

    random.seed(11)
    shells = [box(0, 0, 100), box(10, 10, 40), box(14, 14, 6), [(200.0, 0.5), (260.25, 30), (240, 90), (190, 60)]]
    comb = [(110, 0), (180, 0)] + [p for i in range(35) for p in ((180 - 2 * i, 50), (179 - 2 * i, 50), (179 - 2 * i, 2), (178 - 2 * i, 2))]
    shells.append(comb[:-2])
    holes = [box(5, 5, 90), box(12, 12, 10), box(179.25, 20, 0.5), box(111.25, 45, 0.25), box(230, 40, 1)]
    holes += [box(55 + x, 3 + y * 0.01, 0.125) for x in range(30) for y in (1, 50, 120)]
    holes += [box(round(random.uniform(205, 235), 3), round(random.uniform(25, 60), 3), 0.001) for _ in range(40)]

    def holds(shell, x, y):
        return sum((a[1] <= y) != (b[1] <= y) and a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) < x for a, b in zip(shell, shell[1:])) % 2

    def size(points):
        return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:])) / 2

    shells, holes = [ring(p) for p in shells], [ring(p, True) for p in holes]
    rows = [(key, (r[0], r[1]), r, size(r)) for key in ("a", None) for r in shells + holes]
    point = "struct<x:double,y:double>"
    df = spark.createDataFrame(
        [(k, tuple((float(x), float(y)) for x, y in i), [(float(x), float(y)) for x, y in p], float(s)) for k, i, p, s in rows],
        f"k string, ring_id struct<a:{point},b:{point}>, points array<{point}>, signed_area double")
    got = {(r["k"], tuple(r["hole_id"]["a"]), tuple(r["hole_id"]["b"])): tuple(r["shell_id"]["a"]) for r in G._hole_parents(df, "k").collect()}
    want = {}
    for h in holes:
        around = [s for s in shells if holds(s, *h[0])]
        for key in ("a", None):
            if around:
                want[key, h[0], h[1]] = min(around, key=size)[0]
    assert got == want and len(want) > 250


def test_overlaps_are_kept_and_flagged(spark):
    rows = [("edge", [[square(0, 0, 2, 2)]]), ("edge", [[square(0, 0, 1, 2)]]), ("edge", [[square(0, 0, 1, 2)]]), ("fine", [[square(0, 0)]]), ("fine", [[square(1, 0)]])]
    df = frame(spark, rows)
    empty = spark.createDataFrame([("none", None), ("none", None), (None, None), (None, [])], f"k string, geom {G.GEOMETRY}")
    got = {r["k"]: (r["dissolved"], r["geom"] and len(r["geom"])) for r in G.dissolve(df.unionByName(empty), "k").collect()}
    assert got == {"edge": (False, 2), "fine": (True, 1), "none": (True, None), None: (True, None)}
    # One overlap leaves the other parts of its key dissolved, also those that only touch in a corner, and a part inside a hole.
    ring = [[[square(20 + x, y)]] for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    mixed = [("edge", p) for p in ([[square(10, 0)]], [[square(11, 0)]], [[square(12, 1)]], *[r for r in ring], [[square(21.25, 1.25, 0.5, 0.5)]])]
    parts = G.dissolve_polygons(df.where("k = 'edge'").unionByName(frame(spark, mixed)), "k")
    found = sorted((r["dissolved"], r["area"], r["n"]) for r in parts.select("dissolved", G.area(G.to_multipolygon("polygon")).alias("area"), F.size("polygon").alias("n")).collect())
    assert found == [(False, 2.0, 1), (False, 4.0, 1), (True, 0.25, 1), (True, 1.0, 1), (True, 2.0, 1), (True, 8.0, 2)]
    with pytest.raises(ValueError, match="overlap"):
        G.trace_rings(G.boundary_edges(df, "k"), "k")


def test_connected(spark):
    from landledger.operators.components import connected

    random.seed(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200 + i, 300 - i) for i in range(50)] + [(random.randrange(400, 460), random.randrange(400, 460)) for _ in range(40)] + [(1, 1)]
    nodes = sorted({n for e in edges for n in e} | {7})
    part = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    got = connected(spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.part for r in got.collect()} == part


def test_large_keys_are_strung_in_blocks(spark, monkeypatch):
    """Edges of a large key are traced block by block: rings over many blocks, rings within one, and none with a row per edge and round."""
    def ring(*points):
        return [dict(zip("xy", map(float, p))) for p in (*points, points[0])]

    def square(x, y):
        return [[ring((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1))]]

    comb = [square(x, y) for x in range(30) for y in range(20) if y == 0 or x % 2 == 0]
    apart = [square(100 + 3 * i % 60, 3 * (i // 20)) for i in range(60)]
    df = spark.createDataFrame([(key, g) for key in ("k", None) for g in comb + apart], f"key string, geom {G.GEOMETRY}")
    edges = G.boundary_edges(df, "key")

    def traced(small):
        return sorted(((r.key, tuple(r.ring_id.a), tuple(r.ring_id.b), r.signed_area, tuple(map(tuple, r.points))) for r in G.trace_rings(edges, "key", small).collect()), key=repr)

    want = traced(20_000)
    written = []
    monkeypatch.setattr(G, "materialize", lambda frame, label="step": written.append((label, kept := materialize(frame, label))) or kept)
    for block in (100_000, 40):
        monkeypatch.setattr(G, "BLOCK_EDGES", block)
        written.clear()
        assert traced(10) == want and len(want) > 60
        rounds = [frame.count() for label, frame in written if label == "rings"]
        assert (len(rounds) > 2 and max(rounds) < edges.count() / 4) if block == 40 else not rounds

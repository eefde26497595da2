"""Polygons made from part and order keys: load, reproject, dissolve."""

from __future__ import annotations

from math import radians, sin

from pyspark.sql import functions as F

from landledger.operators import geo as G
from landledger.plans.registry import query
from landledger.session import materialize

WIDTH = 40


def _parts(t):
    """The parts, dealt to all cores: a few megabytes of keys, else read by one task or two, from which all shapes are made.

    Written, since Spark would move the making of shapes before the shuffle, to filter by it.
    """
    return materialize(t.part.repartition(t.spark.sparkContext.defaultParallelism, "p_partkey"), "parts")


def _squares(t, key: str):
    """One unit square per part on a grid ``WIDTH`` wide, as WKT."""
    x, y = F.col("p_partkey") % WIDTH, F.floor(F.col("p_partkey") / WIDTH)
    wkt = F.format_string("MULTIPOLYGON (((%1$d %2$d, %3$d %2$d, %3$d %4$d, %1$d %4$d, %1$d %2$d)))", x, y, x + 1, y + 1)
    return G.load_polygons(_parts(t).select("p_partkey", F.col(key).alias("parcel_id"), wkt.alias("geom")), srid=26796)


@query("""
    SELECT p_partkey, 26796 AS srid, 3.0::DOUBLE AS area_wkt, 3.0::DOUBLE AS area_geojson, 2 AS n_polygons FROM part""")
def load_polygons(t):
    x, y = F.col("p_partkey") % WIDTH, F.floor(F.col("p_partkey") / WIDTH)
    corner = [x, y, x + 3, y + 3, x + 1, y + 1, x + 2, y + 2]
    shell, hole = "%1$d %2$d, %3$d %2$d, %3$d %4$d, %1$d %4$d, %1$d %2$d", "%5$d %6$d, %7$d %6$d, %7$d %8$d, %5$d %8$d, %5$d %6$d"
    wkt = F.format_string(f"MULTIPOLYGON ((({shell}), ({hole})), ((-4 0, -3 0, -3.0 1e0, -4 1, -4 0)))", *corner)
    ring = "[[%1$d,%2$d],[%3$d,%2$d],[%3$d,%4$d],[%1$d,%4$d],[%1$d,%2$d]]"
    inner = "[[%5$d,%6$d],[%7$d,%6$d],[%7$d,%8$d],[%5$d,%8$d],[%5$d,%6$d]]"
    json = F.format_string('{"type":"Polygon","coordinates":[' + ring + "," + inner + "]}", *corner)
    rows = t.part.select("p_partkey", wkt.alias("wkt"), json.alias("json"))
    loaded = G.load_polygons(G.load_polygons(rows, "wkt", "wkt"), "json", "geojson", 26796)
    return loaded.select(
        "p_partkey", "srid", (G.area("wkt") - 6).alias("area_wkt"), (G.area("json") - 5).alias("area_geojson"),
        F.size("wkt").alias("n_polygons"),
    )


# Published parameters of both planes, apart from the code under test: axes and false easting in metres.
_PLANES = {26796: (6378206.4, 6356583.8, 152400.3048006096), 102696: (6378137.0, 6356752.314140356, 250000.0)}


def _inverse_sql(srid: int) -> str:
    a, b, easting = _PLANES[srid]
    unit, k0, lon0, lat0 = 1200 / 3937, 1 - 1 / 15000, -90.5, radians(35 + 50 / 60)
    e2 = 1 - (b / a) ** 2
    ep2 = e2 / (1 - e2)
    meridian = a * (
        (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * lat0 - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * lat0)
        + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * lat0) - 35 * e2 ** 3 / 3072 * sin(6 * lat0)
    )
    e1 = f"((1 - sqrt(1 - {e2!r})) / (1 + sqrt(1 - {e2!r})))"
    return f"""
    WITH p AS (SELECT o_orderkey, (850000 + o_orderkey % 1000 * 50.0 + o_totalprice / 100) AS x, (980000 + o_custkey * 10.0) AS y FROM orders),
    a AS (SELECT *, (x * {unit!r} - {easting!r}) AS xm,
                 ({meridian!r} + y * {unit!r} / {k0!r})
                   / ({a!r} * (1 - {e2!r} / 4 - 3 * pow({e2!r}, 2) / 64 - 5 * pow({e2!r}, 3) / 256)) AS mu FROM p),
    f AS (SELECT *, mu + (3 * {e1} / 2 - 27 * pow({e1}, 3) / 32) * sin(2 * mu) + (21 * pow({e1}, 2) / 16 - 55 * pow({e1}, 4) / 32) * sin(4 * mu)
                 + (151 * pow({e1}, 3) / 96) * sin(6 * mu) + (1097 * pow({e1}, 4) / 512) * sin(8 * mu) AS phi FROM a),
    r AS (SELECT *, {ep2!r} * cos(phi) * cos(phi) AS c, tan(phi) * tan(phi) AS t, 1 - {e2!r} * sin(phi) * sin(phi) AS w FROM f),
    d AS (SELECT *, {a!r} / sqrt(w) AS n, {a!r} * (1 - {e2!r}) / (w * sqrt(w)) AS m, xm / ({a!r} / sqrt(w) * {k0!r}) AS d FROM r)
    SELECT o_orderkey, 4326 AS srid,
           round({lon0!r} + degrees((d - (1 + 2 * t + c) * d * d * d / 6
              + (5 - 2 * c + 28 * t - 3 * c * c + 8 * {ep2!r} + 24 * t * t) * pow(d, 5) / 120) / cos(phi)), 7) AS lon,
           round(degrees(phi - n * tan(phi) / m * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * {ep2!r}) * pow(d, 4) / 24
              + (61 + 90 * t + 298 * c + 45 * t * t - 252 * {ep2!r} - 3 * c * c) * pow(d, 6) / 720)), 7) AS lat
    FROM d"""


def _reprojected(t, srid: int):
    x = 850000 + F.col("o_orderkey") % 1000 * 50.0 + F.col("o_totalprice") / 100
    y = 980000 + F.col("o_custkey") * 10.0

    def point(dx, dy):
        return F.struct((x + dx).cast("double").alias("x"), (y + dy).cast("double").alias("y"))

    ring = F.array(point(0, 0), point(100, 0), point(0, 100), point(0, 0))
    geometry = G.to_multipolygon(F.array(ring))
    parcel = G.set_srid(t.orders.select("o_orderkey", geometry.alias("geom")), srid)
    first = F.col("geom")[0][0][0]
    return G.reproject(parcel, G.srid_of(parcel)).select("o_orderkey", "srid", F.round(first["x"], 7).alias("lon"), F.round(first["y"], 7).alias("lat"))


@query(_inverse_sql(26796))
def reproject_city(t):
    return _reprojected(t, 26796)


@query(_inverse_sql(102696))
def reproject_county(t):
    return _reprojected(t, 102696)


_CELLS = f"""
    WITH c AS (SELECT p_type AS parcel_id, p_partkey % {WIDTH} AS x, p_partkey // {WIDTH} AS y FROM part),
    touching AS (SELECT a.parcel_id, count(*) AS n FROM c a JOIN c b ON a.parcel_id = b.parcel_id
                 AND ((b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY a.parcel_id)"""


@query(f"""{_CELLS}
    SELECT parcel_id, count(*)::DOUBLE AS area, (4 * count(*) - 2 * coalesce(any_value(n), 0))::BIGINT AS boundary
    FROM c LEFT JOIN touching USING (parcel_id) GROUP BY parcel_id""")
def dissolve_outline(t):
    rings = G.trace_rings(G.boundary_edges(_squares(t, "p_type"), "parcel_id"), "parcel_id")
    return rings.groupBy("parcel_id").agg(
        F.sum("signed_area").alias("area"), F.sum((F.size("points") - 1).cast("bigint")).alias("boundary")
    )


@query("""
    SELECT p_brand || '/' || p_type || '/' || p_partkey // 400 AS parcel_id, count(*)::DOUBLE AS area FROM part GROUP BY 1""")
def dissolve(t):
    return G.dissolve(_blocks(t), "parcel_id").select("parcel_id", G.area("geom").alias("area"))


@query("""
    SELECT p_type AS parcel_id, true AS dissolved, count(*)::DOUBLE AS area FROM part GROUP BY p_type""")
def dissolve_polygons(t):
    polygons = G.dissolve_polygons(_squares(t, "p_type").select("parcel_id", "geom"), "parcel_id")
    return polygons.groupBy("parcel_id", "dissolved").agg(F.sum(G.area(G.to_multipolygon("polygon"))).alias("area"))


@query(f"""{_CELLS}
    SELECT parcel_id, true AS dissolved, count(*)::DOUBLE AS area, (4 * count(*) - 2 * coalesce(any_value(n), 0))::BIGINT AS corners
    FROM c LEFT JOIN touching USING (parcel_id) GROUP BY parcel_id
    UNION ALL SELECT DISTINCT parcel_id, false, 6.0, 8 FROM c""")
def dissolve_parts(t):
    """Every key has two shapes that overlap, apart from its squares: those stay, and the squares are dissolved all the same."""
    def box(x, y, width, height):
        corners = [(x, y), (x + width, y), (x + width, y + height), (x, y + height), (x, y)]
        return F.array(F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in corners]))

    squares = _squares(t, "p_type").select("parcel_id", "geom")
    overlapping = F.explode(F.array(F.array(box(-9, 0, 2, 2)), F.array(box(-9, 0, 1, 2)))).alias("geom")
    polygons = G.dissolve_polygons(squares.unionByName(squares.select("parcel_id").distinct().select("parcel_id", overlapping)), "parcel_id")
    corners = F.sum(F.aggregate("polygon", F.lit(0).cast("bigint"), lambda n, ring: n + F.size(ring) - 1))
    return polygons.groupBy("parcel_id", "dissolved").agg(F.sum(G.area(G.to_multipolygon("polygon"))).alias("area"), corners.alias("corners"))


_FRAMES = f"""
    WITH s AS (SELECT p_type AS parcel_id, p_partkey % {WIDTH} AS x, p_partkey // {WIDTH} AS y, p_size % 3 AS kind FROM part)"""


@query(f"""{_FRAMES}
    SELECT parcel_id, count(*)::BIGINT AS n_polygons, sum(CASE kind WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END)::BIGINT AS n_holes,
           sum(CASE kind WHEN 0 THEN 4 WHEN 1 THEN 8 ELSE 12 END)::BIGINT AS corners,
           sum(CASE kind WHEN 0 THEN 64.0 WHEN 1 THEN 48.0 ELSE 56.0 END)::DOUBLE AS area,
           min(10 * x)::DOUBLE AS x_low, max(10 * x + 8)::DOUBLE AS x_high, min(10 * y)::DOUBLE AS y_low, max(10 * y + 8)::DOUBLE AS y_high
    FROM s GROUP BY parcel_id
    UNION ALL SELECT 'all', count(*), sum(kind)::BIGINT, sum(4 + 4 * kind)::BIGINT, sum(CASE kind WHEN 0 THEN 64.0 WHEN 1 THEN 48.0 ELSE 56.0 END),
           min(10 * x), max(10 * x + 8), min(10 * y), max(10 * y + 8) FROM s""")
def dissolve_holes(t):
    """Two halves of each part's square, with no hole, one, or two that touch in a corner; per type, and all of them under one key."""
    x, y = F.col("x"), F.col("y")

    def ring(*points):
        return F.array(*[F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y")) for a, b in [*points, points[0]]])

    # The halves meet in the middle, at x = 4; their inner corners stand on it, so that they share vertices.
    wholes = {
        0: [[(0, 0), (4, 0), (4, 8), (0, 8)], [(4, 0), (8, 0), (8, 8), (4, 8)]],
        1: [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 6), (4, 6), (4, 8), (0, 8)], [(4, 0), (8, 0), (8, 8), (4, 8), (4, 6), (6, 6), (6, 2), (4, 2)]],
        2: [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (4, 4), (4, 6), (4, 8), (0, 8)], [(4, 0), (8, 0), (8, 8), (4, 8), (4, 6), (6, 6), (6, 4), (4, 4), (4, 2)]],
    }
    base = _parts(t).select("p_type", (F.col("p_partkey") % WIDTH * 10).alias("x"), (F.floor(F.col("p_partkey") / WIDTH) * 10).alias("y"), (F.col("p_size") % 3).alias("kind"))
    halves = F.explode(F.array(*[
        F.when(F.col("kind") == 0, ring(*wholes[0][i])).when(F.col("kind") == 1, ring(*wholes[1][i])).otherwise(ring(*wholes[2][i])) for i in (0, 1)
    ])).alias("ring")
    rows = base.select(F.explode(F.array("p_type", F.lit("all"))).alias("parcel_id"), "x", "y", "kind").select("parcel_id", halves)
    polygons = G.dissolve_polygons(rows.select("parcel_id", F.array(F.array("ring")).alias("geom")), "parcel_id")
    straight = G.without_straight_corners("polygon")
    points = F.flatten("polygon")
    low, high = (lambda axis: F.min(F.array_min(F.transform(points, lambda p: p[axis])))), (lambda axis: F.max(F.array_max(F.transform(points, lambda p: p[axis]))))
    return polygons.where("dissolved").groupBy("parcel_id").agg(
        F.count(F.lit(1)).alias("n_polygons"), F.sum((F.size("polygon") - 1).cast("bigint")).alias("n_holes"),
        F.sum(F.aggregate(straight, F.lit(0).cast("bigint"), lambda n, r: n + F.size(r) - 1)).alias("corners"),
        F.sum(G.area(G.to_multipolygon("polygon"))).alias("area"),
        low("x").alias("x_low"), high("x").alias("x_high"), low("y").alias("y_low"), high("y").alias("y_high"),
    )


def _blocks(t):
    """The squares keyed by brand, type and block: some keys repeat, some do not."""
    squares = _squares(t, "p_type").withColumn("block", F.floor(F.col("p_partkey") / 400).cast("string"))
    return squares.join(t.part.select("p_partkey", "p_brand"), "p_partkey").select(
        F.concat_ws("/", "p_brand", "parcel_id", "block").alias("parcel_id"), "geom"
    )

"""Polygons as nested arrays: load, SRID, reprojection, dissolve.

A geometry is ``array<polygon>``, a polygon ``array<ring>`` (shell first, then holes), a ring a
closed ``array<struct<x,y>>``; its ``srid`` is a column beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landledger.functions.projection import CRS, to_degrees
from landledger.operators.components import connected
from landledger.session import discard, materialize, settled

# Edges of large keys that one task strings together.
BLOCK_EDGES = 100_000
# Rows that a task sorts at most, about; tasks grow in number, not in memory.
TASK_ROWS = 500_000
GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"
_POINT = r"([-+0-9.eE]+)\s+([-+0-9.eE]+)(\s+[-+0-9.eE]+)*"


# --- loading -------------------------------------------------------------------------------------

def _points(coordinates: Column) -> Column:
    def point(p: Column) -> Column:
        return F.struct(p[0].alias("x"), p[1].alias("y"))

    return F.transform(coordinates, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, point)))


def _from_coordinates(text: Column, is_multi: Column) -> Column:
    wrapped = F.when(is_multi, text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return _points(F.from_json(wrapped, "array<array<array<array<double>>>>"))


def from_geojson(text: Column | str) -> Column:
    """Polygon or MultiPolygon text to a geometry; a polygon becomes a one-element multipolygon."""
    text = F.col(text) if isinstance(text, str) else text
    kind = F.get_json_object(text, "$.type")
    shape = _from_coordinates(F.get_json_object(text, "$.coordinates"), kind == "MultiPolygon")
    return F.when(kind.isin("Polygon", "MultiPolygon"), shape)


def from_wkt(text: Column | str) -> Column:
    text = F.upper(F.trim(F.col(text) if isinstance(text, str) else text))
    body = F.regexp_replace(text, r"^(MULTI)?POLYGON\s*(Z|M|ZM)?\s*", "")
    numbers = F.regexp_replace(body, _POINT, "[$1,$2]")
    json = F.translate(numbers, "()", "[]")
    shape = _from_coordinates(json, text.startswith("MULTI"))
    return F.when(text.rlike("^(MULTI)?POLYGON"), shape)


def load_polygons(df: DataFrame, column: str = "geom", fmt: str = "wkt", srid: int = 4326) -> DataFrame:
    """Text geometries to nested arrays with a declared SRID."""
    parse = {"wkt": from_wkt, "geojson": from_geojson}[fmt]
    return df.withColumns({column: parse(column), "srid": F.lit(srid)})


def to_multipolygon(polygon: Column | str) -> Column:
    """A single polygon (array of rings) as a one-element multipolygon."""
    return F.array(F.col(polygon) if isinstance(polygon, str) else polygon)


# --- reference systems ---------------------------------------------------------------------------

def set_srid(df: DataFrame, srid: int) -> DataFrame:
    """Declare another SRID; coordinates stay."""
    return df.withColumn("srid", F.lit(srid))


def srid_of(df: DataFrame) -> int:
    """The one SRID of a table; raises when it has none or several."""
    found = [row["srid"] for row in df.select("srid").distinct().limit(2).collect()]
    if len(found) != 1 or found[0] is None:
        raise ValueError(f"expected one SRID, found {found}")
    return found[0]


def _map_points(geometry: pa.Array, convert) -> pa.Array:
    """Apply ``convert(x, y)`` to all points of an Arrow geometry column at once, nesting unchanged."""
    if pa.types.is_struct(geometry.type):
        x, y = (geometry.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        return pa.StructArray.from_arrays([pa.array(v, pa.float64()) for v in convert(x, y)], fields=list(geometry.type))
    inner = geometry.values.slice(geometry.offsets[0].as_py(), geometry.offsets[-1].as_py() - geometry.offsets[0].as_py())
    offsets = pc.subtract(geometry.offsets, geometry.offsets[0])
    return pa.ListArray.from_arrays(offsets, _map_points(inner, convert), type=geometry.type, mask=geometry.is_null())


def reproject(df: DataFrame, srid: int, column: str = "geom",
              shift: tuple[float, float, float] | None = None) -> DataFrame:
    """Coordinates from ``srid`` to degrees (SRID 4326), whole Arrow batches at a time.

    Spark evaluates lambdas over nested arrays point by point without code generation; one NumPy call
    per batch is many times faster and needs no shuffle either.

    Without ``shift`` the datum is taken as is; the 1927 datum then is off by tens of metres, and by
    about ten with the mean shift ``projection.CONUS_1927_SHIFT``. No grid shift is applied.
    """
    if srid not in CRS:
        raise ValueError(f"no transform from SRID {srid}; known: {sorted(CRS)}")
    convert = partial(to_degrees, srid, shift)

    @F.arrow_udf(GEOMETRY)
    def moved(geometry: pa.Array) -> pa.Array:
        return _map_points(geometry, convert)

    return df.withColumns({column: moved(column), "srid": F.lit(4326)})


# --- measures ------------------------------------------------------------------------------------

def _signed_area(ring: Column) -> Column:
    """Shoelace over consecutive points; positive when counter-clockwise."""
    n = F.size(ring)
    pairs = F.zip_with(
        F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda p, q: p["x"] * q["y"] - q["x"] * p["y"],
    )
    return F.aggregate(pairs, F.lit(0.0), lambda total, v: total + v) / 2


def area(geometry: Column | str) -> Column:
    """Shell areas minus hole areas."""
    geometry = F.col(geometry) if isinstance(geometry, str) else geometry

    def polygon_area(polygon: Column) -> Column:
        signed = F.transform(polygon, lambda ring, i: F.abs(_signed_area(ring)) * F.when(i == 0, 1.0).otherwise(-1.0))
        return F.aggregate(signed, F.lit(0.0), lambda total, v: total + v)

    return F.aggregate(F.transform(geometry, polygon_area), F.lit(0.0), lambda total, v: total + v)


def without_straight_corners(polygon: Column | str) -> Column:
    """The rings of a polygon less the points on a straight line between their neighbours; the shape is the same."""
    polygon = F.col(polygon) if isinstance(polygon, str) else polygon

    def bent(ring: Column) -> Column:
        n = F.size(ring) - 1

        def turns(p: Column, i: Column) -> Column:
            before, after = ring[F.pmod(i - 1 + n, n)], ring[F.pmod(i + 1, n)]
            return (p["x"] - before["x"]) * (after["y"] - p["y"]) != (p["y"] - before["y"]) * (after["x"] - p["x"])

        kept = F.filter(F.slice(ring, F.lit(1), n), turns)
        return F.concat(kept, F.slice(kept, 1, 1))

    return F.transform(polygon, bent)


# --- dissolve ------------------------------------------------------------------------------------

def boundary_edges(df: DataFrame, key: str, column: str = "geom") -> DataFrame:
    """Directed edges on the outline of each key's union, interior to the left.

    Shells run counter-clockwise, holes clockwise. Copies of an edge count once, and an edge met from
    both sides is interior. Exact when neighbours share vertices or shapes are identical; partial
    overlaps are not resolved.
    """
    rings = (
        df.select(key, F.explode(column).alias("polygon"))
        .select(key, F.posexplode("polygon").alias("i", "ring"))
        .withColumn("_area", _signed_area(F.col("ring")))
        .withColumn("ring", F.when((F.col("_area") < 0) == (F.col("i") == 0), F.reverse("ring")).otherwise(F.col("ring")))
    )
    n = F.size("ring") - 1
    pair = F.explode(F.arrays_zip(F.slice("ring", F.lit(1), n).alias("a"), F.slice("ring", F.lit(2), n).alias("b")))
    edges = rings.where(F.size("ring") > 1).select(key, pair.alias("e"))
    a, b = F.col("e")["a"], F.col("e")["b"]
    low, high = F.least(a, b), F.greatest(a, b)
    sided = edges.where(a != b).select(
        key, low["x"].alias("x0"), low["y"].alias("y0"), high["x"].alias("x1"), high["y"].alias("y1"),
        (a == low).cast("int").alias("forward"),
    )
    kept = (
        sided.groupBy(key, "x0", "y0", "x1", "y1")
        .agg(F.max("forward").alias("f"), F.max(1 - F.col("forward")).alias("b"))
        .where("f <> b")
    )
    start, end = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    forward = F.col("f") == 1
    return kept.select(
        key, F.when(forward, start).otherwise(end).alias("a"), F.when(forward, end).otherwise(start).alias("b")
    )


def _dealt(df: DataFrame, rows: int, *columns: str, always: bool = False) -> DataFrame:
    """``df`` of about ``rows`` rows, by ``columns`` on tasks of ``TASK_ROWS`` each; as Spark deals it out where its cores do for that.

    With ``always`` it is dealt out here in any case, so that what is worked out next for a window is not sent along.
    """
    parts = -(-rows // TASK_ROWS)
    if parts > df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(parts, *columns)
    return df.repartition(*columns) if always else df


def _successors(edges: DataFrame, key: str) -> DataFrame:
    """For each edge the one that follows it: at its end, the first outgoing edge clockwise.

    ``torn`` marks a corner where the next edge clockwise arrives too: shapes overlap there. Windows
    hold the edges at one vertex, a handful of rows.
    """
    edges = materialize(edges, "outline-edges")
    # An end is its vertex, the edge's other vertex, and whether the edge arrives; the rest is worked out where the ends of a vertex meet.
    # The hash bears on the dealing out only; Spark would send them once more for a window by numbers with a point.
    corner = [F.col("v")["x"].alias("vx"), F.col("v")["y"].alias("vy"), F.col("o")["x"].alias("ox"), F.col("o")["y"].alias("oy")]
    ends = edges.select(key, F.col("b").alias("v"), F.col("a").alias("o"), F.lit(True).alias("arrives")).unionByName(
        edges.select(key, F.col("a").alias("v"), F.col("b").alias("o"), F.lit(False).alias("arrives"))).select(key, *corner, "arrives")
    ends = ends.withColumn("place", F.pmod(F.hash("vx", "vy"), F.lit(1 << 16)))
    at = [key, "place", "vx", "vy"]
    met = _dealt(ends, 2 * edges.count(), key, "place", always=True)
    angle = F.atan2(F.col("oy") - F.col("vy"), F.col("ox") - F.col("vx"))
    around = Window.partitionBy(*at).orderBy(F.desc("angle"), F.desc("arrives"))
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    end = F.struct("ox", "oy", "arrives")
    following = F.coalesce(F.lead(end).over(around), F.first(end).over(whole))
    rows = met.withColumn("angle", angle).withColumn("_next", following).where("arrives")
    v, o, beyond = (F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("vx", "vy"), ("ox", "oy"), ("_next.ox", "_next.oy")))
    ahead = F.struct(F.when(F.col("_next.arrives"), beyond).otherwise(v).alias("a"), F.when(F.col("_next.arrives"), v).otherwise(beyond).alias("b"))
    return rows.select(key, F.struct(o.alias("a"), v.alias("b")).alias("edge"), ahead.alias("next"), F.col("_next.arrives").alias("torn"))


def trace_rings(edges: DataFrame, key: str, small: int = 20_000) -> DataFrame:
    """Closed rings from directed edges: (key, ring_id, points, signed_area). Overlaps raise."""
    follows = settled(lambda: _successors(edges, key), "edges")
    torn = follows.where("torn").select(key).head(1)
    if torn:
        raise ValueError(f"shapes overlap, e.g. of {torn}")
    return _trace(follows, key, small)


def _trace(follows: DataFrame, key: str, small: int = 20_000) -> DataFrame:
    """Rings of materialized successors. None meets itself: one that does is cut there, so holes that touch are two rings.

    A key with at most ``small`` edges is stitched within one task, after a single shuffle. Larger
    keys, of any size, go through ``_trace_large``.
    """
    counted = follows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    large = counted.where(F.col("_n") > small).select(F.col(key).alias("_key"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    if large.isEmpty():
        traced = _trace_small(follows, key)
    else:
        large = materialize(large.withColumn("_id", F.monotonically_increasing_id()), "large")
        traced = _trace_small(follows.join(large, same, "left_anti"), key).unionByName(
            _trace_large(follows.join(large, same).select("_id", "edge", "next")).join(large, "_id").select(F.col("_key").alias(key), "points")
        )
    loops = F.arrow_udf(_loops, "array<array<struct<x:double,y:double>>>")
    simple = traced.select(key, F.explode(loops("points")).alias("points"))
    return simple.withColumns({
        "ring_id": F.struct(F.col("points")[0].alias("a"), F.col("points")[1].alias("b")),
        "signed_area": _signed_area(F.col("points")),
    }).select(key, "ring_id", "points", "signed_area")


def _trace_small(follows: DataFrame, key: str) -> DataFrame:
    """Rings of keys small enough for one task each: (key, points). Keys share Arrow batches."""
    corner = F.struct("edge.a.x", "edge.a.y", F.col("edge.b.x").alias("x2"), F.col("edge.b.y").alias("y2"),
                      F.col("next.b.x").alias("x3"), F.col("next.b.y").alias("y3"))
    rings = F.arrow_udf(_stitch, "array<array<struct<x:double,y:double>>>")
    corners = follows.groupBy(key).agg(F.array_sort(F.collect_list(corner)).alias("corners"))
    return corners.select(key, rings("corners").alias("rings")).select(key, F.explode("rings").alias("points"))


def _stitch(corners: pa.Array) -> pa.Array:
    """Per row, edges with their follow-up points (sorted) to closed rings, each from its smallest edge."""
    x, y, x2, y2, x3, y3 = (corners.values.field(i).to_numpy(zero_copy_only=False).tolist() for i in range(6))
    points_x, points_y, ring_ends, row_ends = [], [], [0], [0]
    bounds = corners.offsets.to_pylist()
    for low, high in zip(bounds, bounds[1:]):
        ahead = {(x[i], y[i], x2[i], y2[i]): (x2[i], y2[i], x3[i], y3[i]) for i in range(low, high)}
        for edge in list(ahead):
            if edge not in ahead:
                continue
            first = edge
            while edge in ahead:
                points_x.append(edge[0])
                points_y.append(edge[1])
                edge = ahead.pop(edge)
            points_x.append(first[0])
            points_y.append(first[1])
            ring_ends.append(len(points_x))
        row_ends.append(len(ring_ends) - 1)
    points = pa.StructArray.from_arrays([pa.array(points_x, pa.float64()), pa.array(points_y, pa.float64())], names=["x", "y"])
    rings = pa.ListArray.from_arrays(pa.array(ring_ends, pa.int32()), points)
    return pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), rings)


def _loops(rings: pa.Array) -> pa.Array:
    """Per closed ring the loops that it is made of, none of which meets a point twice, each from its smallest point."""
    points = rings.flatten()
    x, y = (points.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(rings).to_numpy(zero_copy_only=False))])
    taken, sizes, per_row = [np.zeros(0, np.int64)], [], []
    for low, high in zip(bounds, bounds[1:]):
        _, names = np.unique(x[low:high - 1] + 1j * y[low:high - 1], return_inverse=True)
        loops = [np.arange(high - 1 - low)]
        if names.max(initial=-1) + 1 < len(names):
            loops, path, at = [], [], {}
            for n, name in enumerate(names.tolist()):
                if name in at:
                    start = at[name]
                    loops.append(np.array(path[start:]))
                    for gone in path[start:]:
                        del at[names[gone]]
                    del path[start:]
                at[name] = len(path)
                path.append(n)
            loops.append(np.array(path))
        for loop in loops:
            loop = np.roll(loop, -int(np.argmin(names[loop]))) if len(loop) else loop
            taken.append(low + np.append(loop, loop[:1]))
            sizes.append(len(loop) + 1)
        per_row.append(len(loops))
    inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), points.take(pa.array(np.concatenate(taken), pa.int64())))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()), inner)


def _trace_large(follows: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Rings of numbered keys of any size: (_id, points).

    Edges that lie together are strung to chains first, a block of ``BLOCK_EDGES`` of them in a task. Most rings close there. The others are
    one chain for each block that they pass, and those few rows are put in order by pointer doubling: in each round a chain learns the
    smallest chain, and its distance, within twice the previous reach, and jumps twice as far; n chains in a ring need about log2(n) rounds.
    Neither a large ring nor a large key burdens one task until a ring's points are put into its array.
    """
    a, b, c = F.col("edge.a"), F.col("edge.b"), F.col("next.b")
    key, flat = "_id", follows.select("_id", a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"), c["x"].alias("cx"), c["y"].alias("cy"))
    bounds = flat.groupBy("_id").agg(F.min("ax").alias("x0"), F.min("ay").alias("y0"), F.max("ax").alias("x1"), F.max("ay").alias("y1"), F.count(F.lit(1)).alias("n"))
    # Strips of each key's box, cut across their length by the ranges below: blocks about as wide as they are high.
    blocks, wide, high = F.col("n") / BLOCK_EDGES, F.col("x1") - F.col("x0"), F.greatest(F.col("y1") - F.col("y0"), F.lit(1e-12))
    strips = materialize(bounds.select(F.col("_id").alias("of"), "n", "x0", (wide / F.least(F.greatest(F.ceil(F.sqrt(blocks * wide / high)), F.lit(1)), F.ceil(blocks))).alias("strip")), "strips")
    total = strips.agg(F.sum("n")).head()[0] or 0
    placed = flat.join(strips.select("of", "x0", "strip"), F.col("_id") == F.col("of")).withColumn("strip", F.floor((F.col("ax") - F.col("x0")) / F.nullif("strip", F.lit(0.0))))
    ranged = placed.repartitionByRange(max(1, -(-total // BLOCK_EDGES)), "_id", "strip", "ay", "ax").select(*flat.columns)
    strung = materialize(ranged.mapInArrow(_chains, "_id long, edge struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>, next struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>, points array<struct<x:double,y:double>>"), "chains")
    whole = strung.where("next is null").select("_id", "points")
    chains = strung.where("next is not null")
    if chains.isEmpty():
        return whole
    state = chains.select(key, "edge", "next", F.col("edge").alias("head"), F.lit(0).cast("bigint").alias("hops"))
    reach = 1
    for _ in range(max_rounds):
        ahead = state.select(
            F.col(key).alias("_key"), F.col("edge").alias("_edge"), F.col("next").alias("_next"),
            F.col("head").alias("_head"), F.col("hops").alias("_hops"),
        )
        better = F.col("_head") < F.col("head")
        state = materialize(
            state.join(ahead, F.col(key).eqNullSafe(F.col("_key")) & (F.col("next") == F.col("_edge"))).select(
                key, "edge", F.col("_next").alias("next"), F.least("head", "_head").alias("head"),
                F.when(better, F.col("_hops") + reach).otherwise(F.col("hops")).alias("hops"), better.alias("changed"),
            ),
            "rings",
        )
        reach *= 2
        if state.where("changed").isEmpty():
            break
        state = state.drop("changed")
    else:
        raise RuntimeError("rings did not close; the edges are not a union outline")
    # Hops count down to the head, which comes first.
    place = F.when(F.col("hops") == 0, F.lit(-(2**62))).otherwise(-F.col("hops"))
    parts = state.select(key, "edge", "head", place.alias("place")).join(chains.select(key, "edge", "points"), [key, "edge"])
    rings = parts.groupBy(key, "head").agg(F.array_sort(F.collect_list(F.struct("place", "points"))).alias("sorted"))
    closed = F.arrow_udf(_closed, "array<struct<x:double,y:double>>")
    return whole.unionByName(rings.select(key, closed(F.flatten(F.transform("sorted", lambda item: item["points"]))).alias("points")))


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's edges with their follow-up points, the closed rings, each from its smallest edge, and the chains that lead out of the task.

    A ring has its first point again at its end and no ``next``. A chain has the points its edges begin at, and ``next``, the edge beyond it.
    """
    found = [batch for batch in batches if batch.num_rows]
    if not found:
        return
    rows = pa.Table.from_batches(found)
    columns = [rows.column(i).to_numpy() for i in range(7)]
    order = np.lexsort(columns[4::-1])
    of, ax, ay, bx, by, cx, cy = (values[order].tolist() for values in columns)
    at = {edge: i for i, edge in enumerate(zip(of, ax, ay, bx, by))}
    ahead = [at.get(edge, -1) for edge in zip(of, bx, by, cx, cy)]
    led = np.zeros(len(of), bool)
    led[[i for i in ahead if i >= 0]] = True
    taken, ends, first, last = [], [0], [], []
    done = [False] * len(of)
    for start in [*np.flatnonzero(~led).tolist(), *range(len(of))]:
        if done[start]:
            continue
        i = start
        while i >= 0 and not done[i]:
            done[i], end = True, i
            taken.append(i)
            i = ahead[i]
        if i >= 0:
            taken.append(start)
        first.append(start)
        last.append(end if i < 0 else -1)
        ends.append(len(taken))

    def points(x: list, y: list, some) -> pa.StructArray:
        return pa.StructArray.from_arrays([pa.array(np.array(v)[some], pa.float64()) for v in (x, y)], names=["x", "y"])

    first, last = np.array(first), np.array(last)
    edge = pa.StructArray.from_arrays([points(ax, ay, first), points(bx, by, first)], names=["a", "b"])
    beyond = pa.StructArray.from_arrays([points(bx, by, last), points(cx, cy, last)], names=["a", "b"], mask=pa.array(last < 0))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), points(ax, ay, np.array(taken)))
    yield pa.RecordBatch.from_arrays([pa.array(np.array(of)[first], pa.int64()), edge, beyond, lists], names=["_id", "edge", "next", "points"])


def _closed(rings: pa.Array) -> pa.Array:
    """Open rings, each turned to begin with its smallest edge, and closed."""
    points = rings.flatten()
    x, y = (points.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(rings).to_numpy(zero_copy_only=False))])
    taken = [np.zeros(0, np.int64)]
    for low, high in zip(ends, ends[1:]):
        u, v = x[low:high], y[low:high]
        least = int(np.lexsort((np.roll(v, -1), np.roll(u, -1), v, u))[0])
        taken.append(low + np.append(np.roll(np.arange(high - low), -least), least))
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in taken[1:]])])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), points.take(pa.array(np.concatenate(taken), pa.int64())))


def _numbered(rings: DataFrame) -> DataFrame:
    """``rings`` with a number for each; they are written before it is read."""
    return rings.withColumn("ring", F.monotonically_increasing_id())


def _hole_shells(rings: DataFrame, key: str) -> DataFrame:
    """(hole, shell): the number of the smallest shell around each hole, by the holes' numbers.

    The box of a key's shells is cut into about as many cells as they have points. Each cell has a reference point, halfway up its
    left side. Which shells hold it follows from the crossings of the middle line of the cell's row: their parity per column,
    summed along the row. From there a path leads up or down the side and then across to the hole's first edge, and passes edges of that
    cell only. So a hole meets the shells that hold its cell and the edges of its cell, wherever the other edges of its height are.
    """
    # The middle of an edge, not a corner: a shell may touch the hole there.
    first = [(F.col(f"ring_id.a.{axis}") + F.col(f"ring_id.b.{axis}")) / 2 for axis in "xy"]
    holes = rings.where("signed_area < 0").select(
        F.col(key).alias("_key"), F.col("ring").alias("hole"), first[0].alias("hx"), first[1].alias("hy"))
    # Only keys with holes take part. What has a row per key is written, so that joins by key, however few there are, need no shuffle by it.
    shells = rings.where("signed_area > 0").select(F.col(key).alias("of"), F.col("ring").alias("shell"), "signed_area", "points").join(
        materialize(holes.select("_key").distinct(), "hole-keys"), F.col("of").eqNullSafe(F.col("_key")), "left_semi")

    def ends(axis: str) -> list[Column]:
        along = F.transform("points", lambda p: p[axis])
        return [F.min(F.array_min(along)).alias(f"{axis}_low"), F.max(F.array_max(along)).alias(f"{axis}_high")]

    bounds = shells.groupBy("of").agg(*ends("x"), *ends("y"), F.sum(F.size("points")).alias("n"))
    # The grid begins off the corner by an odd fraction of a cell, so that its lines do not run along those of regular shapes.
    side = F.sqrt(F.col("n").cast("double"))
    grid = materialize(bounds.select(F.col("of").alias("grid_of"), F.monotonically_increasing_id().alias("grid"), "n", *[
        c for axis in "xy" for size in [F.greatest((F.col(f"{axis}_high") - F.col(f"{axis}_low")) / side, F.lit(1e-12))]
        for c in (size.alias(f"d{axis}"), (F.col(f"{axis}_low") - size * 0.3819660112501051).alias(f"{axis}0"))
    ]), "hole-grid")

    def cell(value: Column, axis: str) -> Column:
        return F.floor((value - F.col(f"{axis}0")) / F.col(f"d{axis}"))

    n = F.size("points") - 1
    edges = shells.select(
        "of", "shell", "signed_area", F.explode(F.arrays_zip(F.slice("points", F.lit(1), n).alias("p"), F.slice("points", F.lit(2), n).alias("q"))).alias("e"),
    ).select("of", "shell", "signed_area", *[F.col(f"e.{end}.{axis}").alias(f"{end}{axis}") for end in "pq" for axis in "xy"])
    edges = edges.join(grid.drop("n"), F.col("of").eqNullSafe(F.col("grid_of"))).drop("grid_of", "of")
    total = grid.agg(F.sum("n")).head()[0] or 0
    low, high = F.least("py", "qy"), F.greatest("py", "qy")

    def x_at(y: Column) -> Column:
        return F.col("px") + (y - F.col("py")) * (F.col("qx") - F.col("px")) / F.nullif(F.col("qy") - F.col("py"), F.lit(0.0))

    def y_at(x: Column) -> Column:
        return F.col("py") + (x - F.col("px")) * (F.col("qy") - F.col("py")) / F.nullif(F.col("qx") - F.col("px"), F.lit(0.0))

    by_row = edges.withColumn("row", F.explode(F.sequence(cell(low, "y"), cell(high, "y"))))
    bottom = F.col("y0") + F.col("row") * F.col("dy")
    middle = bottom + F.col("dy") / 2
    # Half-open edges count a crossing at a corner once. Crossings of one column cancel in pairs; the others bound the insides.
    odd = (
        by_row.where((low <= middle) & (middle < high)).select("grid", "shell", "signed_area", "row", cell(x_at(middle), "x").alias("col"))
        .groupBy("grid", "shell", "signed_area", "row", "col").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    )
    along = Window.partitionBy("grid", "shell", "row").orderBy("col")
    inside = (
        odd.withColumns({"nth": F.row_number().over(along), "last": F.lead("col").over(along)}).where("nth % 2 = 1")
        .select("grid", "shell", "signed_area", "row", F.explode(F.sequence(F.col("col") + 1, F.col("last"))).alias("col"))
    )
    # Columns that an edge passes in a row, a little wider, for rounding; the path decides what counts.
    spare = F.col("dx") * 1e-6
    ya, yb = F.greatest(low, F.least(bottom, high)), F.least(high, F.greatest(bottom + F.col("dy"), low))
    xa, xb = F.coalesce(x_at(ya), F.col("px")), F.coalesce(x_at(yb), F.col("qx"))
    passed = by_row.withColumn("col", F.explode(F.sequence(cell(F.least(xa, xb) - spare, "x"), cell(F.greatest(xa, xb) + spare, "x"))))
    # Holes and edges meet by cell, in as many tasks as the edges ask for. Rings go by number, and the holes bring what belongs to their grid.
    at = ["grid", "row", "col"]
    placed = _dealt(holes.join(grid, F.col("_key").eqNullSafe(F.col("grid_of"))).select(
        "hole", "hx", "hy", "grid", "x0", "y0", "dx", "dy", cell(F.col("hy"), "y").alias("row"), cell(F.col("hx"), "x").alias("col")), 3 * total, *at)
    inside, passed = _dealt(inside, 3 * total, *at), _dealt(passed.drop("x0", "y0", "dx", "dy"), 3 * total, *at)
    left = F.col("x0") + F.col("col") * F.col("dx")
    up = (F.least("px", "qx") < left) & (left <= F.greatest("px", "qx")) & ((y_at(left) > middle) != (y_at(left) > F.col("hy")))
    across = (low <= F.col("hy")) & (F.col("hy") < high) & (x_at(F.col("hy")) >= left) & (x_at(F.col("hy")) < F.col("hx"))
    crossed = F.coalesce(up, F.lit(False)).cast("int") + F.coalesce(across, F.lit(False)).cast("int")
    met = inside.join(placed, at).select("hole", "shell", "signed_area", F.lit(1).alias("n")).unionByName(
        passed.join(placed, at).select("hole", "shell", "signed_area", crossed.alias("n")))
    around = met.groupBy("hole", "shell", "signed_area").agg(F.sum("n").alias("n")).where("n % 2 = 1")
    return around.groupBy("hole").agg(F.min_by("shell", "signed_area").alias("shell"))


def _hole_parents(rings: DataFrame, key: str) -> DataFrame:
    """(key, hole_id, shell_id): ``_hole_shells`` of rings without numbers, by their ids."""
    numbered = materialize(_numbered(rings), "numbered-rings")
    found = settled(lambda: _hole_shells(numbered, key), "hole-shells")
    holes = numbered.select(key, F.col("ring").alias("hole"), F.col("ring_id").alias("hole_id"))
    shells = numbered.select(F.col("ring").alias("shell"), F.col("ring_id").alias("shell_id"))
    return found.join(holes, "hole").join(shells, "shell").select(key, "hole_id", "shell_id")


def _polygons(rings: DataFrame, key: str) -> DataFrame:
    """Numbered rings to polygons, each shell with its holes: (key, polygon)."""
    owners = rings.where("signed_area > 0").select(
        key, F.col("ring").alias("shell"), F.struct(F.lit(0).alias("o"), "ring_id", "points").alias("r")
    )
    parents = settled(lambda: _hole_shells(rings, key), "hole-shells")
    held = (
        rings.where("signed_area < 0")
        .join(parents, F.col("ring") == F.col("hole"))
        .select(key, "shell", F.struct(F.lit(1).alias("o"), "ring_id", "points").alias("r"))
    )
    sorted_rings = F.array_sort(F.collect_list("r"))
    return (
        owners.unionByName(held)
        .groupBy(key, "shell")
        .agg(F.transform(sorted_rings, lambda r: r["points"]).alias("polygon"))
        .drop("shell")
    )


def dissolve(df: DataFrame, key: str, column: str = "geom", small: int = 20_000) -> DataFrame:
    """Union per key, one row per key with its multipolygon: (key, geom, dissolved).

    Keys with a single row keep their geometry untouched; only repeated keys are traced. Where shapes
    overlap at an edge or corner no outline can be traced: the shapes that hang together there by shared
    vertices stay side by side as distinct polygons, and ``dissolved`` is false; the other parts of the key
    are dissolved. Keys whose shapes are all null or empty get a null geometry.
    """
    alone, repeated, polygons = _dissolved(df, key, column, small)
    united = polygons.groupBy(key).agg(F.array_sort(F.collect_list("polygon")).alias(column), F.bool_and("dissolved").alias("dissolved"))
    return alone.withColumn("dissolved", F.lit(True)).unionByName(
        repeated.join(united, F.col(key).eqNullSafe(F.col("_key")), "left").select(
            F.col("_key").alias(key), column, F.coalesce("dissolved", F.lit(True)).alias("dissolved")
        )
    )


def dissolve_polygons(df: DataFrame, key: str, column: str = "geom", small: int = 20_000) -> DataFrame:
    """``dissolve`` with one row per polygon: (key, polygon, dissolved).

    For keys whose union is too large for one row.
    """
    alone, _, polygons = _dissolved(df, key, column, small)
    return alone.select(key, F.explode(column).alias("polygon"), F.lit(True).alias("dissolved")).unionByName(polygons)


def _dissolved(df: DataFrame, key: str, column: str, small: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of single keys, the repeated keys as ``_key``, and the polygons of the repeated keys."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(key).alias("_key"))
    repeated = materialize(repeated, "repeated")
    same = F.col(key).eqNullSafe(F.col("_key"))
    alone = df.join(repeated, same, "left_anti").select(key, column)
    several = df.join(repeated, same, "left_semi").select(key, column)
    follows = settled(lambda: _successors(boundary_edges(several, key, column), key), "edges")
    torn = materialize(follows.where("torn").select(F.col(key).alias("_key")).distinct(), "torn")
    rings = settled(lambda: _numbered(_trace(follows.join(torn, same, "left_anti"), key, small)), "outline")
    discard(follows)
    polygons = _polygons(rings, key).withColumn("dissolved", F.lit(True))
    if not torn.isEmpty():
        polygons = polygons.unionByName(_part_by_part(several.join(torn, same, "left_semi"), key, column, small))
    return alone, repeated, polygons


def shape_parts(df: DataFrame, key: str, column: str = "geom") -> DataFrame:
    """(key, part, polygon): distinct polygons, with a number for those of a key that hang together by shared vertices.

    At each vertex its polygons are linked to the one with the smallest number there, so links grow with the vertices and not
    with the pairs of shapes.
    """
    shapes = df.select(key, F.explode(column).alias("polygon")).distinct().withColumn("node", F.monotonically_increasing_id())
    shapes = materialize(shapes, "shapes")
    corner = shapes.select(key, "node", F.explode(F.array_distinct(F.flatten("polygon"))).alias("v")).select(F.col(key).alias("of"), "node", F.col("v.x").alias("x"), F.col("v.y").alias("y"))
    least = corner.groupBy("of", "x", "y").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most").select(
        F.col("of").alias("_of"), F.col("x").alias("_x"), F.col("y").alias("_y"), "b")
    at = F.col("of").eqNullSafe(F.col("_of")) & (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y"))
    links = corner.join(least, at).select(F.col("node").alias("a"), "b").distinct()
    return shapes.join(connected(shapes.select("node"), links), "node").select(key, "part", "polygon")


def _part_by_part(several: DataFrame, key: str, column: str, small: int) -> DataFrame:
    """Polygons of keys with overlaps: (key, polygon, dissolved). Only the parts in which shapes overlap stay as they are."""
    parts = materialize(shape_parts(several, key, column).select(F.struct(F.col(key).alias("key"), "part").alias("unit"), F.array("polygon").alias(column)), "parts")
    follows = settled(lambda: _successors(boundary_edges(parts, "unit", column), "unit"), "edges")
    torn = materialize(follows.where("torn").select(F.col("unit").alias("_unit")).distinct(), "torn")
    same = F.col("unit").eqNullSafe(F.col("_unit"))
    rings = settled(lambda: _numbered(_trace(follows.join(torn, same, "left_anti"), "unit", small)), "outline")
    discard(follows)
    clean = _polygons(rings, "unit").select(F.col("unit.key").alias(key), "polygon", F.lit(True).alias("dissolved"))
    kept = parts.join(torn, same, "left_semi").select(F.col("unit.key").alias(key), F.explode(column).alias("polygon"), F.lit(False).alias("dissolved"))
    return clean.unionByName(kept)

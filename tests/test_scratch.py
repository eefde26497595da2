"""What a job leaves on disk while it runs: no shuffle files of ended steps, no tables that nothing reads any more."""
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from landledger.operators import geo as G
from landledger.plans import registry
from landledger.session import discard, materialize, passing, scratch_path, settled


def scratch(spark):
    folder = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    return sorted(name.rpartition("-")[0] for name in os.listdir(folder)) if os.path.isdir(folder) else []


def added(spark, before):
    now = scratch(spark)
    for name in before:
        now.remove(name)
    return now


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_shuffle_files_go_with_their_step(spark):
    before = shuffle_files(spark)
    kept = materialize(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 100).alias("k")).count())
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and kept.count() == 100


def test_settled_keeps_its_result_only(spark):
    before = scratch(spark)

    def make():
        inner = settled(lambda: materialize(spark.range(7), "first").where("id > 1"), "second")
        return inner.where("id > 2")

    out = settled(make, "third")
    assert added(spark, before) == ["third"] and out.count() == 4
    with passing():
        assert settled(make, "fourth").count() == 4 and added(spark, before) == ["fourth", "third"]
    assert added(spark, before) == ["third"]
    discard(out)
    assert added(spark, before) == []


def test_dissolve_drops_its_edges(spark):
    square = [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]]
    beside = [[[(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]]]
    rows = [("a", [[[(float(x), float(y)) for x, y in ring] for ring in polygon] for polygon in shape]) for shape in (square, beside)]
    before = scratch(spark)
    got = G.dissolve_polygons(spark.createDataFrame(rows, f"k string, geom {G.GEOMETRY}"), "k").select(F.size("polygon").alias("n"), G.area(F.array("polygon")).alias("area")).collect()
    assert [(r["n"], r["area"]) for r in got] == [(2, 31.0)]
    assert not {"edges", "outline-edges", "hole-grid", "hole-keys"} & set(added(spark, before))


def test_ends_of_edges_are_sent_once_and_without_angles(spark):
    point = "struct<x:double,y:double>"
    corners = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (-0.0, 1.0)]
    edges = spark.createDataFrame([("a", p, q) for p, q in zip(corners, corners[1:] + corners[:1])], f"k string, a {point}, b {point}")
    follows = G._successors(edges, "k")
    assert sorted(tuple(r["next"]["a"]) for r in follows.collect()) == sorted((x + 0.0, y) for x, y in corners)
    plan = follows._jdf.queryExecution().sparkPlan().toString()
    exchange = follows._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert exchange.count("Exchange hashpartitioning") == 1 and "ATAN2" in plan.upper()


def test_a_republished_spine_leaves_its_publications_only(spark, tmp_path):
    n = 60
    table = pa.table({
        "l_orderkey": pa.array([i // 3 for i in range(n)], pa.int64()), "l_partkey": pa.array([i * 5 % 23 for i in range(n)], pa.int64()),
        "l_suppkey": pa.array([i % 3 + 1 for i in range(n)], pa.int64()), "l_linenumber": pa.array([i % 3 + 1 for i in range(n)], pa.int32()),
        "l_quantity": pa.array([float(i) for i in range(n)]), "l_extendedprice": pa.array([100.0 + i for i in range(n)]),
        "l_returnflag": ["ANR"[i % 7 % 3] for i in range(n)], "l_linestatus": ["OF"[i % 2] for i in range(n)],
        "l_shipdate": pa.array([1_000_000 * i for i in range(n)], pa.timestamp("us")),
    })
    pq.write_table(table, tmp_path / "lineitem.parquet")
    registry.load_all()
    before = scratch(spark)
    rows = registry.QUERIES["spine_republished"](spark, str(tmp_path)).collect()
    assert rows and not any(r["moved"] for r in rows)
    assert added(spark, before) == ["published"]

import random

import pytest
from pyspark.sql import functions as F

from landledger.operators import keys as K
from landledger.operators.ordering import next_by_range, next_in_order, number_copies, number_rows


def brute_numbers(rows):
    out, seen = [], {}
    for key, value in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1])):
        seen[key] = seen.get(key, 0) + 1
        out.append((key, value, seen[key]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window_rows", [0, 50, 10**6])
def test_number_rows_with_hot_and_null_keys(spark, window_rows):
    # One key holds a third of all rows; some keys are null.
    rows = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 40}", i * 7919 % 3001) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    got = number_rows(df, ["k"], ["v"], "n", window_rows=window_rows)
    assert dict(got.dtypes)["n"] == "bigint"
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_numbers(rows)


def test_number_rows_hot_key_is_spread(spark):
    from landledger.operators import ordering

    df = spark.range(40000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = []
        original, ordering.materialize = ordering.materialize, lambda d, label="x": kept.append((label, original(d, label))) or kept[-1][1]
        got = number_rows(df, ["k"], ["v"], "n", window_rows=100)
        assert got.where("n <> v + 1").isEmpty() and got.count() == 40000
        placed = dict(kept)["placed"]
        assert placed.select("_part").distinct().count() > 4
    finally:
        ordering.materialize = original
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_number_rows_start(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    start = spark.createDataFrame([("a", 10)], "k string, start bigint")
    for window_rows in (0, 100):
        got = number_rows(df, ["k"], ["v"], "n", start=start, window_rows=window_rows)
        assert sorted(map(tuple, got.collect())) == [("a", 1, 11), ("a", 2, 12), ("b", 1, 1)]


@pytest.mark.parametrize("chunk", [3, 10, 1000])
def test_number_copies(spark, chunk):
    rows = [("x", 1)] * 25 + [("y", None)] * 10 + [("z", 2)]
    got = number_copies(spark.createDataFrame(rows, "a string, b int"), "n", chunk=chunk)
    want = [(a, b, i + 1) for a, b, n in (("x", 1, 25), ("y", None, 10), ("z", 2, 1)) for i in range(n)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_next_in_order_matches_lead(spark):
    random.seed(3)
    rows = [(random.choice(["hot", "hot", "hot", "b", None]), f"2024-{random.randint(1, 12):02d}-{random.randint(1, 28):02d}", i) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, day string, id int").withColumn("m", F.substring("day", 1, 7))
    got = next_in_order(df, ["k"], ["day", "id"], "m", "nxt")
    df.createOrReplaceTempView("v")
    want = spark.sql("select *, lead(day) over (partition by k order by day, id) as nxt from v")
    assert got.exceptAll(want).isEmpty() and got.count() == 800


@pytest.mark.parametrize("parts", [1, 6])
def test_next_by_range_matches_lead(spark, parts):
    """Also where one key has one date, where dates are missing, and where rows are equal."""
    random.seed(parts)
    rows = [("hot", "2024-01-01", i) for i in range(300)] + [("hot", "2024-02-01", i) for i in range(5)] + [("null", None, i) for i in range(100)]
    rows += [("null", "2024-03-01", i) for i in range(40)] + [(random.choice(["b", None]), random.choice([None, "2024-05-01", "2024-06-01"]), i // 3) for i in range(90)] + [("b", "x", 1)] * 4
    df = spark.createDataFrame(rows, "k string, day string, id int").repartition(5)
    got = next_by_range(df, ["k"], ["day", "id"], "nxt", parts)
    df.createOrReplaceTempView("v")
    want = spark.sql("select *, lead(day) over (partition by k order by day, id) as nxt from v")
    assert got.exceptAll(want).isEmpty() and got.count() == len(rows)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    # The window over the rows is cut at the ranges; those over a key see one row per range.
    assert any("[k#" in line and "_range#" in line.split("], [")[1] for line in windows)


def refs(spark, pairs):
    return K.native_refs(spark.createDataFrame(pairs, "region string, ref string"), "region", "ref")


def test_mint_is_stable_and_order_free(spark):
    pairs = [("r1", f"h{i:03d}") for i in range(50)] + [("r2", "h000"), ("r2", None), (None, "x")]
    first = K.mint(K.empty_crosswalk(spark), refs(spark, pairs[:30]))
    shuffled = pairs[:30][::-1] + pairs[:10]
    again = K.mint(K.empty_crosswalk(spark), refs(spark, shuffled))
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()
    full = K.extend(first, refs(spark, pairs))
    assert first.exceptAll(full).isEmpty()
    assert full.count() == 51
    assert K.crosswalk_violations(full).isEmpty()
    assert K.mint(full, refs(spark, pairs)).isEmpty()
    assert full.where("region = 'r1'").agg(F.max("seq")).head()[0] == 50


def test_crosswalk_violations(spark):
    bad = spark.createDataFrame([("r", "a", 1), ("r", "a", 2), ("r", "b", 2)], K.CROSSWALK)
    assert sorted((r["rule"], r["value"]) for r in K.crosswalk_violations(bad).collect()) == [("native_ref", "a"), ("seq", "2")]


def test_lookup_leaves_unminted_null(spark):
    crosswalk = spark.createDataFrame([("r", "a", 1)], K.CROSSWALK)
    feed = spark.createDataFrame([("a",), ("b",), (None,)], "ref string")
    got = K.lookup(feed, crosswalk, F.lit("r"), "ref", "seq")
    assert sorted(map(tuple, got.collect()), key=repr) == [("a", 1), ("b", None), (None, None)]

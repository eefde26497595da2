from pyspark.sql import functions as F

from landledger.operators import summaries as S

EXACT = ["column", "position", "n_rows", "n_null", "n_blank", "n_numbers", "min_text", "max_text", "min_number", "max_number"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_parts_merge_to_the_whole(spark):
    df = spark.range(20_000).select(
        F.pmod(F.xxhash64("id"), F.lit(7)).cast("string").alias("part"), F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, F.lit(" ")).when(F.col("id") % 3 == 1, F.concat(F.lit("v"), F.col("id") % 500)).alias("a.b"),
        F.lit(None).cast("string").alias("none"),
    )
    whole = S.summarize(df.drop("part"))
    merged = S.merge(S.summarize(df, ["part"]))
    assert rows(whole.select(EXACT)) == rows(merged.select(EXACT))
    for got in (whole, merged):
        by_name = {r["column"]: r for r in S.estimates(got).collect()}
        assert abs(by_name["n"].n_distinct - 20_000) < 0.05 * 20_000 and abs(by_name["a.b"].n_distinct - 500) < 25
        assert all(abs(q - 20_000 * share) < 600 for q, share in zip(by_name["n"].quantiles, (0.25, 0.5, 0.75)))
        assert by_name["none"].n_distinct == 0 and by_name["none"].quantiles is None and by_name["none"].min_text is None
        assert (by_name["a.b"].n_null, by_name["a.b"].n_blank, by_name["a.b"].n_numbers) == (6666, 6667, 0)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert rows(S.summarize(empty).select("column", "n_rows", "n_null", "n_numbers")) == [("a", 0, 0, 0), ("b", 0, 0, 0)]
    assert S.summarize(empty, ["a"]).count() == 0
    assert S.estimates(S.merge(S.summarize(empty))).where("n_distinct = 0 and quantiles is null").count() == 2
    assert rows(S.drift(S.summarize(empty), S.summarize(empty)).select("column", "change")) == [("a", "same"), ("b", "same")]


def test_drift(spark):
    before = spark.createDataFrame([(str(i), "x", str(i), "9", "a", "") for i in range(100)], "k string, gone string, code string, n string, t string, f string")
    after = spark.createDataFrame(
        [(str(i), "R" if i == 3 else str(i), "10", "a" if i > 4 else None, "a" if i > 6 else "", "y" if i < 6 else None) for i in range(100)],
        "k string, code string, n string, t string, fresh string, f string",
    )
    got = dict(rows(S.drift(S.summarize(before), S.summarize(after)).select("column", "change")))
    assert got == {"k": "same", "gone": "removed", "code": "not numeric", "n": "wider", "t": "same", "fresh": "added", "f": "fuller"}


def test_one_exchange(spark):
    plan = S.summarize(spark.range(10).select("id", F.lit("x").alias("t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate explode" not in plan and "Window" not in plan

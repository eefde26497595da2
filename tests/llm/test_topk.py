import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landledger.llm import topk


def brute(rows, k):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = tuple(math.floor(1024 * x) for x in v)
            kept[i] = min(kept.get(i, ints), ints)
    out = set()
    for q in (i for i in kept if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q and len(v) == len(kept[q]))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("block_rows, block_queries", [(8192, 65_536), (37, 2)])
def test_against_brute_force(spark, block_rows, block_queries):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 6)]) for i in rng.permutation(700)]
    rows += [(700 + i, rows[0][1]) for i in range(15)]  # ties
    rows += [(9, rows[3][1]), (9, rows[3][1]), (800, None), (801, [None] * 6), (900, [float("nan")] * 6), (901, [float("inf")] + [0.0] * 5), (None, rows[1][1])]
    rows += [(1000, [1.0, 2.0]), (1001, [0.5, 0.25]), (1100, []), (1200, [0.0] * 6)]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = topk.top_k(vectors, F.col("vec_id") % 100 == 0, block_rows=block_rows, block_queries=block_queries)
    assert {tuple(r) for r in got.collect()} == brute(rows, 10)


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(5)
    values = rng.integers(-5, 6, (4000, 20))
    values[:30] += rng.integers(200, 400, (30, 20))
    index = topk.Index(np.arange(4000), values)
    for query in (np.full(20, 7), rng.integers(-9, 10, 20), np.zeros(20, np.int64)):
        ids, scores = index.best(query, 3, 10)
        exact = values @ query
        order = [i for i in np.lexsort((np.arange(4000), -exact)) if i != 3][:10]
        assert ids.tolist() == order and scores.tolist() == exact[order].tolist()


def test_edges(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e12]), (1, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()

"""Exact top-k by inner product over an impact-ordered index, score at a time.

Candidates are dealt into blocks; each block gets postings per component, cut into segments by quantised impact. A query walks
the segments of all components in the order of what they add to its score at least, and adds them up. Whatever a candidate has
not met yet can add no more than the best segment left of that component: when few candidates can still reach
the k-th best score known for sure, the walk stops, and exactly these are scored anew from their integers. The best k of
all blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.common import parts_for, spread

SCALE = 1024.0
LEVELS = 16
STEPS = 8  # parts of the walk, between which the proof is tried
FOUND = "query_id long, vec_id long, score long"


def integers(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(1024 x) of every component. Rows with a null id, a null vector, or a component that is null or not
    finite take no part; of rows that repeat an id, the one with the least vector does."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
    sound = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(F.coalesce(sound, F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(F.lit(SCALE) * x)).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


class Index:
    """Postings of a block of vectors: per component and level, the rows whose value lies in that level."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        n, dims = values.shape
        self.low, self.high = values.min(0), values.max(0)
        self.width = (self.high - self.low) // LEVELS + 1
        self.level = (values - self.low) // self.width
        flat = self.level + np.arange(dims) * LEVELS
        self.postings = np.argsort(flat.ravel("F"), kind="stable").astype(np.int64) % n
        self.sizes = np.bincount(flat.ravel(), minlength=dims * LEVELS)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``; ties to the smaller id."""
        n, dims = self.values.shape
        step = np.arange(LEVELS)
        up = query >= 0
        # What a level adds above the least that the component can give, at least; a row of it adds ``slack`` more at most.
        below = np.where(up[:, None], step * self.width[:, None], np.maximum(0, self.high[:, None] - self.low[:, None] - (step + 1) * self.width[:, None] + 1))
        gain = np.abs(query)[:, None] * below
        slack = np.abs(query) * (self.width - 1)
        order = np.argsort(-gain.ravel(), kind="stable")
        order = order[self.sizes[order] > 0]
        reach = np.cumsum(self.sizes[order])
        cuts = np.unique(np.searchsorted(reach, n * dims * np.arange(1, STEPS + 1) / STEPS) + 1)
        sums, alive, members, done = np.zeros(n), self.ids != own, np.arange(n), 0
        for cut in cuts if dims else ():
            segments = order[done:cut]
            rows = np.concatenate([self.postings[self.starts[s]:self.starts[s + 1]] for s in segments])
            sums += np.bincount(rows, np.repeat(gain.ravel()[segments].astype(float), self.sizes[segments]), n)
            done = cut
            # What is left adds no more than the best segment left of each component.
            left = np.zeros(dims)
            np.maximum.at(left, order[done:] // LEVELS, gain.ravel()[order[done:]])
            sure = np.partition(sums[alive], -k)[-k] if alive.sum() >= k else -np.inf
            members = np.flatnonzero(alive & (sums + slack.sum() + left.sum() >= sure))
            if len(members) <= max(4 * k, n // 32):
                break
        members = members[self.ids[members] != own]
        scores = self.values[members] @ query
        top = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members][top], scores[top]


def checked(values: list, dims: int) -> np.ndarray:
    """Vectors as rows; scores that would not fit 64 bits raise."""
    out = np.array(values, np.int64).reshape(len(values), dims)
    if out.size and float(np.abs(out.astype(float)).max()) ** 2 * max(1, dims) >= 2.0 ** 62:
        raise OverflowError("scores would not fit into 64 bits")
    return out


def search_block(k: int):
    def run(key, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if candidates.num_rows and queries.num_rows:
            dims = int(key[0].as_py())
            index = Index(np.array(candidates.column("vec_id").to_pylist(), np.int64), checked(candidates.column("v").to_pylist(), dims))
            for query_id, query in zip(queries.column("vec_id").to_pylist(), checked(queries.column("v").to_pylist(), dims)):
                ids, scores = index.best(query, query_id, k)
                found["query_id"] += [query_id] * len(ids)
                found["vec_id"] += ids.tolist()
                found["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in found.items()})

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    block_rows: int = 8192, block_queries: int = 65_536,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every query row (all, if fewer), ties to the smaller id.

    ``is_query`` is a condition on vec_id. Only vectors of as many components as the query's are candidates. Every block of
    candidates meets every block of queries once: neither side of a task outgrows its block, and each pair of blocks sends
    k rows a query at most.
    """
    rows = integers(vectors, id_column, vector_column)
    n = vectors.count()
    blocks, groups = parts_for(n, block_rows), parts_for(vectors.select(F.col(id_column).alias("vec_id")).where(is_query).count(), block_queries)
    candidates = rows.select(
        F.size("v").alias("dims"), spread("vec_id", blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "vec_id", "v",
    )
    queries = rows.where(is_query).select(
        F.size("v").alias("dims"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), spread("vec_id", groups).alias("part"), "vec_id", "v",
    )
    found = candidates.groupBy("dims", "block", "part").cogroup(queries.groupBy("dims", "block", "part")).applyInArrow(search_block(k), FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Connected components as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.session import materialize


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, part) for every row of ``nodes`` (node long): the smallest node that ``edges`` (a, b) lead to.

    In a round each part joins the part with the smallest number among its neighbours, so at most half of the parts that still have
    smaller neighbours are left, and rounds grow with the logarithm of the nodes. A round is written to the shared folder.
    """
    both = edges.where("a <> b").select("a", "b").unionAll(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "component-edges")
    state = materialize(nodes.select("node", F.col("node").alias("part")).distinct(), "components")
    while True:
        ends = both.join(state.select(F.col("node").alias("a"), "part"), "a").join(state.select(F.col("node").alias("b"), F.col("part").alias("other")), "b")
        joins = materialize(ends.where("other < part").groupBy("part").agg(F.min("other").alias("other")), "component-joins")
        if joins.isEmpty():
            return state
        # A part that joins another which joins a third goes there at once, two steps in a round.
        beyond = joins.select(F.col("part").alias("other"), F.col("other").alias("beyond"))
        steps = materialize(joins.join(beyond, "other", "left").select("part", F.coalesce("beyond", "other").alias("other")), "component-steps")
        state = materialize(state.join(steps, "part", "left").select("node", F.coalesce("other", "part").alias("part")), "components")

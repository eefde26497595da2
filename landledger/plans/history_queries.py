"""Snapshots, change capture and validity ranges on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.operators import history as H
from landledger.plans.registry import query
from landledger.sources import landing


@query("""
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y_%m_01_00_00_00') AS snapshot FROM orders
    WHERE strftime(o_orderdate, '%Y_%m') = (SELECT max(strftime(o_orderdate, '%Y_%m')) FROM orders)""")
def latest_snapshot(t):
    month = landing.snapshot_key(F.date_trunc("month", "o_orderdate"))
    return landing.latest_snapshot(t.orders.select("o_orderkey", "o_custkey", month.alias("snapshot")))


@query("""
    WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS note
                 FROM orders WHERE o_orderdate < '2000-06-01'),
         new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
                        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS note
                 FROM orders WHERE o_orderdate >= '1996-01-01')
    SELECT o_orderkey, CASE WHEN old.o_orderstatus IS NULL THEN 'insert' WHEN new.o_orderstatus IS NULL THEN 'delete'
             WHEN old.o_orderstatus = new.o_orderstatus THEN 'same' ELSE 'update' END AS change,
           old.o_orderstatus AS old_status, new.o_orderstatus AS new_status
    FROM old FULL OUTER JOIN new USING (o_orderkey)""")
def changes(t):
    note = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("note")
    old = t.orders.where("o_orderdate < '2000-06-01'").select("o_orderkey", "o_orderstatus", "o_totalprice", note)
    status = F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    new = t.orders.where("o_orderdate >= '1996-01-01'").select("o_orderkey", status, "o_totalprice", note)
    return H.changes(old, new, ["o_orderkey"]).select(
        "o_orderkey", "change", F.col("old.o_orderstatus").alias("old_status"), F.col("new.o_orderstatus").alias("new_status")
    )


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate,
                      lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM orders)
    SELECT o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS valid_from, strftime(nxt, '%Y-%m-%d') AS valid_to,
           nxt IS NULL AS is_current FROM r""")
def history_ranges(t):
    versions = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    ranged = H.validity(versions, ["o_custkey"], "day", F.trunc("day", "month"), tie_break=["o_orderkey"])
    return ranged.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query("""
    WITH v AS (SELECT *, CASE WHEN l_returnflag = 'N' THEN '2000-01-01' ELSE strftime(l_shipdate, '%Y-%m-01') END AS day FROM lineitem),
    r AS (SELECT *, lead(day) OVER (PARTITION BY l_returnflag ORDER BY day, l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice) AS nxt FROM v)
    SELECT l_returnflag, l_orderkey, l_linenumber, l_suppkey, day AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current FROM r""")
def history_ranges_hot_key(t):
    """Three keys hold all versions, and one of them has all of its own on one date."""
    day = F.when(F.col("l_returnflag") == "N", "2000-01-01").otherwise(F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd"))
    ties = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice"]
    ranged = H.validity(t.lineitem.select("l_returnflag", *ties, day.alias("day")), ["l_returnflag"], "day", tie_break=ties)
    return ranged.select("l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey", "valid_from", "valid_to", "is_current")


@query("""
    SELECT snapshot, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM (
      SELECT o_orderkey, '2024_01_01_00_00_00' AS snapshot FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT o_orderkey, '2024_02_01_00_00_00' FROM orders) GROUP BY snapshot""")
def history_snapshots(t):
    from landledger.session import scratch_path

    path = scratch_path(t.spark, "history")
    H.snapshot_append(t.orders, path, "2024_01_01_00_00_00")
    # A re-run of a snapshot replaces it; another snapshot is added beside it.
    H.snapshot_append(t.orders.where("o_orderstatus = 'F'"), path, "2024_01_01_00_00_00")
    H.snapshot_append(t.orders, path, "2024_02_01_00_00_00")
    return H.read_history(t.spark, path).groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys")
    )

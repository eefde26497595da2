"""Plan shapes that must hold at any size: pruning, pushdown, shuffles."""

import re

from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.operators import history as H
from landledger.operators import ordering as O
from landledger.operators import quality as Q
from landledger.plans import entity_queries, registry
from landledger.sources import landing


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_region_prefix_reaches_the_scan(spark, tmp_path):
    made = spark.range(50).select(ids.global_id(840, F.lit(29510), "id").alias("parcel_id"), F.lit("x").alias("pad"))
    made.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    text = plan(stored.where(ids.in_region("parcel_id", 840, 29510)).select("parcel_id"))
    assert "StringStartsWith(parcel_id,840.29510.)" in text and "pad" not in text


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "h")
    for snapshot in ("2024_01_01_00_00_00", "2024_02_01_00_00_00"):
        H.snapshot_append(spark.range(3).toDF("k"), path, snapshot)
    newest = landing.latest_snapshot(spark.read.parquet(path))
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", plan(newest)).group(1)
    assert "2024_02_01_00_00_00" in found and newest.count() == 3


def test_merge_reads_only_its_columns(spark, sf):
    text = plan(registry.QUERIES["merge_duplicates"](spark, sf))
    assert text.count("Exchange") == 1
    assert "l_discount" not in text and "l_orderkey" not in text


def test_no_query_forces_a_broadcast():
    import pathlib

    root = pathlib.Path(registry.__file__).parents[1]
    for source in root.rglob("*.py"):
        text = source.read_text()
        assert "broadcast(" not in text and "localCheckpoint" not in text and "crossJoin" not in text, source


def test_validity_shuffles_rows_once(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumn("b", F.trunc("o_orderdate", "month"))
    text = plan(O.next_in_order(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "b", "nxt"))
    # Rows once; the per-bucket heads twice (count them, then put them in order).
    assert text.count("Exchange hashpartitioning") == 3 and "Join" not in text and "SortAggregate" not in text


def test_audit_is_one_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = plan(Q.mutation_audit(orders, orders, ["o_orderkey", "o_totalprice"]))
    assert text.count("Exchange") == 1 and "o_custkey" not in text


def test_shapes_read_one_column(spark, sf):
    text = plan(entity_queries.E.shapes(entity_queries.accounts(registry.Tables(spark, sf))))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text

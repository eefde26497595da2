"""Snapshot history and change capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.operators.ordering import next_by_range, next_in_order
from landledger.operators.quality import require_unique


def snapshot_append(df: DataFrame, path: str, snapshot: str) -> None:
    """Append one snapshot to a history table partitioned by ``snapshot``.

    Only that snapshot's partition is written, and a re-run replaces it: retries are harmless.
    """
    (
        df.withColumn("snapshot", F.lit(snapshot))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("snapshot", F.col("snapshot").cast("string"))


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Per key: insert, update, delete or same, with both payloads as structs.

    Payloads are compared value by value, null equal to null. ``check`` proves the keys unique first;
    with duplicates a full join would pair every copy with every other.
    """
    keys = list(keys)
    if check:
        require_unique(old, keys, "old snapshot")
        require_unique(new, keys, "new snapshot")
    payload = [c for c in new.columns if c not in keys]
    joined = old.select(*keys, F.struct(*payload).alias("old")).join(
        new.select(*keys, F.struct(*payload).alias("new")), keys, "full_outer"
    )
    change = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull(), "delete")
        .when(F.col("old").eqNullSafe(F.col("new")), "same")
        .otherwise("update")
    )
    return joined.select(*keys, change.alias("change"), "old", "new")


def validity(
    history: DataFrame, keys: Sequence[str], at: str, bucket: Column | None = None, tie_break: Sequence[str] = ()
) -> DataFrame:
    """``valid_from`` / ``valid_to`` per version; the open version ends with null.

    ``bucket`` is a coarser form of ``at`` (its month, say) that splits long-lived keys over tasks with one shuffle. Without it rows
    are placed by range, which also splits a key with very many versions on one date.
    """
    if bucket is None:
        ranged = next_by_range(history, keys, [at, *tie_break], "valid_to")
    else:
        ranged = next_in_order(history.withColumn("_bucket", bucket), keys, [at, *tie_break], "_bucket", "valid_to").drop("_bucket")
    return ranged.withColumnRenamed(at, "valid_from").withColumn("is_current", F.col("valid_to").isNull())

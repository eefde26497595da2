"""Row numbering that never puts one key's rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landledger.session import materialize

# Rows that a task takes on where rows are sorted or grouped by key: a pure work size.
TASK_ROWS = 1_000_000


def dealt(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``df`` by ``columns`` on tasks of about ``TASK_ROWS`` of ``rows`` each; as Spark deals it out where its own number of tasks does for that.

    Joins and aggregates by these columns keep the tasks, so what one of them sorts does not grow with the input. It is enough to deal out
    the smaller side of a join by the rows of the larger one: that one follows, and stays where it is if the smaller is broadcast.
    """
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(tasks, *columns) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "seq",
    start: DataFrame | None = None,
    window_rows: int = 1_000_000,
) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` as bigint, for keys of any size.

    ``order`` must be total within a key. Keys of at most ``window_rows`` rows take a plain window,
    one shuffle; larger keys, which a window would send to one task, are placed by range instead.
    ``start`` (keys and a ``start`` column) is added to the numbers of its key.

    ``df`` is read twice, so materialize it first when it is costly to compute.
    """
    keys, order = list(keys), list(order)
    window = Window.partitionBy(*keys).orderBy(*order)
    # At most one key per ``window_rows`` rows; written, so the planner knows how few.
    hot = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > window_rows).select(*keys), "hot")
    if hot.isEmpty():
        numbered = df.withColumn(out, F.row_number().over(window).cast("bigint"))
    else:
        cold = null_safe_join(df, hot, keys, "left_anti")
        numbered = cold.withColumn(out, F.row_number().over(window).cast("bigint")).unionByName(
            _place_by_range(null_safe_join(df, hot, keys, "left_semi"), keys, order, out)
        )
    if start is None:
        return numbered
    shifted = null_safe_join(numbered, start, keys)
    return shifted.withColumn(out, F.col(out) + F.coalesce("start", F.lit(0))).select(*df.columns, out)


def _place_by_range(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Row numbers from sorted range partitions.

    A key spreads over as many partitions as it needs; a row's number is its offset in its partition
    plus the rows of its key in earlier partitions.
    """
    sort = [F.col(name) for name in keys + order]
    placed = materialize(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id()),
        "placed",
    )
    runs = placed.groupBy("_part", *keys).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    # One row per partition and key in it; written, so the planner knows how small it is.
    runs = materialize(runs.select("_part", *keys, base.alias("_base")), "runs")
    numbered = null_safe_join(placed, runs, ["_part", *keys], how="inner")
    return numbered.select(*df.columns, (F.col("_row") + F.col("_base")).alias(out))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys, nulls equal too; the keys of ``right`` are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, on, how).drop(*[f"_r_{key}" for key in keys])


def number_copies(df: DataFrame, out: str = "copy_no", chunk: int = 100_000) -> DataFrame:
    """Every row with ``out`` = 1..n among its exact copies, so that the row becomes unique.

    Copies are counted with map-side combine. A row with more than ``chunk`` copies is first split
    into chunks that are spread over the cluster, so no task writes out all copies.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.where(F.col("_n") <= chunk).select(*cols, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias(out))
    many = (
        counted.where(F.col("_n") > chunk)
        .select(*cols, "_n", F.explode(F.sequence(F.lit(1), F.col("_n"), F.lit(chunk))).alias("_from"))
        .repartition(*cols, "_from")
        .select(*cols, F.explode(F.sequence("_from", F.least(F.col("_from") + chunk - 1, "_n"))).alias(out))
    )
    return few.unionByName(many)


def next_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str, out: str) -> DataFrame:
    """``lead(order[0]) over (partition by keys order by order)``, each key's window cut at ``bucket``.

    ``bucket`` must not decrease along ``order`` (the month of a date, say). The first value of each
    bucket, one row per key and bucket, is handed to the bucket before it as one more row, so the
    window over ``keys + bucket`` is complete in itself. The rows are shuffled once, and a key with
    most of the table is shared by as many tasks as it has buckets.
    """
    keys, order, value = list(keys), list(order), order[0]
    # Null values come first in the order, so a bucket that has one begins with it.
    heads = df.groupBy(*keys, bucket).agg(F.min(value).alias("_least"), F.max(F.col(value).isNull()).alias("_null")).select(
        *keys, bucket, F.when(~F.col("_null"), F.col("_least")).alias(value)
    )
    place = Window.partitionBy(*keys).orderBy(bucket)
    markers = heads.select(
        *keys, F.lag(bucket).over(place).alias(bucket), value, F.lit(True).alias("_marker"), (F.row_number().over(place) > 1).alias("_has_previous"),
    ).where("_has_previous").drop("_has_previous")
    rows = df.withColumn("_marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
    ahead = F.lead(value).over(Window.partitionBy(*keys, bucket).orderBy("_marker", *order))
    return rows.withColumn(out, ahead).where("not _marker").drop("_marker")


def next_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, parts: int | None = None) -> DataFrame:
    """``lead(order[0]) over (partition by keys order by order)`` for keys of any size, with as many equal values as there may be.

    Rows are placed by range in the order of keys and ``order``, a number given before telling equal ones apart, so a key with most of
    the table on one date is shared by many tasks. The range a row falls into is its bucket for ``next_in_order``: one row is
    carried over each boundary, and no window holds a whole key.
    """
    tied = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "lead-rows")
    sort = [*keys, *order, "_tie"]
    ranged = tied.repartitionByRange(parts, *sort) if parts else tied.repartitionByRange(*sort)
    placed = materialize(ranged.withColumn("_range", F.spark_partition_id()), "lead-ranges")
    return next_in_order(placed, keys, [*order, "_tie"], "_range", out).drop("_range", "_tie")

"""Gates and checks: routing, reconciliation, keys, profiles, drift, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(
    df: DataFrame,
    excluded_if: Sequence[tuple[str, Column]] = (),
    rejected_if: Sequence[tuple[str, Column]] = (),
) -> DataFrame:
    """Tag each row ``loaded``, ``excluded`` or ``rejected`` with the first reason that holds.

    One pass, no row lost: split the result with ``filter`` on ``route``. Exclusion (out of scope)
    wins over rejection (bad value).
    """
    reason = F.lit(None).cast("string")
    target = F.lit("loaded")
    for name, rules in (("rejected", rejected_if), ("excluded", excluded_if)):
        for why, condition in reversed(list(rules)):
            hit = F.coalesce(condition, F.lit(False))
            reason = F.when(hit, F.lit(why)).otherwise(reason)
            target = F.when(hit, F.lit(name)).otherwise(target)
    return df.withColumns({"route": target, "reason": reason})


def reconcile(routed: DataFrame, feed: str | None = None) -> DataFrame:
    """Per feed: loaded, excluded, rejected and source counts, and whether they add up."""

    def tally(name: str) -> Column:
        return F.count_if(F.col("route") == name).alias(name)

    grouped = routed.groupBy(feed) if feed else routed.groupBy()
    counts = grouped.agg(tally("loaded"), tally("excluded"), tally("rejected"), F.count(F.lit(1)).alias("source"))
    return counts.withColumn(
        "balanced", F.col("loaded") + F.col("excluded") + F.col("rejected") == F.col("source")
    )


def row_reconciliation(source: DataFrame, keys: Sequence[str], target: DataFrame) -> DataFrame:
    """One row: distinct non-null source keys against target rows."""
    distinct = source.select(*keys).dropna().distinct().groupBy().agg(F.count(F.lit(1)).alias("source_keys"))
    loaded = target.groupBy().agg(F.count(F.lit(1)).alias("target_rows"))
    both = distinct.select("source_keys", F.lit(None).cast("bigint").alias("target_rows")).unionByName(
        loaded.select(F.lit(None).cast("bigint").alias("source_keys"), "target_rows")
    )
    return both.agg(F.max("source_keys").alias("source_keys"), F.max("target_rows").alias("target_rows")).withColumn(
        "matches", F.col("source_keys") == F.col("target_rows")
    )


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are null or occur more than once, with their row count."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where((F.col("n_rows") > 1) | missing)


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """``df`` itself, once its key is proven unique and not null (runs a job over the keys)."""
    bad = pk_violations(df, keys).head(3)
    if bad:
        raise ValueError(f"{what}: key {list(keys)} is not unique and non-null, e.g. {bad}")
    return df


def fk_violations(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Child key values without a parent, with their row count; a null in the key is no violation.

    Both sides are counted by key in one aggregate, combined before its shuffle: a hot key is one row per task on either side,
    and there is no join that the optimizer could push below the counts.
    """
    names = [name for name, _ in on]
    children = child.select(*names, F.lit(1).cast("bigint").alias("_child"), F.lit(0).cast("bigint").alias("_parent"))
    parents = parent.select(*[F.col(p).alias(c) for c, p in on], F.lit(0).cast("bigint").alias("_child"), F.lit(1).cast("bigint").alias("_parent"))
    counted = children.unionByName(parents).dropna(subset=names).groupBy(*names).agg(F.sum("_child").alias("n_rows"), F.max("_parent").alias("_parent"))
    return counted.where("n_rows > 0 and _parent = 0").select(*names, "n_rows")


def mutation_audit(source: DataFrame, loaded: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose number of copies differs between the two sides, as ``n_source`` and ``n_loaded``.

    Both directions of EXCEPT ALL in one shuffle with map-side combine.
    """
    tagged = source.select(*cols, F.lit(1).alias("_s"), F.lit(0).alias("_l")).unionByName(
        loaded.select(*cols, F.lit(0).alias("_s"), F.lit(1).alias("_l"))
    )
    return (
        tagged.groupBy(*cols)
        .agg(F.sum("_s").alias("n_source"), F.sum("_l").alias("n_loaded"))
        .where("n_source <> n_loaded")
    )


def as_text(df: DataFrame) -> DataFrame:
    """All columns as strings, the form in which data lands."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def profile(df: DataFrame, exact: bool = False, placeholders: Sequence[str] = ("0", "-", "N/A")) -> DataFrame:
    """One row per column: rows, nulls, blanks, distinct values, text bounds, kind and bucket.

    All measures of all columns are one aggregate without keys, and nothing is sorted. The default counts distinct values
    approximately, and no cell becomes a row. ``exact`` counts them from distinct (column, value) pairs: there every filled cell
    becomes a row, and each distinct value is shuffled once from every task that has it.
    """
    words = as_text(df)
    measures = []
    for place, column in enumerate(words.columns, 1):
        value = F.col(f"`{column}`")
        filled = F.when(F.trim(value) != "", value)
        measures.append(F.struct(
            F.lit(column).alias("column"), F.lit(place).alias("position"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(value.isNull()).alias("n_null"), F.count_if(value.isNotNull() & filled.isNull()).alias("n_blank"),
            (F.lit(0).cast("bigint") if exact else F.approx_count_distinct(filled)).alias("n_distinct"),
            F.min(filled).alias("min_text"), F.max(filled).alias("max_text"),
            F.coalesce(F.bool_and(filled.isin("0", "1")), F.lit(False)).alias("is_flag"),
            F.coalesce(F.bool_and(filled.isin(*placeholders)), F.lit(False)).alias("is_placeholder"),
        ))
    stats = words.agg(F.array(*measures).alias("measures")).select(F.inline("measures"))
    if exact:
        cells = words.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in words.columns])).alias("c"))
        pairs = cells.select("c.column", "c.value").where(F.trim("value") != "").distinct()
        distinct = pairs.groupBy("column").agg(F.count(F.lit(1)).alias("_distinct"))
        stats = stats.join(distinct, "column", "left").withColumn("n_distinct", F.coalesce("_distinct", F.lit(0)))
    empty = F.col("n_distinct") == 0
    two_flags = F.col("is_flag") & (F.col("n_distinct") == 2)
    status = F.when(empty, "empty").when(two_flags, "boolean").when(F.col("is_placeholder"), "placeholder")
    # A column is coded when few values cover many rows.
    coded = two_flags | ((F.col("n_distinct") <= 100) & (F.col("n_rows") >= 10 * F.col("n_distinct")))
    bucket = F.when(empty | (F.col("is_placeholder") & ~two_flags), "other").when(coded, "coded_data")
    return stats.select(
        "column", "position", "n_rows", "n_null", "n_blank", "n_distinct", "min_text", "max_text",
        status.otherwise("values").alias("profile_status"), bucket.otherwise("actual_data").alias("bucket"),
    )


def schema_frame(df: DataFrame, table: str) -> DataFrame:
    """The schema of ``df`` as rows (table, column, position, type)."""
    rows = [(table, f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "table string, column string, position int, type string")


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed, moved or retyped between two ``schema_frame`` tables."""
    keys = ["table", "column"]
    joined = before.select(*keys, F.struct("position", "type").alias("old")).join(
        after.select(*keys, F.struct("position", "type").alias("new")), keys, "full_outer"
    )
    moved = F.col("old.position") != F.col("new.position")
    retyped = F.col("old.type") != F.col("new.type")
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(moved & retyped, "moved and retyped")
        .when(moved, "moved")
        .when(retyped, "retyped")
    )
    return joined.select(
        *keys, change.alias("change"), F.col("old.position").alias("old_position"),
        F.col("new.position").alias("new_position"), F.col("old.type").alias("old_type"),
        F.col("new.type").alias("new_type"),
    ).where(F.col("change").isNotNull())


def decode_health(vocabulary: DataFrame, group: str, title: str) -> DataFrame:
    """Per vocabulary: entries, and how many have no usable description (null, blank, ``None``)."""
    lost = F.col(title).isNull() | F.trim(title).isin("", "None")
    return vocabulary.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_entries"), F.count_if(lost).alias("n_without_title")
    ).withColumn("healthy", F.col("n_without_title") == 0)

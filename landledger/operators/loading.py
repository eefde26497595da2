"""Loading tables that refer to each other: rejects that spread along foreign keys, and all keys checked in one shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.operators.entities import union_standard
from landledger.session import materialize

# (child, column, parent): the column refers to the parent's key.
Foreign = Sequence[tuple[str, str, str]]


def load_groups(tables: Iterable[str], foreign: Foreign) -> list[list[str]]:
    """Tables in an order that puts parents first; tables that refer to each other in a circle stand in one group."""
    tables = list(tables)
    parents = {t: {p for c, _, p in foreign if c == t and p in tables} for t in tables}

    def reached(start: str) -> set[str]:
        seen, stack = set(), [start]
        while stack:
            for parent in parents[stack.pop()] - seen:
                seen.add(parent)
                stack.append(parent)
        return seen

    above = {t: reached(t) for t in tables}
    group = {t: tuple(sorted({t} | {o for o in above[t] if t in above[o]})) for t in tables}
    edges: dict[tuple, set] = {g: set() for g in group.values()}
    for t in tables:
        edges[group[t]] |= {group[p] for p in parents[t]} - {group[t]}
    try:
        return [list(g) for g in TopologicalSorter(edges).static_order()]
    except CycleError as error:  # groups hold all circles
        raise AssertionError("circle between groups") from error


def cascade(routed: Mapping[str, DataFrame], keys: Mapping[str, str], foreign: Foreign) -> dict[str, DataFrame]:
    """``routed`` tables with their routes carried on to all rows below: a row whose parent is not loaded is not loaded either.

    Each table has ``route`` and ``reason``. A loaded row loses its place through the first of its foreign keys, in the order of
    ``foreign``, whose parent row is missing, rejected or excluded; an excluded parent excludes, any other rejects. ``reason`` then names
    the column and the parent's state, and ``root`` the reason at the top of the chain. Null keys refer to nothing, a key that
    several parent rows share is good if one of them is loaded. No row is dropped.

    Tables are settled parents first, each in one pass; circles, and tables that refer to themselves, in rounds until no row changes.
    A pass has one aggregate over all keys of the table, combined before its shuffle, which leaves the lost keys; only those
    meet the rows again, so rows are not shuffled while the lost keys are few.
    """
    done = {t: df.withColumn("root", F.col("reason")) for t, df in routed.items()}
    for group in load_groups(routed, foreign):
        links = {t: [(column, parent) for child, column, parent in foreign if child == t and parent in done] for t in group}
        circular = any(parent in group for t in group for _, parent in links[t])
        while True:
            changed = 0
            for t in group:
                if not links[t]:
                    continue
                lost = materialize(lost_keys(done[t], links[t], done, keys), f"lost-{t}")
                n = lost.count()
                if n:
                    done[t] = materialize(without_parents(done[t], links[t], lost), f"routed-{t}")
                changed += n
            if not circular or not changed:
                break
    return done


def lost_keys(child: DataFrame, links: Sequence[tuple[str, str]], tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """(link, key, state, root): keys that loaded rows of ``child`` use and that no loaded row of the parent has.

    Every row of either side meets one aggregate of small numbers, which is hashed and not sorted; states and roots, which are texts, are
    then looked up for the lost keys alone.
    """
    uses = F.array(*[F.struct(F.lit(i).alias("link"), F.col(column).cast("string").alias("key")) for i, (column, _) in enumerate(links)])
    used = child.where("route = 'loaded'").select(F.inline(uses)).where("key is not null").select("link", "key", F.lit(1).alias("used"), F.lit(0).alias("there"))
    parents = union_standard([
        tables[parent].select(F.lit(i).alias("link"), F.col(keys[parent]).cast("string").alias("key"), F.col("route").alias("state"), "root").where("key is not null")
        for i, (_, parent) in enumerate(links)
    ], ["link", "key", "state", "root"])
    there = parents.where("state = 'loaded'").select("link", "key", F.lit(0).alias("used"), F.lit(1).alias("there"))
    counted = used.unionByName(there).groupBy("link", "key").agg(F.max("used").alias("used"), F.max("there").alias("there"))
    lost = materialize(counted.where("used = 1 and there = 0").select("link", "key"), "lost-keys")
    rank = F.array_position(F.array(F.lit("loaded"), F.lit("excluded"), F.lit("rejected")), F.col("state"))
    # Of lost keys that several parent rows share, the state and root of the first by rank.
    best = parents.where("state <> 'loaded'").join(lost, ["link", "key"], "left_semi").groupBy("link", "key").agg(F.min(F.struct(rank.alias("rank"), "state", "root")).alias("best"))
    return lost.join(best, ["link", "key"], "left").select("link", "key", F.coalesce("best.state", F.lit("missing")).alias("state"), "best.root")


def without_parents(child: DataFrame, links: Sequence[tuple[str, str]], lost: DataFrame) -> DataFrame:
    """``child`` with the routes of rows that use a lost key."""
    columns = child.columns
    hits = []
    for i, (column, parent) in enumerate(links):
        why = F.concat(F.lit(f"{column}: {parent} "), F.col("state"))
        part = lost.where(F.col("link") == i).select(
            F.col("key").alias(f"_key{i}"), F.struct(F.when(F.col("state") == "excluded", "excluded").otherwise("rejected").alias("route"), why.alias("reason"), F.coalesce("root", why).alias("root")).alias(f"_lost{i}"),
        )
        child = child.join(part, (F.col(column).cast("string") == F.col(f"_key{i}")) & (F.col("route") == "loaded"), "left")
        hits.append(F.col(f"_lost{i}"))
    first = F.coalesce(*hits)
    taken = child.withColumn("_lost", first)
    new = {c: F.when(F.col("_lost").isNotNull(), F.col("_lost")[c]).otherwise(F.col(c)) for c in ("route", "reason", "root")}
    return taken.select(*[new[c].alias(c) if c in new else F.col(c) for c in columns])


def integrity_violations(frames: Mapping[str, DataFrame], keys: Mapping[str, str], foreign: Foreign) -> DataFrame:
    """(rule, key, n_rows) of all violations of all keys: primary keys that are null or repeat, foreign keys without a parent.

    One aggregate for any number of rules. Every row gives one entry for its own key and one for each key that it refers to, all
    grouped by (table referred to, key); the counts of both kinds stand side by side in a group, and are combined before the
    one shuffle. Null foreign keys are no violation. Rules whose tables are not given are left out.
    """
    rules = {parent: [(c, column) for c, column, p in foreign if p == parent and c in frames] for parent in frames}
    width = 1 + max((len(found) for found in rules.values()), default=0)
    parts = []
    for table, df in frames.items():
        entries = [F.struct(F.lit(table).alias("to"), F.lit(0).alias("role"), F.col(keys[table]).cast("string").alias("key"))]
        for parent, found in rules.items():
            entries += [
                F.struct(F.lit(parent).alias("to"), F.lit(i).alias("role"), F.col(column).cast("string").alias("key")) for i, (child, column) in enumerate(found, 1) if child == table
            ]
        parts.append(df.select(F.inline(F.array(*entries))).where("role = 0 or key is not null"))
    counted = union_standard(parts, ["to", "role", "key"]).groupBy("to", "key").agg(*[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(width)])

    def broken(table: str) -> Column:
        own = F.struct(F.lit(f"pk {table}").alias("rule"), F.when((F.col("n0") > 1) | (F.col("key").isNull() & (F.col("n0") > 0)), F.col("n0")).alias("n_rows"))
        below = [
            F.struct(F.lit(f"fk {child}.{column}").alias("rule"), F.when(F.col("n0") == 0, F.col(f"n{i}")).alias("n_rows")) for i, (child, column) in enumerate(rules[table], 1)
        ]
        return F.array(own, *below)

    cases = F.lit(None)
    for table in frames:
        cases = F.when(F.col("to") == table, broken(table)).otherwise(cases)
    return counted.select("key", F.inline(cases)).where("n_rows > 0").select("rule", "key", "n_rows")

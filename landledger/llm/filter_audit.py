"""How filters share the work: what each of five filters removes in every order in which they can be applied.

Every document gets a mask of the filters that it fails, whatever the order. Masks are counted per part, so that at most 2^5 cells
of a part are left of all its documents. A cell then folds across an array of all orders: ``transform`` walks the orders,
``aggregate`` the steps of one, and the cell's counts land in one of 5 x 120 structs. The arrays of a part's cells are added up
place by place.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import materialize

LETTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SPACES = r"[\x20\x09-\x0D]+"


def text_mask(text: str) -> dict[str, Column]:
    """Conditions of filters A to D over a text column that holds no null and an array column ``words``."""
    n = F.size("words").cast("long")
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct("words")).cast("long") < 50 * n,
        "C": 100 * F.regexp_count(F.col(text), F.lit("[A-Z]")).cast("long") > 2 * F.char_length(text).cast("long"),
        "D": F.col(text).rlike("[#$%&*|]"),
    }


def masked(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source",
) -> DataFrame:
    """(doc_id, part, mask): one row per row of ``documents``; bit i of the mask is set if filter ``LETTERS[i]`` fails.

    Null texts are empty and equal to empty ones, null parts are ''. E fails where a smaller id has the same text: rows that repeat
    the smallest id pass it, a null id is neither smaller nor larger than another. Equal texts are told by their SHA-256; only
    digests that two ids share meet the rows again, and a text with very many copies is split by Spark's skew join.
    """
    rows = documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).withColumn("words", F.array_remove(F.split("text", SPACES), ""))
    bits = sum((F.when(failed, 1 << LETTERS.index(letter)).otherwise(0) for letter, failed in text_mask("text").items()), F.lit(0))
    rows = materialize(rows.select("doc_id", "part", bits.alias("bits"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")), "audit-masks")
    shared = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = materialize(shared.where("first < last").select("digest", "first"), "audit-copies")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << LETTERS.index("E")).otherwise(0)
    return rows.join(shared, "digest", "left").select("doc_id", "part", (F.col("bits") + copy).alias("mask"))


def cells(masks: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask, and those labelled quality 1 and toxic 1.

    An id with several labels is good, or toxic, if any of them says so; null ids have no labels.
    """
    marks = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("labelled")).agg(
        F.bool_or(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.bool_or(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    ).where("good or toxic")
    joined = masks.join(marks, F.col("doc_id") == F.col("labelled"), "left")
    return joined.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def orders_of(letters: str) -> list[str]:
    return ["".join(order) for order in permutations(letters)]


def folded(cell_rows: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step from (part, mask, n, good, toxic): filter_order, step, ``COUNTS`` and shapley.

    The orders are one literal array, made once; a part gathers its cells, 2^k at most for k filters, and every sum is exact.
    """
    k, names = len(letters), orders_of(letters)
    orders = "array(" + ", ".join("array(" + ", ".join(str(letters.index(c)) for c in name) + ")" for name in names) + ")"
    of_type = "array<struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">>"
    hit, bit = "(c.mask & shiftleft(1, f)) <> 0", "shiftleft(1, f)"
    step = f"""
        named_struct(
            'kept', if(s.gone or {hit}, 0L, c.n), 'removed', if({hit} and not s.gone, c.n, 0L), 'redundant', if({hit} and s.gone, c.n, 0L),
            'unique_fails', if(c.mask = {bit}, c.n, 0L), 'good_lost', if({hit} and not s.gone, c.good, 0L), 'toxic_lost', if({hit} and not s.gone, c.toxic, 0L))
    """
    one_cell = f"""
        flatten(transform(orders, o -> aggregate(o, named_struct('gone', false, 'steps', cast(array() as {of_type})),
            (s, f) -> named_struct('gone', s.gone or {hit}, 'steps', concat(s.steps, array({step}))), s -> s.steps)))
    """
    added = "named_struct(" + ", ".join(f"'{c}', a.{c} + b.{c}" for c in COUNTS) + ")"
    zero = "named_struct(" + ", ".join(f"'{c}', 0L" for c in COUNTS) + ")"
    parts = cell_rows.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")).withColumn("orders", F.expr(orders))
    summed = parts.select("part", F.expr(f"aggregate(cells, array_repeat({zero}, {k * len(names)}), (t, c) -> zip_with(t, {one_cell}, (a, b) -> {added}))").alias("steps"))
    shapley = f"""
        aggregate(zip_with(steps, flatten({orders}), (s, f) -> named_struct('f', f, 'removed', s.removed)), array_repeat(0L, {k}),
            (t, x) -> transform(t, (v, i) -> v + if(i = x.f, x.removed, 0L)))
    """
    rows = summed.select("part", F.expr(shapley).alias("shares"), F.posexplode("steps").alias("place", "s"))
    order = F.element_at(F.lit(names), F.expr(f"cast(place div {k} as int)") + 1)
    rows = rows.select("part", order.alias("filter_order"), (F.col("place") % k + 1).cast("int").alias("step"), "s.*", "shares")
    return rows.select(
        "part", "filter_order", "step", *COUNTS,
        F.expr(f"shares[instr('{letters}', substring(filter_order, step, 1)) - 1]").alias("shapley"),
    )


def audit(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source",
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of filters A to E.

    600 rows per part, zeros included; no documents, no rows. A text is read once and never moved.
    """
    return folded(cells(masked(documents, id_column, text_column, part_column), labels))


ORACLE = r"""
    with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    m as (select doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text),
        regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) over (partition by text), false)] as fails from d),
    y as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
    c as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from m left join y using (doc_id) group by part, fails),
    l(i, letter) as (values (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')),
    o as (select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.i, b.i, c.i, d.i, e.i] as f from l a, l b, l c, l d, l e
        where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    s as (select part, filter_order, step, f[step] as filter, n, good, toxic, fails[f[step]] as fail, len(list_filter(f[1:step - 1], lambda i: fails[i])) > 0 as gone,
        len(list_filter(fails, lambda x: x)) = 1 as alone from c, o, (select cast(unnest(range(1, 6)) as integer) as step)),
    r as (select part, filter_order, step, filter,
        cast(sum(if(fail or gone, 0, n)) as bigint) as kept, cast(sum(if(fail and not gone, n, 0)) as bigint) as removed, cast(sum(if(fail and gone, n, 0)) as bigint) as redundant,
        cast(sum(if(fail and alone, n, 0)) as bigint) as unique_fails, cast(sum(if(fail and not gone, good, 0)) as bigint) as good_lost,
        cast(sum(if(fail and not gone, toxic, 0)) as bigint) as toxic_lost from s group by all)
    select * exclude (filter), cast(sum(removed) over (partition by part, filter) as bigint) as shapley from r
"""

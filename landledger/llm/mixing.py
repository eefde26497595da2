"""Interleaving sources by target weights, as a proportionate fair schedule, in DataFrame operations only.

Every source is cut into blocks of about equal text. With ``k`` of ``W`` slots, its block j may not start before slot
floor(j W / k), its release, and must be placed before slot ceil((j + 1) W / k), its deadline. In each slot the released
block with the earliest deadline is placed; as the k add up to W, no deadline is missed, so after every slot each source has its
share of the slots to within one block. The schedule repeats after W slots: W steps are worked out once, in one row, and all blocks
look up their slot, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.common import materialize, parts_for

# Rows numbered by one window.
WINDOW_ROWS = 20_000
# Width of the place that orders the documents of a source: 15 hexadecimal digits.
PLACE_BITS = 60


def target_slots(sizes: DataFrame, weights: DataFrame | None = None, temper: float = 0.7, slots: int = 1024) -> DataFrame:
    """(source, k, total): the slots of each source out of ``total``.

    ``sizes``: (source, chars). ``weights``: (source, weight), any positive numbers; a source without one, or with none above
    0, gets the least of those given. By default a source weighs chars ** ``temper``. Every source gets one slot, and the rest
    by largest remainders, ties by name. ``total`` is ``slots``, or its least multiple of at least 16 slots a source.
    """
    rows = sizes.withColumn("weight", F.pow(F.greatest(F.col("chars"), F.lit(1)).cast("double"), F.lit(temper)))
    if weights is not None:
        given = weights.groupBy("source").agg(F.max(F.when(F.col("weight") > 0, F.col("weight").cast("double"))).alias("given"))
        given = given.select(F.col("source").alias("of"), "given")
        everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.join(given, F.col("source").eqNullSafe(F.col("of")), "left").withColumn(
            "weight", F.coalesce("given", F.min("given").over(everything), F.lit(1.0))
        )
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = rows.select(
        "source", (F.col("weight") / F.sum("weight").over(everything)).alias("share"), F.count("*").over(everything).alias("n"),
    ).withColumn("total", (F.lit(slots) * F.ceil(F.col("n") * 16 / slots)).cast("long"))
    wanted = shared.withColumn("wanted", F.col("share") * (F.col("total") - F.col("n"))).withColumn("base", F.floor("wanted").cast("long"))
    left = F.col("total") - F.col("n") - F.sum("base").over(everything)
    turn = F.row_number().over(Window.orderBy(F.desc(F.col("wanted") - F.col("base")), F.col("source").asc_nulls_first()))
    return wanted.select("source", (1 + F.col("base") + (turn <= left).cast("long")).alias("k"), "total")


def timetable(slots: DataFrame) -> DataFrame:
    """(source, nth, slot, k, total): earliest deadline first over one period, from (source, k, total)."""
    table = slots.groupBy("total").agg(F.sort_array(F.collect_list(F.struct("source", "k"))).alias("s"))
    table = table.select("total", "s", F.expr("transform(s, x -> x.k)").alias("k"))
    # done: blocks placed of each source. A step finds the released block of the earliest deadline, then counts it.
    released = "filter(transform(k, (w, i) -> struct((state.done[i] * total + total + w - 1) div w as deadline, i as i, " \
        "state.done[i] * total div w as release)), c -> c.release <= t)"
    step = f"""
        transform(array(array_min({released}).i), p -> named_struct(
            'done', transform(state.done, (x, i) -> x + if(i = p, 1L, 0L)), 'placed', concat(state.placed, array(p))))[0]
    """
    placed = table.select(
        "s", "total",
        F.expr(f"""
            aggregate(sequence(0L, total - 1), named_struct('done', transform(k, w -> 0L), 'placed', cast(array() as array<int>)),
                (state, t) -> {step}).placed
        """).alias("placed"),
    )
    rows = placed.select("s", "total", F.posexplode("placed").alias("slot", "i"))
    nth = F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1
    return rows.select(
        F.expr("s[i].source").alias("source"), nth.cast("long").alias("nth"), F.col("slot").cast("long").alias("slot"),
        F.expr("s[i].k").alias("k"), "total",
    )


def hashed_place(column: str | Column) -> Column:
    """A number of ``PLACE_BITS`` bits from the MD5 of a value's text; null has place 0."""
    digits = F.substring(F.md5(F.col(column).cast("string") if isinstance(column, str) else column), 1, PLACE_BITS // 4)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0))


def interleaved(
    documents: DataFrame, weights: DataFrame | None = None, temper: float = 0.7, block_chars: int = 65_536, slots: int = 1024,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """All rows and columns of ``documents`` with mix_start, mix_block, mix_slot, mix_k and mix_total.

    Read in the order of (mix_slot, mix_start), each source has ``mix_k / mix_total`` of the slots to within one block, for as long
    as it has blocks. ``mix_start`` counts the characters of the source before the document, in the order of a hash of its id
    (then id, then text); its block is the one in which it starts, and a text longer than a block leaves the blocks it covers
    empty. Null sources are a source of their own, null texts have no characters; repeated rows stand next to each
    other. Columns of the new names that were there before are replaced. Nothing is dropped or repeated.
    """
    bits = (parts_for(documents.count(), WINDOW_ROWS) - 1).bit_length()
    added = ("mix_start", "mix_block", "mix_slot", "mix_k", "mix_total")
    # The caller's row travels in one column, so that no name of its own meets one of these; its text beside it, for it sorts rows.
    others = [c for c in documents.columns if c != text_column]
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), *[F.col(f"`{c}`").alias(name) for c, name in ((source_column, "source"), (id_column, "id"), (text_column, "text"))],
    ).withColumns({"size": F.coalesce(F.char_length("text"), F.lit(0)).cast("long"), "place": hashed_place("id")})
    rows = rows.withColumn("part", F.shiftright(F.col("place"), PLACE_BITS - bits))
    # Sizes of the parts of each source: what stands before a part is added to what stands before a row inside it.
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("chars"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(parts.select("source", "part", "chars", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("offset")), "mix-offsets")
    plan = materialize(timetable(target_slots(offsets.groupBy("source").agg(F.sum("chars").alias("chars")), weights, temper, slots)), "mix-timetable")
    within = Window.partitionBy("source", "part").orderBy("place", "id", "text").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("start", F.sum("size").over(within) - F.col("size"))
    offsets = offsets.select(F.col("source").alias("o_source"), F.col("part").alias("o_part"), "offset")
    placed = numbered.join(
        offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("part") == F.col("o_part")),
    ).withColumn("start", F.col("start") + F.col("offset")).withColumn("block", F.expr(f"start div {int(block_chars)}"))
    shares = plan.select(F.col("source").alias("k_source"), "k", "total").distinct()
    turns = plan.select(F.col("source").alias("t_source"), "nth", F.col("slot").alias("turn"))
    placed = placed.join(shares, F.col("source").eqNullSafe(F.col("k_source")))
    placed = placed.join(turns, F.col("source").eqNullSafe(F.col("t_source")) & (F.expr("block % k") == F.col("nth")))
    return placed.select(
        *[(F.col("text") if c == text_column else F.col("row")[c]).alias(c) for c in documents.columns if c not in added],
        F.col("start").alias("mix_start"), F.col("block").alias("mix_block"), F.expr("block div k * total + turn").alias("mix_slot"),
        F.col("k").alias("mix_k"), F.col("total").alias("mix_total"),
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of ``interleaved`` in their order, without its columns."""
    ordered = mixed.orderBy("mix_slot", "mix_start")
    return ordered.drop("mix_start", "mix_block", "mix_slot", "mix_k", "mix_total")


ORACLE = f"""
    with recursive d as (
        select doc_id, source, text, cast(length(coalesce(text, '')) as bigint) as size,
            coalesce(cast('0x' || md5(cast(doc_id as varchar))[1:15] as bigint), 0) as place from documents
    ), s as (
        select doc_id, source, cast(sum(size) over (partition by source order by place, doc_id, text rows unbounded preceding) - size as bigint) as mix_start from d
    ), w as (select source, pow(greatest(sum(size), 1), 0.7) as weight from d group by source),
    n as (select source, weight / sum(weight) over () as share, count(*) over () as n, 1024 * cast(ceil(count(*) over () * 16 / 1024) as bigint) as total from w),
    f as (select *, share * (total - n) as wanted, cast(floor(share * (total - n)) as bigint) as base from n),
    k as (select source, total, 1 + base + cast(row_number() over (order by wanted - base desc, source nulls first) <= total - n - sum(base) over () as bigint) as k from f),
    a as (select list(k order by source nulls first) as ks, list(source order by source nulls first) as sources, any_value(total) as total from k),
    e(t, done, pick) as (
        select cast(-1 as bigint), list_transform(ks, lambda x: cast(0 as bigint)), cast(0 as bigint) from a
        union all
        select t + 1, list_transform(done, lambda x, i: x + cast(i = chosen as bigint)), chosen from (
            select t, done, list_min(list_filter(list_transform(ks, lambda w, i: {{'deadline': (done[i] * total + total + w - 1) // w, 'i': i, 'release': done[i] * total // w}}),
                lambda c: c.release <= t + 1)).i as chosen
            from e, a where t + 1 < total)
    ), turns as (
        select sources[pick] as source, t as slot, row_number() over (partition by pick order by t) - 1 as nth from e, a where t >= 0
    )
    select s.doc_id, s.source, s.mix_start, s.mix_start // 65536 as mix_block,
        (s.mix_start // 65536) // k.k * k.total + turns.slot as mix_slot, k.k as mix_k, k.total as mix_total
    from s join k on s.source is not distinct from k.source
    join turns on s.source is not distinct from turns.source and (s.mix_start // 65536) % k.k = turns.nth
"""

"""Quoted CSV of any size in one pass over its lines.

Whether a line lies inside a quoted field depends on all quotes before it. Every split of a file therefore sums up its lines for both
cases, begun outside and inside quotes: records, fields per record, what is left open. The summaries, two rows a split, are chained by
a prefix sum of quote parities; that settles which case holds, and with it everything a load has to know about a file.
A second pass knows how each split begins: it hands on whole records, and pieces of those that cross a split's end.

Quotes toggle, a doubled quote inside toggles twice, and commas and line ends count outside only. Lines of nothing are no records.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A header longer than this is damage: it would be one record of a file whose first quote never closes.
MOST_HEADER = 1 << 20
SUMMARY = "file long, block long, start int, parity int, started long, head long, tail long, first long, second long, header string, blank boolean, fields long, n long"


def steady(spark: SparkSession, split_bytes: int = 64 << 20) -> SparkSession:
    """A session whose text splits depend on the file alone, not on what else is read: both passes see the same ones."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return session


def plain_path(column: Column | str) -> Column:
    """A file's path as the file list spells it. It is worked out for every line, so only a path with escapes is decoded."""
    column = F.col(column) if isinstance(column, str) else column
    local = F.concat(F.lit("file:/"), F.ltrim(F.substring(column, len("file:") + 1, 1 << 30), F.lit("/")))
    path = F.when(column.startswith("file:/"), local).otherwise(column)
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, block, value): lines with a number for their file and the start of their split, in order within a task.

    Bytes that are not UTF-8 are replaced.
    """
    read = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    return read.select(F.xxhash64(plain_path("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.make_valid_utf8("value").alias("value"))


@dataclass
class Lines:
    """Per line of an array: quotes, commas outside quotes if it begins outside and if it begins inside, and whether it is empty."""

    quotes: np.ndarray
    commas: tuple[np.ndarray, np.ndarray]
    blank: np.ndarray


def counted(values: pa.Array) -> Lines:
    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
    if not quotes.any():
        # The usual case: all commas count alike, and no line is inside quotes unless its first one is.
        blank = pc.or_(pc.equal(pc.binary_length(values), 0), pc.equal(values, "\r")).to_numpy(zero_copy_only=False)
        return Lines(np.zeros(len(values), np.int64), (pc.count_substring(values, ",").to_numpy(zero_copy_only=False).astype(np.int64), np.zeros(len(values), np.int64)), blank)
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]] if buffer else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(values)
    lengths = np.diff(offsets)
    blank = lengths == 0
    short = np.flatnonzero(lengths == 1)
    blank[short] = data[offsets[short]] == 13
    quote_at, comma_at = np.flatnonzero(data == 34), np.flatnonzero(data == 44)
    line = np.searchsorted(offsets, comma_at, "right") - 1
    if not quote_at.size:
        return Lines(np.zeros(n, np.int64), (np.bincount(line, minlength=n), np.zeros(n, np.int64)), blank)
    before = np.searchsorted(quote_at, offsets)
    inside = (np.searchsorted(quote_at, comma_at) - before[line]) & 1
    return Lines(np.diff(before), (np.bincount(line[inside == 0], minlength=n), np.bincount(line[inside == 1], minlength=n)), blank)


@dataclass
class Case:
    """What a split amounts to if it begins outside (0) or inside (1) quotes."""

    start: int
    now: int = 0
    started: int = 0
    head: int = 0
    open: int = 0
    known: list[int] = field(default_factory=list)
    fields: dict[int, int] = field(default_factory=dict)
    header: list[str] = field(default_factory=list)
    size: int = 0

    def __post_init__(self):
        self.now = self.start

    def close(self, numbers: np.ndarray) -> None:
        """Count finished records by their fields."""
        if len(self.known) < 2:
            self.known += numbers[: 2 - len(self.known)].tolist()
        if len(numbers) and (numbers == numbers[0]).all():
            found = [(int(numbers[0]), len(numbers))]
        else:
            found = zip(*(x.tolist() for x in np.unique(numbers, return_counts=True)))
        for value, n in found:
            self.fields[value] = self.fields.get(value, 0) + n

    def add(self, part: Lines, values: pa.Array) -> None:
        inside = (self.now + np.cumsum(part.quotes) - part.quotes) & 1
        commas = np.where(inside == 0, part.commas[0], part.commas[1])
        begin = np.flatnonzero((inside == 0) & ~part.blank)
        if self.start == 0 and self.started < 2 and self.size <= MOST_HEADER:
            stop = begin[1 - self.started] if len(begin) > 1 - self.started else len(values)
            first = 0 if self.started else (begin[0] if len(begin) else len(values))
            piece = values.slice(first, stop - first).to_pylist()
            self.header += piece
            self.size += sum(map(len, piece))
        if not len(begin):
            if self.started:
                self.open += int(commas.sum())
            else:
                self.head += int(commas.sum())
        else:
            front = int(commas[: begin[0]].sum())
            if self.started:
                self.close(np.array([self.open + front + 1]))
            else:
                self.head += front
            sums = np.add.reduceat(commas, begin)
            self.close(sums[:-1] + 1)
            self.open, self.started = int(sums[-1]), self.started + len(begin)
        self.now = int(self.now + part.quotes.sum()) & 1

    def rows(self, file: int, block: int, parity: int, blank: bool) -> list[dict]:
        ends_inside = self.now == 1
        if self.started and not ends_inside:
            self.close(np.array([self.open + 1]))
        same = {"file": file, "block": block, "start": self.start}
        whole = self.known or not ends_inside
        header = "\n".join(self.header) if self.start == 0 and block == 0 and self.started and self.size <= MOST_HEADER and whole else None
        return [same | {
            "parity": parity, "started": self.started, "head": self.head, "tail": self.open if self.started and ends_inside else None,
            "first": self.known[0] if block == 0 and self.known else None, "second": self.known[1] if block == 0 and len(self.known) > 1 else None,
            "header": header.rstrip("\r\n") if header is not None else None, "blank": blank,
        }] + [same | {"fields": f, "n": n} for f, n in self.fields.items()]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(file, block, rows) of the stretches of a task's rows that come from one split, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield int(file[a]), int(block[a]), batch.slice(a, b - a)


def summarised(rows: DataFrame) -> DataFrame:
    """``SUMMARY`` rows of ``lines``: per split and case one with its totals, and one for each number of fields a record has."""
    schema = pa.schema([
        (name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}[kind]) for name, kind in (c.split() for c in SUMMARY.split(", "))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cases, quotes, blank = None, [], 0, False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row for case in cases for row in case.rows(*at, quotes & 1, blank)], schema=schema)

        for file, block, part in runs(batches):
            numbers = counted(part.column(2))
            if at != (file, block):
                if at:
                    yield done()
                at, cases, quotes, blank = (file, block), [Case(0), Case(1)], 0, bool(block == 0 and numbers.blank[0])
            quotes += int(numbers.quotes.sum())
            for case in cases:
                case.add(numbers, part.column(2))
        if at:
            yield done()

    return rows.mapInArrow(run, SUMMARY)


def chained(summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(splits, files) from written ``SUMMARY`` rows.

    ``splits``: (file, block, inside, before, started) with ``inside`` whether it begins inside quotes and the number of records
    begun before it. ``files``: (file, header, blank, first, second, records, open, counts): ``counts`` maps fields to records,
    the header's included; ``first`` and ``second`` are the fields of the first two records.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = summary.where("parity is not null")
    parity = totals.where("start = 0").select("file", "block", F.pmod(F.coalesce(F.sum("parity").over(earlier), F.lit(0)), F.lit(2)).alias("start"))
    held = totals.join(parity.withColumn("start", F.col("start").cast("int")), ["file", "block", "start"])
    held = held.withColumn("before", F.coalesce(F.sum("started").over(earlier), F.lit(0)))
    # Records that cross a split's end: their beginning, and what later splits add.
    heads = held.where("start = 1").select("file", F.col("before").alias("record"), F.col("head").alias("commas"))
    tails = held.where("tail is not null").select("file", (F.col("before") + F.col("started")).alias("record"), F.col("tail").alias("commas"))
    crossing = heads.unionByName(tails).groupBy("file", "record").agg((F.sum("commas") + 1).alias("fields")).select(
        "file", "fields", F.lit(1).cast("long").alias("n"), F.when(F.col("record") == 1, F.col("fields")).alias("first"), F.when(F.col("record") == 2, F.col("fields")).alias("second"),
    )
    inner = summary.where("fields is not null").join(held.select("file", "block", "start"), ["file", "block", "start"]).select("file", "fields", "n")
    counts = inner.unionByName(crossing.select("file", "fields", "n")).groupBy("file", "fields").agg(F.sum("n").alias("n"))
    counts = counts.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("fields", "n"))).alias("counts"))
    known = crossing.groupBy("file").agg(F.max("first").alias("first2"), F.max("second").alias("second2"))
    files = held.groupBy("file").agg(
        F.max("header").alias("header"), F.bool_or("blank").alias("blank"), F.max("first").alias("first1"), F.max("second").alias("second1"),
        F.sum("started").alias("records"), (F.sum("parity") % 2 == 1).alias("open"),
    ).join(counts, "file", "left").join(known, "file", "left")
    return held.select("file", "block", (F.col("start") == 1).alias("inside"), "before", "started"), files.select(
        "file", "header", "blank", F.coalesce("first1", "first2").alias("first"), F.coalesce("second1", "second2").alias("second"), "records", "open", "counts",
    )


def records(rows: DataFrame) -> DataFrame:
    """(file, block, piece, record) of ``lines`` with ``inside``, null counting as outside, less the first record of each file.

    ``piece`` is null for whole records, 0 for the end of a record that began in an earlier split, 1 for the beginning of one that goes on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now, held, skip, head = None, 0, None, False, False

        def out(found: list[str] | pa.Array, piece: int | None = None) -> pa.RecordBatch:
            texts = found if isinstance(found, pa.Array) else pa.array(found, pa.string())
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(at[0], pa.int64()), n), pa.repeat(pa.scalar(at[1], pa.int64()), n), pa.repeat(pa.scalar(piece, pa.int32()), n), texts], ["file", "block", "piece", "record"],
            )

        def closed() -> Iterator[pa.RecordBatch]:
            """The record still open when a split ends."""
            if held is not None and not skip:
                text = "\n".join(held)
                if head:
                    yield out([text if now else text.removesuffix("\r")], 0)
                else:
                    yield out([text], 1) if now else out([text.removesuffix("\r")])

        def before_next() -> Iterator[pa.RecordBatch]:
            """The record still open when another begins."""
            if held is not None and not skip:
                yield out(["\n".join(held).removesuffix("\r")], 0 if head else None)

        for file, block, part in runs(batches):
            values = part.column(2)
            if at != (file, block):
                if at:
                    yield from closed()
                at, now = (file, block), int(bool(part.column(3)[0].as_py()))
                held, skip, head = ([] if now else None), block == 0, bool(now)
            numbers = counted(values)
            inside = (now + np.cumsum(numbers.quotes) - numbers.quotes) & 1
            begin = np.flatnonzero((inside == 0) & ~numbers.blank)
            now = int(now + numbers.quotes.sum()) & 1
            if len(begin) == len(values) and not now:
                # Every line is a record, the usual case: they go on as they are, but for the one before and the last.
                yield from before_next()
                skip_one = 1 if skip and held is None else 0
                if held is not None or skip_one:
                    skip = False
                whole = values.slice(skip_one, len(values) - 1 - skip_one) if len(values) > skip_one else values.slice(0, 0)
                if len(whole):
                    yield out(pc.replace_substring_regex(whole, r"\r$", "") if pc.any(pc.ends_with(whole, "\r")).as_py() else whole)
                head = False
                if skip_one and len(values) == 1:
                    held, skip = [values[0].as_py()], True
                else:
                    held = [values[len(values) - 1].as_py()]
                continue
            texts = values.to_pylist()
            front = texts[: begin[0]] if len(begin) else texts
            if held is not None:
                # Blank lines outside quotes belong to no record.
                stop = len(front)
                outside = np.flatnonzero((inside[:stop] == 0) & numbers.blank[:stop])
                held += front if not len(outside) else front[: outside[0]]
            found = []
            for i, a in enumerate(begin.tolist()):
                if held is not None:
                    if skip:
                        skip = False
                    elif head:
                        yield out(["\n".join(held).removesuffix("\r")], 0)
                    else:
                        found.append("\n".join(held).removesuffix("\r"))
                    head = False
                b = int(begin[i + 1]) if i + 1 < len(begin) else len(texts)
                outside = np.flatnonzero((inside[a + 1:b] == 0) & numbers.blank[a + 1:b])
                held = texts[a:a + 1 + int(outside[0])] if len(outside) else texts[a:b]
            if found:
                yield out(found)
        if at:
            yield from closed()

    return rows.mapInArrow(run, "file long, block long, piece int, record string")


def rejoined(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, record): the records that the ``pieces`` of ``records`` make up; a handful per split."""
    place = F.when(F.col("piece") == 0, F.col("before")).otherwise(F.col("before") + F.col("started"))
    placed = pieces.join(splits, ["file", "block"]).select("file", place.alias("nth"), F.struct("block", "record").alias("piece"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["record"]), "\n")
    return placed.where("nth > 1").groupBy("file", "nth").agg(text.alias("record")).select("file", "record")

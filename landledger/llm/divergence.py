"""How far the sources of a language differ in their words: exact, smoothed term shares of every source against every other.

Terms are counted by document first; those of enough documents make the language's vocabulary. It is range-partitioned in byte
order, each range becomes minimal acyclic transducers, and their files go to the shared folder. The texts are then streamed through
the transducers and recounted as ordinals, small numbers that sort as the terms do, which also break ties. Pairs of sources are
compared in blocks of ordinals by blocks of sources. A worker holds transducers up to a stated size, whatever the vocabulary's.
"""

from __future__ import annotations

import re
from collections import Counter, OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.common import as_bytes, materialize, parts_for, scratch_path
from landledger.llm.transducer import LOWER, Builder, Transducer, prefix, prefixes, words

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
# Sizes of work, none of which bears on a result: text and entries a worker holds at a time, states of one transducer, bytes of
# transducers kept open, ordinals and sources of one comparison.
SLICE, ENTRIES, STATES, HELD = 4 << 20, 200_000, 16_384, 128 << 20
BLOCK, TILE = 1024, 256
SCALE, SMOOTH = 1_000_000_000, 5
WIDE = "decimal(38,0)"


def slices(text: bytes, most: int = SLICE) -> Iterator[bytes]:
    """A text in pieces of about ``most`` bytes that cut no term."""
    start = 0
    while len(text) - start > most:
        stop = start + most
        if TERM.match(text, stop - 1, stop):
            after = TERM.match(text, stop)
            stop = after.end() if after else stop
        yield text[start:stop]
        start = stop
    yield text[start:]


def document_counts(rows: DataFrame) -> DataFrame:
    """(lang, term, n_docs): rows of (lang, source, text) in which each term occurs; combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                terms = pa.array(list(found), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), terms, pa.array(list(found.values()), pa.int64())], ["lang", "term", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(2))):
                found: set[bytes] = set()
                for piece in slices(text):
                    found.update(TERM.findall(piece.lower()))
                counts.setdefault(lang, Counter()).update(found)
                if sum(map(len, counts.values())) > ENTRIES:
                    yield from flush()
        yield from flush()

    counted = rows.mapInArrow(run, "lang string, term string, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n_docs"))


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


@dataclass
class Vocabulary:
    """Where the transducers are: per language, in term order, (path, first and last prefix, ordinal of the first term)."""

    index: dict[str, list[tuple[str, int, int, int]]]
    sizes: dict[str, int]

    def reader(self) -> "Reader":
        return Reader(self)


class Reader:
    """Opens transducers as they are needed and keeps the last used ones, up to ``HELD`` bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.open: OrderedDict[str, Transducer] = OrderedDict()

    def transducer(self, path: str) -> Transducer:
        if path in self.open:
            self.open.move_to_end(path)
            return self.open[path]
        files, name = opened(path)
        row = pyarrow.parquet.read_table(name, filesystem=files).to_pylist()[0]
        found = Transducer(
            row["terms"], np.frombuffer(row["symbols"], row["kind"]), np.frombuffer(row["follow"], np.int32).reshape(row["states"], -1),
            np.frombuffer(row["before"], np.int32).reshape(row["states"], -1), np.frombuffer(row["final"], bool), row["states"] - 1,
        )
        self.open[path] = found
        while len(self.open) > 1 and sum(t.bytes_held for t in self.open.values()) > HELD:
            self.open.popitem(last=False)
        return found

    def ordinals(self, lang: str, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ordinals in the language's vocabulary, -1 for other words. A word meets the transducers of its first bytes only."""
        result = np.full(len(starts), -1, dtype=np.int64)
        shards = self.vocabulary.index.get(lang, [])
        if len(shards) == 1:
            return self.transducer(shards[0][0]).ordinals(data, starts, lengths)
        keys = prefixes(data, starts, lengths)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        for path, first, last, offset in shards:
            some = order[np.searchsorted(keys, np.uint64(first), "left"):np.searchsorted(keys, np.uint64(last), "right")]
            if some.size:
                found = self.transducer(path).ordinals(data, starts[some], lengths[some])
                hit = found >= 0
                result[some[hit]] = found[hit] + offset
        return result

    def term(self, lang: str, ordinal: int) -> bytes:
        shards = self.vocabulary.index[lang]
        at = np.searchsorted([s[3] for s in shards], ordinal, "right") - 1
        return self.transducer(shards[at][0]).term(ordinal - shards[at][3])


def vocabulary(kept: DataFrame) -> Vocabulary:
    """Transducers of (lang, term), one file each, from ranges of terms in byte order. The driver gets a row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, of = Builder(), None

        def done() -> pa.RecordBatch:
            t = builder.finish()
            row = {
                "lang": of, "first": prefix(first), "last": prefix(builder.last), "first_term": first, "terms": t.terms, "states": len(t.final),
                "kind": t.symbols.dtype.str, "symbols": t.symbols.tobytes(), "follow": t.follow.tobytes(), "before": t.before.tobytes(), "final": t.final.tobytes(),
            }
            row |= {"first": row["first"] - (1 << 63), "last": row["last"] - (1 << 63)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([
            ("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("first_term", pa.binary()), ("terms", pa.int64()), ("states", pa.int64()),
            ("kind", pa.string()), ("symbols", pa.binary()), ("follow", pa.binary()), ("before", pa.binary()), ("final", pa.binary()),
        ])
        first = b""
        for batch in batches:
            for lang, term in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                if builder.terms and (lang != of or builder.states >= STATES):
                    yield done()
                    builder = Builder()
                if not builder.terms:
                    of, first = lang, term
                builder.add(term)
        if builder.terms:
            yield done()

    spark = kept.sparkSession
    ranged = kept.select("lang", "term").repartitionByRange(parts_for(kept.count(), 8 * BLOCK, 4), "lang", "term").sortWithinPartitions("lang", "term")
    path = scratch_path(spark, "transducers")
    columns = "lang string, first long, last long, first_term binary, terms long, states long, kind string, symbols binary, follow binary, before binary, final binary"
    ranged.mapInArrow(run, columns).write.option("maxRecordsPerFile", 1).parquet(path)
    files = spark.read.schema(columns).parquet(path).select("lang", "first", "last", "first_term", "terms", F.col("_metadata.file_path").alias("path"))
    index: dict[str, list[tuple[str, int, int, int]]] = {}
    sizes: dict[str, int] = {}
    for row in sorted(files.collect(), key=lambda r: (r["lang"], bytes(r["first_term"]))):
        offset = sizes.get(row["lang"], 0)
        index.setdefault(row["lang"], []).append((row["path"], row["first"] + (1 << 63), row["last"] + (1 << 63), offset))
        sizes[row["lang"]] = offset + row["terms"]
    return Vocabulary(index, sizes)


def recounted(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of the vocabulary's terms, every text streamed through its language's transducers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = vocab.reader()
        waiting: dict[str, list[tuple[int, bytes]]] = {}
        sources: dict[str, int] = {}
        counted: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        # A key is a source's number and an ordinal; both stay far below their bits.
        shift = np.int64(40)

        def count(lang: str) -> None:
            texts = waiting.pop(lang, [])
            joined = b" ".join(text for _, text in texts)
            data = LOWER[np.frombuffer(joined, np.uint8)]
            begins = np.cumsum([0] + [len(text) + 1 for _, text in texts])[:-1]
            starts, lengths = words(data)
            ordinals = reader.ordinals(lang, data, starts, lengths)
            hit = ordinals >= 0
            owner = np.array([s for s, _ in texts], dtype=np.int64)[np.searchsorted(begins, starts[hit], "right") - 1]
            keys, n = np.unique((owner << shift) | ordinals[hit], return_counts=True)
            old = counted.get(lang)
            if old is not None:
                keys, back = np.unique(np.concatenate((old[0], keys)), return_inverse=True)
                n = np.bincount(back, np.concatenate((old[1], n)).astype(np.float64)).astype(np.int64)
            counted[lang] = (keys, n)

        def flush() -> Iterator[pa.RecordBatch]:
            names = pa.array(list(sources), pa.string())
            for lang, (keys, n) in counted.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), names.take(pa.array(keys >> shift)), pa.array(keys & ((1 << 40) - 1)), pa.array(n, pa.int64())],
                    ["lang", "source", "ordinal", "n"],
                )
            counted.clear()
            sources.clear()

        held: dict[str, int] = {}
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))):
                if lang not in vocab.index:
                    continue
                for piece in slices(text):
                    waiting.setdefault(lang, []).append((sources.setdefault(source, len(sources)), piece))
                    held[lang] = held.get(lang, 0) + len(piece)
                    if held[lang] >= SLICE:
                        count(lang)
                        held[lang] = 0
                if sum(held.values()) > 4 * SLICE or len(sources) > ENTRIES or sum(len(k) for k, _ in counted.values()) > 5 * ENTRIES:
                    for name in list(waiting):
                        count(name)
                    held.clear()
                    yield from flush()
        for name in list(waiting):
            count(name)
        yield from flush()

    return rows.mapInArrow(run, "lang string, source string, ordinal long, n long").groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def share(count: str, total: str, size: str) -> str:
    """SQL for 1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * size)), exact."""
    return f"1 + (cast({SCALE} as {WIDE}) * (cast({count} as decimal(20,0)) + {SMOOTH})) div (cast({total} as decimal(20,0)) + {SMOOTH} * cast({size} as decimal(18,0)))"


def compared(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the summed distance of sources a < b by their numbers, over all kept terms.

    ``counts``: (lang, number, ordinal, p); ``groups``: (lang, number, tiles, blocks, size, zero), ``zero`` the share of a term that
    does not occur. A task gets ``BLOCK`` terms of two tiles of ``TILE`` sources at most. Every block has a row of every source, so
    that terms found on one side only count too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        lang, tile_a, tile_b = (table.column(c)[0].as_py() for c in ("lang", "tile_a", "tile_b"))
        number, ordinal, p = (table.column(c).to_numpy() for c in ("number", "place", "p"))
        base = ordinal < 0
        numbers = np.sort(number[base])
        wide = int(table.column("wide")[0].as_py())
        row = np.searchsorted(numbers, number)
        shares = np.empty((len(numbers), wide), dtype=np.int64)
        shares[row[base]] = p[base][:, None]
        shares[row[~base], ordinal[~base]] = p[~base]
        first, second = np.flatnonzero(numbers // TILE == tile_a), np.flatnonzero(numbers // TILE == tile_b)
        a, b, value = [], [], []
        for i in first:
            others = second[second > i]
            a.append(np.full(len(others), numbers[i]))
            b.append(numbers[others])
            value.append(np.abs(shares[others] - shares[i]).sum(axis=1))
        joined = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (a, b, value)]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(joined[0]), pa.string()), *map(pa.array, joined)], ["lang", "a", "b", "value"])

    tile = (F.col("number") / TILE).cast("long")
    wide = F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK).cast("int")
    bases = groups.select("lang", "number", "tiles", "size", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(-1).alias("place"), F.col("zero").alias("p"))
    found = counts.join(groups.select("lang", "number", "tiles", "size"), ["lang", "number"]).select(
        "lang", "number", "tiles", "size", F.expr(f"ordinal div {BLOCK}").alias("block"), (F.col("ordinal") % BLOCK).cast("int").alias("place"), "p",
    )
    rows = bases.unionByName(found).withColumn("wide", wide).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("lang", F.least(tile, "other").alias("tile_a"), F.greatest(tile, "other").alias("tile_b"), "block", "wide", "number", "place", "p")
    parts = rows.groupBy("lang", "tile_a", "tile_b", "block").applyInArrow(run, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(
    documents: DataFrame, min_docs: int = 30, most_terms: int = 50, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' ranks the other sources of the language by distance, part 'term' the
    terms by how much more of the source than of the language they are, to rank ``most_terms``.

    Nulls are ''. Rows that repeat count each time. A source without kept terms is compared all the same; where a language keeps
    no term, all its distances are 0 and there are no terms. Texts are read twice and never moved; a term of any length stays
    whole. No documents, no rows. The number of pairs of sources is the number of rows asked for.
    """
    rows = documents.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))
    ])
    kept = materialize(document_counts(rows).where(F.col("n_docs") >= min_docs).select("lang", "term"), "kept-terms")
    vocab = vocabulary(kept)
    counts = materialize(recounted(rows, vocab), "recounts")

    # One row per source of a language: its number, its total, and the vocabulary's size.
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    groups = rows.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    groups = groups.join(sizes, "lang", "left").na.fill(0, ["total", "size"])
    everyone = Window.partitionBy("lang")
    groups = materialize(groups.select(
        "lang", "source", "total", "size", (F.row_number().over(everyone.orderBy("source")) - 1).cast("long").alias("number"),
        F.ceil(F.count(F.lit(1)).over(everyone) / TILE).cast("long").alias("tiles"), F.sum("total").over(everyone).alias("lang_total"),
        F.greatest(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("long").alias("blocks"),
    ).withColumn("zero", F.when(F.col("size") > 0, F.expr(share("0", "total", "size"))).otherwise(0).cast("long")), "divergence-groups")

    of_lang = F.sum("n").over(Window.partitionBy("lang", "ordinal"))
    shares = counts.withColumn("lang_n", of_lang).join(groups.select("lang", "source", "number", "total", "lang_total", "size"), ["lang", "source"]).select(
        "lang", "source", "number", "ordinal", F.expr(share("n", "total", "size")).cast("long").alias("p"), F.expr(share("lang_n", "lang_total", "size")).cast("long").alias("q"),
    )
    shares = materialize(shares, "divergence-shares")

    pairs = compared(shares.select("lang", "number", "ordinal", "p"), groups)
    both = pairs.select("lang", "a", "b", "value").unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("number").alias("a"), "source")
    items = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    named = both.join(names, ["lang", "a"]).join(items, ["lang", "b"])
    nearest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rows = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(nearest).alias("rank"))

    strongest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = shares.where("p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value")).withColumn("rank", F.row_number().over(strongest))
    return pair_rows.unionByName(spelled(best.where(F.col("rank") <= most_terms), vocab))


def spelled(ranked: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Part 'term' with the terms of its ordinals, read off the transducers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = vocab.reader()
        for batch in batches:
            terms = [reader.term(lang, ordinal) for lang, ordinal in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(["term"] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), batch.column(3), batch.column(4)],
                ["lang", "source", "part", "item", "value", "rank"],
            )

    return ranked.select("lang", "source", "ordinal", "value", "rank").mapInArrow(run, "lang string, source string, part string, item string, value long, rank int")


ORACLE = f"""
    with t as (select row_number() over () as i, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
    o as (select i, lang, source, unnest(w) as term from t),
    k as (select lang, term from o group by lang, term having count(distinct i) >= 30),
    v as (select lang, count(*) as v from k group by lang),
    g as (select distinct lang, source from t),
    c as (select lang, source, term, count(*) as n from o join k using (lang, term) group by all),
    d as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
    p as (select lang, source, term, n, 1 + (cast({SCALE} as hugeint) * (n + {SMOOTH})) // (sum(n) over (partition by lang, source) + {SMOOTH} * v.v) as p from d join v using (lang)),
    q as (select lang, term, 1 + (cast({SCALE} as hugeint) * (sum(n) + {SMOOTH})) // (any_value(a.n_all) + {SMOOTH} * any_value(v.v)) as q
        from d join v using (lang) join (select lang, sum(n) as n_all from d group by lang) a using (lang) group by lang, term),
    f as (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),
    pairs as (select x.lang, x.source, 'pair' as part, y.source as item, cast(coalesce(f.value, 0) as bigint) as value
        from g x join g y on x.lang = y.lang and x.source <> y.source left join f on f.lang = x.lang and f.source = x.source and f.item = y.source),
    terms as (select p.lang, p.source, 'term' as part, p.term as item, cast(p.p - q.q as bigint) as value from p join q using (lang, term) where p.n > 0 and p.p > q.q),
    r as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from (select * from pairs union all select * from terms))
    select * from r where part = 'pair' or rank <= 50
"""

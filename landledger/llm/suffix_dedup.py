"""Exact removal of repeated passages by sorting suffixes in buckets.

Every byte covered by a ``WIDTH``-byte string that also starts earlier (in the order of document and start) goes. A suffix at every
byte would be far more data than the text, so suffixes are sorted only where two equal strings must both have one:

1. *Anchors.* A window's anchor is its ``SEED``-byte string with the least hash. Equal windows have their anchors at the same place,
   so two equal windows are always seen from two equal seeds. About 3 % of all positions are anchors.
2. *Repeated seeds.* Hashes of seeds are bucketed and compared; anchors whose seed occurs once in the corpus can't match and end here.
3. *Suffix buckets.* What is left becomes suffixes of ``WIDTH`` bytes with the bytes before them. A task first settles
   what it can alone (a copy of what the task has seen need not travel), then deals the rest over buckets by sampled splitters of the
   leading bytes. A bucket sorts its suffixes by multikey quicksort; in each group of equal seeds, the first start of every window stays.
4. *Boundaries.* A seed that fills several splitters is dealt over all buckets between them; each window that
   such a bucket has not removed goes to a bucket of its own hash, where its bytes are compared. A bucket of suffixes leaves one start of a
   window open, so a seed, however frequent, is never in one task. All other seeds lie inside one bucket.
5. The removed windows of a document are united and cut out.

Hashes choose candidates and pair windows; bytes are compared before anything is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import as_bytes, parts_for, tidy

WIDTH = 100
SEED = 32
LEFT = WIDTH - SEED
CONTEXT = LEFT + WIDTH
# Text handled by one round of array operations, anchors and suffixes a task holds before it sends them on.
CHUNK_BYTES = 1 << 18
HELD_ANCHORS = 1 << 19
HELD_SUFFIXES = 1 << 16
# Rows of a batch that are Python objects at a time.
ROWS = 512
LOWEST = -(1 << 63)
# Buckets of open windows for each bucket of suffixes, as a suffix has up to LEFT + 1 windows.
WINDOW_BUCKETS = 64

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LETTER = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

ANCHORS = "bucket int, known boolean, seed binary, d binary, t binary, at binary"
PLACES = "d long, t long, at int"
SUFFIXES = "bucket int, hot boolean, cut boolean, d binary, t binary, at binary, before binary, after binary, context binary, fresh binary"
WINDOWS = "bucket int, d binary, t binary, start binary, end binary, window binary"
CUTS = "d long, t long, cut binary"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, hash of the seed) of every anchor in ``texts``; texts shorter than a window have none."""
    sizes = np.array([len(text) for text in texts])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not (sizes >= WIDTH).any():
        none = np.array([], np.int64)
        return none, none, none.astype(np.uint64)
    h, span = LETTER[data], 1
    while span < SEED:
        h = h[:-span] * power(BASE, span) + h[span:]
        span *= 2
    h = mixed(h) | np.uint64(1)
    window = LEFT + 1
    least, span = h, 1
    while span * 2 <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:len(h) - LEFT], least[window - span:window - span + len(h) - LEFT])
    for start, end in zip(ends - sizes, ends):
        least[max(start, end - WIDTH + 1):end] = 0  # windows that would run into the next text
    most, span = np.concatenate([np.zeros(LEFT, np.uint64), least, np.zeros(LEFT, np.uint64)]), 1
    while span * 2 <= window:
        most = np.maximum(most[:-span], most[span:])
        span *= 2
    most = np.maximum(most[:len(h)], most[window - span:window - span + len(h)])
    at = np.flatnonzero(most == h)
    number = np.searchsorted(ends, at, "right")
    return number, at - (ends - sizes)[number], h[at]


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def raw(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(as_bytes(column)), kind)


def pieces_of(order: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
    """``order`` cut where the sorted ``keys`` change."""
    return np.split(order, np.flatnonzero(np.diff(keys)) + 1) if len(order) else []


def document_bucket(d: np.ndarray, t: np.ndarray) -> np.ndarray:
    """A number of 44 bits for each document; null ids, and equal ones, part by their texts."""
    return (mixed(d.astype(np.uint64) + mixed(t.astype(np.uint64))) >> np.uint64(20)).astype(np.int64)


def anchor_rows(parts: int):
    """Per task: its anchors by bucket of the seed's hash. Of seeds met twice in the task, one goes to the bucket; all are known already.

    Known ones meet nobody and go to a bucket of their document, so that a frequent seed does not fill one.
    """

    def send(held: list) -> Iterator[pa.RecordBatch]:
        d, t, at, seed = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(seed, kind="stable")
        ordered = seed[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        alone = first & np.concatenate([first[1:], [True]])
        rows = []
        for known, chosen in ((True, order[~alone]), (False, order[first])):
            repeated = ~alone[first] if not known else None
            bucket = (document_bucket(d[chosen], t[chosen]) if known else (seed[chosen] >> np.uint64(40)).astype(np.int64)) % parts
            place = np.argsort(bucket, kind="stable")
            for part in pieces_of(place, bucket[place]):
                i = chosen[part]
                where = at[i].astype(np.int32)
                if not known:
                    where = np.where(repeated[part], -1, where).astype(np.int32)  # for the others to meet; it is known itself
                rows.append((int(bucket[part[0]]), known, b"" if known else raw(seed[i]), raw(d[i]), raw(t[i]), raw(where)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.bool_(), *[pa.binary()] * 4))], names=["bucket", "known", "seed", "d", "t", "at"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in slices(batches):
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = as_bytes(batch.column(2))
            for start, end in chunks(texts):
                number, at, seed = anchors(texts[start:end])
                if len(at):
                    held.append((d[start:end][number], t[start:end][number], at, seed))
                    n += len(at)
                if n >= HELD_ANCHORS:
                    yield from send(held)
                    held, n = [], 0
        if held:
            yield from send(held)

    return run


def per_document(d: np.ndarray, t: np.ndarray) -> list[np.ndarray]:
    """The rows of each document."""
    order = np.lexsort((t, d))
    change = np.flatnonzero((np.diff(d[order]) != 0) | (np.diff(t[order]) != 0)) + 1
    return np.split(order, change) if len(order) else []


def repeated_places(rows: pa.Table) -> pa.Table:
    """Of one bucket, the anchors whose seed another anchor shares."""
    known = rows.column("known").to_numpy(zero_copy_only=False).astype(bool)
    sure, open_ = rows.filter(pa.array(known)), rows.filter(pa.array(~known))
    seed = joined(open_.column("seed"), np.uint64)
    d, t, at = (joined(open_.column(c), k) for c, k in (("d", np.int64), ("t", np.int64), ("at", np.int32)))
    order = np.argsort(seed, kind="stable")
    same = seed[order][1:] == seed[order][:-1]
    shared = np.zeros(len(seed), bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    shared &= at >= 0
    d, t, at = (
        np.concatenate([x[shared], joined(sure.column(c), k)])
        for x, c, k in ((d, "d", np.int64), (t, "t", np.int64), (at, "at", np.int32))
    )
    return pa.table({"d": d, "t": t, "at": at})


def multikey(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by their columns of 8-byte tokens, and the group of equal rows that each place of the order belongs to.

    Sorts by the first token, then only the rows that tie by the next, and so on. Ties stay in the order given.
    """
    n = len(tokens)
    order = np.argsort(tokens[:, 0], kind="stable")
    new = np.concatenate([[True], tokens[order[1:], 0] != tokens[order[:-1], 0]]) if n else np.zeros(0, bool)
    for column in range(1, tokens.shape[1]):
        tied = ~(new & np.concatenate([new[1:], [True]]))
        places = np.flatnonzero(tied)
        if not len(places):
            break
        group = np.cumsum(new)[places]
        rows = order[places]
        inner = np.lexsort((tokens[rows, column], group))
        order[places] = rows = rows[inner]
        group, value = group[inner], tokens[rows, column]
        new[places[1:]] |= (group[1:] == group[:-1]) & (value[1:] != value[:-1]) & (np.diff(places) == 1)
    return order, np.cumsum(new)


def window_firsts(key: np.ndarray) -> np.ndarray:
    """For rows in order, the first row with the same key."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    start = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    first = np.empty(len(key), np.int64)
    first[order] = np.repeat(order[start], np.diff(np.append(start, len(key))))
    return first


def settle(d, t, at, before, after, context) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window removed, last window removed, open windows) per suffix, as offsets before the anchor; -1 where none is removed.

    A window is removed if an earlier suffix of the same group holds the same window. The others are open (a truth value for each
    offset): other buckets' suffixes may still have to be compared with them. ``context`` has ``LEFT`` bytes before the anchor and
    ``WIDTH`` from it on, of which ``before`` and ``after`` lie inside the text. Rows of one place (of repeated rows) count once.
    """
    n = len(at)
    low, high = np.full(n, -1), np.full(n, -1)
    offsets = np.arange(LEFT + 1)
    open_ = (np.maximum(0, WIDTH - after)[:, None] <= offsets) & (offsets <= before[:, None])
    if not n:
        return low, high, open_
    by_place = np.lexsort((at, t, d))
    places = np.stack([d[by_place], t[by_place], at[by_place].astype(np.int64)])
    again = np.concatenate([[False], (places[:, 1:] == places[:, :-1]).all(0)])
    open_[by_place[again]] = False
    by_place = by_place[~again]
    seeds = np.ascontiguousarray(context[by_place][:, LEFT:LEFT + SEED]).view(">u8").astype(np.uint64)
    order, group = multikey(seeds)
    rows = by_place[order]  # by seed, then by place
    text, salt = context[rows], mixed(group.astype(np.uint64) * BASE)
    bounds = before[rows].astype(np.uint64) * np.uint64(1 << 20) + after[rows].astype(np.uint64)
    whole = salt + mixed(bounds + np.uint64(7))
    for column in range(CONTEXT):
        whole = whole * BASE + LETTER[text[:, column]]
    first = window_firsts(mixed(whole))
    copy = (first != np.arange(len(rows))) & (bounds == bounds[first]) & (group == group[first])
    copy[copy] = (text[copy] == text[first[copy]]).all(1)
    nearest = np.maximum(0, WIDTH - after[rows])
    low[rows[copy]], high[rows[copy]], open_[rows[copy]] = nearest[copy], before[rows][copy], False
    # What differs somewhere is compared window by window.
    left = ~copy
    rows, text, salt, nearest = rows[left], text[left], salt[left], nearest[left]
    lonely = np.ones(len(rows), bool)
    lonely[1:] &= salt[1:] != salt[:-1]
    lonely[:-1] &= salt[1:] != salt[:-1]
    rows, text, salt, nearest = rows[~lonely], text[~lonely], salt[~lonely], nearest[~lonely]
    farthest = before[rows].astype(np.int64)
    if not len(rows):
        return low, high, open_
    value = np.zeros(len(rows), np.uint64)
    for column in range(LEFT, CONTEXT):
        value = value * BASE + LETTER[text[:, column]]
    undo, top = np.uint64(pow(int(BASE), -1, 1 << 64)), power(BASE, WIDTH - 1)
    for offset in range(LEFT + 1):
        if offset:
            value = (value - LETTER[text[:, CONTEXT - offset]]) * undo + LETTER[text[:, LEFT - offset]] * top
        real = np.flatnonzero((nearest <= offset) & (offset <= farthest))
        if not len(real):
            continue
        first = real[window_firsts(mixed(value[real] + salt[real]))]
        later = first != real
        i, j = real[later], first[later]
        equal = (salt[i] == salt[j]) & (text[i, LEFT - offset:CONTEXT - offset] == text[j, LEFT - offset:CONTEXT - offset]).all(1)
        gone = rows[i[equal]]
        low[gone] = np.where(low[gone] < 0, offset, low[gone])
        high[gone] = offset
        open_[gone, offset] = False
    return low, high, open_


def united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [start, end); runs that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([new[1:], [True]])]


def cut_rows(d, t, at, low, high, parts: int) -> list[tuple]:
    """Removed stretches of suffixes as rows that go to a bucket of their document."""
    gone = np.flatnonzero(low >= 0)
    rows = []
    if len(gone):
        d, t = d[gone], t[gone]
        start, end = at[gone].astype(np.int64) - high[gone], at[gone].astype(np.int64) - low[gone] + WIDTH
        bucket = document_bucket(d, t) % parts
        place = np.argsort(bucket, kind="stable")
        for part in pieces_of(place, bucket[place]):
            rows.append((int(bucket[part[0]]), False, True, raw(d[part]), raw(t[part]), b"", raw(start[part]), raw(end[part]), b"", b""))
    return rows


def suffix_rows(chosen, bucket, hot: bool, d, t, at, before, after, context, fresh=None) -> list[tuple]:
    """``fresh``: the windows still open, where only these go on."""
    rows = []
    lead = np.ascontiguousarray(context[chosen][:, LEFT:LEFT + SEED]).view(f"S{SEED}").ravel()
    place = np.lexsort((lead, bucket))
    for part in pieces_of(place, bucket[place]):
        i = chosen[part]
        rows.append((
            int(bucket[part[0]]), hot, False, raw(d[i]), raw(t[i]), raw(at[i]), raw(before[i].astype(np.uint8)), raw(after[i].astype(np.uint8)),
            zstandard.ZstdCompressor(level=1).compress(raw(context[i])), b"" if fresh is None else raw(np.packbits(fresh[i], axis=1)),
        ))
    return rows


SUFFIX_KINDS = (pa.int32(), pa.bool_(), pa.bool_(), *[pa.binary()] * 7)
SUFFIX_NAMES = ["bucket", "hot", "cut", "d", "t", "at", "before", "after", "context", "fresh"]


def as_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(SUFFIX_NAMES)
    return pa.table([pa.array(c, k) for c, k in zip(columns, SUFFIX_KINDS)], names=SUFFIX_NAMES)


def unpacked(rows: pa.Table) -> tuple:
    d, t, at = (joined(rows.column(c), k) for c, k in (("d", np.int64), ("t", np.int64), ("at", np.int32)))
    before, after = (joined(rows.column(c), np.uint8).astype(np.int64) for c in ("before", "after"))
    unpack = zstandard.ZstdDecompressor()
    context = np.frombuffer(b"".join(unpack.decompress(x) for x in as_bytes(rows.column("context"))), np.uint8).reshape(-1, CONTEXT)
    return d, t, at, before, after, context


def suffixes(splitters: list[bytes], parts: int):
    """Per task: suffixes at the given places, less those that the task settles alone, by bucket of their leading bytes."""
    fence = np.array(splitters, f"S{SEED}")

    def send(held: list) -> pa.RecordBatch:
        d, t, at, before, after, context = (np.concatenate(x) for x in zip(*held))
        low, high, open_ = settle(d, t, at, before, after, context)
        chosen = np.flatnonzero(open_.any(1))
        lead = np.ascontiguousarray(context[chosen][:, LEFT:LEFT + SEED]).view(f"S{SEED}").ravel()
        left, right = np.searchsorted(fence, lead, "left"), np.searchsorted(fence, lead, "right")
        hot = right - left > 1
        wide = np.where(hot, right - left, 1)
        bucket = right - document_bucket(d[chosen], t[chosen]) % wide
        rows = cut_rows(d, t, at, low, high, parts)
        for kind in (False, True):
            rows += suffix_rows(chosen[hot == kind], bucket[hot == kind], kind, d, t, at, before, after, context)
        return as_table(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        columns = np.arange(CONTEXT)
        for batch in slices(batches):
            ids, ties = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            every, bounds = batch.column(3).values.to_numpy(), batch.column(3).offsets.to_numpy()
            for row, text in enumerate(as_bytes(batch.column(2).field("text"))):
                at = np.unique(every[bounds[row]:bounds[row + 1]])
                padded = np.zeros(len(text) + CONTEXT, np.uint8)
                padded[LEFT:LEFT + len(text)] = np.frombuffer(text, np.uint8)
                for some in np.array_split(at, parts_for(len(at), HELD_SUFFIXES)):
                    held.append((
                        np.full(len(some), ids[row], np.int64), np.full(len(some), ties[row], np.int64), some,
                        np.minimum(some, LEFT).astype(np.int64), np.minimum(len(text) - some, WIDTH).astype(np.int64),
                        padded[some[:, None] + columns],
                    ))
                    n += len(some)
                    if n >= HELD_SUFFIXES:
                        yield from send(held).to_batches()
                        held, n = [], 0
        if held:
            yield from send(held).to_batches()

    return run


def settle_bucket(parts: int):
    """One bucket: stretches pass through; suffixes are settled; suffixes of hot seeds go on with the windows still open."""

    def run(rows: pa.Table) -> pa.Table:
        cut = rows.column("cut").to_numpy(zero_copy_only=False).astype(bool)
        out = [tuple(row[name] for name in SUFFIX_NAMES) for row in rows.filter(pa.array(cut)).to_pylist()]
        for hot in (False, True):
            some = rows.filter(pa.array(~cut & (rows.column("hot").to_numpy(zero_copy_only=False).astype(bool) == hot)))
            d, t, at, before, after, context = unpacked(some)
            low, high, open_ = settle(d, t, at, before, after, context)
            out += cut_rows(d, t, at, low, high, parts)
            if hot and open_.any():
                chosen = np.flatnonzero(open_.any(1))
                out += suffix_rows(chosen, document_bucket(d[chosen], t[chosen]) % parts, True, d, t, at, before, after, context, open_)
        return as_table(out)

    return run


def open_windows(parts: int):
    """Stretches pass through; each open window of the suffixes of hot seeds goes to a bucket of its hash, with its start and its bytes."""
    kinds = (pa.int32(), *[pa.binary()] * 5)
    names = ["bucket", "d", "t", "start", "end", "window"]

    def spread(d, t, start, window) -> pa.RecordBatch:
        h = np.zeros(len(d), np.uint64)
        for column in range(WIDTH):
            h = h * BASE + LETTER[window[:, column]]
        bucket = (mixed(h) >> np.uint64(20)).astype(np.int64) % (parts * WINDOW_BUCKETS)
        place = np.argsort(bucket, kind="stable")
        rows = [(int(bucket[i[0]]), raw(d[i]), raw(t[i]), raw(start[i]), b"", raw(window[i])) for i in pieces_of(place, bucket[place])]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = batch.column("cut")
            done = batch.filter(cut)
            yield pa.RecordBatch.from_arrays(
                [done.column(c) for c in ("bucket", "d", "t", "before", "after")] + [pa.array([b""] * done.num_rows, pa.binary())], names=names,
            )
            for row in np.flatnonzero(~cut.to_numpy(zero_copy_only=False).astype(bool)).tolist():
                rows = pa.Table.from_batches([batch.slice(row, 1)])
                d, t, at, _, _, context = unpacked(rows)
                fresh = np.unpackbits(joined(rows.column("fresh"), np.uint8).reshape(len(d), -1), axis=1)
                every = np.lib.stride_tricks.sliding_window_view(context, WIDTH, axis=1)
                for some in np.array_split(np.arange(len(at)), parts_for(len(at), 512)):
                    i, offset = np.nonzero(fresh[some])
                    i = some[i]
                    yield spread(d[i], t[i], at[i].astype(np.int64) - offset, every[i, LEFT - offset])

    return run


def later_windows(rows: pa.Table) -> pa.Table:
    """Of one bucket, the windows that also start earlier, and the stretches that are known, united by document."""
    d, t, start = (joined(rows.column(c), np.int64) for c in ("d", "t", "start"))
    sizes = [len(x) // 8 for x in as_bytes(rows.column("d"))]
    open_ = np.repeat([len(x) > 0 for x in as_bytes(rows.column("window"))], sizes)
    end = start + WIDTH
    end[~open_] = joined(rows.column("end"), np.int64)
    window = joined(rows.column("window"), np.uint8).reshape(-1, WIDTH)
    gone = ~open_
    if len(window):
        place = np.flatnonzero(open_)
        by_place = np.lexsort((start[place], t[place], d[place]))
        tokens = np.ascontiguousarray(np.pad(window[by_place], ((0, 0), (0, 4)))).view(">u8").astype(np.uint64)
        order, group = multikey(tokens)
        i = place[by_place[order]]
        first = i[np.searchsorted(group, group, "left")]
        gone[i] = (d[i] != d[first]) | (t[i] != t[first]) | (start[i] != start[first])
    return cuts_of(d[gone], t[gone], start[gone], end[gone])


def cuts_of(ds, ts, starts, ends) -> pa.Table:
    out_d, out_t, out_cut = [], [], []
    for part in per_document(ds, ts):
        out_d.append(int(ds[part[0]]))
        out_t.append(int(ts[part[0]]))
        out_cut.append(raw(np.stack(united(starts[part], ends[part]), 1).astype(np.int64)))
    return pa.table({"d": pa.array(out_d, pa.int64()), "t": pa.array(out_t, pa.int64()), "cut": pa.array(out_cut, pa.binary())})


def cut_out(with_text: bool, carried: bool):
    """Per document: the union of its stretches, and what is left of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            removed, spans, digests, kept, sizes = [], [], [], [], []
            for text, cuts in zip(batch.column(1).field("text").cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                missing, text = text is None, text or b""
                pairs = np.frombuffer(b"".join(cuts or []), np.int64).reshape(-1, 2)
                starts, ends = united(pairs[:, 0], pairs[:, 1]) if len(pairs) else (np.array([], int), np.array([], int))
                left = b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)]))
                sizes.append(len(text))
                removed.append(len(text) - len(left))
                spans.append(len(starts))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "ignore") if with_text and not missing else None)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(digests, pa.string()), pa.array(kept, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            if carried:
                columns, names = [*columns, batch.column(1).field("row")], [*names, "row"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def sampled_leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few leading seeds of every text, and its size."""
    for batch in batches:
        texts = as_bytes(batch.column(0))
        leads, sizes = [], []
        for text in texts:
            _, at, _ = anchors([text])
            leads.append([text[i:i + SEED] for i in at[::max(1, len(at) // 16)]])
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays([pa.array(leads, pa.list_(pa.binary())), pa.array(sizes, pa.int64())], names=["leads", "size"])


def identified(documents: DataFrame, id_column: str, text_column: str, carry: list[str]) -> DataFrame:
    """(d, t, doc): the id, with null before all others, a tie-breaker from the text, and the text with the columns to carry.

    One struct holds what the joins need, so that both ask for the same columns and Spark shuffles the texts once.
    """
    text: Column = F.col(text_column).cast("string")
    row = [F.struct(*(F.col(c) for c in carry)).alias("row")] if carry else []
    return documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)).alias("d"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"), F.struct(text.alias("text"), *row).alias("doc"),
    )


def remove_repeats(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False, carry: list[str] | None = None,
    bucket_bytes: int = 8 << 20, sample_docs: int = 2000,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): one row per row of ``documents``.

    ``kept`` holds the text left, if ``with_text``, without the bytes of characters that a cut went through; the digest is that
    of all bytes left; a null text stays null. With ``carry``, ``row`` is a struct of these columns. Rows with equal id and equal
    text count as one document, and each gets its result; rows with equal id and other text are ordered by a hash of the text; a
    null id comes before all others, and a null text is empty. ``sample_docs`` texts, at most, choose the splitters and the
    number of buckets (of about ``bucket_bytes`` of text): this bears on balance only.
    """
    texts = identified(documents, id_column, text_column, carry or [])
    n = documents.count()
    share = min(1.0, sample_docs / max(1, n))
    sample = texts.select("doc.text").sample(share, seed=7).limit(2 * sample_docs).mapInArrow(tidy(sampled_leads), "leads array<binary>, size long").collect()
    size = n * sum(row.size for row in sample) // max(1, len(sample))
    parts = parts_for(size, bucket_bytes, least=4)
    leads = sorted(bytes(lead) for row in sample for lead in row.leads)
    splitters = [leads[len(leads) * i // parts] for i in range(1, parts)] if leads else []

    places = texts.select("d", "t", "doc.text").mapInArrow(tidy(anchor_rows(parts)), ANCHORS).groupBy("bucket").applyInArrow(repeated_places, PLACES)
    per_text = places.groupBy("d", "t").agg(F.collect_list("at").alias("at"))
    found = texts.join(per_text, ["d", "t"]).select("d", "t", "doc", "at")
    settled = (
        found.mapInArrow(tidy(suffixes(splitters, parts)), SUFFIXES)
        .groupBy("bucket").applyInArrow(settle_bucket(parts), SUFFIXES)
        .mapInArrow(tidy(open_windows(parts)), WINDOWS)
        .groupBy("bucket").applyInArrow(later_windows, CUTS)
    )
    cuts = settled.groupBy("d", "t").agg(F.collect_list("cut").alias("cut"))
    marked = texts.join(cuts, ["d", "t"], "left").select(F.when(F.col("d") != LOWEST, F.col("d")).alias("doc_id"), "doc", "cut")
    row = f", row {texts.schema['doc'].dataType['row'].dataType.simpleString()}" if carry else ""
    return marked.mapInArrow(tidy(cut_out(with_text, bool(carry))), KEPT + row)


ORACLE = r"""
    with t as (select doc_id, encode(coalesce(text, '')) as h from documents),
    w as (select doc_id, unnest(list_transform(range(0, octet_length(h) - 99), lambda p: {'p': p, 'm': md5(h[p + 1:p + 100])}), recursive := true) from t),
    f as (select m, min({'d': doc_id, 'p': p}) as first from w group by m having count(*) > 1),
    g as (select doc_id, p, doc_id <> first.d or p <> first.p as again from w join f using (m)),
    m as (select doc_id, p, p > 100 + coalesce(lag(p) over (partition by doc_id order by p), -1000) as opens from g where again),
    i as (select doc_id, p, sum(cast(opens as int)) over (partition by doc_id order by p) as run from m),
    spans as (select doc_id, run, min(p) as a, max(p) + 100 as b from i group by doc_id, run),
    keep as (
        select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from spans
        union all select doc_id, max(b), 1000000000 from spans group by doc_id
    ), k as (select keep.doc_id, string_agg(hex(h[a + 1:b]), '' order by a) as h from keep join t using (doc_id) group by keep.doc_id),
    c as (select doc_id, sum(b - a) as removed, count(*) as n from spans group by doc_id)
    select t.doc_id, cast(octet_length(t.h) as bigint) as n_bytes, cast(coalesce(c.removed, 0) as bigint) as n_removed, coalesce(c.n, 0) as n_spans,
        case when k.h is null then sha256(t.h) else sha256(unhex(k.h)) end as kept_sha256
    from t left join c using (doc_id) left join k using (doc_id)
"""

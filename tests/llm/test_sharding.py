import zlib
from collections import Counter

import numpy as np
import pytest

from landledger.llm import sharding as sh

ROWS = "doc_id long, text string, shard string, size int"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4096, 4097])
def test_permutation_is_one_to_one_and_goes_back(n):
    p = sh.Permutation(n, "a")
    there = p(np.arange(n))
    assert sorted(there.tolist()) == list(range(n)) and p(there, back=True).tolist() == list(range(n))
    if n > 100:
        assert there.tolist() != sh.Permutation(n, "b")(np.arange(n)).tolist()
        # A shuffle: neighbours come apart, and each tenth of the rows spreads over all shards.
        assert np.mean(np.abs(np.diff(there)) < n / 50) < 0.1
        assert len(set((there[: n // 10] % 24).tolist())) == 24
    for row in (0, n - 1):
        assert p.row(*p.place(row, 7), 7) == row


def test_large_numbers_stay_exact():
    p = sh.Permutation((1 << 62) - 5)
    some = np.array([0, 1, (1 << 62) - 6, 1 << 61, 123456789012345678])
    assert p(p(some), back=True).tolist() == some.tolist()
    plain = []
    for value in some.tolist():
        left, right = value >> 31, value & sh.PRIME
        for a, b, c in p.keys():
            x = (right * a + b) % sh.PRIME
            left, right = right, left ^ ((x * x * x + c) % sh.PRIME)
        plain.append(left << 31 | right)
    assert p.once(some).tolist() == plain


def table_rows():
    rows = [(i, f"text {i} é" if i % 3 else "copy", "clash", 1) for i in range(500)]
    return rows + [(None, "copy", "", 0), (None, None, "", 0), (7, "", None, 0), (7, None, None, 0), (8, "x" * 200_000, "", 0), *[rows[4]] * 60]


def test_places(spark):
    rows = table_rows()
    got = sh.sharded(spark.createDataFrame(rows, ROWS)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows
    )
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(24):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(counts[shard]))
    # The place of a row can be computed from its number.
    p = sh.Permutation(len(rows))
    numbers = {(r.shard, r.slot): p.row(r.shard, r.slot, 24) for r in got}
    ordered = sorted(got, key=lambda r: numbers[r.shard, r.slot])
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)


def test_layout_does_not_matter(spark):
    frame = spark.createDataFrame(table_rows(), ROWS)
    a, b = (sorted(map(str, sh.sharded(f).collect())) for f in (frame.repartition(7), frame.orderBy("text").coalesce(1)))
    assert a == b
    assert a != sorted(map(str, sh.sharded(frame, seed="other").collect()))


def test_few_or_no_rows(spark):
    assert sh.sharded(spark.createDataFrame([], ROWS)).count() == 0
    few = sh.sharded(spark.createDataFrame(table_rows()[:3], ROWS)).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


def test_files(spark, tmp_path):
    rows = table_rows()
    placed = sh.sharded(spark.createDataFrame(rows, ROWS), shards=5, carry=["text", "shard"])
    files = sh.write_shards(placed, str(tmp_path / "shards"), file_rows=50).collect()
    assert sum(f.rows for f in files) == len(rows) and all(f.first == 50 * f.part and f.rows <= 50 for f in files)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(back.select("doc_id", "row.text", "row.shard").collect()) == Counter((d, t, s) for d, t, s, _ in rows)
    one = [r.slot for r in spark.read.parquet(str(tmp_path / "shards/shard=2/part=1")).collect()]
    assert one == sorted(one)

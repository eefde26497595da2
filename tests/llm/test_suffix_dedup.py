import hashlib
import os
import random
import tempfile
import uuid

import numpy as np
import pytest

from landledger.llm import suffix_dedup as sd


def brute(docs):
    """Per document, in the order given: bytes, bytes removed, runs, digest and what is left."""
    seen, out = set(), []
    for data in docs:
        covered = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            w = data[p:p + 100]
            if w in seen:
                covered[p:p + 100] = True
            seen.add(w)
        left = bytes(np.frombuffer(data, np.uint8)[~covered])
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((len(data), int(covered.sum()), runs, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
    return out


def texts(seed, n):
    rng = random.Random(seed)

    def words(k):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(k))

    base = [words(60) for _ in range(8)]
    hot = words(40)
    out = []
    for _ in range(n):
        b = rng.choice(base)
        i = rng.randint(0, len(b) - 1)
        j = rng.randint(i, len(b))
        out.append(rng.choice([
            b, words(15) + b[i:j] + words(rng.randint(0, 15)), b[i:j], "a" * rng.randint(90, 300), "ab" * rng.randint(40, 150) + b[:60],
            words(rng.randint(0, 30)), words(3) + hot + words(4), words(8) + hot[rng.randint(0, 50):] + words(4), b + b, "é" * rng.randint(40, 120), "", "x" * 99,
        ]))
    return out


def check(spark, docs, **options):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(7)
    got = {r.doc_id: tuple(r)[1:] for r in sd.remove_repeats(frame, with_text=True, **options).collect()}
    assert got == dict(enumerate(brute([d.encode() for d in docs])))


def test_against_brute_force(spark):
    check(spark, texts(1, 150))


@pytest.mark.parametrize("held", [64, 1 << 17])
def test_small_buckets_and_hot_seeds(spark, monkeypatch, held):
    monkeypatch.setattr(sd, "HELD_SUFFIXES", held)
    monkeypatch.setattr(sd, "HELD_ANCHORS", 500)
    docs = texts(2, 120)
    rng = random.Random(4)
    passage = "".join(rng.choice("pqrstuv ") for _ in range(160))
    docs += ["".join(rng.choice("klmno ") for _ in range(60)) + passage + "".join(rng.choice("klmno ") for _ in range(60)) for _ in range(60)]
    check(spark, docs, bucket_bytes=1500)


def test_splitters_with_a_hot_seed_deal_it_over_buckets():
    seed = b"s" * sd.SEED
    run = sd.suffixes([b"a" * sd.SEED, seed, seed, seed, b"z" * sd.SEED], 6)
    rng = random.Random(1)
    docs = ["".join(rng.choice("klmno") for _ in range(80)).encode() + seed + "".join(rng.choice("klmno") for _ in range(90)).encode() for _ in range(40)]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(40), pa.int64()), pa.array([0] * 40, pa.int64()), pa.array([{"text": d} for d in docs]), pa.array([[80]] * 40, pa.list_(pa.int32())),
    ], names=["d", "t", "doc", "at"])
    rows = [r for b in run([batch]) for r in b.to_pylist()]
    assert all(r["hot"] and not r["cut"] for r in rows) and {r["bucket"] for r in rows} == {2, 3, 4}


def test_multikey():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order, group = sd.multikey(tokens)
    rows = [tuple(tokens[i]) for i in order]
    assert rows == sorted(rows)
    assert all((a == b) == (x == y) for a, b, x, y in zip(rows, rows[1:], group, group[1:]))
    assert all(i < j for i, j, x, y in zip(order, order[1:], group, group[1:]) if x == y)


def test_edges(spark):
    long = "0123456789" * 30
    rows = [(5, long, "a"), (5, long, "a"), (6, None, "b"), (None, long, "c"), (7, "", "d"), (8, "short", None), (9, "zebra " * 40_000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cut string")
    got = sd.remove_repeats(docs, with_text=True, carry=["cut", "doc_id"]).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    # The null id comes first and keeps one period of its text; documents with id 5 are one, and repeat it.
    assert by[None][0].n_removed == brute([long.encode()])[0][1] and [r.n_removed for r in by[5]] == [300, 300]
    assert by[6][0].n_bytes == 0 and by[6][0].kept is None and by[7][0].kept == "" and by[8][0].kept == "short"
    assert by[8][0].row.cut is None and by[9][0].row.cut == "e" and by[9][0].n_removed == brute([rows[-1][1].encode()])[0][1]
    assert sd.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("held", [4, 1 << 16])
def test_repeated_rows_do_not_erase_each_other(spark, monkeypatch, held):
    monkeypatch.setattr(sd, "HELD_SUFFIXES", held)
    rng = random.Random(8)
    alone, inner, twice = ("".join(rng.choice("klmnopq ") for _ in range(300)) for _ in range(3))
    rows = [(1, alone), (1, alone), (1, alone), (None, inner * 2), (None, inner * 2), (3, twice), (3, twice), (4, twice), (4, twice)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id or 0, r.n_removed, r.kept) for r in sd.remove_repeats(docs, with_text=True).collect()))
    want = [(0, 300, inner)] * 2 + [(1, 0, alone)] * 3 + [(3, 0, twice)] * 2 + [(4, 300, "")] * 2
    assert got == want


def test_a_hot_seed_is_not_gathered_in_one_task(spark, monkeypatch):
    """A line in every document, other text around it: nothing can be removed there, and no group may hold all its suffixes."""
    rng = random.Random(11)
    line = "".join(rng.choice("pqrstuv ") for _ in range(90))
    passage = "".join(rng.choice("wxyz ") for _ in range(140))
    docs = ["".join(rng.choice("klmno ") for _ in range(90)) + (line if i % 9 else passage) + "".join(rng.choice("klmno ") for _ in range(90)) for i in range(600)]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(6)
    folder = os.environ["LARGEST_GROUP"] = tempfile.mkdtemp(prefix="largest-")
    plain = sd.settle

    def noted(d, *rest):
        with open(f"{os.environ.get('LARGEST_GROUP', folder)}/{uuid.uuid4().hex}", "w") as file:
            file.write(str(len(d)))
        return plain(d, *rest)

    monkeypatch.setattr(sd, "HELD_SUFFIXES", 100)
    monkeypatch.setattr(sd, "settle", noted)
    got = {r.doc_id: tuple(r)[1:] for r in sd.remove_repeats(frame, with_text=True, bucket_bytes=8000).collect()}
    assert got == dict(enumerate(brute([d.encode() for d in docs])))
    sizes = []
    for name in os.listdir(folder):
        with open(f"{folder}/{name}") as file:
            sizes.append(int(file.read()))
    assert sizes and max(sizes) < 450, max(sizes)

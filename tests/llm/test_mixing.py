from collections import Counter

import pytest
from pyspark.sql import functions as F

from landledger.llm import mixing


def test_no_source_is_off_by_a_block(spark):
    sizes = spark.createDataFrame([("a", 10 ** 9), ("b", 5 * 10 ** 7), (None, 3), ("c", 0), ("d", 123_456), ("e", 1)], "source string, chars long")
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.31), ("c", 0.01), ("d", -1.0), ("zz", 9.0)], "source string, weight double")
    for given in (None, weights):
        slots = mixing.target_slots(sizes, given).cache()
        share = {r.source: (r.k, r.total) for r in slots.collect()}
        total = next(iter(share.values()))[1]
        assert len(share) == 6 and sum(k for k, _ in share.values()) == total and min(k for k, _ in share.values()) >= 1
        rows = sorted(mixing.timetable(slots).collect(), key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(total))
        done = Counter()
        for t, r in enumerate(rows, 1):
            assert r.nth == done[r.source]
            done[r.source] += 1
            for source, (k, _) in share.items():
                assert abs(done[source] - k * t / total) < 1
        assert dict(done) == {s: k for s, (k, _) in share.items()}


@pytest.mark.parametrize("window_rows", [20_000, 7])
def test_whole_and_in_order(spark, monkeypatch, window_rows):
    monkeypatch.setattr(mixing, "WINDOW_ROWS", window_rows)
    rows = [(i, "x" * (i % 90), "hot" if i % 3 else f"s{i % 7}", "clash") for i in range(900)]
    rows += [(900, None, "s1", ""), (901, "", None, ""), (None, "abc", None, ""), (5, "x" * 5, "hot", "clash"), (902, "y" * 5000, "s2", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_slot string")
    got = mixing.interleaved(docs, block_chars=100).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(r[:3] for r in rows)
    for source in {r.source for r in got}:
        own = sorted((r for r in got if r.source == source), key=lambda r: (r.mix_start, len(r.text or "") > 0))
        start = 0
        for r in own:
            assert r.mix_start == start and r.mix_block == start // 100
            start += len(r.text or "")
        slots = [r.mix_slot for r in own]
        assert slots == sorted(slots)
    ordered = mixing.in_order(mixing.interleaved(docs.drop("mix_slot"), block_chars=100))
    assert ordered.columns == ["doc_id", "text", "source"] and ordered.count() == len(rows)


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.interleaved(none).count() == 0
    one = none.unionAll(spark.createDataFrame([(1, None, None)], none.schema))
    assert [r.mix_slot for r in mixing.interleaved(one).collect()] == [0]
    assert mixing.interleaved(one).select(F.col("mix_k") == F.col("mix_total")).head()[0]


def test_columns_of_any_name_come_back(spark):
    names = ["mix_size", "mix_place", "mix_part", "mix_of", "mix_name", "mix_from", "mix_source", "mix_offset", "mix_nth", "mix_turn", "row", "size", "place", "part", "start",
             "block", "k", "total", "nth", "turn", "offset", "id", "o_source", "with space"]
    rows = [(i, "x" * i, f"s{i % 3}", *[f"{name} {i}" for name in names]) for i in range(40)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    got = mixing.interleaved(docs, block_chars=50)
    assert got.columns == [*docs.columns, "mix_start", "mix_block", "mix_slot", "mix_k", "mix_total"]
    assert sorted(tuple(r)[:len(docs.columns)] for r in got.collect()) == sorted(rows)

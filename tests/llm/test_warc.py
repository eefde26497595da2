import gzip
import hashlib
import io
import os

import pytest

from landledger.llm import warc

LONG = "<html>" + "payload " * 40 + "</html>"
ROWS = [
    (4, "http://a/4", LONG), (2, "http://a/2", LONG), (7, "http://a/7 x\ny", LONG), (1, "http://a/1", "short"), (3, "http://a/3", "short"), (5, None, None),
    (6, "http://a/6", ""), (None, "http://a/n", LONG), (8, "http://a/8", "é" * 50), (9, "http://a/9", "é" * 50), (10, "u", "é" * 49), (2, "http://a/2", LONG),
    (11, "http://a/11", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n" + "x" * 300_000), (12, "u", "\x1f\u008b\x08" * 100),
]


def pages(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string")


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, tmp_path, compress):
    written = warc.write(pages(spark).repartition(3), str(tmp_path / "w"), roll_bytes=2000, compress=compress)
    assert written.agg({"records": "sum"}).head()[0] == len(ROWS)
    got = warc.read(written).withColumn("page_id", warc.page_number("record_id")).withColumn("first", warc.page_number("refers_to")).collect()
    assert all(r.reason is None for r in got)
    want = []
    for i, url, html in ROWS:
        body = (html or "").encode()
        same = [j for j, _, other in ROWS if (other or "") == (html or "") and j is not None]
        first = min(same) if len(body) >= 100 and (i is None or i > min(same)) else None
        want.append((i is None, i or 0, "revisit" if first is not None else "response", first or 0, len(body), hashlib.sha256(body).hexdigest()))
    assert sorted((r.page_id is None, r.page_id or 0, r.record_type, r.first or 0, r.payload_bytes, r.payload_digest) for r in got) == sorted(want)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    folder = warc.archives(spark, str(tmp_path / "w"))
    assert folder.count() == written.count() and warc.read(folder, payloads=False).count() == len(ROWS)


def test_empty(spark, tmp_path):
    written = warc.write(pages(spark).limit(0), str(tmp_path / "none"))
    assert written.count() == 0 and warc.read(written).count() == 0


def records(n=6):
    out = []
    for i in range(n):
        body = f"page {i} ".encode() * 50
        out.append(warc.record(i, f"http://x/{i}", body, hashlib.sha256(body).hexdigest(), None, "2024-01-01T00:00:00Z"))
    return out


def events(data, **options):
    out = list(warc.salvage(io.BytesIO(data), len(data), **options))
    return [e[2]["warc-record-id"] for e in out if e[0] == "record"], [e[1:] for e in out if e[0] == "gap"]


def names(*numbers):
    return [f"<urn:page:{i}>" for i in numbers]


def test_undamaged():
    assert events(b"".join(records())) == (names(*range(6)), [])
    assert events(b"".join(gzip.compress(r) for r in records())) == (names(*range(6)), [])
    assert events(gzip.compress(b"".join(records()))) == (names(*range(6)), [])
    assert events(b"") == ([], [])


def test_damaged_members():
    members = [gzip.compress(r) for r in records()]
    starts = [sum(map(len, members[:i])) for i in range(7)]
    flipped = bytearray(b"".join(members))
    flipped[starts[2] + len(members[2]) // 2] ^= 0xFF
    found, gaps = events(bytes(flipped))
    assert found == names(0, 1, 3, 4, 5) and [(g[0], g[1]) for g in gaps] == [(starts[2], starts[3])]
    wrong_sum = bytearray(b"".join(members))
    wrong_sum[starts[4] - 6] ^= 1
    assert events(bytes(wrong_sum))[0] == names(0, 1, 2, 4, 5)
    no_head = b"junk" * 10 + b"".join(members[1:3]) + b"\x00" * 5000 + members[3]
    found, gaps = events(no_head)
    assert found == names(1, 2, 3) and gaps[0][:2] == (0, 40) and gaps[1][1] - gaps[1][0] == 5000
    found, gaps = events(b"".join(members)[:-20])
    assert found == names(0, 1, 2, 3, 4) and gaps[0][:2] == (starts[5], starts[6] - 20)
    assert events(b"\x1f\x8b\x08 nothing")[0] == []


def test_damaged_records():
    plain = records()
    starts = [sum(map(len, plain[:i])) for i in range(7)]
    data = b"".join(plain)
    bad_length = data.replace(b"Content-Length: " + str(len(plain[2].split(b"\r\n\r\n", 1)[1]) - 4).encode(), b"Content-Length: 99999999", 3)
    found, gaps = events(bad_length)
    assert found and gaps
    flipped = bytearray(data)
    flipped[starts[3] - 30] ^= 1  # inside the payload of record 2
    found, gaps = events(bytes(flipped))
    assert found == names(0, 1, 3, 4, 5) and gaps == [(starts[2], starts[3], None, "the block digest differs")]
    found, gaps = events(data[:starts[1] + 40] + data[starts[2]:])
    assert found == names(0, 2, 3, 4, 5) and gaps[0][0] == starts[1]
    assert events(b"garbage before " + data)[0] == names(*range(6))
    assert events(data, most=10)[0] == []


def test_damage_inside_one_member():
    plain = records()
    broken = bytearray(b"".join(plain))
    broken[len(plain[0]) + 3] ^= 1  # version line of record 1
    found, gaps = events(gzip.compress(bytes(broken)))
    assert found == names(0, 2, 3, 4, 5)
    assert gaps and gaps[0][2] == len(plain[0])
    mixed = plain[0] + gzip.compress(plain[1]) + plain[2]
    assert set(events(mixed)[0]) >= set(names(0, 2))


def test_gaps_are_rows(spark, tmp_path):
    members = [gzip.compress(r) for r in records()]
    members[1] = members[1][:20] + b"\x00" * 10 + members[1][30:]
    os.makedirs(tmp_path / "x")
    (tmp_path / "x" / "a.warc.gz").write_bytes(b"".join(members))
    got = warc.read(warc.archives(spark, str(tmp_path / "x"))).collect()
    assert sum(r.reason is None for r in got) == 5
    gap = next(r for r in got if r.reason)
    assert (gap.start, gap.gap_end) == (len(members[0]), len(members[0]) + len(members[1])) and gap.record_id is None


def test_broken_from_the_first_byte():
    members = [gzip.compress(r) for r in records()]
    broken = b"\x1f\x8b\x08" + b"\xff" * 40
    for data, at, kept in (
        (broken + b"".join(members), 0, range(6)), (members[0] + broken + b"".join(members[1:]), len(members[0]), range(6)), (b"".join(members) + broken, sum(map(len, members)), range(6)),
    ):
        found, gaps = events(data)
        assert found == names(*kept) and [g[:3] for g in gaps] == [(at, at + len(broken), None)]


def test_long_fields_are_no_damage(spark, tmp_path):
    """What ``write`` makes of a page, ``read`` gives back, whatever the length of its address."""
    url = "http://a/" + "p" * 5_000_000 + " ü"
    long = spark.createDataFrame([(1, url, LONG), (2, url, LONG), (3, "http://b", "x")], "page_id long, url string, html string")
    for compress in (True, False):
        got = warc.read(warc.write(long, str(tmp_path / str(compress)), compress=compress)).collect()
        assert len(got) == 3 and all(r.reason is None for r in got)
        assert max(len(r.uri) for r in got) == len(url) + 2  # the blank takes three characters


def test_damage_among_fields_stays_small():
    plain = records()
    torn = plain[1].replace(b"Content-Type: ", b"Content-Type- ", 1)
    found, gaps = events(plain[0] + torn + b"".join(plain[2:]))
    assert found == names(0, 2, 3, 4, 5) and gaps == [(len(plain[0]), len(plain[0]) + len(torn), None, "a field without a colon")]

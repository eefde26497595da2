import random
from collections import Counter

import pyarrow as pa
import pytest

from landledger.operators import catalog
from landledger.sources import csvfiles, csvscan
from landledger.sources.landing import list_landing


def plain_records(text):
    """Records by toggling at every quote, and the number of fields of each; blank lines outside quotes are none."""
    found, now, inside, commas = [], [], False, 0
    for line in text.split("\n"):
        if not inside and line in ("", "\r"):
            if now:
                found.append(("\n".join(now), commas + 1))
            now, commas = [], 0
            continue
        if not inside and now:
            found.append(("\n".join(now), commas + 1))
            now, commas = [], 0
        now.append(line)
        for c in line:
            inside ^= c == '"'
            commas += c == "," and not inside
    if now:
        found.append(("\n".join(now), commas + 1))
    return [(r.removesuffix("\r"), n) for r, n in found], inside


def small_splits(monkeypatch, size):
    real = csvscan.steady
    monkeypatch.setattr(csvscan, "steady", lambda spark, split_bytes=0: real(spark, size))


@pytest.mark.parametrize("size", [90, 1 << 20])
def test_scan_against_a_plain_loop(spark, tmp_path, monkeypatch, size):
    small_splits(monkeypatch, size)
    random.seed(size)
    texts = {
        "empty": "", "blank": "\na,b\n1,2\n", "header": "a,b", "one": 'a,"b\n\nc",d\n', "open": 'a,b\n1,"x\ny\nz\n', "lines": "a,b\r\n" + "\r\n1,2" * 30,
        "late": "a,b\n" + "1,2\n" * 20 + '"' + "q\n,\n" * 30 + '",z\n' + "3,4\n" * 10, "ragged": 'a,b\n1\n1,2,3\n"x,\ny",2\n',
        "double": 'a,b\n"say ""hi""\nthere",2\n"",\n' * 5, "wide": "a,b\n" + "é" * 100 + ",\n",
    }
    for i in range(5):
        texts[f"random{i}"] = "h,k\n" + "".join(random.choices(['"', ",", "\n", "x", "\r\n", '"a\nb"', "1,2\n", "ü"], weights=[1, 4, 4, 6, 1, 3, 6, 1], k=80))
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    session = csvscan.steady(spark)
    summary = csvscan.summarised(csvscan.lines(session, str(tmp_path)))
    summary = csvfiles.materialize(summary)
    splits, files = csvscan.chained(summary)
    name_of = {r.file: r.name.removesuffix(".csv") for r in list_landing(spark, str(tmp_path)).selectExpr("xxhash64(regexp_replace(path, '^file:/+', 'file:/')) as file", "name").collect()}
    seen = {name_of[r.file]: r for r in files.collect()}
    assert set(seen) == set(texts) - {"empty"}
    for name, r in seen.items():
        want, inside = plain_records(texts[name])
        assert r.open == inside and r.records == len(want), name
        assert dict(r.counts or {}) == dict(Counter(n for _, n in want)), name
        assert (r.first, r.second) == (want[0][1] if want else None, want[1][1] if len(want) > 1 else None), name
        assert r.blank == (texts[name].split("\n")[0] in ("", "\r"))
        if size > 300 and not (inside and len(want) == 1):
            assert r.header == want[0][0], name
    rows = csvscan.lines(session, str(tmp_path)).join(splits.where("inside").select("file", "block", "inside"), ["file", "block"], "left")
    found = csvfiles.materialize(csvscan.records(rows.select("file", "block", "value", "inside")))
    pieces = csvscan.rejoined(found.where("piece is not null"), splits)
    got = Counter((name_of[r.file], r.record) for r in found.where("piece is null").select("file", "record").unionByName(pieces).collect())
    # What is never closed is refused by the loader; its last record has no end.
    want = Counter((name, record) for name, text in texts.items() for record, _ in plain_records(text)[0][1:] if not plain_records(text)[1])
    assert Counter({k: n for k, n in got.items() if not plain_records(texts[k[0]])[1]}) == want
    if size == 90:
        assert splits.where("inside").count() > 10 and pieces.count() > 5


@pytest.mark.parametrize("size", [24, 1 << 20])
def test_load_of_records_across_splits(spark, tmp_path, monkeypatch, size):
    small_splits(monkeypatch, size)
    want = [(str(i), None if i % 3 else "", f'say "{i}",\n\n' * (i % 5) or None) for i in range(60)]

    def cell(value):
        return "" if value is None else '"' + value.replace('"', '""') + '"'

    (tmp_path / "t.csv").write_text("id,b,c\n" + "".join(f"{i},{cell(b)},{cell(c)}\n" for i, b, c in want))
    catalog.reset_layer(spark, "split_t", str(tmp_path / "db"))
    report = csvfiles.load_snapshot(spark, str(tmp_path / "t.csv"), "split_t").head()
    assert (report.status, report.rows) == ("loaded", 60)
    got = sorted((tuple(r) for r in spark.table("split_t.t").collect()), key=lambda r: int(r[0]))
    assert got == want
    spark.sql("drop database split_t cascade")


def test_many_small_files_take_few_jobs(spark, tmp_path):
    base = tmp_path / "landing"
    base.mkdir()
    for i in range(150):
        bad = {7: "1,2,3\n", 8: "1\n", 9: '"open,2\n'}.get(i % 50, "")
        head = "a,b\n" if i % 2 else "x,y z\n"
        (base / f"f{i}.csv").write_text(head + f"{i},2\n" * (i % 5) + bad)
    (base / "parts.csv").mkdir()
    for i in range(3):
        (base / f"parts.csv/part-{i}.csv").write_text(f"a,b\n{i},{i}\n")
    (base / "mixed.csv").mkdir()
    for i in range(2):
        (base / f"mixed.csv/part-{i}.csv").write_text(("a,b\n", "b,a\n")[i] + "1,2\n")
    catalog.reset_layer(spark, "many_t", str(tmp_path / "db"))
    spark.sparkContext.setJobGroup("many files", "")
    report = {r.table: r for r in csvfiles.load_snapshot(spark, str(base), "many_t").collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("many files"))
    spark.sparkContext._jsc.clearJobGroup()
    assert len(report) == 152 and jobs < 60
    status = Counter(r.status for r in report.values())
    assert status == {"loaded": 142, "refused": 3, "failed": 7}
    assert all(report[f"f{i}"].rows == i % 5 and spark.table(f"many_t.f{i}").count() == i % 5 for i in (0, 1, 4, 10, 33, 149))
    assert spark.table("many_t.f14").columns == ["x", "y_z"] and report["parts"].rows == 3 and "headers differ" in report["mixed"].error
    assert report["f7"].error == "1 rows are longer than 2 fields" and report["f58"].error == "1 rows do not have 2 fields" and "never closed" in report["f9"].error
    assert catalog.tables(spark, "many_t").count() == 142
    # A second load takes the place of the first.
    (base / "f4.csv").write_text("a,b,c\n1,2,3\n")
    assert {r.table: r.status for r in csvfiles.load_snapshot(spark, str(base / "f4.csv"), "many_t").collect()} == {"f4": "loaded"}
    assert spark.table("many_t.f4").columns == ["a", "b", "c"] and spark.table("many_t.f3").count() == 3
    spark.sql("drop database many_t cascade")


def test_quotes_that_readers_take_differently_are_reported(spark, tmp_path):
    """A quote inside an unquoted field: toggling hides its comma, Spark's reader does not. Such a file is not loaded."""
    (tmp_path / "pipes.csv").write_text('a,b\n5" pipe, 6" pipe,2\n')
    (tmp_path / "fine.csv").write_text('a,b\n5" x 6",2\n')
    catalog.reset_layer(spark, "quote_t", str(tmp_path / "db"))
    report = {r.table: (r.status, r.rows) for r in csvfiles.load_snapshot(spark, str(tmp_path), "quote_t").collect()}
    assert report == {"pipes": ("failed", None), "fine": ("loaded", 1)}
    assert [tuple(r) for r in spark.table("quote_t.fine").collect()] == [('5" x 6"', "2")]
    spark.sql("drop database quote_t cascade")


@pytest.mark.parametrize("lines", [["a,b", "", "\r", "1,2\r", "é,,"], ["", "\r"], ['"x,y",z', "1,2"], ['"x', "1,2", '"'], []])
def test_counts_of_lines(lines):
    """Lines without a quote are counted without looking at their bytes one by one, and alike."""
    got = csvscan.counted(pa.array(lines, pa.string()))
    for i, line in enumerate(lines):
        sides = [0, 0]
        for at, letter in enumerate(line):
            sides[line[:at].count('"') % 2] += letter == ","
        assert (got.quotes[i], got.commas[0][i], got.commas[1][i], bool(got.blank[i])) == (line.count('"'), *sides, line in ("", "\r"))


def test_paths_as_the_list_spells_them(spark):
    """Worked out for every line: no regular expression, and decoding only where there is something to decode."""
    paths = {"file:///a/b.csv": "file:/a/b.csv", "file:/a%20b+c.csv": "file:/a b+c.csv", "s3a://x/file:/%C3%A9%25+.csv": "s3a://x/file:/é%+.csv", "file:////x/y+": "file:/x/y+"}
    column = csvscan.plain_path("path")
    assert "regexp" not in str(column)
    assert {r.path: r.plain for r in spark.createDataFrame([(p,) for p in paths], "path string").select("path", column.alias("plain")).collect()} == paths

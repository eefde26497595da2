import csv
import json

import pytest
from pyspark.sql import functions as F

from landledger.operators import catalog
from landledger.sources import csvfiles, landing


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("multi_line", [False, True])
def test_copy_null_rule(spark, tmp_path, multi_line):
    path = put(tmp_path, "t.csv", 'a,b,c\n1,"",x\n2,,y\n  s ,t,u\n')
    got = csvfiles.read_text_csv(spark, path, multi_line=multi_line)
    assert rows(got) == rows(spark.createDataFrame([("1", "", "x"), ("2", None, "y"), ("  s ", "t", "u")], got.schema))


def test_quoted_breaks_and_quotes_survive(spark, tmp_path):
    path = put(tmp_path, "q.csv", 'id,text\n1,"two\nlines"\n2,"say ""hi"""\n3,"a,b\n\nc"\n4,plain\n')
    assert csvfiles.has_line_breaks_in_quotes(spark, path)
    got = csvfiles.read_text_csv(spark, path)
    assert rows(got) == [("1", "two\nlines"), ("2", 'say "hi"'), ("3", "a,b\n\nc"), ("4", "plain")]


def test_quoted_breaks_across_splits(spark, tmp_path):
    body = "".join(f'{i},"row {i}\nsecond ""line"", {"x" * (i % 50)}\nthird",end{i}\n' for i in range(3000))
    path = put(tmp_path, "big.csv", "id,note,tail\r\n" + body.replace("\n", "\r\n", 3))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = csvfiles.read_text_csv(spark, path)
        assert csvfiles.record_lines(spark, path).count() == 3001
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        with open(path, newline="") as f:
            truth = sorted(tuple(r) for r in list(csv.reader(f))[1:])
        assert rows(got) == sorted(truth, key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_open_quotes_and_unlike_headers_are_refused(spark, tmp_path):
    open_quote = put(tmp_path, "open.csv", 'a,b\n1,"x\n' + "2,y\n" * 50)
    with pytest.raises(ValueError, match="never closed"):
        csvfiles.read_text_csv(spark, open_quote)
    put(tmp_path, "parts.csv/p1.csv", "a,b\n1,2\n")
    put(tmp_path, "parts.csv/p2.csv", "b,a\n1,2\n")
    with pytest.raises(ValueError, match="headers differ"):
        csvfiles.read_text_csv(spark, str(tmp_path / "parts.csv"))


def test_load_reports_each_file(spark, tmp_path):
    put(tmp_path, "good.csv", "a,b\n1,2\n")
    put(tmp_path, "long.csv", "a,b\n1,2\n1,2,3\n")
    put(tmp_path, "short.csv", "a,b\n1,2\n1\n")
    put(tmp_path, "open.csv", 'a,b\n1,"2\n3,4\n')
    catalog.create_layer(spark, "staging_reports")
    got = {r.table: (r.status, r.rows) for r in csvfiles.load_snapshot(spark, str(tmp_path), "staging_reports").collect()}
    spark.sql("drop database staging_reports cascade")
    assert got == {"good": ("loaded", 1), "long": ("refused", None), "short": ("failed", None), "open": ("failed", None)}


@pytest.mark.parametrize("bad", ["3,4\n", "5,6,7,8\n"])
@pytest.mark.parametrize("quoted", ["", '"multi\nline",y,z\n'])
def test_load_aborts_on_ragged_rows(spark, tmp_path, bad, quoted):
    path = put(tmp_path, "r.csv", "a,b,c\n1,2,3\n" + quoted + bad)
    with pytest.raises(Exception):
        csvfiles.read_text_csv(spark, path).collect()


@pytest.mark.parametrize("text, ok", [
    ("a,b,c\n1,2,3\n3,4\n", True),
    ("a,b,c\n1,2,3\n5,6,7,8\n", False),
    ("a,b,c\n1,2,3\n5,6,7,\n", False),
    ('a,b,c\n1,"x,y\nz",3\n', True),
    ('a,b,c\n1,2,3\n1,"x,y\nz",3,4\n', False),
    ("a,b,c\n1,2,3,4\n5,6,7,8\n", True),
    ("a,b,c\n1,2,3,4\n5,6,7,8,9\n", False),
    ("", False),
    ("\na,b\n", False),
])
def test_gate(spark, tmp_path, text, ok):
    assert csvfiles.gate_csv(spark, put(tmp_path, "g.csv", text)).head()["ok"] is ok


def test_gate_replaces_bad_bytes(spark, tmp_path):
    assert csvfiles.gate_csv(spark, put(tmp_path, "b.csv", b"a,b\n1,\xff\n")).head()["ok"]


def test_headers(spark, tmp_path):
    assert csvfiles.read_headers(spark, put(tmp_path, "h.csv", '"Parcel ID","a\nb",Order,,\n1,2,3,4,5\n')) == [
        "parcel_id", "ab", "order_", "column_", "column__1"]
    with pytest.raises(ValueError, match="No header row"):
        csvfiles.read_headers(spark, put(tmp_path, "blank.csv", "\na,b\n1,2\n"))


def test_index_column(spark):
    df = spark.createDataFrame([(0, "x")], "column_ int, a string")
    assert csvfiles.drop_index_column(df).columns == ["a"]
    assert csvfiles.drop_index_column(df.select("a")).columns == ["a"]


def test_catalogue(spark, tmp_path):
    path = put(tmp_path, "files.json", json.dumps({"gov_files": [
        {"file_name": "a.zip", "file_location": "http://x/a.zip"}, {"file_name": "b.csv", "file_location": "http://x/b"}]}, indent=2))
    assert rows(landing.read_catalogue(spark, path)) == [("a.zip", "http://x/a.zip"), ("b.csv", "http://x/b")]


def test_snapshot_key_and_latest(spark):
    df = spark.createDataFrame([("2024-03-05 07:08:09", "2024_01_01_00_00_00"), ("2024-03-05 07:08:09", "2024_02_01_00_00_00")], "t string, snapshot string")
    assert df.select(landing.snapshot_key(F.to_timestamp("t")).alias("k")).head()["k"] == "2024_03_05_07_08_09"
    assert [r["snapshot"] for r in landing.latest_snapshot(df).collect()] == ["2024_02_01_00_00_00"]
    root = df.withColumn("snapshot", F.lit(None).cast("string"))
    assert landing.latest_snapshot(root).count() == 2


def test_routing(spark):
    names = ["a.mdb", "b.xls", "c.v1.txt", "d e.csv", "e.CSV", "f.pdf", "g.zip"]
    routed = landing.route_files(spark.createDataFrame([(n,) for n in names], "name string"))
    assert [(r["action"], r["target"]) for r in routed.collect()] == [
        ("export_tables", None), ("convert_sheet", "b.csv"), ("rename", "c.v1.csv"), ("land", "d e.csv"),
        ("ignore", None), ("ignore", None), ("unpack", None)]
    tables = spark.createDataFrame([("prcl.mdb", ["Prcl", "", "Bldg Sect", "\n"])], "name string, tables array<string>")
    assert [r["target"] for r in landing.fan_out(tables).collect()] == ["prcl_Prcl.csv", "prcl_Bldg_Sect.csv"]
    key = tables.select(landing.landing_key(F.lit("2024_01_01_00_00_00"), F.lit("d e.csv")).alias("k"))
    assert key.head()["k"] == "2024_01_01_00_00_00/de.csv"


@pytest.mark.parametrize("name, kind, sample, verdict", [
    ("x.zip", None, b" \n<!DOCTYPE html>", landing.LOOKS_HTML),
    ("x.csv", None, b"<HTML><body>", landing.LOOKS_HTML),
    ("x.ZIP", None, b"PK\x03\x04\xff\xfe", landing.ZIP_OK),
    ("x.zip", None, b"text", landing.ZIP_BAD),
    ("x", "application/zip; q", b"PK", landing.ZIP_OK),
    ("x.csv", None, "é,b".encode(), landing.TEXT_OK),
    ("x.csv", None, b"a\xff", landing.TEXT_BAD),
    ("x", "text/CSV", b"a", landing.TEXT_OK),
    ("x.bin", None, b"a", landing.UNCLASSIFIED),
    ("x.csv", None, b"a" * 2048 + b"\xff", landing.TEXT_OK),
    ("x.csv", None, b"", landing.TEXT_OK),
])
def test_sniff(spark, name, kind, sample, verdict):
    df = spark.createDataFrame([(name, kind, bytearray(sample))], "n string, k string, s binary")
    assert df.select(landing.sniff("n", "k", "s").alias("v")).head()["v"] == verdict


def test_manifest_and_drift(spark, tmp_path):
    import hashlib

    put(tmp_path, "vocab/a.csv", "x")
    put(tmp_path, "vocab/b.csv", "yy")
    before = landing.manifest(spark, str(tmp_path))
    got = {r["name"]: (r["category"], r["sha256"], r["length"]) for r in before.collect()}
    assert got["b.csv"] == ("vocab", hashlib.sha256(b"yy").hexdigest(), 2)
    frozen = spark.createDataFrame(before.collect(), before.schema)
    put(tmp_path, "vocab/b.csv", "zz")
    put(tmp_path, "vocab/c.csv", "new")
    (tmp_path / "vocab/a.csv").unlink()
    drift = landing.manifest_drift(frozen, landing.manifest(spark, str(tmp_path)))
    assert sorted((r["path"][-5:], r["drift"]) for r in drift.collect()) == [
        ("a.csv", "missing"), ("b.csv", "changed"), ("c.csv", "added")]


def test_load_snapshot_isolates_failures(spark, tmp_path):
    base = tmp_path / "2024_01_01_00_00_00"
    put(base, "Prcl-Main.CSV", 'Parcel ID,Order\n1,a\n2,"b\nc"\n')
    put(base, "bad.csv", "a,b\n1\n")
    put(base, "empty file.csv", "")
    put(base, "x_1.csv", "a\n1\n")
    put(base, "x-1.csv", "a\n2\n")
    put(base, "notes.txt", "a\n2\n")
    catalog.reset_layer(spark, "staging_t")
    report = {r["file"].rsplit("/", 1)[1]: r for r in csvfiles.load_snapshot(spark, str(tmp_path), "staging_t").collect()}
    assert {k: v["status"] for k, v in report.items()} == {
        "Prcl-Main.CSV": "loaded", "bad.csv": "failed", "empty file.csv": "failed", "x_1.csv": "failed", "x-1.csv": "failed"}
    assert report["Prcl-Main.CSV"]["rows"] == 2
    assert rows(spark.table("staging_t.prcl_main").select("parcel_id", "order_")) == [("1", "a"), ("2", "b\nc")]
    assert not spark.catalog.tableExists("staging_t.bad")
    prefix = landing.list_landing(spark, str(tmp_path)).select(landing.prefix_of("path").alias("p")).distinct()
    assert [r["p"] for r in prefix.collect()] == ["2024_01_01_00_00_00"]
    assert [r["tablename"] for r in catalog.tables(spark, "staging_t").collect()] == ["prcl_main"]
    spark.sql("DROP DATABASE staging_t CASCADE")


def test_spill_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", None, 'q"x'), ("2", "", "a,b"), ("3", " s ", "l\nm")], "a string, b string, c string")
    csvfiles.write_csv(df.coalesce(1), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*.csv"))
    assert rows(csvfiles.read_text_csv(spark, str(part))) == rows(df)


def test_metadata_scans(spark, tmp_path):
    put(tmp_path, "v/zoning.csv", '"DATELASTUPDATED","DEFINITION","IDENTIFIER","REFERENCEURL","TITLE","VOCABULARYID"\n"d","","H","","Area","53"\n')
    put(tmp_path, "v/street.csv", '"DATELASTUPDATED","DEFINITION","IDENTIFIER","REFERENCEURL","TITLE","VOCABULARYID"\n"d","","","","Avenue","66"\n')
    vocab = csvfiles.read_vocabularies(spark, str(tmp_path / "v"))
    assert sorted((r["VOCABULARYID"], r["IDENTIFIER"], r["TITLE"]) for r in vocab.collect()) == [("53", "H", "Area"), ("66", "", "Avenue")]
    put(tmp_path, "f/fields.csv", '"DATAFORMAT","DATASETID","DATATYPEID","DESCRIPTION","DISTRIBUTIONID","LABEL","NAME","VOCABULARYID"\n'
        '"","0","115","","189","x","ASMTLAND","0"\n"","0","115","","195","x","AsrLandUse1","24"\n"","0","110","a, ""b""","189","x","HANDLE","0"\n')
    fields = {r["NAME"]: (r["kind"], r["type"]) for r in csvfiles.read_field_definitions(spark, str(tmp_path / "f")).collect()}
    assert fields == {"ASMTLAND": ("amount", "double"), "AsrLandUse1": ("amount", "string"), "HANDLE": ("number", "string")}


def test_newest_landing(spark, tmp_path):
    put(tmp_path, "a.csv", "x\n1\n")
    assert landing.newest_landing(spark, str(tmp_path)) == str(tmp_path)
    for name in ("2024_02_01_00_00_00", "2023_12_31_23_59_59"):
        put(tmp_path, f"{name}/a.csv", "x\n1\n")
        put(tmp_path, f"{name}/b.csv/part-0.csv", "x\n1\n")
    assert landing.newest_landing(spark, str(tmp_path)) == str(tmp_path / "2024_02_01_00_00_00")
    tables = csvfiles.landed_tables(spark, landing.newest_landing(spark, str(tmp_path)))
    assert sorted(r["table"] for r in tables.collect()) == ["a", "b"]


def test_gated_orders_in_several_parts(spark, tmp_path):
    """Each part of the landed orders has the header; long rows are counted wherever they stand, the first row of a part included."""
    from landledger.plans import registry

    registry.load_all()
    spark.range(50, 1050, numPartitions=5).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 'a, "b"\nc', "en", "s", 8)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = {row["name"]: (row.ok, row.width, row.long_rows) for row in registry.QUERIES["csv_gate"](spark, str(tmp_path)).collect()}
    assert found == {"orders.csv": (False, 3, 10), "documents.csv": (True, 5, 0)}

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.functions import values as V
from landledger.operators import typing as TY


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "v string").select(expression("v").alias("o")).head()["o"]


def infer(spark, cells, **options):
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    return TY.infer_types(df, **options).head()["type"]


@pytest.mark.parametrize("cells, expected", [
    (["yes", "no", "NULL"], "boolean"),
    (["1,200", "7"], "int"),
    (["2147483647", "-2147483648"], "int"),
    (["2147483648"], "bigint"),
    (["9223372036854775808"], "double"),
    (["1.5", "2", None, ""], "double"),
    (["1d"], "string"),
    (["nan", "1"], "double"),
    (["2024-01-31 10:00:00"], "timestamp"),
    (["2024-01-31 10:00:00", "2024-01-31 00:00:00"], "date"),
    (["2024-01-31"], "date"),
    (["1/31/2024", "12/1/2023"], "date"),
    (["2024-02-31"], "string"),
    (["", "null", "NULL", None], "string"),
    (["yes", "1"], "string"),
    (["x"], "string"),
])
def test_inference(spark, cells, expected):
    assert infer(spark, cells) == expected


def test_forced_text_and_sample(spark):
    df = spark.createDataFrame([("007", "1")] * 3 + [("x", "y")], " Handle string, n string".strip())
    types = TY.type_map(TY.infer_types(df, force_text=["HANDLE "]))
    assert types == {"Handle": "string", "n": "string"}
    assert TY.type_map(TY.infer_types(df.limit(3).coalesce(1), sample=3))["n"] == "int"


def test_apply_types_routes_failures(spark):
    df = spark.createDataFrame(
        [("1,000", "Yes", "2024-01-31"), ("x", "no", "2024-01-01"), ("", "NULL", "31/31/2024")], "n string, f string, d string"
    )
    good, bad = TY.typed_from_text(df, {"n": "Long Integer", "f": "Yes/No", "d": "Date/Time"})
    assert [tuple(r) for r in good.collect()] == [(1000, True, dt.date(2024, 1, 31))]
    assert sorted((r["n"], r["failed_columns"]) for r in bad.collect()) == [("", "d"), ("x", "n")]
    assert good.count() + bad.count() == df.count()


def test_clean_numeric_touches_named_columns_only(spark):
    df = spark.createDataFrame([("1,234.5", "007"), ("", "008"), ("abc", "009")], "n string, id string")
    assert [tuple(r) for r in TY.clean_numeric(df, ["n"]).collect()] == [(1234.5, "007"), (None, "008"), (None, "009")]


def test_ddl(spark):
    assert TY.ddl({"2nd col": "int", "Área": "string"}, spark) == "_2nd_col int, área string"


def test_json_total_and_day(spark):
    assert one(spark, '{"a": 1.5, "b": 2}', V.json_total) == 3.5
    day = one(spark, "2024-01-06", lambda c: V.day_type(F.to_date(c)))
    assert (day["is_weekday"], day["activity"]) == (False, "going to the beach")


def test_global_id(spark):
    df = spark.createDataFrame([(29510, 123, 0, 0), (29510, 123, 1, 2)], "r long, p long, b long, u long")
    out = df.select(ids.global_id(840, "r", "p", "b", "u").alias("id"))
    got = [r["id"] for r in out.collect()]
    assert got == ["840.29510.000123.0000.00000", "840.29510.000123.0001.00002"]
    parts = out.select(ids.parse_global_id("id").alias("p"), ids.parent_id("id").alias("up"), ids.in_region("id", 840, 29510).alias("in"))
    rows = parts.collect()
    assert tuple(rows[1]["p"]) == (840, 29510, 123, 1, 2)
    assert [r["up"] for r in rows] == [None, "840.29510.000123.0001.00000"]
    assert rows[0]["in"]


def test_global_id_never_truncates(spark):
    df = spark.createDataFrame([(1234567,)], "p long")
    with pytest.raises(Exception, match="does not fit"):
        df.select(ids.global_id(840, F.lit(29510), "p")).collect()


def test_legacy_ids(spark):
    df = spark.createDataFrame([("12.5", "30", "9", "1200")], "block string, parcel string, owner string, big string")
    row = df.select(
        ids.parcel9("block", "parcel").alias("p9"), ids.parcel11("block", "parcel", "owner").alias("p11"),
        ids.handle("block", F.lit(True), "parcel", "owner").alias("h"),
        ids.is_condo_placeholder("parcel").alias("no"), ids.is_condo_placeholder("big").alias("yes"),
    ).head()
    assert tuple(row) == ("001250030", "0012500309", "001250800309", False, True)


def test_first_rows_do_not_depend_on_the_layout(spark):
    df = spark.createDataFrame([(i % 10, str(i)) for i in range(200)], "k int, v string")
    want = sorted([(i % 10, str(i)) for i in range(200)])[:25]
    for layout in (df.repartition(7), df.coalesce(1).orderBy("v")):
        assert [tuple(r) for r in TY.first_rows(layout, 25, ["k"]).collect()] == want
    plan = TY.first_rows(df.repartition(7), 25, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_inference_makes_no_row_per_cell(spark):
    wide = spark.createDataFrame([tuple("1" if j % 2 else "x" for j in range(90)), ("",) * 90], [f"c{j}" for j in range(90)])
    found = TY.infer_types(wide)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # One row of aggregates per 40 columns is taken apart, nothing else.
    assert len(re.findall(r"Generate inline\(m", plan)) == 3 == len(re.findall("Generate", plan))
    assert TY.type_map(found) == {f"c{j}": "int" if j % 2 else "string" for j in range(90)}


def test_unreadable_legacy_numbers_are_null(spark):
    from landledger.functions import ids

    df = spark.createDataFrame([("12.5", "7", "1"), ("x", "7", "1"), ("12.5", "?", "1")], "block string, parcel string, owner string")
    got = [tuple(r) for r in df.select(ids.parcel9("block", "parcel"), ids.parcel11("block", "parcel", "owner")).collect()]
    assert got == [("001250007", "0012500071"), (None, None), (None, None)]
    with pytest.raises(Exception, match="does not fit"):
        df.select(ids.global_id(1, F.lit(2), F.lit(3), "block")).collect()

import re
import string
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landledger.functions import names as N


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [row["out"] for row in df.select("i", expression("v").alias("out")).orderBy("i").collect()]


GOLDEN = [
    (["Parcel ID", "2024 Total", "Order"], ["parcel_id", "_2024_total", "order_"]),
    (["Area", "area#"], ["area", "area_1"]),
    (["", "###"], ["column_", "column__1"]),
    (["Área", "a\tb"], ["rea", "ab"]),
    (["a", "a", "a_1"], ["a", "a_1", "a_1_1"]),
    (["a_1", "a", "a"], ["a_1", "a", "a_2"]),
    (["a" * 70, "a" * 70], ["a" * 63, "a" * 61 + "_1"]),
]


@pytest.mark.parametrize("raw, expected", GOLDEN)
def test_clean_headers(raw, expected):
    assert N.clean_headers(raw) == expected


def test_clean_name_column_equals_header_rule(spark):
    raw = ["Parcel ID", "2024 Total", "Order", "", "###", "Área", "a\tb", "a" * 70, "USER", "İx", "Kelvin",
           "ẞ", "Two  Blanks", "x\ny", "_ok", "column", "Σ1", " lead"]
    raw += N.RESERVED
    assert column(spark, raw, N.clean_name) == [N.clean_header(v) for v in raw]
    assert column(spark, [None], N.clean_name) == ["column_"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=string.printable + "áÉıİ#ß", max_size=80), max_size=12))
def test_clean_headers_total_unique_short(headers):
    cleaned = N.clean_headers(headers)
    assert len(cleaned) == len(headers) == len(set(cleaned))
    for name in cleaned:
        assert re.fullmatch(r"[a-z_][a-z0-9_]{0,62}", name)
        assert name not in N.RESERVED


def test_reserved_words():
    assert len(N.RESERVED) == len(set(N.RESERVED)) == 98
    assert N.clean_header("select_") == "select_"


def test_clean_table(spark):
    raw = ["2024/Prcl-Main.CSV", "123.csv", ".csv", "a b.csv", "x.csv.csv", "user.csv", "a/b/" + "q" * 70 + ".csv"]
    assert column(spark, raw, N.clean_table) == ["prcl_main", "_123", "table", "ab", "xcsv", "user", "q" * 63]


def test_safe_identifier(spark):
    assert column(spark, ["2nd col", "Área#", "a-b"], N.safe_identifier) == ["_2nd_col", "área_", "a_b"]


def test_require_safe():
    assert N.require_safe(["a_1"]) == ["a_1"]
    with pytest.raises(ValueError):
        N.require_safe(["a b"])
    with pytest.raises(ValueError):
        N.require_safe(["a\n"])


def test_paths(spark):
    assert column(spark, ["a/b/c.tar.gz", "x", ".hidden", "p/.csv"], N.stem) == ["c.tar", "x", ".hidden", ".csv"]
    assert column(spark, ["a b.xls"], lambda c: N.swap_extension(c, ".csv")) == ["a b.csv"]


def test_ellipsize(spark):
    out = column(spark, [None, "", "x" * 80, "x" * 81], N.ellipsize)
    assert out == ["", "", "x" * 80, "x" * 79 + "…"]


def test_alnum_only(spark):
    assert column(spark, ["dag.task-1é " + "x" * 120], N.alnum_only) == ["dagtask1é" + "x" * 90]


def test_percent_encode(spark):
    raw = ["a b", "p@ss/w*rd~", "é+%", "-._", "a&b=c"]
    assert column(spark, raw, N.percent_encode) == [quote(v) for v in raw]

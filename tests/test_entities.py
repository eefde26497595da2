import dataclasses

import pytest
from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.operators import entities as E
from landledger.operators import keys as K
from landledger.operators import quality as Q
from landledger.operators.versions import Store
from landledger.plans import owners, spine, usecases


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_duplicates_nulls_and_ties(spark):
    df = spark.createDataFrame(
        [(1, "b", "x", 0.1, 5), (1, "a", None, 0.2, None), (1, "a", None, None, 7), (2, None, None, None, None), (None, "c", "y", 1.0, 1)],
        "k int, t string, m string, v double, y int",
    )
    got = E.merge_duplicates(df, "k", {"t": "texts", "m": "min", "v": "sum", "y": "max"})
    got = got.withColumn("v", F.col("v").cast("double"))
    assert rows(got) == sorted([(1, "a, b", "x", 0.3, 7), (2, None, None, None, None), (None, "c", "y", 1.0, 1)], key=repr)


def test_merge_duplicates_is_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("t"), F.col("id").cast("double").alias("v"))
    plan = E.merge_duplicates(df, "k", {"t": "texts", "v": "sum"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_left_merge(spark):
    left = spark.createDataFrame([("h1", 1), ("h2", 2), (None, 3)], "handle string, g int")
    right = spark.createDataFrame([("h1", "a"), ("h1", "b"), (None, "z")], "handle string, owner string")
    assert rows(E.left_merge(left, right, "handle")) == sorted([("h1", 1, "a"), ("h1", 1, "b"), ("h2", 2, None), (None, 3, None)], key=repr)
    assert rows(Q.pk_violations(right, ["handle"])) == sorted([("h1", 2), (None, 1)], key=repr)
    with pytest.raises(ValueError, match="g"):
        E.left_merge(left, right.withColumnRenamed("owner", "g"), "handle")


def test_decode_never_fans_out(spark):
    words = spark.createDataFrame([("H", "Area"), ("H", "Area two"), ("", "Avenue"), (None, "x")], "IDENTIFIER string, TITLE string")
    df = spark.createDataFrame([("H",), ("Q",), ("",), (None,)], "code string")
    got = E.decode(df, words, "code", "title")
    assert rows(got) == sorted([("H", "Area"), ("Q", None), ("", None), (None, None)], key=repr)
    assert rows(E.undecoded(got, "code", "title")) == [("", 1), ("Q", 1)]


def test_skewed_decode_splits_the_hot_key(spark):
    """A join too large to broadcast: a third of all rows share a key, and Spark splits that partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 90000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 2003).alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
        )
        words = spark.range(2003).select(F.col("id").alias("IDENTIFIER"), F.col("id").cast("string").alias("TITLE"))
        got = E.decode(facts, words, "code", "title")
        assert got.where("title is not null").count() == 90000
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dedup_entities_null_safe(spark):
    df = spark.createDataFrame([("ACME, Inc.", "1 Main St"), ("acme  inc", "1 MAIN ST."), ("Acme Inc", None), ("ACME INC", None), (None, None)], "n string, a string")
    got = E.dedup_entities(df, "n", "a").select("name_key", "address_key", "n_sources")
    assert rows(got) == sorted([("ACME INC", "1 MAIN ST", 2), ("ACME INC", None, 2), (None, None, 1)], key=repr)


def test_small_builders(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", None), ("d", -1)], "k string, n int")
    assert rows(E.explode_count(df, "n", "i").select("k", "i")) == [("a", 1), ("a", 2)]
    wide = spark.createDataFrame([("p", "A", "0", None), ("q", "", "B", "C")], "k string, zoning1 string, zoning2 string, zoning3 string")
    assert rows(E.slots_to_rows(wide, ["k"], ["zoning1", "zoning2", "zoning3"])) == [("p", "zoning1", "A"), ("q", "zoning2", "B"), ("q", "zoning3", "C")]
    land = spark.createDataFrame([("Y",), ("N",), (None,)], "vacantland string")
    assert rows(E.not_vacant(land)) == sorted([("N",), (None,)], key=repr)
    names = spark.createDataFrame([("A", "B"), ("A", " "), ("A", None), (None, "B")], "a string, b string")
    assert [r[0] for r in names.select(E.display_name("a", "b")).collect()] == ["A B", "A", "A", "B"]
    line = spark.createDataFrame([("1200 N Grand Blvd Unit 4B",), ("12 Main",), ("PO Box 7",), (None,)], "l string")
    got = [r["p"] for r in line.select(E.parse_situs("l").alias("p")).collect()]
    assert tuple(got[0]) == (1200, "N", "Grand Blvd", "4B") and tuple(got[1]) == (12, None, "Main", None)
    assert tuple(got[2]) == (None,) * 4 and tuple(got[3]) == (None,) * 4


def test_union_feeds_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, note string")
    b = spark.createDataFrame([(2, 5.0)], "id int, cost double")
    got = E.union_feeds({"plumbing": a, "electrical": b}, "permit_type").select("id", "permit_type", "note", "cost")
    assert rows(got) == [(1, "plumbing", "x", None), (2, "electrical", None, 5.0)]


def test_mapping_by_status(spark):
    mapping = spark.createDataFrame(
        [("ZONING1", "parcel", "zoning", "needs_lookup", "Zoning"), ("FRONTAGE", "parcel", "frontage", "candidate_direct", ""),
         ("GONE", "parcel", "gone", "candidate_direct", ""), ("X", "parcel", "x", "needs_decision", "")],
        "source_field string, current_table string, current_column string, mapping_status string, vocabulary string",
    )
    df = spark.createDataFrame([("H", "12", "q")], "zoning1 string, frontage string, x string")
    words = {"Zoning": spark.createDataFrame([("H", "Area")], "IDENTIFIER string, TITLE string")}
    got = E.apply_mapping(df, mapping, "parcel", words, {"frontage": "int", "county": "string"})
    assert got.select("frontage", "zoning", "county").head() == (12, "Area", None)
    assert "x" not in got.columns and "gone" not in got.columns
    coverage = E.mapping_coverage(mapping.withColumn("entity", F.col("current_table")))
    assert ("parcel", "candidate_direct", 2) in rows(coverage)


# --- the spine on a hand-made city ---------------------------------------------------------------

ACCOUNTS = """handle string, cityblock string, parcel string, ownercode string, giscityblock string, gisparcel string,
  gisownercode string, landuse string, vacantland string, zoning string, condo string"""


@pytest.fixture(scope="module")
def city(spark):
    accounts = spark.createDataFrame([
        ("100", "1.0", "10", "0", "1.0", "10", "0", "R", "N", "H", "N"),     # house
        ("200", "2.0", "20", "0", "2.0", "20", "0", "C", "N", "I", "N"),     # shop, two sections
        ("300", "3.0", "30", "0", "3.0", "30", "0", "V", "Y", "H", "N"),     # vacant lot
        ("400", "4.0", "40", "0", "4.0", "40", "0", "R", "N", "H", "Y"),     # condo footprint
        ("400", "4.0", "42", "0", "4.0", "40", "0", "R", "N", "H", "Y"),     # condo units
        ("400", "4.0", "41", "0", "4.0", "40", "0", "R", "N", "H", "Y"),
        ("500", "5.0", "50", "0", "5.0", "50", "0", "R", "N", "H", "N"),     # shared, not a condo
        ("500", "5.0", "50", "9", "5.0", "50", "0", "R", "N", "H", "N"),
        ("600", "6.0", "60", "0", "6.0", "60", "0", "BILLBOARD", "N", "H", "N"),
        (None, "7.0", "70", "0", "7.0", "70", "0", "R", "N", "H", "N"),
    ], ACCOUNTS)
    detail = spark.createDataFrame([("1.0", "10", "0", 1, 900), ("1.0", "10", "0", 2, 100), ("2.0", "20", "0", 1, 5000), ("3.0", "30", "0", 1, 5)],
                                   "cityblock string, parcel string, ownercode string, bldgnum int, totalarea int")
    homes = detail.where("cityblock = '1.0'")
    sections = spark.createDataFrame([("2.0", "20", "0", 1, "B"), ("2.0", "20", "0", 1, "A"), ("1.0", "10", "0", 1, "A"), ("1.0", "10", "0", 1, "B")],
                                     "cityblock string, parcel string, ownercode string, bldgnum int, sectnum string")
    feeds = spine.Feeds(accounts, detail, homes, sections)
    return spine.build(feeds, K.empty_crosswalk(spark), spine.Region(840, 29510), ["BILLBOARD"], condo=F.col("condo") == "Y")


def gid(parcel, building=0, unit=0):
    return f"840.29510.{parcel:06d}.{building:04d}.{unit:05d}"


def test_spine_parcels(city):
    assert rows(city.parcel.select("parcel_id", "handle", "zoning_class_id")) == [
        (gid(1), "100", "H"), (gid(2), "200", "I"), (gid(3), "300", "H"), (gid(4), "400", "H"), (gid(5), "500", "H")]
    assert rows(city.mapping.select("parcel_id", "municpal_parcel_id"))[:2] == [(gid(1), "100"), (gid(2), "200")]


def test_spine_buildings_and_units(city):
    assert rows(city.building.select("building_id", "parcel_id", "shape")) == [
        (gid(1, 1), gid(1), "simple"), (gid(1, 2), gid(1), "simple"), (gid(2, 1), gid(2), "simple"), (gid(4, 1), gid(4), "condo")]
    assert rows(city.unit.select("unit_id", "building_id")) == [
        (gid(1, 1, 1), gid(1, 1)), (gid(1, 2, 1), gid(1, 2)), (gid(2, 1, 1), gid(2, 1)), (gid(2, 1, 2), gid(2, 1)),
        (gid(4, 1, 1), gid(4, 1)), (gid(4, 1, 2), gid(4, 1))]


def test_spine_logs_and_checks(city):
    assert rows(city.logs().select("landuse", "route", "reason")) == [("BILLBOARD", "excluded", "not real estate"), ("R", "rejected", "no handle")]
    totals = Q.reconcile(city.routed).head()
    assert tuple(totals) == (8, 1, 1, 10, True)
    assert rows(city.secondary_owners.select("handle", "ownercode")) == [("500", "9")]
    for rule, bad in spine.checks(city).items():
        assert bad.isEmpty(), rule


def test_ids_follow_the_hierarchy(city):
    linked = city.unit.where(ids.building_of("unit_id") != F.col("building_id"))
    assert linked.isEmpty()


def test_a_region_has_more_than_a_million_parcels(spark, tmp_path):
    """Minted numbers go on past six digits, in all tables, checks and the published mapping."""
    known = spark.createDataFrame([("29510", "old", 999_999)], K.CROSSWALK)
    keys = "cityblock string, parcel string, ownercode string"
    accounts = spark.createDataFrame(
        [("100", "1", "10", "0", "1", "10", "0", "R", "N"), ("200", "2", "20", "0", "2", "20", "0", "R", "N")],
        f"handle string, {keys}, giscityblock string, gisparcel string, gisownercode string, landuse string, vacantland string")
    detail = spark.createDataFrame([("1", "10", "0", "1"), ("2", "20", "0", "1")], f"{keys}, bldgnum string")
    sections = spark.createDataFrame([("2", "20", "0", "1", "A")], f"{keys}, bldgnum string, sectnum string")
    built = spine.build(spine.Feeds(accounts, detail, detail, sections), known, spine.Region(840, 29510))
    assert rows(built.parcel.select("parcel_id")) == [(gid(1_000_000),), (gid(1_000_001),)]
    assert rows(built.unit.select("unit_id", "building_id")) == [(gid(1_000_000, 1, 1), gid(1_000_000, 1)), (gid(1_000_001, 1, 1), gid(1_000_001, 1))]
    assert built.unit.where(ids.building_of("unit_id") != F.col("building_id")).isEmpty()
    assert built.building.where(ids.parent_id("building_id") != F.col("parcel_id")).isEmpty()
    assert built.parcel.where(ids.parse_global_id("parcel_id")["parcel"] < 1_000_000).isEmpty() and spine.violations(built).isEmpty()
    store = Store(spark, str(tmp_path / "published"))
    assert spine.publish(built, store) == 1 and store.read("municipal_parcel_id_mapping").count() == 3


def test_publish(spark, city, tmp_path):
    store = Store(spark, str(tmp_path / "published"))
    assert spine.publish(city, store) == 1 and "unit" in store.current().tables
    assert store.read("unit").count() == 6 and store.read("exclusion_log").count() == 3
    broken = dataclasses.replace(city, parcel=city.parcel.where("handle <> '100'"))
    with pytest.raises(ValueError, match="fk building.parcel_id"):
        spine.publish(broken, store)
    assert store.current().number == 1


def test_owner_ids_survive_a_rerun(spark):
    feed = spark.createDataFrame([("Acme, Inc", "1 Main St.", "X", "MO", "1"), ("ACME INC", "1 MAIN ST", "x", "mo", "1"), ("Bob", None, None, None, None)],
                                 "name string, raw_line string, city string, state string, zip string")
    first = owners.build([feed], K.empty_crosswalk(spark), 840, 29510)
    assert first.legal_entity.count() == 2 and first.address.count() == 2
    more = spark.createDataFrame([("Aaron", "0 First", "X", "MO", "1")], feed.schema)
    again = owners.build([more, feed], first.crosswalk, 840, 29510)
    assert first.legal_entity.exceptAll(again.legal_entity).isEmpty()
    assert again.legal_entity.count() == 3
    assert Q.fk_violations(again.legal_entity, again.address, [("address_id", "address_id")]).isEmpty()


# --- use cases -----------------------------------------------------------------------------------

def test_blight_gap_recovers_a_linear_model(spark):
    df = spark.range(400).select(
        (F.col("id") % 4).alias("hood"), F.col("id").cast("double").alias("area"), (F.col("id") % 13).cast("double").alias("rooms"),
        (F.col("id") % 5 != 0).alias("active"),
    ).withColumn("value", F.when(F.col("active"), 10 + 3 * F.col("area") + 7 * F.col("rooms")).otherwise(100.0))
    df = df.withColumn("rooms", F.when(F.col("area") == 5, None).otherwise(F.col("rooms")))
    got = usecases.blight_gap(df, ["area", "rooms"], "value", F.col("active"), "hood")
    want = df.where("not active").groupBy("hood").agg(
        F.count("*"), F.count_if(F.col("rooms").isNull()), F.sum(F.when(F.col("rooms").isNotNull(), 100.0)),
        F.round(F.sum(10 + 3 * F.col("area") + 7 * F.col("rooms")), 1))
    assert rows(got.drop("gap")) == rows(want)


def test_demolition_effect(spark):
    values = spark.createDataFrame([("t", 1, 10.0), ("t", 5, 16.0), ("c", 1, 8.0), ("c", 5, 9.0), ("other", 1, 1.0)], "area string, at int, value double")
    razed = spark.createDataFrame([("t", 3), ("t", 9)], "area string, at int")
    levels = spark.createDataFrame([("t", 0), ("c", 0), ("other", 1)], "area string, level int")
    assert rows(usecases.demolition_effect(values, razed, levels)) == [(0, 10.0, 16.0, 8.0, 9.0, 5.0)]


def test_sections_and_accounts_are_numbered_as_numbers(spark):
    keys = "cityblock string, parcel string, ownercode string"
    building = spark.createDataFrame([("h", "1", "2", "3", 1, "simple")], f"handle string, {keys}, bldgnum long, shape string")
    sections = spark.createDataFrame([("1", "2", "3", "1", s) for s in ("10", "2", "A", "1", "2")], f"{keys}, bldgnum string, sectnum string")
    units = E.simple_units(building, sections, sections.limit(0))
    assert {r.sectnum: r.unit_seq for r in units.collect()} == {"1": 1, "2": 2, "10": 3, "A": 4}
    accounts = spark.createDataFrame([("h", "1", p, "0", "1", "1", "0") for p in ("1", "10", "9", "9B")], f"handle string, {keys}, giscityblock string, gisparcel string, gisownercode string")
    shape = spark.createDataFrame([("h", "condo")], "handle string, shape string")
    found = E.condo_units(accounts, shape, ["parcel", "ownercode"])
    assert {r.parcel: r.unit_seq for r in found.collect()} == {"9": 1, "10": 2, "9B": 3} and found.columns == [*accounts.columns, "unit_seq", "bldgnum"]


def test_building_numbers_out_of_range_are_rejected(spark):
    """0 is the parcel's own id, and what does not fit four digits would end the build."""
    detail = spark.createDataFrame([("1", "2", "3", n) for n in ("0", "1", "9999", "10000", "-1", None, "x")], "cityblock string, parcel string, ownercode string, bldgnum string")
    accounts = spark.createDataFrame([("1", "2", "3", "loaded", "simple", False)], "cityblock string, parcel string, ownercode string, _route string, shape string, _vacant boolean")
    got = {r.bldgnum: r.reason for r in spine.route_details(detail, accounts).collect()}
    wrong = "building number out of range"
    assert got == {"0": wrong, "1": None, "9999": None, "10000": wrong, "-1": wrong, None: "no building number", "x": "no building number"}


def test_units_and_buildings_are_dealt_out_by_their_rows(spark, monkeypatch):
    """More rows are more tasks, not larger ones; sections and residential rows of other buildings, nulls and copies change nothing."""
    monkeypatch.setattr("landledger.operators.ordering.TASK_ROWS", 20)
    accounts = [(f"h{i}", i, 1, 7) for i in range(300)] + [("c", 900, j, 7) for j in range(1, 4)] + [(None, 901, 1, 7)]
    accounts = spark.createDataFrame(accounts, "handle string, cityblock int, parcel int, ownercode int")
    detail = spark.createDataFrame(
        [(i, 1, 7, str(b)) for i in range(300) for b in (1, 2)] + [(900, 1, 7, "1"), (None, 1, 7, "1"), (5000, 1, 7, "1")],
        "cityblock int, parcel int, ownercode int, bldgnum string",
    )
    sections = [(i, 1, 7, "2", str(s)) for i in range(300) for s in range(1, 1 + i % 4)] * 2 + [(900, 1, 7, "1", "1"), (900, 1, 7, "1", "2"), (3, 1, 7, None, "1")]
    sections = spark.createDataFrame(sections, "cityblock int, parcel int, ownercode int, bldgnum string, sectnum string")
    homes = spark.createDataFrame([(i, 1, 7, "2") for i in range(0, 300, 5)] * 2 + [(900, 1, 7, "1")], "cityblock int, parcel int, ownercode int, bldgnum string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = E.buildings(accounts, E.shapes(accounts), detail)
        plan = built._jdf.queryExecution().executedPlan().toString()
        # 304 accounts and 603 building rows.
        assert ", 16), REPARTITION_BY_NUM" in plan and ", 31), REPARTITION_BY_NUM" in plan
        assert sorted(map(tuple, built.where("handle is not null and shape = 'condo'").select("handle", "bldgnum").collect())) == [("c", 1)]
        got = E.simple_units(built, sections, homes).where("handle is not null").select("handle", "bldgnum", "unit_seq", "sectnum")
        want = [(f"h{i}", 1, 1, None) for i in range(300)]
        for i in range(300):
            want += [(f"h{i}", 2, 1, None)] if i % 5 == 0 or i % 4 <= 1 else [(f"h{i}", 2, s, str(s)) for s in range(1, 1 + i % 4)]
        assert rows(got) == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

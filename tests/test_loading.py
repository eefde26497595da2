import re

from pyspark.sql import functions as F

from landledger.operators import catalog as C
from landledger.operators import loading as L
from landledger.operators import quality as Q
from landledger.plans import quality_queries
from landledger.plans.registry import Tables


def routes(found, key):
    return {(r[key], r.route, r.reason, r.root) for r in found.collect()}


def table(spark, schema, rows, rejected="false", excluded="false"):
    return Q.route(spark.createDataFrame(rows, schema), [("out", F.expr(excluded))], [("bad", F.expr(rejected))])


def test_groups_put_parents_first():
    links = [("b", "x", "a"), ("c", "x", "b"), ("c", "y", "d"), ("d", "z", "c"), ("e", "x", "d"), ("f", "self", "f")]
    order = L.load_groups("edcbaf", links)
    assert ["c", "d"] in order and order.index(["a"]) < order.index(["b"]) < order.index(["c", "d"]) < order.index(["e"]) and ["f"] in order
    assert [t for g in L.load_groups(C.COLUMNS, C.FOREIGN_KEYS) for t in g].index("building") > 0


def test_rejects_spread_with_the_first_lost_parent(spark):
    feeds = {
        "unit": table(spark, "u int, b int, o int", [(1, 10, 5), (2, 11, 5), (3, 12, 5), (4, None, 6), (5, 10, None), (6, 99, 6), (7, 13, 5)]),
        "building": table(spark, "b int, p int", [(10, 1), (11, 2), (12, 3), (13, 1), (13, 3)]),
        "parcel": table(spark, "p int, z string", [(1, "x"), (2, "x"), (3, "y")], rejected="p = 2", excluded="z = 'y'"),
        "owner": table(spark, "o int", [(5,)]),
    }
    links = [("building", "p", "parcel"), ("unit", "b", "building"), ("unit", "o", "owner")]
    found = L.cascade(feeds, {"parcel": "p", "building": "b", "owner": "o", "unit": "u"}, links)
    assert routes(found["building"], "b") == {
        (10, "loaded", None, None), (11, "rejected", "p: parcel rejected", "bad"), (12, "excluded", "p: parcel excluded", "out"), (13, "loaded", None, None), (13, "excluded", "p: parcel excluded", "out"),
    }
    assert routes(found["unit"], "u") == {
        (1, "loaded", None, None), (2, "rejected", "b: building rejected", "bad"), (3, "excluded", "b: building excluded", "out"),
        (4, "rejected", "o: owner missing", "o: owner missing"), (5, "loaded", None, None), (6, "rejected", "b: building missing", "b: building missing"),
        (7, "loaded", None, None),  # one of the two buildings 13 is loaded
    }
    for name, df in found.items():
        assert df.count() == feeds[name].count() and df.columns == [*feeds[name].columns, "root"]


def test_circles_and_self_references_come_to_rest(spark):
    n = 12
    chain = table(spark, "k int, up int, other int", [(i, i - 1 if i else None, None) for i in range(n)] + [(100, 101, None), (101, 100, None), (50, None, 7)], rejected="k = 3")
    other = table(spark, "q int, back int", [(7, 5), (8, 2)])
    found = L.cascade({"chain": chain, "other": other}, {"chain": "k", "other": "q"}, [("chain", "up", "chain"), ("chain", "other", "other"), ("other", "back", "chain")])
    lost = {r.k for r in found["chain"].where("route <> 'loaded'").collect()}
    assert lost == set(range(3, n)) | {50}
    assert {r.root for r in found["chain"].where("route <> 'loaded'").collect()} == {"bad"}
    assert routes(found["other"], "q") == {(7, "rejected", "back: chain rejected", "bad"), (8, "loaded", None, None)}


def test_integrity_counts(spark):
    frames = {
        "address": spark.createDataFrame([(1,), (1,), (None,), (2,)], "address_id int"),
        "legal_entity": spark.createDataFrame([(1, 1), (2, 7), (3, 7), (4, None)], "legal_entity_id int, address_id int"),
        "permit": spark.createDataFrame([(1, 2, 9), (2, 9, None)], "permit_id int, applicant_id int, contractor_id int").withColumn("permit_type_id", F.lit(3)),
    }
    got = {tuple(r) for r in C.integrity(frames).collect()}
    assert got == {
        ("pk address", "1", 2), ("pk address", None, 1), ("fk legal_entity.address_id", "7", 2), ("fk permit.applicant_id", "9", 1), ("fk permit.contractor_id", "9", 1),
    }
    assert C.integrity({"address": spark.createDataFrame([], "address_id int")}).isEmpty()


def test_all_keys_take_one_shuffle(spark, sf):
    text = quality_queries.current_integrity(Tables(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", text)) == 1


def test_loading_in_registry_order(spark):
    routed = {
        "building": table(spark, "building_id int, parcel_id int, owner_id int, use_type_id int", [(1, 1, None, None), (2, 5, None, None)]),
        "parcel": table(spark, "parcel_id int, owner_id int, zoning_class_id int", [(1, None, None)]),
    }
    found = C.load_in_order(routed)
    assert list(found) == ["parcel", "building"]
    assert Q.reconcile(found["building"]).head().asDict() == {"loaded": 1, "excluded": 0, "rejected": 1, "source": 2, "balanced": True}


def test_used_keys_are_hashed_and_not_sorted(spark, monkeypatch):
    """Only lost keys meet the texts of their parents; of several parent rows with one key the first by state counts."""
    plans, real = {}, L.materialize
    monkeypatch.setattr(L, "materialize", lambda df, label="step": (plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString()), real(df, label))[1])
    child = spark.createDataFrame([(1, "loaded"), (2, "loaded"), (3, "loaded"), (4, "loaded"), (5, "rejected"), (None, "loaded")], "k int, route string")
    parent = spark.createDataFrame([(1, "rejected", "z"), (1, "loaded", None), (2, "rejected", "a"), (2, "excluded", "b"), (4, "rejected", "d"), (4, "rejected", "c"), (5, "rejected", "e")], "id long, route string, root string")
    got = L.lost_keys(child, [("k", "p")], {"p": parent}, {"p": "id"})
    assert {tuple(r) for r in got.collect()} == {(0, "2", "excluded", "b"), (0, "3", "missing", None), (0, "4", "rejected", "c")}
    assert "HashAggregate" in plans["lost-keys"] and "SortAggregate" not in plans["lost-keys"]

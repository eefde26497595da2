import pytest
from pyspark.sql import functions as F

from landledger.operators import catalog as C
from landledger.operators import history as H
from landledger.operators import quality as Q


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_route_first_reason_wins_and_nothing_is_lost(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (None, "x"), (-1, "z")], "v int, t string")
    got = Q.route(df, [("is x", F.col("t") == "x")], [("null v", F.col("v").isNull()), ("negative", F.col("v") < 0), ("any", F.col("v") < 5)])
    assert rows(got.select("v", "route", "reason")) == sorted([
        (1, "excluded", "is x"), (2, "rejected", "any"), (3, "rejected", "any"), (None, "excluded", "is x"), (-1, "rejected", "negative")], key=repr)
    assert tuple(Q.reconcile(got).head()) == (0, 2, 3, 5, True)
    assert rows(Q.reconcile(Q.route(df), None)) == [(5, 0, 0, 5, True)]


def test_keys(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, t string")
    child = spark.createDataFrame([(1, "a"), (1, "z"), (2, "b"), (None, "a"), (9, "a"), (9, "a")], "p int, t string")
    assert rows(Q.fk_violations(child, parent, [("p", "id")])) == [(9, 2)]
    assert rows(Q.fk_violations(child, parent, [("p", "id"), ("t", "t")])) == [(1, "z", 1), (9, "a", 2)]
    assert rows(Q.pk_violations(child, ["p"])) == sorted([(1, 2), (9, 2), (None, 1)], key=repr)
    with pytest.raises(ValueError, match="not unique"):
        Q.require_unique(child, ["p"])
    assert Q.require_unique(parent.dropna(), ["id"]).count() == 2


def test_fk_check_shuffles_keys_not_rows(spark):
    child = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit("wide").alias("pad"))
    plan = Q.fk_violations(child, spark.range(3).toDF("id"), [("k", "id")])._jdf.queryExecution().executedPlan().toString()
    assert "pad" not in plan and plan.index("HashAggregate") < plan.index("Range")


def test_row_reconciliation(spark):
    src = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert tuple(Q.row_reconciliation(src, ["k"], spark.range(2)).head()) == (2, 2, True)
    assert tuple(Q.row_reconciliation(src, ["k"], spark.range(3)).head()) == (2, 3, False)


def test_mutation_audit(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, " y")], "k int, t string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, t string")
    assert rows(Q.mutation_audit(a, b, ["k", "t"])) == [(1, "x", 2, 1), (3, " y", 1, 0), (3, "y", 0, 1)]
    assert Q.mutation_audit(a, a, ["k", "t"]).isEmpty()


def test_profile_modes_agree(spark):
    df = spark.createDataFrame([(str(i % 2), None if i % 3 else "a", "") for i in range(60)], "flag string, some string, blank string")
    exact, quick = rows(Q.profile(df, exact=True)), rows(Q.profile(df))
    assert exact == quick
    by_name = {r[0]: r for r in exact}
    assert by_name["flag"][8:] == ("boolean", "coded_data") and by_name["blank"][8:] == ("empty", "other")
    assert by_name["some"][2:6] == (60, 40, 0, 1)


def test_profile_wide_table(spark):
    wide = spark.range(50).select(*[(F.col("id") % (i + 1)).cast("string").alias(f"c{i}") for i in range(187)])
    got = {r["column"]: r["n_distinct"] for r in Q.profile(wide, exact=True).collect()}
    assert got == {f"c{i}": min(i + 1, 50) for i in range(187)}


def test_schema_diff(spark):
    old = spark.createDataFrame([], "a int, b string, c double")
    new = spark.createDataFrame([], "b string, a int, c string, d date")
    got = {r["column"]: r["change"] for r in Q.schema_diff(Q.schema_frame(old, "t"), Q.schema_frame(new, "t")).collect()}
    assert got == {"a": "moved", "b": "moved", "c": "retyped", "d": "added"}
    assert Q.schema_diff(Q.schema_frame(old, "t"), Q.schema_frame(old, "t")).isEmpty()


def test_decode_health(spark):
    df = spark.createDataFrame([("z", "None"), ("z", "Area"), ("n", "x"), ("s", None)], "v string, title string")
    assert rows(Q.decode_health(df, "v", "title")) == [("n", 1, 0, True), ("s", 1, 1, False), ("z", 2, 1, False)]


def test_changes_null_safe_and_guarded(spark):
    old = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "c", "q")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, None, None)], "k int, v string, w string")
    assert rows(H.changes(old, new, ["k"]).select("k", "change")) == [(1, "same"), (2, "update"), (3, "delete"), (4, "insert")]
    with pytest.raises(ValueError, match="old snapshot"):
        H.changes(old.union(old), new, ["k"])


def test_history_and_validity(spark, tmp_path):
    path = str(tmp_path / "history")
    for snapshot, value in (("2024_01_01_00_00_00", "a"), ("2024_02_01_00_00_00", "b"), ("2024_02_01_00_00_00", "c")):
        H.snapshot_append(spark.createDataFrame([(1, value)], "k int, v string"), path, snapshot)
    history = H.read_history(spark, path)
    assert rows(history.select("k", "v", "snapshot")) == [(1, "a", "2024_01_01_00_00_00"), (1, "c", "2024_02_01_00_00_00")]
    ranged = H.validity(history, ["k"], "snapshot", F.substring("snapshot", 1, 7))
    assert rows(ranged.select("v", "valid_from", "valid_to", "is_current")) == [
        ("a", "2024_01_01_00_00_00", "2024_02_01_00_00_00", False), ("c", "2024_02_01_00_00_00", None, True)]


def test_registry_shape():
    assert len(C.SCHEMAS) == 19 and len(C.FOREIGN_KEYS) == 25
    for child, column, parent in C.FOREIGN_KEYS:
        assert column in C.SCHEMAS[child].names and parent in C.SCHEMAS
    order = C.build_order()
    assert all(order.index(parent) < order.index(child) for child, _, parent in C.FOREIGN_KEYS)
    assert C.dependents("inspection") == ["condemnation"] and "service" in C.dependents("use_type")
    assert C.schema("parcel", text_ids=True)["zip_code"].dataType.simpleString() == "string"
    assert C.schema("address", text_ids=True).names[-1] == "raw_line"


def test_lifecycle(spark):
    C.create_all(spark, "current_t")
    C.create_all(spark, "current_t")
    assert C.tables(spark, "current_t").count() == 19
    comment = [c.description for c in spark.catalog.listColumns("current_t.parcel") if c.name == "parcel_id"]
    assert comment == ["Warehouse identifier, not the municipal identifier (handle)"]
    spark.sql("insert into current_t.use_type values (1, 2)")
    spark.sql("insert into current_t.building values (1, 1, 1, 1, 1, 1)")
    spark.sql("insert into current_t.address values (1, 1, '', '', '', '', '', '', 1)")
    emptied = C.truncate_table(spark, "current_t", "use_type")
    assert "building" in emptied and "address" not in emptied
    assert spark.table("current_t.building").isEmpty() and not spark.table("current_t.address").isEmpty()
    assert len(C.truncate_all(spark, "current_t")) == 19 and spark.table("current_t.address").isEmpty()
    C.replace_table(spark.range(3).toDF("x"), "current_t", "merged")
    C.swap(spark, "current_t", "merged", "use_type")
    assert spark.table("current_t.use_type").columns == ["x"] and not spark.catalog.tableExists("current_t.merged")
    C.create_layer(spark, "history")
    assert "history" in [r[0] for r in C.layers(spark).collect()]
    C.reset_layer(spark, "current_t")
    assert C.tables(spark, "current_t").isEmpty()
    spark.sql("drop database current_t cascade")
    spark.sql("drop database history cascade")


def test_integrity(spark):
    frames = {
        "address": spark.createDataFrame([(1,), (1,)], "address_id int"),
        "legal_entity": spark.createDataFrame([(1, 1), (2, 7)], "legal_entity_id int, address_id int"),
    }
    found = [tuple(r) for r in C.integrity(frames).orderBy("rule").collect()]
    assert found == [("fk legal_entity.address_id", "7", 1), ("pk address", "1", 2)]

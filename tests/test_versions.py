import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landledger.operators import catalog
from landledger.operators import keys as K
from landledger.operators.versions import Conflict, Store


def refs(spark, *names):
    return K.native_refs(spark.createDataFrame([("29510", n) for n in names], "region string, ref string"), "region", "ref")


def seqs(crosswalk):
    return {r.native_ref: r.seq for r in crosswalk.collect()}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def failing(spark):
    return spark.range(10).select(F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("id"))


def test_all_tables_switch_together(spark, store):
    assert store.current() is None and store.versions().isEmpty()
    with pytest.raises(KeyError):
        store.read("a")
    assert store.publish({"a": spark.range(3), "b": spark.range(4)}) == 1
    before = store.read("a")
    with pytest.raises(PySparkException):
        store.publish({"a": spark.range(30), "b": failing(spark)})
    assert store.current().number == 1 and store.read("a").count() == 3 and store.read("b").count() == 4
    # A table made from itself, another kept as it is.
    assert store.publish({"a": store.read("a").unionAll(spark.range(2))}, keep=True) == 2
    assert store.read("a").count() == 5 and store.read("b").count() == 4 and before.count() == 3
    assert store.publish({"a": spark.range(1)}) == 3 and list(store.current().tables) == ["a"]
    assert store.roll_back(2) == 4 and store.read("a").count() == 5 and store.read("a", 3).count() == 1
    assert {(r.version, r.table, r.rows) for r in store.versions().collect()} == {(1, "a", 3), (1, "b", 4), (2, "a", 5), (2, "b", 4), (3, "a", 1), (4, "a", 5), (4, "b", 4)}


def test_recover_spares_what_is_named_or_new(spark, store, tmp_path):
    store.publish({"a": spark.range(3)})
    store.mint(refs(spark, "x"))
    with pytest.raises(PySparkException):
        store.publish({"a": spark.range(30), "b": failing(spark)})
    (tmp_path / "store/crosswalk/_half").mkdir()
    assert store.recover() == [] and len(os.listdir(tmp_path / "store/versions")) == 2
    gone = store.recover(older_than=0)
    assert len(gone) == 2 and "crosswalk/_half" in gone and len(os.listdir(tmp_path / "store/versions")) == 1
    assert store.read("a").count() == 3 and seqs(store.crosswalk()) == {"x": 1}


def test_two_publications_at_once(spark, store):
    """The one that ends second is refused, for its tables were made from what the first has replaced."""
    store.publish({"a": spark.range(1)})
    real = store._claim

    def late(made, folder, number):
        store._claim = real
        store.publish({"a": spark.range(2)})
        real(made, folder, number)

    store._claim = late
    with pytest.raises(Conflict):
        store.publish({"a": spark.range(3)})
    assert store.current().number == 2 and store.read("a").count() == 2
    assert not [n for n in store._names("log") if n.startswith("_")]


def test_ids_never_move(spark, store):
    assert seqs(store.mint(refs(spark, "m", "c"))) == {"c": 1, "m": 2}
    # A run that minted and died before it published: its ids are found again, in whatever order the next run comes.
    store.mint(refs(spark, "a", "z"))
    again = seqs(Store(spark, store.root).mint(refs(spark, "z", "b", "c", "a", "m")))
    assert again == {"c": 1, "m": 2, "a": 3, "z": 4, "b": 5} and seqs(store.crosswalk()) == again
    assert store._numbers("crosswalk") == [1, 2, 3]
    store.mint(refs(spark, "a", "b"))
    assert store._numbers("crosswalk") == [1, 2, 3]  # nothing new, no batch


def test_stale_crosswalks_are_refused(spark, store):
    store.mint(refs(spark, "a"))
    stale = K.extend(store.crosswalk(), refs(spark, "b")).cache()
    store.mint(refs(spark, "c"))
    with pytest.raises(Conflict):  # number 2 is c's
        store.append(stale)
    moved = spark.createDataFrame([("29510", "a", 9)], K.CROSSWALK)
    with pytest.raises(Conflict):
        store.append(moved)
    assert store.append(store.crosswalk()) == 0


def test_two_runs_mint_at_once(spark, store):
    real = store._claim

    def late(made, folder, number):
        store._claim = real
        store.mint(refs(spark, "b"))
        real(made, folder, number)

    store._claim = late
    assert seqs(store.mint(refs(spark, "a", "b"))) == {"b": 1, "a": 2} == seqs(store.crosswalk())


def test_views(spark, store):
    store.publish({"a": spark.range(3)})
    spark.sql("create database views_t")
    assert store.register("views_t") == ["a"] and spark.table("views_t.a").count() == 3
    store.publish({"a": spark.range(5)})
    store.register("views_t")
    assert spark.table("views_t.a").count() == 5
    spark.sql("drop database views_t cascade")


def test_a_reload_that_fails_keeps_the_table(spark):
    catalog.create_layer(spark, "reload_t")
    catalog.replace_table(spark.range(3), "reload_t", "a")
    with pytest.raises(PySparkException):
        catalog.replace_table(failing(spark), "reload_t", "a")
    assert spark.table("reload_t.a").count() == 3 and catalog.tables(spark, "reload_t").count() == 1
    catalog.replace_table(spark.table("reload_t.a").where("id > 0"), "reload_t", "a")
    assert spark.table("reload_t.a").count() == 2
    spark.sql("drop database reload_t cascade")

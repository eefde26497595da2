"""Crosswalk minting and hierarchical ids on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.operators import keys as K
from landledger.operators import quality as Q
from landledger.operators.ordering import number_copies, number_rows
from landledger.plans.registry import query
from landledger.session import materialize


def _customer_crosswalk(t):
    return K.mint(K.empty_crosswalk(t.spark), K.native_refs(t.customer, "c_nationkey", "c_name"))


_MINT_SQL = """
    SELECT c_nationkey::VARCHAR AS region, c_name AS native_ref,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS seq FROM customer"""


@query(_MINT_SQL)
def mint_crosswalk(t):
    return _customer_crosswalk(t)


@query("""
    SELECT 'all' AS region, l_orderkey || '-' || l_linenumber AS native_ref,
           row_number() OVER (ORDER BY l_orderkey || '-' || l_linenumber) AS seq
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def mint_one_region(t):
    ref = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return K.mint(K.empty_crosswalk(t.spark), K.native_refs(t.lineitem, F.lit("all"), ref))


@query("""
    WITH first_run AS (
      SELECT c_nationkey::VARCHAR AS region, c_name AS native_ref,
             row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS seq FROM customer WHERE c_mktsegment <> 'BUILDING'),
    later AS (
      SELECT c.c_nationkey::VARCHAR AS region, c_name AS native_ref,
             coalesce(m.top, 0) + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS seq
      FROM customer c LEFT JOIN (SELECT region, max(seq) AS top FROM first_run GROUP BY region) m ON m.region = c.c_nationkey::VARCHAR
      WHERE c_mktsegment = 'BUILDING')
    SELECT * FROM first_run UNION ALL SELECT * FROM later""")
def remint_is_stable(t):
    some = t.customer.where("c_mktsegment <> 'BUILDING'")
    first = K.mint(K.empty_crosswalk(t.spark), K.native_refs(some, "c_nationkey", "c_name"))
    return K.extend(first, K.native_refs(t.customer, "c_nationkey", "c_name"))


@query("""
    SELECT c_custkey, printf('840.%05d.%06d.0000.00000', 29510 + c_nationkey, c_custkey) AS parcel_id,
           printf('840.%05d.%06d.%04d.%05d', 29510 + c_nationkey, c_custkey, 1 + c_custkey % 7, c_custkey % 3) AS unit_id FROM customer""")
def global_id(t):
    region = F.col("c_nationkey") + 29510
    return t.customer.select(
        "c_custkey", ids.global_id(840, region, "c_custkey", grows=ids.MINTED).alias("parcel_id"),
        ids.global_id(840, region, "c_custkey", F.col("c_custkey") % 7 + 1, F.col("c_custkey") % 3, grows=ids.MINTED).alias("unit_id"),
    )


@query("""
    SELECT printf('840.%05d.%06d.%04d.%05d', 29510 + c_nationkey, c_custkey, c_custkey % 7, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey % 3 END) AS id,
           840::BIGINT AS country, 29510::BIGINT AS region, c_custkey AS parcel, c_custkey % 7 AS building,
           CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey % 3 END AS unit,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN printf('840.29510.%06d.0000.00000', c_custkey)
                ELSE printf('840.29510.%06d.%04d.00000', c_custkey, c_custkey % 7) END AS parent
    FROM customer WHERE c_nationkey = 0""")
def parse_global_id(t):
    building = F.col("c_custkey") % 7
    unit = F.when(building == 0, 0).otherwise(F.col("c_custkey") % 3)
    made = t.customer.select(ids.global_id(840, F.col("c_nationkey") + 29510, "c_custkey", building, unit, grows=ids.MINTED).alias("id"))
    parts = ids.parse_global_id("id")
    return made.where(ids.in_region("id", 840, 29510)).select("id", parts.alias("p"), ids.parent_id("id").alias("parent")).select(
        "id", "p.country", "p.region", "p.parcel", "p.building", "p.unit", "parent"
    )


@query("""
    SELECT printf('840.%05d.%06d.0000.00000', 29510, l_orderkey) AS parcel_id, count(*) AS n_units, sum(l_quantity)::DOUBLE AS quantity
    FROM lineitem GROUP BY l_orderkey""")
def hierarchy_join(t):
    unit = t.lineitem.select(
        ids.global_id(840, F.lit(29510), "l_orderkey", 1, F.col("l_linenumber"), grows=ids.MINTED).alias("unit_id"), "l_quantity"
    )
    rolled = unit.select(ids.parcel_of("unit_id").alias("parcel_id"), "l_quantity").groupBy("parcel_id").agg(
        F.count(F.lit(1)).alias("n_units"), F.sum("l_quantity").alias("quantity")
    )
    parcel = t.orders.select(ids.global_id(840, F.lit(29510), "o_orderkey", grows=ids.MINTED).alias("parcel_id"))
    return parcel.join(rolled, "parcel_id")


@query("""
    SELECT s_name, '840.29510.legal_entity.' || row_number() OVER (ORDER BY s_name) AS legal_entity_id FROM supplier""")
def namespaced_surrogate(t):
    minted = K.mint(K.empty_crosswalk(t.spark), K.native_refs(t.supplier, F.lit("legal_entity"), "s_name"))
    return minted.select(F.col("native_ref").alias("s_name"), ids.namespaced_id(840, 29510, "legal_entity", "seq").alias("legal_entity_id"))


@query("""
    SELECT printf('840.29510.%06d.%04d.00000', l_orderkey, l_linenumber) AS building_id,
           printf('840.29510.%06d.0000.00000', l_orderkey) AS parent_id, count(*) AS n_rows
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P' WHERE o_orderkey IS NULL GROUP BY ALL""")
def parent_links(t):
    # Ids are stored columns of the published tables; links are checked on those.
    building = t.lineitem.select(ids.global_id(840, F.lit(29510), "l_orderkey", "l_linenumber", grows=ids.MINTED).alias("building_id"))
    linked = materialize(building, "building").withColumn("parent_id", ids.parent_id("building_id"))
    parcel = t.orders.where("o_orderstatus <> 'P'").select(ids.global_id(840, F.lit(29510), "o_orderkey", grows=ids.MINTED).alias("parcel_id"))
    orphans = Q.fk_violations(linked, parcel, [("parent_id", "parcel_id")]).select("parent_id")
    return linked.join(orphans, "parent_id").groupBy("building_id", "parent_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
    SELECT 2 * count(*) AS n_rows, 2 * count(*) AS n_ids, 0::BIGINT AS n_clashes FROM customer""")
def federation(t):
    city, county = (
        K.mint(K.empty_crosswalk(t.spark), K.native_refs(t.customer, F.lit(region), "c_name")) for region in ("29510", "29189")
    )
    both = K.federate(*[part.select(ids.global_id(840, "region", "seq", grows=ids.MINTED).alias("id"), "native_ref") for part in (city, county)])
    return both.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"), F.count_if(F.col("n") > 1).alias("n_clashes")
    )


@query("""
    SELECT printf('840.%05d.%06d.0000.00000', c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name)) AS parcel_id,
           c_name AS municpal_parcel_id, c_nationkey::VARCHAR AS municipality_id FROM customer""")
def municipal_mapping(t):
    return K.municipal_mapping(_customer_crosswalk(t), 840, "region")


@query(f"""
    WITH x AS ({_MINT_SQL} WHERE c_mktsegment <> 'BUILDING')
    SELECT o_orderkey, c_name, seq AS parcel_seq FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN x ON x.region = c_nationkey::VARCHAR AND native_ref = c_name""")
def crosswalk_lookup(t):
    known = t.customer.where("c_mktsegment <> 'BUILDING'")
    registered = K.mint(K.empty_crosswalk(t.spark), K.native_refs(known, "c_nationkey", "c_name"))
    feed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_nationkey")
    return K.lookup(feed, registered, F.col("c_nationkey"), "c_name", "parcel_seq").drop("c_nationkey")


@query("""
    SELECT l_orderkey, l_linenumber,
           printf('%06d%03d', l_partkey * 100 % 1000000, l_linenumber) AS parcel9,
           printf('%06d%03d', l_partkey * 100 % 1000000, l_linenumber) || l_suppkey % 10 AS parcel11,
           printf('%06d', l_partkey * 100 % 1000000) || CASE WHEN length(l_orderkey::VARCHAR) >= 4 THEN '8' ELSE '0' END
             || printf('%04d', l_linenumber) || l_suppkey % 10 AS handle,
           length(l_orderkey::VARCHAR) >= 4 AS is_condo, count(*) AS n
    FROM lineitem GROUP BY ALL""")
def legacy_ids(t):
    block = (F.col("l_partkey") % 10000).cast("string")
    owner = (F.col("l_suppkey") % 10).cast("string")
    condo = ids.is_condo_placeholder("l_orderkey")
    return (
        t.lineitem.select(
            "l_orderkey", "l_linenumber", ids.parcel9(block, "l_linenumber").alias("parcel9"),
            ids.parcel11(block, "l_linenumber", owner).alias("parcel11"),
            ids.handle(block, condo, "l_linenumber", owner).alias("handle"), condo.alias("is_condo"),
        )
        .groupBy("l_orderkey", "l_linenumber", "parcel9", "parcel11", "handle", "is_condo")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("""
    SELECT event_type, user_id, event_id, row_number() OVER (PARTITION BY event_type ORDER BY user_id, event_id) AS seq FROM events""")
def numbered_rows(t):
    return number_rows(t.events.select("event_type", "user_id", "event_id"), ["event_type"], ["user_id", "event_id"])


@query("""
    SELECT l_returnflag, l_orderkey, l_linenumber, l_suppkey, l_partkey, copy_no,
           row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey, copy_no) + 1000 AS seq FROM (
      SELECT l_returnflag, l_orderkey, l_linenumber, l_suppkey, l_partkey,
             row_number() OVER (PARTITION BY l_returnflag, l_orderkey, l_linenumber, l_suppkey, l_partkey) AS copy_no FROM lineitem)""")
def number_large_keys(t):
    """Rows of three hot keys, placed by range over many tasks, after copies were numbered in chunks of one."""
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    unique = materialize(number_copies(rows, chunk=1), "copies")
    start = t.lineitem.select("l_returnflag").distinct().withColumn("start", F.lit(1000).cast("bigint"))
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "copy_no"]
    return number_rows(unique, ["l_returnflag"], order, "seq", start=start, window_rows=100)

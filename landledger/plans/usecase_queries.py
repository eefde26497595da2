"""Use cases and the whole spine build on the test tables."""

from __future__ import annotations

import dataclasses

from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.operators import keys as K
from landledger.operators import quality as Q
from landledger.operators.versions import Store
from landledger.plans import owners, spine, usecases
from landledger.plans.registry import query
from landledger.session import passing, scratch_path


@query("""
    SELECT c_nationkey, count(*) AS n_parcels, count(*) FILTER (o_orderstatus = 'F') AS n_vacant,
           round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS vacancy_rate
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""")
def vacancy(t):
    parcels = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return usecases.vacancy_by_neighborhood(parcels, F.col("o_orderstatus") == "F", "c_nationkey")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 100000""")
def vacancy_list(t):
    vacant = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000)
    return usecases.vacancy_list(t.orders, vacant, ["o_orderkey", "o_custkey"])


@query("""
    WITH e AS (
      SELECT o_custkey AS property_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS event_date, 'permit' AS kind, o_orderkey AS ref, o_orderpriority AS detail FROM orders
      UNION ALL SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 'service', event_id, event_type FROM events)
    SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY event_date, kind, ref) AS seq FROM e""")
def timeline(t):
    permits = t.orders.select(
        F.col("o_custkey").alias("property_id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_date"),
        F.col("o_orderkey").alias("ref"), F.col("o_orderpriority").alias("detail"),
    )
    services = t.events.select(
        F.col("user_id").alias("property_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_date"),
        F.col("event_id").alias("ref"), F.col("event_type").alias("detail"),
    )
    return usecases.timeline({"permit": permits, "service": services})


@query("""
    WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem WHERE l_returnflag <> 'N'),
    g AS (SELECT l_suppkey % 25 AS neighborhood, count(*) AS n_inactive, 0::BIGINT AS n_skipped, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS assessed,
                 round(sum(a + b * l_quantity), 1) AS modelled FROM lineitem, m WHERE l_returnflag = 'N' GROUP BY 1)
    SELECT *, round(modelled - assessed, 1) AS gap FROM g""")
def blight_gap(t):
    parcels = t.lineitem.withColumn("neighborhood", F.col("l_suppkey") % 25)
    return usecases.blight_gap(parcels, ["l_quantity"], "l_extendedprice", F.col("l_returnflag") != "N", "neighborhood")


_BLIGHT_FEATURES = ["l_quantity", "l_tax", "p_size", "p_retailprice"]


def _blight_parcels(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("neighborhood", F.col("l_suppkey") % 25)


@query()
def blight_gap_model(t):
    return usecases.blight_gap(_blight_parcels(t), _BLIGHT_FEATURES, "l_extendedprice", F.col("l_returnflag") != "N", "neighborhood")


@query("""SELECT unnest(['(intercept)', 'l_quantity', 'l_tax', 'p_size', 'p_retailprice']) AS feature, 0.0::DOUBLE AS share""")
def blight_gap_residuals(t):
    left = usecases.residual_sums(_blight_parcels(t), _BLIGHT_FEATURES, "l_extendedprice", F.col("l_returnflag") != "N")
    return left.select("feature", F.abs(F.round("share", 8)).alias("share"))


@query("""
    WITH own AS (SELECT user_id AS area, min(ts) AS own FROM events WHERE event_type = 'signup' AND json_extract_string(props, '$.k')::INTEGER >= 95 GROUP BY 1),
    areas AS (SELECT DISTINCT user_id AS area, user_id % 3 AS level FROM events),
    cuts AS (SELECT area, level, own, coalesce(own, min(own) OVER (PARTITION BY level)) AS cut FROM areas LEFT JOIN own USING (area)),
    v AS (SELECT user_id AS area, ts, value::DECIMAL(18,2) AS value FROM events WHERE event_type = 'purchase'),
    m AS (SELECT level, round(sum(value) FILTER (own IS NOT NULL AND ts < cut)::DOUBLE / count(*) FILTER (own IS NOT NULL AND ts < cut), 6) AS treated_before,
                 round(sum(value) FILTER (own IS NOT NULL AND ts >= cut)::DOUBLE / count(*) FILTER (own IS NOT NULL AND ts >= cut), 6) AS treated_after,
                 round(sum(value) FILTER (own IS NULL AND ts < cut)::DOUBLE / nullif(count(*) FILTER (own IS NULL AND ts < cut), 0), 6) AS control_before,
                 round(sum(value) FILTER (own IS NULL AND ts >= cut)::DOUBLE / count(*) FILTER (own IS NULL AND ts >= cut), 6) AS control_after
          FROM v JOIN cuts USING (area) GROUP BY level)
    SELECT *, round((treated_after - treated_before) - (control_after - control_before), 5) AS effect FROM m""")
def demolition_effect(t):
    values = t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("area"), F.col("ts").alias("at"), "value")
    razed = t.events.where((F.col("event_type") == "signup") & (F.get_json_object("props", "$.k").cast("int") >= 95))
    levels = t.events.select(F.col("user_id").alias("area")).distinct().withColumn("level", F.col("area") % 3)
    return usecases.demolition_effect(values, razed.select(F.col("user_id").alias("area"), F.col("ts").alias("at")), levels)


@query("""
    SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 1000""")
def owner_explorer(t):
    holders = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    held = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 1000)
    return usecases.explorer(t.orders, holders, "o_custkey", held, ["o_orderkey", "c_name", "o_totalprice"])


@query("""
    SELECT r_name, c_mktsegment, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total,
           (CASE WHEN grouping(c_mktsegment) = 0 THEN 2 WHEN grouping(r_name) = 0 THEN 1 ELSE 0 END)::INTEGER AS depth
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, c_mktsegment)""")
def development_dashboard(t):
    facts = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return usecases.dashboard(facts, ["r_name", "c_mktsegment"], "o_totalprice")


# --- the spine, end to end -----------------------------------------------------------------------

def _feeds(t):
    """Line items as accounts: vacant, shared and condo plots, plots without or with several footprints, unmatched details."""
    line = t.lineitem
    key = [F.col("l_orderkey").alias("cityblock"), F.col("l_linenumber").alias("parcel"), F.col("l_suppkey").alias("ownercode")]
    accounts = line.select(
        F.col("l_orderkey").alias("handle"), *key, F.col("l_orderkey").alias("giscityblock"), F.lit(1).alias("gisparcel"),
        F.col("l_suppkey").alias("gisownercode"), F.col("l_returnflag").alias("landuse"),
        F.when(F.col("l_partkey") % 7 == 0, "Y").otherwise("N").alias("vacantland"),
        F.col("l_linestatus").alias("zoning"), F.col("l_quantity").alias("frontage"), F.col("l_partkey").alias("tie"),
        F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("shipped"),
    )
    lost = F.when(F.col("l_suppkey") % 50 == 0, F.col("l_linenumber") + 100).otherwise(F.col("l_linenumber")).alias("parcel")
    key = [key[0], lost, key[2]]
    detail = line.select(*key, F.lit("1").alias("bldgnum"), F.col("l_extendedprice").alias("totalarea"))
    section = line.select(*key, F.lit("1").alias("bldgnum"), F.explode(F.sequence(F.lit(1), F.pmod("l_partkey", F.lit(3)) + 1)).alias("sectnum"))
    homes = line.where("l_returnflag = 'R'").select(*key, F.lit("1").alias("bldgnum"))
    return spine.Feeds(accounts, detail, homes, section)


def _spine(t, crosswalk=None, only=None):
    feeds = _feeds(t)
    if only is not None:
        feeds = dataclasses.replace(feeds, accounts=feeds.accounts.where(only))
    return spine.build(
        feeds, crosswalk or K.empty_crosswalk(t.spark), spine.Region(840, 29510), not_real_estate=["A"], condo=F.col("zoning") == "O",
    )


_TIES = "l_returnflag, l_partkey % 7 = 0, l_linestatus, l_quantity, l_partkey, l_extendedprice, l_shipdate"
_SPINE_SQL = f"""
    WITH real AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey ORDER BY {_TIES}) AS nth FROM lineitem WHERE l_returnflag <> 'A'),
    main AS (SELECT l_orderkey, min({{'a': l_linenumber, 'b': l_suppkey}}) AS m FROM real WHERE nth = 1 AND l_linenumber = 1 GROUP BY l_orderkey),
    routed AS (SELECT real.*, CASE WHEN nth > 1 THEN 'repeated account key' WHEN m IS NULL THEN 'plot without footprint'
                 WHEN l_linenumber = 1 AND l_suppkey <> m.b THEN 'second footprint of its plot' END AS reason FROM real LEFT JOIN main USING (l_orderkey)),
    loaded AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, bool_or(l_linestatus = 'O') OVER (PARTITION BY l_orderkey) AS condo, l_partkey % 7 = 0 AS vacant
               FROM routed WHERE reason IS NULL),
    plots AS (SELECT *, CASE WHEN n = 1 THEN 'simple' WHEN condo THEN 'condo' ELSE 'shared' END AS shape FROM loaded),
    x AS (SELECT h AS l_orderkey, row_number() OVER (ORDER BY h::VARCHAR) AS seq FROM (SELECT DISTINCT l_orderkey AS h FROM loaded)),
    accounts AS (
        SELECT l_orderkey, l_linenumber, l_suppkey, 'loaded' AS route, shape, vacant FROM plots
        UNION ALL SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, 'rejected', NULL, NULL::BOOLEAN FROM routed r WHERE reason IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM plots p WHERE p.l_orderkey = r.l_orderkey AND p.l_linenumber = r.l_linenumber AND p.l_suppkey = r.l_suppkey)
        UNION ALL SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, 'excluded', NULL, NULL::BOOLEAN FROM lineitem r WHERE l_returnflag = 'A'
            AND NOT EXISTS (SELECT 1 FROM real p WHERE p.l_orderkey = r.l_orderkey AND p.l_linenumber = r.l_linenumber AND p.l_suppkey = r.l_suppkey)),
    fed AS (SELECT l_orderkey, CASE WHEN l_suppkey % 50 = 0 THEN l_linenumber + 100 ELSE l_linenumber END AS l_linenumber, l_suppkey, l_extendedprice, l_partkey, l_returnflag FROM lineitem),
    details AS (SELECT fed.*, route, CASE WHEN route = 'excluded' THEN 'account excluded' WHEN vacant THEN 'vacant land'
                  WHEN shape = 'condo' THEN 'condo plot, its one building is synthesized' WHEN route IS NULL THEN 'no such account' WHEN route = 'rejected' THEN 'account rejected'
                  WHEN shape = 'shared' THEN 'plot shared by several accounts' WHEN nth > 1 THEN 'repeated building number' END AS reason
                FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey ORDER BY l_extendedprice) AS nth FROM fed) fed
                LEFT JOIN accounts USING (l_orderkey, l_linenumber, l_suppkey)),
    simple AS (SELECT * FROM details WHERE reason IS NULL),
    parts AS (SELECT 'sections' AS feed, fed.*, s.l_orderkey IS NULL AS lost, u FROM fed LEFT JOIN simple s USING (l_orderkey, l_linenumber, l_suppkey), unnest(range(1, 2 + fed.l_partkey % 3)) AS t(u)
              UNION ALL SELECT 'residential', fed.*, s.l_orderkey IS NULL, 0 FROM fed LEFT JOIN simple s USING (l_orderkey, l_linenumber, l_suppkey) WHERE fed.l_returnflag = 'R'),
    homes AS (SELECT DISTINCT l_orderkey FROM parts WHERE feed = 'residential' AND NOT lost),
    sections AS (SELECT DISTINCT l_orderkey, u FROM parts WHERE feed = 'sections' AND NOT lost),
    counted AS (SELECT l_orderkey, count(*) AS k FROM sections GROUP BY l_orderkey),
    units AS (
        SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS u FROM plots WHERE shape = 'condo' AND NOT vacant AND l_linenumber <> 1
        UNION ALL SELECT l_orderkey, 1 FROM simple LEFT JOIN counted USING (l_orderkey) WHERE l_orderkey IN (SELECT l_orderkey FROM homes) OR coalesce(k, 0) <= 1
        UNION ALL SELECT l_orderkey, u FROM sections JOIN counted USING (l_orderkey) WHERE k > 1 AND l_orderkey NOT IN (SELECT l_orderkey FROM homes)),
    buildings AS (SELECT l_orderkey, 'simple' AS shape, l_extendedprice AS totalarea FROM simple
        UNION ALL SELECT DISTINCT l_orderkey, 'condo', NULL FROM plots WHERE shape = 'condo' AND NOT vacant AND l_linenumber <> 1)"""


@query(f"""{_SPINE_SQL}
    SELECT printf('840.29510.%06d.0000.00000', seq) AS parcel_id, l_orderkey AS handle, l_quantity AS frontage, l_linestatus AS zoning_class_id
    FROM plots JOIN x USING (l_orderkey) WHERE l_linenumber = 1""")
def spine_parcels(t):
    return _spine(t).parcel


@query(f"""{_SPINE_SQL}
    SELECT printf('840.29510.%06d.0001.%05d', seq, u) AS unit_id, printf('840.29510.%06d.0001.00000', seq) AS building_id, l_orderkey AS handle
    FROM units JOIN x USING (l_orderkey)""")
def spine_units(t):
    return _spine(t).unit


@query(f"""{_SPINE_SQL}
    SELECT printf('840.29510.%06d.0001.00000', seq) AS building_id, printf('840.29510.%06d.0000.00000', seq) AS parcel_id, shape, totalarea
    FROM buildings JOIN x USING (l_orderkey)""")
def spine_buildings(t):
    return _spine(t).building.select("building_id", "parcel_id", "shape", "totalarea")


@query("SELECT '' AS rule, 0::BIGINT AS n WHERE false")
def spine_checks(t):
    return spine.violations(_spine(t))


_ROUTES_SQL = f"""{_SPINE_SQL}, routes AS (
    SELECT 'accounts' AS feed, CASE WHEN reason IS NULL THEN 'loaded' ELSE 'rejected' END AS route, reason FROM routed
    UNION ALL SELECT 'accounts', 'excluded', 'not real estate' FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL SELECT 'buildings', CASE WHEN reason IS NULL THEN 'loaded' WHEN reason IN ('account excluded', 'vacant land', 'condo plot, its one building is synthesized')
        THEN 'excluded' ELSE 'rejected' END, reason FROM details
    UNION ALL SELECT feed, CASE WHEN lost THEN 'rejected' ELSE 'loaded' END, CASE WHEN lost THEN 'no such building loaded' END FROM parts)"""


@query(f"""{_ROUTES_SQL} SELECT feed, route, reason, count(*) AS n FROM routes GROUP BY feed, route, reason""")
def spine_logs(t):
    return _spine(t).feeds().groupBy("feed", "route", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{_ROUTES_SQL}
    SELECT feed, count(*) FILTER (route = 'loaded') AS loaded, count(*) FILTER (route = 'excluded') AS excluded, count(*) FILTER (route = 'rejected') AS rejected,
           count(*) AS source, true AS balanced FROM routes GROUP BY feed""")
def spine_reconciliation(t):
    return Q.reconcile(_spine(t).feeds(), "feed")


@query(f"""{_SPINE_SQL}
    SELECT printf('840.29510.%06d.0000.00000', seq) AS parcel_id, l_orderkey::VARCHAR AS municpal_parcel_id, false AS moved
    FROM (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey % 2, l_orderkey::VARCHAR) AS seq FROM x)""")
def spine_republished(t):
    """Published for part of the plots, then for all: the plots of the first time keep their ids."""
    store = Store(t.spark, scratch_path(t.spark, "published"))
    # What a build has written is of no use once it is published.
    with passing():
        spine.publish(_spine(t, only="handle % 2 = 0"), store)
    with passing():
        spine.publish(_spine(t, store.crosswalk()), store)
    first = store.read("municipal_parcel_id_mapping", 1).select("municpal_parcel_id", F.col("parcel_id").alias("was"))
    joined = store.read("municipal_parcel_id_mapping").join(first, "municpal_parcel_id", "left")
    return joined.select("parcel_id", "municpal_parcel_id", F.coalesce(F.col("parcel_id") != F.col("was"), F.lit(False)).alias("moved"))


@query("""
    WITH x AS (SELECT c_custkey, c_nationkey, c_name, printf('840.%05d.%06d.0000.00000', c_nationkey, row_number() OVER (
        PARTITION BY c_nationkey ORDER BY c_mktsegment <> 'BUILDING', c_name)) AS id FROM customer),
    o AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)
    SELECT id AS parcel_id, c_name AS municpal_parcel_id, coalesce(n_orders, 0) AS n_orders, c_mktsegment = 'BUILDING' AS in_between, false AS moved,
           c_mktsegment = 'BUILDING' AS first_time, true AS whole_between FROM x JOIN customer USING (c_custkey, c_name) LEFT JOIN o ON o_custkey = c_custkey""")
def publication_survives_failure(t):
    """A publication that fails half way, between two that do not: ids stay, and the old set is whole in between.

    The first covers one segment of the customers. The second mints the others and dies in its last table. Then it is run again.
    """
    store = Store(t.spark, scratch_path(t.spark, "published"))
    counted = t.customer.join(t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders")), "c_custkey", "left")

    def tables(customers):
        crosswalk = store.mint(K.native_refs(customers, "c_nationkey", "c_name"))
        parcel = K.lookup(customers, crosswalk, F.col("c_nationkey"), "c_name", "seq").select(
            ids.global_id(840, "c_nationkey", "seq", grows=ids.MINTED).alias("parcel_id"), F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        )
        return {"municipal_parcel_id_mapping": K.municipal_mapping(crosswalk, 840, "region"), "parcel": parcel}

    def published():
        return store.read("municipal_parcel_id_mapping").join(store.read("parcel"), "parcel_id")

    store.publish(tables(counted.where("c_mktsegment = 'BUILDING'")))
    first = published().select("municpal_parcel_id", F.col("parcel_id").alias("was"))
    n_first = first.count()
    second = tables(counted)
    try:
        store.publish(second | {"parcel": second["parcel"].where(F.col("n_orders") < F.raise_error(F.lit("the disk is full")).cast("bigint"))})
    except SparkRuntimeException:
        pass
    between = published().select("municpal_parcel_id", F.lit(True).alias("in_between"))
    whole = store.current().number == 1 and between.count() == n_first
    store.publish(tables(counted))
    joined = published().join(first, "municpal_parcel_id", "left").join(between, "municpal_parcel_id", "left")
    return joined.select(
        "parcel_id", "municpal_parcel_id", "n_orders", F.coalesce("in_between", F.lit(False)).alias("in_between"),
        F.coalesce(F.col("parcel_id") != F.col("was"), F.lit(False)).alias("moved"), F.col("was").isNotNull().alias("first_time"), F.lit(whole).alias("whole_between"),
    )


# --- owners --------------------------------------------------------------------------------------

def _owner_tables(t):
    customers = t.customer.select(
        F.concat(F.lit("Owner "), (F.col("c_custkey") % 400).cast("string")).alias("name"),
        F.concat((F.col("c_nationkey") % 7).cast("string"), F.lit(" Main St.")).alias("raw_line"),
        F.col("c_mktsegment").alias("city"), F.lit("MO").alias("state"), F.lit(None).cast("string").alias("zip"),
    )
    suppliers = t.supplier.select(
        F.concat(F.lit("OWNER, "), (F.col("s_suppkey") % 400).cast("string")).alias("name"),
        F.concat((F.col("s_nationkey") % 7).cast("string"), F.lit("  main st")).alias("raw_line"),
        F.lit("building").alias("city"), F.lit("mo").alias("state"), F.lit(None).cast("string").alias("zip"),
    )
    return owners.build([customers, suppliers], K.empty_crosswalk(t.spark), 840, 29510)


_OWNER_SQL = """
    WITH s AS (
      SELECT 'OWNER ' || c_custkey % 400 AS n, c_nationkey % 7 || ' MAIN ST|' || c_mktsegment || '|MO|' AS a,
             'Owner ' || c_custkey % 400 AS name, c_nationkey % 7 || ' Main St.' AS raw_line FROM customer
      UNION ALL SELECT 'OWNER ' || s_suppkey % 400, s_nationkey % 7 || ' MAIN ST|BUILDING|MO|', 'OWNER, ' || s_suppkey % 400,
             s_nationkey % 7 || '  main st' FROM supplier),
    addr AS (SELECT a, row_number() OVER (ORDER BY a) AS id, min(raw_line) AS raw_line FROM s GROUP BY a),
    ent AS (SELECT n, a, row_number() OVER (ORDER BY n || '|' || a) AS id, min(name) AS name FROM s GROUP BY n, a)"""


@query(f"""{_OWNER_SQL}
    SELECT '840.29510.legal_entity.' || ent.id AS legal_entity_id, name, '840.29510.address.' || addr.id AS address_id FROM ent JOIN addr USING (a)""")
def owner_entities(t):
    return _owner_tables(t).legal_entity


@query(f"""{_OWNER_SQL}
    SELECT '840.29510.address.' || id AS address_id, raw_line FROM addr""")
def owner_addresses(t):
    return _owner_tables(t).address.select("address_id", "raw_line")

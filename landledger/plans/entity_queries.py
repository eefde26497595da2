"""Merges, decodes, unions and the spine builders on the test tables.

Stand-ins: an order is a plot of land (handle), its line items are the accounts on it; customers and
suppliers are owners; nations and regions are vocabularies; events are permit and service feeds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.operators import entities as E
from landledger.plans.registry import query
from landledger.session import materialize

ORDER = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
         "l_linestatus", "l_shipdate"]


def _double(column: str):
    return F.col(column).cast("double").alias(column)


_STANDARD = """
    SELECT l_partkey AS parcel_id, l_returnflag || l_linestatus AS prop_add, l_suppkey::VARCHAR AS prop_zip, l_returnflag AS municipali,
           {county} AS county, l_extendedprice AS asstlandva, l_quantity AS asstimpval, l_tax AS totassmt, l_returnflag AS propclass,
           CASE WHEN l_linenumber < 3 THEN l_linestatus END AS zoning, year(l_shipdate)::INTEGER AS yearblt
    FROM lineitem WHERE l_linestatus {test} 'O'"""

_ALL_PARCELS = _STANDARD.format(county="'city'", test="=") + "\n    UNION ALL" + _STANDARD.format(county="'county'", test="<>")


def _all_parcels(t):
    """Two tables cut to the standard columns (geometry aside) and stacked."""
    lines = t.lineitem.select(
        F.col("l_partkey").alias("parcel_id"), F.concat("l_returnflag", "l_linestatus").alias("prop_add"),
        F.col("l_suppkey").cast("string").alias("prop_zip"), F.col("l_returnflag").alias("municipali"),
        F.when(F.col("l_linestatus") == "O", "city").otherwise("county").alias("county"),
        F.col("l_extendedprice").alias("asstlandva"), F.col("l_quantity").alias("asstimpval"), F.col("l_tax").alias("totassmt"),
        F.col("l_returnflag").alias("propclass"), F.when(F.col("l_linenumber") < 3, F.col("l_linestatus")).alias("zoning"),
        F.year("l_shipdate").alias("yearblt"),
    )
    columns = [c for c in E.PARCEL_COLUMNS if c != "geom"]
    return E.union_standard([lines.where("county = 'city'"), lines.where("county = 'county'")], columns)


@query(f"""
    SELECT parcel_id, string_agg(DISTINCT prop_add, ', ' ORDER BY prop_add) AS prop_add, min(prop_zip) AS prop_zip, min(municipali) AS municipali,
           min(county) AS county, sum(asstlandva::DECIMAL(18,2))::DOUBLE AS asstlandva, sum(asstimpval::DECIMAL(18,2))::DOUBLE AS asstimpval,
           sum(totassmt::DECIMAL(18,2))::DOUBLE AS totassmt, string_agg(DISTINCT propclass, ', ' ORDER BY propclass) AS propclass,
           string_agg(DISTINCT zoning, ', ' ORDER BY zoning) AS zoning, max(yearblt) AS yearblt
    FROM ({_ALL_PARCELS}) GROUP BY parcel_id""")
def merge_duplicates(t):
    merged = E.merge_duplicates(_all_parcels(t), "parcel_id", E.PARCEL_MERGE)
    sums = [c for c, how in E.PARCEL_MERGE.items() if how == "sum"]
    return merged.select(*[_double(c) if c in sums else F.col(c) for c in merged.columns])


@query(f"SELECT county, count(*) AS n, sum(asstlandva::DECIMAL(18,2))::DOUBLE AS asstlandva FROM ({_ALL_PARCELS}) GROUP BY county")
def all_parcels(t):
    return _all_parcels(t).groupBy("county").agg(
        F.count(F.lit(1)).alias("n"), F.sum(E.money("asstlandva")).cast("double").alias("asstlandva")
    )


@query("""
    SELECT o.*, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders) o
    LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey""")
def left_merge(t):
    target = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return E.left_merge(target, t.customer.where("c_mktsegment <> 'BUILDING'"), "o_custkey", "c_custkey")


@query("""
    SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def left_merge_fan_out(t):
    right = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return E.left_merge(t.customer.select("c_custkey"), right, "c_custkey", "o_custkey")


@query("""
    SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice * 2, 2) AS p_retailprice FROM part""")
def update_column(t):
    changed = t.part.withColumn("p_retailprice", F.round(F.col("p_retailprice") * 2, 2))
    return materialize(changed, "part-version")


@query("""
    SELECT s_suppkey, n_name AS nation, r_name AS region FROM supplier
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def decode_join(t):
    nations = t.nation.where("n_regionkey <> 0")
    named = E.decode(t.supplier, nations, "s_nationkey", "nation", "n_nationkey", "n_name")
    placed = E.decode(named, nations, "s_nationkey", "region_key", "n_nationkey", "n_regionkey")
    return E.decode(placed, t.region, "region_key", "region", "r_regionkey", "r_name").select("s_suppkey", "nation", "region")


@query("""
    SELECT p_type AS code, count(DISTINCT p_size) AS n_titles, min(p_size::VARCHAR) AS first_title, max(p_size::VARCHAR) AS last_title
    FROM part WHERE p_type <> '' GROUP BY p_type HAVING count(DISTINCT p_size) > 1""")
def repeated_codes(t):
    return E.repeated_codes(t.part.select("p_type", F.col("p_size").cast("string").alias("size")), "p_type", "size")


@query("""
    SELECT c_nationkey, count(*) AS n_rows FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 0 GROUP BY c_nationkey""")
def undecoded_codes(t):
    decoded = E.decode(t.customer, t.nation.where("n_regionkey <> 0"), "c_nationkey", "nation", "n_nationkey", "n_name")
    return E.undecoded(decoded, "c_nationkey", "nation")


@query("""
    SELECT p_partkey, p_size AS street_number, CASE p_partkey % 3 WHEN 0 THEN 'North' WHEN 1 THEN 'West' END AS direction,
           p_name AS street_name, CASE WHEN p_partkey % 2 = 0 THEN p_partkey::VARCHAR END AS secondary_designator FROM part""")
def address_components(t):
    direction = F.when(F.col("p_partkey") % 3 == 0, "N ").when(F.col("p_partkey") % 3 == 1, "w ").otherwise("")
    unit = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" Unit "), F.col("p_partkey").cast("string"))).otherwise("")
    line = F.concat(F.col("p_size").cast("string"), F.lit(" "), direction, "p_name", unit)
    parsed = t.part.select("p_partkey", E.parse_situs(line).alias("a")).select("p_partkey", "a.*")
    titles = F.create_map(*[F.lit(x) for pair in E.DIRECTIONS.items() for x in pair])
    return parsed.select("p_partkey", "street_number", titles[F.col("street_name_prefix")].alias("direction"), "street_name", "secondary_designator")


@query("""
    SELECT event_id AS inspection_id, user_id AS building_id, strftime(ts, '%Y-%m-%d') AS inspection_date,
           NULL::INTEGER AS number_of_violations, n_name AS inspection_type
    FROM events LEFT JOIN nation ON n_nationkey = json_extract_string(props, '$.k')::INTEGER WHERE event_type = 'error'""")
def inspection_events(t):
    found = t.events.where("event_type = 'error'").withColumn("code", F.get_json_object("props", "$.k").cast("int"))
    typed = E.decode(found, t.nation, "code", "kind", "n_nationkey", "n_name")
    return E.inspections(typed, "event_id", "user_id", F.col("ts"), "kind").drop("completion_date").withColumn(
        "inspection_date", F.col("inspection_date").cast("string")
    )


@query("""
    SELECT event_id AS condemnation_id, user_id AS inspection_id, strftime(ts, '%Y-%m-%d') AS letter_date, n_name AS condemnation_type,
           c_mktsegment AS status
    FROM events LEFT JOIN nation ON n_nationkey = user_id % 40 LEFT JOIN customer ON c_custkey = user_id WHERE event_type = 'signup'""")
def condemnation_events(t):
    letters = t.events.where("event_type = 'signup'").withColumn("code", F.col("user_id") % 40)
    typed = E.decode(letters, t.nation, "code", "kind", "n_nationkey", "n_name")
    status = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("status"))
    joined = E.composite_join(typed, status, ["user_id"])
    return E.condemnations(joined, "event_id", "user_id", F.col("ts"), "kind", "status").withColumn(
        "letter_date", F.col("letter_date").cast("string")
    )


@query("""
    WITH bldg AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS area FROM lineitem GROUP BY ALL),
         sect AS (SELECT l_orderkey, l_linenumber, l_suppkey, max(l_tax) AS rate FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
    SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, area, coalesce(rate, 0.0) AS rate
    FROM lineitem l LEFT JOIN bldg USING (l_orderkey, l_linenumber) LEFT JOIN sect USING (l_orderkey, l_linenumber, l_suppkey)""")
def composite_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    detail = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("area"))
    section = t.lineitem.where("l_returnflag = 'A'").groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.max("l_tax").alias("rate"))
    with_detail = E.composite_join(lines, detail, ["l_orderkey", "l_linenumber"])
    return E.composite_join(with_detail, section, ["l_orderkey", "l_linenumber", "l_suppkey"]).withColumn(
        "rate", F.coalesce("rate", F.lit(0.0))
    )


def _owners(t):
    customers = t.customer.select(
        F.col("c_name").alias("name"), F.concat(F.lit("Nation "), (F.col("c_nationkey") % 5).cast("string")).alias("address"),
        F.lit("customer").alias("source"), F.col("c_custkey").alias("source_key"),
    )
    suppliers = t.supplier.select(
        F.concat(F.lit("customer #"), F.format_string("%09d", "s_suppkey")).alias("name"),
        F.concat(F.lit(" nation  "), (F.col("s_nationkey") % 5).cast("string"), F.lit(".")).alias("address"),
        F.lit("supplier").alias("source"), F.col("s_suppkey").alias("source_key"),
    )
    return E.union_standard([customers, suppliers], ["name", "address", "source", "source_key"])


_OWNERS = """
    SELECT c_name AS name, 'Nation ' || c_nationkey % 5 AS address, 'customer' AS source, c_custkey AS source_key FROM customer
    UNION ALL SELECT 'customer #' || printf('%09d', s_suppkey), ' nation  ' || s_nationkey % 5 || '.', 'supplier', s_suppkey FROM supplier"""


@query(_OWNERS)
def union_owners(t):
    return _owners(t)


def _norm_sql(column: str) -> str:
    return f"trim(regexp_replace(regexp_replace(upper({column}), '[^A-Z0-9 ]', '', 'g'), ' +', ' ', 'g'))"


@query(f"""
    SELECT {_norm_sql("replace(lower(name), ' ', '')")} AS name_key, {_norm_sql("address")} AS address_key, min(replace(lower(name), ' ', '')) AS name, min(address) AS raw_line,
           count(*) AS n_sources FROM ({_OWNERS}) GROUP BY 1, 2""")
def entity_dedup(t):
    owners = _owners(t).withColumn("name", F.translate(F.lower("name"), " ", ""))
    return E.dedup_entities(owners, "name", "address")


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_name || ' ' || c_mktsegment END AS owner FROM customer""")
def owner_names(t):
    second = F.when(F.col("c_custkey") % 4 == 0, " ").when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment"))
    return t.customer.withColumn("name2", second).select("c_custkey", E.display_name("c_name", "name2").alias("owner"))


@query("""
    SELECT event_id, event_type AS permit_type, strftime(ts, '%Y-%m-%d') AS issue_date, value AS cost,
           CASE WHEN event_type = 'click' THEN user_id END AS applicant_id, CASE WHEN event_type = 'purchase' THEN props END AS description
    FROM events""")
def union_feeds(t):
    def feed(kind: str, *extra):
        day = F.date_format("ts", "yyyy-MM-dd").alias("issue_date")
        return t.events.where(F.col("event_type") == kind).select("event_id", day, F.col("value").alias("cost"), *extra)

    extra = {"click": [F.col("user_id").alias("applicant_id")], "purchase": [F.col("props").alias("description")]}
    kinds = ("click", "error", "purchase", "signup", "view")
    return E.union_feeds({kind: feed(kind, *extra.get(kind, [])) for kind in kinds}, "permit_type")


@query("""
    SELECT type_id, service_type, n FROM (
      SELECT row_number() OVER (ORDER BY event_type) AS type_id, event_type AS service_type, count(*) AS n FROM events GROUP BY event_type)""")
def service_types(t):
    from landledger.operators import keys as K

    minted = K.mint(K.empty_crosswalk(t.spark), K.native_refs(t.events, F.lit("service_type"), "event_type"))
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return minted.join(counts, F.col("native_ref") == F.col("event_type")).select(
        F.col("seq").alias("type_id"), F.col("event_type").alias("service_type"), "n"
    )


# --- spine ---------------------------------------------------------------------------------------

def accounts(t):
    """Line items as assessment accounts; line 1 of a plot is its footprint account."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("handle"), F.col("l_orderkey").alias("cityblock"), F.col("l_linenumber").alias("parcel"),
        F.col("l_suppkey").alias("ownercode"), F.col("l_orderkey").alias("giscityblock"), F.lit(1).alias("gisparcel"),
        F.col("l_suppkey").alias("gisownercode"), *[F.col(c) for c in ORDER],
    )


@query("""
    SELECT l_orderkey AS handle, count(*) AS n_accounts, CASE WHEN count(*) = 1 THEN 'simple' ELSE 'condo' END AS shape FROM lineitem GROUP BY l_orderkey""")
def footprint_shape(t):
    return E.shapes(accounts(t))


@query("""
    SELECT l_orderkey AS handle, l_returnflag AS ward, l_linestatus AS zoning, l_suppkey AS owner FROM lineitem WHERE l_linenumber = 1""")
def parcels_from_footprints(t):
    return E.parcels(accounts(t), {"ward": "l_returnflag", "zoning": "l_linestatus", "owner": "l_suppkey"})


def _detail(t, **more):
    """One to three building rows per account, by its quantity, with ``more`` columns of the account."""
    n = F.pmod(F.col("l_quantity").cast("int"), F.lit(3)) + 1
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("cityblock"), F.col("l_linenumber").alias("parcel"), F.col("l_suppkey").alias("ownercode"),
        F.col("l_extendedprice").alias("totalarea"), n.alias("n"), *[column.alias(name) for name, column in more.items()],
    )
    return E.explode_count(rows, "n", "bldgnum").drop("n")


_SIMPLE = """simple AS (SELECT l_orderkey, any_value(l_linenumber) AS parcel, any_value(l_suppkey) AS owner, any_value(l_quantity)::INTEGER AS q,
                 any_value(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1)"""


@query(f"""
    WITH {_SIMPLE}
    SELECT l_orderkey AS handle, b::BIGINT AS bldgnum, price AS totalarea, 'simple' AS shape FROM simple, unnest(range(1, 2 + q % 3)) AS u(b)
    UNION ALL SELECT l_orderkey, 1, NULL, 'condo' FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def building_from_accounts(t):
    owned = accounts(t)
    return E.buildings(owned, E.shapes(owned), _detail(t)).select("handle", "bldgnum", "totalarea", "shape")


@query(f"""
    WITH {_SIMPLE}, b AS (SELECT l_orderkey, b, q FROM simple, unnest(range(1, 2 + q % 3)) AS u(b)),
    kinds AS (SELECT *, b <> 2 AS home, q % 4 AS sections FROM b)
    SELECT l_orderkey AS handle, b::BIGINT AS bldgnum, 1::BIGINT AS unit_seq, NULL::VARCHAR AS sectnum FROM kinds WHERE home OR sections <= 1
    UNION ALL SELECT l_orderkey, b::BIGINT, s, s::VARCHAR FROM kinds, unnest(range(1, 1 + sections)) AS u(s) WHERE NOT (home OR sections <= 1)""")
def unit_from_buildings(t):
    owned = accounts(t)
    built = E.buildings(owned, E.shapes(owned), _detail(t))
    sections = E.explode_count(_detail(t, sections=F.pmod(F.col("l_quantity").cast("int"), F.lit(4))), "sections", "sectnum").select(*E.ACCOUNT, "bldgnum", "sectnum")
    homes = _detail(t).where("bldgnum <> 2")
    return E.simple_units(built, sections, homes).select("handle", "bldgnum", "unit_seq", "sectnum")


@query(f"""
    SELECT l_orderkey AS handle, l_linenumber AS parcel, l_suppkey AS ownercode, 1::BIGINT AS bldgnum,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, {", ".join(ORDER)}) AS unit_seq
    FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n > 1 AND l_linenumber <> 1""")
def unit_from_accounts(t):
    owned = accounts(t)
    return E.condo_units(owned, E.shapes(owned), ["parcel", "ownercode"]).select("handle", "parcel", "ownercode", "bldgnum", "unit_seq")


@query("""
    SELECT l_orderkey AS handle, count(*) AS n_accounts FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1 AND bool_and(l_linenumber = 1)""")
def buildings_without_units(t):
    owned = accounts(t)
    shape = E.shapes(owned)
    condo = shape.where("shape = 'condo'").select("handle", "n_accounts")
    return E.buildings_without_units(condo, owned.where("not (parcel = gisparcel)"), ["handle"])


@query("""
    SELECT l_orderkey AS handle, l_linenumber AS parcel, l_suppkey AS ownercode, count(*) AS n
    FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, min(CASE WHEN l_linenumber = 1 THEN l_suppkey END) OVER (PARTITION BY l_orderkey) AS main,
                 bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS condo FROM lineitem)
    WHERE n > 1 AND NOT condo AND l_suppkey IS DISTINCT FROM main GROUP BY ALL""")
def co_owner_log(t):
    owned = accounts(t)
    shape = E.shapes(owned, condo=F.col("l_returnflag") == "R")
    log = E.secondary_owners(owned, shape, ["ownercode"])
    return log.groupBy("handle", "parcel", "ownercode").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT o_orderkey, number FROM orders, unnest(range(1, 1 + substr(o_orderpriority, 1, 1)::INTEGER - 2)) AS u(n), LATERAL (SELECT n::INTEGER AS number)""")
def row_generation(t):
    n = F.substring("o_orderpriority", 1, 1).cast("int") - 2
    return E.explode_count(t.orders.select("o_orderkey", n.alias("n")), "n").drop("n")


@query("""
    SELECT p_partkey, slot, code FROM (
      SELECT p_partkey, 'zoning1' AS slot, (p_size % 4)::VARCHAR AS code FROM part
      UNION ALL SELECT p_partkey, 'zoning2', CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END FROM part
      UNION ALL SELECT p_partkey, 'zoning3', CASE WHEN p_size % 5 > 0 THEN p_brand END FROM part) WHERE code IS NOT NULL AND trim(code) NOT IN ('', '0')""")
def slots_to_bridge(t):
    wide = t.part.select(
        "p_partkey", (F.col("p_size") % 4).cast("string").alias("zoning1"),
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type")).alias("zoning2"),
        F.when(F.col("p_size") % 5 > 0, F.col("p_brand")).alias("zoning3"),
    )
    return E.slots_to_rows(wide, ["p_partkey"], ["zoning1", "zoning2", "zoning3"])


@query("""
    SELECT c_custkey AS municpal_parcel_id, n_name AS neighborhood, c_acctbal AS frontage, NULL::INTEGER AS census_block
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def mapping_select(t):
    mapping = t.spark.createDataFrame(
        [
            ("C_CUSTKEY", "parcel", "municpal_parcel_id", "proposed", ""),
            ("C_NATIONKEY", "parcel", "neighborhood", "needs_lookup", "Nation"),
            ("C_ACCTBAL", "parcel", "frontage", "candidate_direct", ""),
            ("C_MKTSEGMENT", "", "", "not_modeled", ""),
            ("C_NAME", "legal_entity", "name", "candidate_direct", ""),
        ],
        "source_field string, current_table string, current_column string, mapping_status string, vocabulary string",
    )
    words = t.nation.select(F.col("n_nationkey").alias("IDENTIFIER"), F.col("n_name").alias("TITLE"))
    return E.apply_mapping(t.customer, mapping, "parcel", {"Nation": words}, {"frontage": "double", "census_block": "int"})


@query("""
    SELECT o_orderkey AS parcel_id, NULL::VARCHAR AS assessment_date, o_totalprice AS assessment_amount, o_totalprice * 0.25 AS land_value,
           o_totalprice * 0.75 AS improvement_value, strftime(o_orderdate, '%Y_%m') AS snapshot FROM orders""")
def assessment_snapshot(t):
    split = t.orders.withColumn("land", F.col("o_totalprice") * 0.25).withColumn("improvement", F.col("o_totalprice") * 0.75)
    built = E.assessments(split, "o_orderkey", "o_totalprice", "land", "improvement", F.date_format("o_orderdate", "yyyy_MM"))
    return built.withColumn("assessment_date", F.col("assessment_date").cast("string"))


@query("""
    SELECT c_custkey AS legal_entity_id, NULL::INTEGER AS last_paid_year, -c_acctbal AS amount_delinquent FROM customer WHERE c_acctbal < 0""")
def delinquency(t):
    return E.delinquencies(t.customer.withColumn("due", -F.col("c_acctbal")), "c_custkey", "due")


@query("""
    SELECT 'rejected' AS route, 'unreadable due' AS reason, count(*) AS n, NULL::DOUBLE AS amount FROM customer WHERE c_custkey % 10 = 3
    UNION ALL SELECT 'loaded', NULL, count(*), sum(CASE WHEN c_custkey % 10 = 4 THEN 1200.5 WHEN -c_acctbal > 0 THEN -c_acctbal ELSE 0 END::DECIMAL(18,2))::DOUBLE
    FROM customer WHERE c_custkey % 10 <> 3""")
def delinquency_rejects(t):
    """Balances as staged text, some of them with a thousands comma, some unreadable."""
    kind = F.col("c_custkey") % 10
    text = F.when(kind == 3, "n/a due").when(kind == 4, "1,200.50").otherwise((-F.col("c_acctbal")).cast("string"))
    routed = E.unreadable(t.customer.withColumn("due", text), {"due": "double"})
    owed = E.delinquencies(routed.where("route = 'loaded'"), "c_custkey", "due")
    total = owed.agg(F.sum(E.money("amount_delinquent")).cast("double").alias("amount")).withColumn("of", F.lit("loaded"))
    counts = routed.groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(total, F.col("route") == F.col("of"), "left").drop("of")


@query("""
    SELECT count(*) FILTER (kept) AS n_built, count(*) FILTER (NOT kept) AS n_vacant FROM (SELECT coalesce(l_returnflag <> 'N', true) AS kept FROM lineitem)""")
def vacant_land(t):
    flagged = t.lineitem.select(F.when(F.col("l_returnflag") == "N", "Y").otherwise("N").alias("vacantland"))
    built = E.not_vacant(flagged).agg(F.count(F.lit(1)).alias("n_built"))
    vacant = flagged.where("vacantland = 'Y'").agg(F.count(F.lit(1)).alias("n_vacant"))
    return built.unionByName(vacant, allowMissingColumns=True).agg(F.max("n_built").alias("n_built"), F.max("n_vacant").alias("n_vacant"))


@query("""
    SELECT p_size AS street_number, p_name AS street_name, p_type AS street_name_suffix, p_partkey::VARCHAR AS zip, NULL::VARCHAR AS raw_line FROM part""")
def situs_addresses(t):
    source = t.part.withColumn("zip_text", F.col("p_partkey").cast("string"))
    return E.situs_addresses(source, {"street_number": "p_size", "street_name": "p_name", "street_name_suffix": "p_type", "zip": "zip_text"})


@query("""
    SELECT c_custkey, '  ' || c_name AS raw_line, c_mktsegment AS city, c_nationkey::VARCHAR AS zip FROM customer""")
def mailing_addresses(t):
    padded = t.customer.withColumn("line", F.concat(F.lit("  "), "c_name"))
    lines = E.mailing_addresses(padded.withColumn("state", F.col("c_custkey")), "line", "c_mktsegment", "state", "c_nationkey")
    return lines.select(F.col("state").alias("c_custkey"), "raw_line", "city", "zip")



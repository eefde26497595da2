"""Gates, reconciliation, key checks, profiles and drift on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.operators import catalog, loading
from landledger.operators import quality as Q
from landledger.operators import summaries
from landledger.operators.typing import infer_types
from landledger.plans.registry import query
from landledger.plans.text_queries import infer_sql


def _routed(events):
    return Q.route(
        events,
        excluded_if=[("not real estate", F.col("event_type") == "error")],
        rejected_if=[("no amount", F.col("value").isNull()), ("amount too small", F.col("value") <= 1.0)],
    )


@query("""
    WITH r AS (SELECT user_id, CASE WHEN event_type = 'error' THEN 'excluded' WHEN value IS NULL OR value <= 1.0 THEN 'rejected'
                               ELSE 'loaded' END AS route FROM events)
    SELECT user_id, count(*) FILTER (route = 'loaded') AS loaded, count(*) FILTER (route = 'excluded') AS excluded,
           count(*) FILTER (route = 'rejected') AS rejected, count(*) AS source, true AS balanced FROM r GROUP BY user_id""")
def capture_all(t):
    return Q.reconcile(_routed(t.events), "user_id")


@query("""
    SELECT event_id, event_type, value, CASE WHEN event_type = 'error' THEN 'excluded' ELSE 'rejected' END AS route,
           CASE WHEN event_type = 'error' THEN 'not real estate' WHEN value IS NULL THEN 'no amount' ELSE 'amount too small' END AS reason
    FROM events WHERE event_type = 'error' OR value IS NULL OR value <= 1.0""")
def exclusion_and_reject_log(t):
    return _routed(t.events).where("route <> 'loaded'").select("event_id", "event_type", "value", "route", "reason")


@query("""
    SELECT count(DISTINCT l_orderkey) AS source_keys, (SELECT count(*) FROM orders) AS target_rows,
           count(DISTINCT l_orderkey) = (SELECT count(*) FROM orders) AS matches FROM lineitem""")
def row_reconciliation(t):
    return Q.row_reconciliation(t.lineitem, ["l_orderkey"], t.orders)


@query("""
    SELECT o_orderkey, count(*) AS n_rows FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderkey""")
def fk_check(t):
    return Q.fk_violations(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")])


@query("""
    SELECT 'lineitem' AS child, 'orders' AS parent, count(*) AS n_orphans FROM (
      SELECT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'lineitem', 'part', count(*) FROM (SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part)
    UNION ALL SELECT 'lineitem', 'supplier', count(*) FROM (SELECT l_suppkey FROM lineitem EXCEPT SELECT s_suppkey FROM supplier)
    UNION ALL SELECT 'orders', 'customer', count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)
    UNION ALL SELECT 'events', 'customer', count(*) FROM (SELECT user_id FROM events EXCEPT SELECT c_custkey FROM customer)
    UNION ALL SELECT 'customer', 'nation', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT n_nationkey FROM nation)""")
def fk_report(t):
    rules = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
        ("events", "user_id", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
    ]
    report = None
    for child, column, parent, key in rules:
        found = Q.fk_violations(getattr(t, child), getattr(t, parent), [(column, key)])
        line = found.agg(F.count(F.lit(1)).alias("n_orphans")).select(
            F.lit(child).alias("child"), F.lit(parent).alias("parent"), "n_orphans"
        )
        report = line if report is None else report.unionByName(line)
    return report


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_check(t):
    return Q.pk_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    WITH altered AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN ltrim(o_orderpriority, '1') ELSE o_orderpriority END AS o_orderpriority,
                            round(o_totalprice, 1) AS o_totalprice FROM orders WHERE o_totalprice > 5000),
    both_sides AS (SELECT o_orderkey, o_orderpriority, o_totalprice, 1 AS s, 0 AS l FROM orders UNION ALL SELECT *, 0, 1 FROM altered)
    SELECT o_orderkey, o_orderpriority, o_totalprice, sum(s)::BIGINT AS n_source, sum(l)::BIGINT AS n_loaded
    FROM both_sides GROUP BY ALL HAVING sum(s) <> sum(l)""")
def no_mutation_audit(t):
    cut = F.regexp_replace("o_orderpriority", "^1+", "")
    altered = t.orders.where("o_totalprice > 5000").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", cut).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.round("o_totalprice", 1).alias("o_totalprice"),
    )
    return Q.mutation_audit(t.orders, altered, ["o_orderkey", "o_orderpriority", "o_totalprice"])


def _profile_sql(table: str, columns: list[str]) -> str:
    one = """
      SELECT '{c}' AS "column", {i} AS position, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null,
             count(*) FILTER (trim({c}::VARCHAR) = '') AS n_blank, count(DISTINCT {c}::VARCHAR) FILTER (trim({c}::VARCHAR) <> '') AS n_distinct,
             min({c}::VARCHAR) FILTER (trim({c}::VARCHAR) <> '') AS min_text, max({c}::VARCHAR) FILTER (trim({c}::VARCHAR) <> '') AS max_text,
             coalesce(bool_and({c}::VARCHAR IN ('0', '1')) FILTER (trim({c}::VARCHAR) <> ''), false) AS is_flag,
             coalesce(bool_and({c}::VARCHAR IN ('0', '-', 'N/A')) FILTER (trim({c}::VARCHAR) <> ''), false) AS is_placeholder
      FROM {table}"""
    union = "\n UNION ALL ".join(one.format(c=c, i=i + 1, table=table) for i, c in enumerate(columns))
    return f"""
    SELECT "column", position, n_rows, n_null, n_blank, n_distinct, min_text, max_text,
           CASE WHEN n_distinct = 0 THEN 'empty' WHEN is_flag AND n_distinct = 2 THEN 'boolean'
                WHEN is_placeholder THEN 'placeholder' ELSE 'values' END AS profile_status,
           CASE WHEN n_distinct = 0 OR (is_placeholder AND NOT (is_flag AND n_distinct = 2)) THEN 'other'
                WHEN (is_flag AND n_distinct = 2) OR (n_distinct <= 100 AND n_rows >= 10 * n_distinct) THEN 'coded_data'
                ELSE 'actual_data' END AS bucket
    FROM ({union})"""


_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
]


@query(_profile_sql("lineitem", _LINE_COLUMNS))
def column_profile(t):
    return Q.profile(t.lineitem, exact=True)


@query(_profile_sql("(SELECT quality::VARCHAR AS quality, toxic::VARCHAR AS toxic, '' AS blank, CASE WHEN doc_id % 2 = 0 THEN '0' END AS filler, NULL::VARCHAR AS missing FROM labels)",
                    ["quality", "toxic", "blank", "filler", "missing"]))
def flag_profile(t):
    staged = t.labels.select(
        F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"), F.lit("").alias("blank"),
        F.when(F.col("doc_id") % 2 == 0, "0").alias("filler"), F.lit(None).cast("string").alias("missing"),
    )
    return Q.profile(staged, exact=True)


# Per column its text in either snapshot; null text means that the snapshot lacks the column.
_DRIFT_COLUMNS = {
    "o_orderkey": ("o_orderkey", "o_orderkey"),
    "o_custkey": ("o_custkey", "CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR ELSE 'unknown' END"),
    "o_orderstatus": ("o_orderstatus", "CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus ELSE ' ' END"),
    "o_orderpriority": ("o_orderpriority", None),
    "o_shippriority": (None, "CASE WHEN o_orderstatus <> 'F' THEN '0' END"),
}


def _summary_sql(which: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{column}' AS c, count(*) AS n, count(*) FILTER (v IS NULL) AS nulls, count(*) FILTER (trim(v) = '') AS blanks,
            count(TRY_CAST(nullif(trim(v), '') AS DOUBLE)) AS numbers, min(v) FILTER (trim(v) <> '') AS lo, max(v) FILTER (trim(v) <> '') AS hi,
            min(TRY_CAST(nullif(trim(v), '') AS DOUBLE)) AS low, max(TRY_CAST(nullif(trim(v), '') AS DOUBLE)) AS high
            FROM (SELECT ({texts[which]})::VARCHAR AS v FROM orders)"""
        for column, texts in _DRIFT_COLUMNS.items() if texts[which]
    )


@query(f"""
    WITH b AS ({_summary_sql(0)}), a AS ({_summary_sql(1)})
    SELECT coalesce(b.c, a.c) AS "column",
        CASE WHEN b.c IS NULL THEN 'added' WHEN a.c IS NULL THEN 'removed'
             WHEN 100 * ((a.n - a.nulls - a.blanks) * b.n - (b.n - b.nulls - b.blanks) * a.n) < -5 * a.n * b.n THEN 'emptier'
             WHEN 100 * ((a.n - a.nulls - a.blanks) * b.n - (b.n - b.nulls - b.blanks) * a.n) > 5 * a.n * b.n THEN 'fuller'
             WHEN b.numbers = b.n - b.nulls - b.blanks AND b.numbers > 0 AND a.numbers < a.n - a.nulls - a.blanks THEN 'not numeric'
             WHEN CASE WHEN b.numbers = b.n - b.nulls - b.blanks AND a.numbers = a.n - a.nulls - a.blanks
                       THEN a.low < b.low OR a.high > b.high ELSE a.lo < b.lo OR a.hi > b.hi END THEN 'wider' ELSE 'same' END AS change,
        b.n AS n_rows_before, a.n AS n_rows_after, b.nulls AS n_null_before, a.nulls AS n_null_after, b.blanks AS n_blank_before,
        a.blanks AS n_blank_after, b.numbers AS n_numbers_before, a.numbers AS n_numbers_after, b.lo AS min_text_before,
        a.lo AS min_text_after, b.hi AS max_text_before, a.hi AS max_text_after
    FROM b FULL OUTER JOIN a USING (c)""")
def profile_drift(t):
    """Summaries of the orders of each status, merged to those of two snapshots, which are then compared without another scan."""
    def merged(which: int):
        texts = {c: v[which] for c, v in _DRIFT_COLUMNS.items() if v[which]}
        staged = t.orders.select(
            F.col("o_orderstatus").alias("part"), *[F.expr(v.replace("::VARCHAR", "::string")).cast("string").alias(c) for c, v in texts.items()],
        )
        return summaries.merge(summaries.summarize(staged, ["part"]))

    return summaries.drift(merged(0), merged(1))


_DIFF_SQL = f"""
    WITH later AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice || '$' AS o_totalprice, o_orderdate, '' AS o_comment FROM orders),
    old AS ({infer_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])}),
    new AS ({infer_sql("later", ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_comment"])})
    SELECT 'orders' AS "table", "column", CASE WHEN old.type IS NULL THEN 'added' WHEN new.type IS NULL THEN 'removed'
             WHEN old.position <> new.position THEN 'moved' ELSE 'retyped' END AS change,
           old.position AS old_position, new.position AS new_position, old.type AS old_type, new.type AS new_type
    FROM old FULL OUTER JOIN new USING ("column")
    WHERE old.type IS NULL OR new.type IS NULL OR old.position <> new.position OR old.type <> new.type"""


@query(_DIFF_SQL)
def schema_diff(t):
    price = F.concat(F.col("o_totalprice").cast("string"), F.lit("$")).alias("o_totalprice")
    later = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", price, "o_orderdate", F.lit("").alias("o_comment"))
    before, after = (
        infer_types(Q.as_text(frame)).select(F.lit("orders").alias("table"), "column", "position", "type")
        for frame in (t.orders, later)
    )
    return Q.schema_diff(before, after)


@query("""
    SELECT p_type AS vocabulary, count(*) AS n_entries, count(*) FILTER (p_partkey % 6 IN (1, 2, 3)) AS n_without_title,
           count(*) FILTER (p_partkey % 6 IN (1, 2, 3)) = 0 AS healthy FROM part GROUP BY p_type""")
def decode_health(t):
    kind = F.col("p_partkey") % 6
    title = F.when(kind == 1, "None").when(kind == 2, " ").when(kind == 3, F.lit(None)).otherwise(F.col("p_name"))
    return Q.decode_health(t.part.select(F.col("p_type").alias("vocabulary"), title.alias("title")), "vocabulary", "title")


# --- keys and rejects of tables that refer to each other -----------------------------------------------------------------------

_LINKS = [
    ("nation", "n_regionkey", "region"), ("customer", "c_nationkey", "nation"), ("supplier", "s_nationkey", "nation"), ("orders", "o_custkey", "customer"),
    ("lineitem", "l_orderkey", "orders"), ("lineitem", "l_partkey", "part"), ("lineitem", "l_suppkey", "supplier"),
]
_KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}


def _feed_routes(t):
    """Eight tables with what is wrong with their own rows; part has no row for some numbers that are used."""
    def routed(df, excluded=(), rejected=()):
        return Q.route(df, [(why, F.expr(when)) for why, when in excluded], [(why, F.expr(when)) for why, when in rejected])

    return {
        "lineitem": routed(t.lineitem, rejected=[("too many", "l_quantity > 49")]), "orders": routed(t.orders, excluded=[("pending", "o_orderstatus = 'P'")]),
        "customer": routed(t.customer, rejected=[("overdrawn", "c_acctbal < -900")]), "supplier": routed(t.supplier), "nation": routed(t.nation),
        "part": routed(t.part.where("p_partkey % 40 <> 7"), rejected=[("no size", "p_size < 3")]), "region": routed(t.region, excluded=[("out of scope", "r_name = 'AFRICA'")]),
    }


def _lost_sql(name, source, key, own, links):
    """A table's rows with route, reason and root: ``own`` is (route, reason, condition), ``links`` are (column, table, alias)."""
    joins = " ".join(f"LEFT JOIN (SELECT k, min({{'o': o, 'route': route, 'root': root}}) AS m FROM {parent} GROUP BY k) p{i} ON {column} = p{i}.k" for i, (column, _, parent) in enumerate(links))
    lost = [f"WHEN {column} IS NOT NULL AND coalesce(p{i}.m.route, 'missing') <> 'loaded' THEN" for i, (column, *_) in enumerate(links)]
    reasons = [f"'{column}: {table} ' || coalesce(p{i}.m.route, 'missing')" for i, (column, table, _) in enumerate(links)]
    route, why, when = own
    return f"""{name} AS (SELECT k, route, reason, root, CASE route WHEN 'loaded' THEN 1 WHEN 'excluded' THEN 2 ELSE 3 END AS o FROM (SELECT {key} AS k,
        CASE WHEN {when} THEN '{route}' {' '.join(f"{c} CASE WHEN p{i}.m.route = 'excluded' THEN 'excluded' ELSE 'rejected' END" for i, c in enumerate(lost))} ELSE 'loaded' END AS route,
        CASE WHEN {when} THEN '{why}' {' '.join(f"{c} {reasons[i]}" for i, c in enumerate(lost))} END AS reason,
        CASE WHEN {when} THEN '{why}' {' '.join(f"{c} coalesce(p{i}.m.root, {reasons[i]})" for i, c in enumerate(lost))} END AS root
        FROM {source} {joins}))"""


_REJECTS_SQL = "WITH " + ", ".join([
    _lost_sql("r", "region", "r_regionkey", ("excluded", "out of scope", "r_name = 'AFRICA'"), []),
    _lost_sql("n", "nation", "n_nationkey", ("rejected", "", "false"), [("n_regionkey", "region", "r")]),
    _lost_sql("c", "customer", "c_custkey", ("rejected", "overdrawn", "c_acctbal < -900"), [("c_nationkey", "nation", "n")]),
    _lost_sql("s", "supplier", "s_suppkey", ("rejected", "", "false"), [("s_nationkey", "nation", "n")]),
    _lost_sql("p", "(SELECT * FROM part WHERE p_partkey % 40 <> 7)", "p_partkey", ("rejected", "no size", "p_size < 3"), []),
    _lost_sql("o", "orders", "o_orderkey", ("excluded", "pending", "o_orderstatus = 'P'"), [("o_custkey", "customer", "c")]),
    _lost_sql("l", "lineitem", "l_orderkey", ("rejected", "too many", "l_quantity > 49"), [("l_orderkey", "orders", "o"), ("l_partkey", "part", "p"), ("l_suppkey", "supplier", "s")]),
]) + ", f AS (" + " UNION ALL ".join(f"SELECT '{t}' AS feed, route, reason, root FROM {a}" for t, a in [
    ("region", "r"), ("nation", "n"), ("customer", "c"), ("supplier", "s"), ("part", "p"), ("orders", "o"), ("lineitem", "l")]) + ")"


def _settled(t):
    found = loading.cascade(_feed_routes(t), _KEYS, _LINKS)
    return loading.union_standard([df.select(F.lit(name).alias("feed"), "route", "reason", "root") for name, df in found.items()], ["feed", "route", "reason", "root"])


@query(f"{_REJECTS_SQL} SELECT feed, route, reason, root, count(*) AS n FROM f GROUP BY ALL")
def load_order_rejects(t):
    """Rows that go with their parents, over a graph of seven tables: each with its first lost parent and the reason at the top."""
    return _settled(t).groupBy("feed", "route", "reason", "root").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{_REJECTS_SQL}
    SELECT feed, count(*) FILTER (route = 'loaded') AS loaded, count(*) FILTER (route = 'excluded') AS excluded, count(*) FILTER (route = 'rejected') AS rejected,
           count(*) AS source, true AS balanced FROM f GROUP BY feed""")
def load_order_reconciliation(t):
    return Q.reconcile(_settled(t), "feed")


def _planted(t):
    """Ten of the normalized tables, with keys that repeat, are missing, or refer to nothing."""
    line, customer = t.lineitem, t.customer
    building = F.expr("l_orderkey * 8 + l_linenumber")
    return {
        "address": customer.where("c_custkey % 50 <> 3").select(F.col("c_custkey").alias("address_id")),
        "legal_entity": customer.select(F.col("c_custkey").alias("legal_entity_id"), F.col("c_custkey").alias("address_id")),
        "zoning_class": t.nation.select(F.when(F.col("n_nationkey") != 4, F.col("n_nationkey")).alias("zoning_class_id")),
        "use_type": t.part.where("p_partkey <= 40").select(F.col("p_partkey").alias("use_type_id")),
        "parcel": t.orders.where("o_orderkey % 11 <> 5").select(
            F.col("o_orderkey").alias("parcel_id"), F.col("o_custkey").alias("owner_id"), F.expr("if(o_orderstatus = 'F', o_custkey % 30, null)").alias("zoning_class_id")),
        "building": line.select(
            building.alias("building_id"), F.col("l_orderkey").alias("parcel_id"), F.lit(None).cast("bigint").alias("owner_id"), (F.col("l_suppkey") % 45).alias("use_type_id")),
        "inspection": t.events.where("event_type = 'view'").select(
            F.col("event_id").alias("inspection_id"), F.expr("user_id * 8 + 1").alias("building_id"), F.lit(None).cast("bigint").alias("inspection_type_id")),
        "condemnation": t.events.where("event_type = 'click'").select(F.col("event_id").alias("condemnation_id"), (F.col("event_id") + 1).alias("inspection_id")),
        "tax_delinquency": t.events.where("event_type = 'purchase'").select(F.col("event_id").alias("tax_delinquency_id"), (F.col("user_id") + 7).alias("legal_entity_id")),
        "inspection_type": t.region.select(F.col("r_regionkey").alias("inspection_type_id")),
    }


@query("""
    WITH address AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 50 <> 3), entity AS (SELECT c_custkey AS k FROM customer),
    zoning AS (SELECT CASE WHEN n_nationkey <> 4 THEN n_nationkey END AS k FROM nation), use AS (SELECT p_partkey AS k FROM part WHERE p_partkey <= 40),
    parcel AS (SELECT o_orderkey AS k, o_custkey AS owner, CASE WHEN o_orderstatus = 'F' THEN o_custkey % 30 END AS zoning FROM orders WHERE o_orderkey % 11 <> 5),
    building AS (SELECT l_orderkey * 8 + l_linenumber AS k, l_orderkey AS parcel, l_suppkey % 45 AS use FROM lineitem),
    inspection AS (SELECT event_id AS k, user_id * 8 + 1 AS building FROM events WHERE event_type = 'view'),
    condemnation AS (SELECT event_id AS k, event_id + 1 AS inspection FROM events WHERE event_type = 'click'),
    tax AS (SELECT event_id AS k, user_id + 7 AS entity FROM events WHERE event_type = 'purchase'),
    u AS (
        SELECT 'pk address' AS rule, k FROM address GROUP BY k HAVING count(*) > 1 OR k IS NULL UNION ALL SELECT 'pk legal_entity', k FROM entity GROUP BY k HAVING count(*) > 1 OR k IS NULL)
    SELECT 'pk zoning_class' AS rule, k::VARCHAR AS key, count(*) AS n_rows FROM zoning GROUP BY k HAVING count(*) > 1 OR k IS NULL
    UNION ALL SELECT rule, k::VARCHAR, 2 FROM u
    UNION ALL SELECT 'pk building', k::VARCHAR, count(*) FROM building GROUP BY k HAVING count(*) > 1
    UNION ALL SELECT 'pk inspection', k::VARCHAR, count(*) FROM inspection GROUP BY k HAVING count(*) > 1
    UNION ALL SELECT 'pk condemnation', k::VARCHAR, count(*) FROM condemnation GROUP BY k HAVING count(*) > 1
    UNION ALL SELECT 'pk tax_delinquency', k::VARCHAR, count(*) FROM tax GROUP BY k HAVING count(*) > 1
    UNION ALL SELECT 'fk legal_entity.address_id', k::VARCHAR, count(*) FROM entity WHERE k NOT IN (SELECT k FROM address) GROUP BY k
    UNION ALL SELECT 'fk parcel.owner_id', owner::VARCHAR, count(*) FROM parcel WHERE owner NOT IN (SELECT k FROM entity) GROUP BY owner
    UNION ALL SELECT 'fk parcel.zoning_class_id', zoning::VARCHAR, count(*) FROM parcel WHERE NOT EXISTS (SELECT 1 FROM zoning z WHERE z.k = zoning) AND zoning IS NOT NULL GROUP BY zoning
    UNION ALL SELECT 'fk building.parcel_id', parcel::VARCHAR, count(*) FROM building WHERE parcel NOT IN (SELECT k FROM parcel) GROUP BY parcel
    UNION ALL SELECT 'fk building.use_type_id', use::VARCHAR, count(*) FROM building WHERE use NOT IN (SELECT k FROM use) GROUP BY use
    UNION ALL SELECT 'fk inspection.building_id', building::VARCHAR, count(*) FROM inspection WHERE building NOT IN (SELECT k FROM building) GROUP BY building
    UNION ALL SELECT 'fk condemnation.inspection_id', inspection::VARCHAR, count(*) FROM condemnation WHERE inspection NOT IN (SELECT k FROM inspection) GROUP BY inspection
    UNION ALL SELECT 'fk tax_delinquency.legal_entity_id', entity::VARCHAR, count(*) FROM tax WHERE entity NOT IN (SELECT k FROM entity) GROUP BY entity""")
def current_integrity(t):
    """Violations of ten primary and ten foreign keys, found in one aggregate."""
    return catalog.integrity(_planted(t))

"""Names, typed text and small scalars on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.functions import names as N
from landledger.functions import values as V
from landledger.operators import typing as TY
from landledger.operators.quality import as_text
from landledger.plans.registry import query
from landledger.sources import landing

_RESERVED_SQL = ", ".join(f"'{word}'" for word in N.RESERVED)


@query(f"""
    WITH raw AS (
      SELECT p_partkey, CASE p_partkey % 5
          WHEN 0 THEN p_name || ' #' || p_brand WHEN 1 THEN p_size || ' ' || p_name
          WHEN 2 THEN CASE WHEN p_size > 25 THEN 'Order' ELSE 'User ' END
          WHEN 3 THEN '###' ELSE repeat(p_type || '.' || p_name || ' ', 8) END AS header FROM part),
    kept AS (SELECT *, regexp_replace(replace(lower(header), ' ', '_'), '[^a-z0-9_]', '', 'g') AS s FROM raw),
    named AS (SELECT *, CASE WHEN s = '' THEN 'column' WHEN regexp_matches(s, '^[0-9]') THEN '_' || s ELSE s END AS n FROM kept)
    SELECT p_partkey, header,
           substr(CASE WHEN n IN ({_RESERVED_SQL}) THEN n || '_' ELSE n END, 1, 63) AS column_name,
           CASE WHEN length(header) > 80 THEN substr(header, 1, 79) || '…' ELSE header END AS short_header,
           substr(regexp_replace(header, '[^A-Za-z0-9]', '', 'g'), 1, 99) AS folder
    FROM named""")
def clean_names_column(t):
    kind = F.col("p_partkey") % 5
    header = (
        F.when(kind == 0, F.concat("p_name", F.lit(" #"), "p_brand"))
        .when(kind == 1, F.concat_ws(" ", F.col("p_size").cast("string"), "p_name"))
        .when(kind == 2, F.when(F.col("p_size") > 25, "Order").otherwise("User "))
        .when(kind == 3, "###")
        .otherwise(F.repeat(F.concat("p_type", F.lit("."), "p_name", F.lit(" ")), 8))
    )
    return t.part.select("p_partkey", header.alias("header")).select(
        "p_partkey", "header", N.clean_name("header").alias("column_name"),
        N.ellipsize("header").alias("short_header"), landing.work_folder("header").alias("folder"),
    )


@query("""
    WITH named AS (
      SELECT DISTINCT url,
             replace(regexp_replace(lower(split_part(url, '/', -1)), '\\.csv$', ''), '-', '_') AS s FROM pages),
    kept AS (SELECT url, regexp_replace(s, '[^a-z0-9_]', '', 'g') AS s FROM named),
    named2 AS (SELECT url, substr(CASE WHEN s = '' THEN 'table' WHEN regexp_matches(s, '^[0-9]') THEN '_' || s ELSE s END, 1, 63) AS table_name FROM kept)
    SELECT table_name AS "table", count(*) AS n_paths, min(url) AS first_path, max(url) AS last_path
    FROM named2 GROUP BY table_name HAVING count(*) > 1""")
def clean_table_names(t):
    return landing.table_collisions(t.pages, "url")


@query("""
    SELECT page_id, '2024_01_31_00_00_00/' || replace(name, ' ', '') AS landing_key, name,
           CASE WHEN page_id % 6 = 0 THEN 'unpack' WHEN page_id % 6 = 1 THEN 'export_tables'
                WHEN page_id % 6 = 2 THEN 'convert_sheet' WHEN page_id % 6 = 3 THEN 'rename'
                WHEN page_id % 6 = 4 THEN 'land' ELSE 'ignore' END AS action,
           CASE WHEN page_id % 6 IN (2, 3) THEN 'page ' || page_id || '.csv' WHEN page_id % 6 = 4 THEN name END AS target,
           'page ' || page_id || '_Main_Table.csv' AS table_file
    FROM (SELECT page_id, 'page ' || page_id || CASE page_id % 6 WHEN 0 THEN '.zip' WHEN 1 THEN '.mdb' WHEN 2 THEN '.xls'
                 WHEN 3 THEN '.txt' WHEN 4 THEN '.csv' ELSE '.CSV' END AS name FROM pages)""")
def route_files(t):
    extension = F.element_at(F.array(*map(F.lit, (".zip", ".mdb", ".xls", ".txt", ".csv", ".CSV"))), (F.col("page_id") % 6 + 1).cast("int"))
    files = t.pages.select("page_id", F.concat(F.lit("page "), F.col("page_id").cast("string"), extension).alias("name"))
    return landing.route_files(files).select(
        "page_id", landing.landing_key(F.lit("2024_01_31_00_00_00"), "name").alias("landing_key"), "name", "action", "target",
        landing.table_file("name", F.lit("Main Table")).alias("table_file"),
    )


@query("""
    WITH s AS (
      SELECT 'page' AS kind, page_id AS id, '/' || page_id || CASE page_id % 2 WHEN 0 THEN '.csv' ELSE '.zip' END AS name, html AS text FROM pages
      UNION ALL
      SELECT 'document', doc_id, '/' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.csv' WHEN 1 THEN '.zip' ELSE '.bin' END, text FROM documents)
    SELECT kind, id, CASE
        WHEN starts_with(lower(regexp_replace(text, '^[ \\t\\n\\r\\f\\v]+', '')), '<!doctype html')
          OR starts_with(lower(regexp_replace(text, '^[ \\t\\n\\r\\f\\v]+', '')), '<html') THEN 'looks like HTML (not data)'
        WHEN name LIKE '%.zip' THEN CASE WHEN starts_with(text, 'PK') THEN 'zip signature OK' ELSE 'not a ZIP signature' END
        WHEN name LIKE '%.csv' THEN CASE WHEN octet_length(encode(text)) <= 2048
              OR substr(hex(encode(text)), 4097, 1) NOT IN ('8', '9', 'A', 'B')
            THEN 'text sample OK' ELSE 'not UTF-8 text' END
        ELSE 'unclassified' END AS verdict
    FROM s""")
def sniff_files(t):
    ends = F.element_at(F.array(*map(F.lit, (".csv", ".zip", ".bin"))), (F.col("doc_id") % 3 + 1).cast("int"))
    pages = t.pages.select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        F.concat(F.lit("/"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".csv").otherwise(".zip")).alias("name"),
        F.col("html").alias("text"),
    )
    documents = t.documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        F.concat(F.lit("/"), F.col("doc_id").cast("string"), ends).alias("name"), "text",
    )
    verdict = landing.sniff("name", F.lit(None).cast("string"), "text")
    return pages.unionByName(documents).select("kind", "id", verdict.alias("verdict"))


@query("""
    SELECT o_orderkey, try_cast(replace(txt, ',', '') AS DOUBLE) AS amount, handle FROM (
      SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'n/a'
                         ELSE format('{:,.2f}', o_totalprice) END AS txt, printf('%010d', o_orderkey) AS handle FROM orders)""")
def numeric_clean(t):
    kind = F.col("o_orderkey") % 10
    text = F.when(kind == 0, "").when(kind == 1, "NULL").when(kind == 2, "n/a").otherwise(F.format_number("o_totalprice", 2))
    landed = t.orders.select("o_orderkey", text.alias("amount"), F.format_string("%010d", "o_orderkey").alias("handle"))
    return TY.clean_numeric(landed, ["amount"])


def infer_sql(table: str, columns: list[str], forced: str = "") -> str:
    one = """
      SELECT '{c}' AS "column", {i} AS position, CASE
        WHEN '{c}' = '{forced}' OR count(v) = 0 THEN 'string'
        WHEN bool_and(lower(trim(v)) IN ('true', 'false', 'yes', 'no')) THEN 'boolean'
        WHEN bool_and(regexp_matches(trim(replace(v, ',', '')), '^[+-]?[0-9]+$')) THEN
          CASE WHEN min(try_cast(replace(v, ',', '') AS HUGEINT)) >= -2147483648
                AND max(try_cast(replace(v, ',', '') AS HUGEINT)) <= 2147483647 THEN 'int' ELSE 'bigint' END
        WHEN bool_and(try_cast(replace(v, ',', '') AS DOUBLE) IS NOT NULL) THEN 'double'
        WHEN bool_and(coalesce(try_cast(v AS TIMESTAMP) <> date_trunc('day', try_cast(v AS TIMESTAMP)), false)) THEN 'timestamp'
        WHEN bool_and(try_cast(v AS DATE) IS NOT NULL) THEN 'date' ELSE 'string' END AS type, count(v) AS n_values
      FROM (SELECT CASE WHEN {c}::VARCHAR NOT IN ('', 'null', 'NULL') THEN {c}::VARCHAR END AS v FROM {table})"""
    return "\n UNION ALL ".join(one.format(c=c, i=i + 1, table=table, forced=forced) for i, c in enumerate(columns))


@query(infer_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"], "o_custkey"))
def infer_types(t):
    return TY.infer_types(as_text(t.orders), force_text=["O_CUSTKEY"])


@query(infer_sql("""(SELECT event_id::VARCHAR AS event_id, ts, event_type, CASE WHEN event_id::VARCHAR >= '2' THEN 'n/a' ELSE value::VARCHAR END AS value
        FROM events ORDER BY event_id::VARCHAR LIMIT 100)""", ["event_id", "ts", "event_type", "value"]))
def sampled_types(t):
    """Types by the first rows in the order of a key: amounts are numbers there, and text further down."""
    landed = as_text(t.events.select("event_id", "ts", "event_type", "value"))
    landed = landed.withColumn("value", F.when(F.col("event_id") >= "2", "n/a").otherwise(F.col("value")))
    return TY.infer_types(landed, sample=100, order=["event_id"])


@query(infer_sql("events", ["event_id", "ts", "user_id", "event_type", "value", "props"], ""))
def infer_event_types(t):
    return TY.infer_types(as_text(t.events))


@query("""
    WITH landed AS (
      SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'bad' WHEN event_id % 7 = 1 THEN '' ELSE value::VARCHAR END AS amount,
             regexp_extract(props, '([0-9]+)', 1) AS units,
             CASE WHEN event_id % 11 = 0 THEN 'maybe' WHEN event_type = 'error' THEN 'Yes' ELSE 'No' END AS flag,
             CASE WHEN event_id % 13 = 0 THEN '13/45/2024' ELSE strftime(ts, '%m/%d/%Y') END AS day FROM events)
    SELECT event_id, concat_ws(',', CASE WHEN event_id % 7 = 0 THEN 'amount' END, CASE WHEN event_id % 11 = 0 THEN 'flag' END,
                               CASE WHEN event_id % 13 = 0 THEN 'day' END) AS failed_columns,
           NULL::DOUBLE AS amount, NULL::INTEGER AS units, NULL::BOOLEAN AS flag, NULL::VARCHAR AS day
    FROM landed WHERE event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0
    UNION ALL
    SELECT event_id, '', try_cast(amount AS DOUBLE), units::INTEGER, flag = 'Yes', strftime(strptime(day, '%m/%d/%Y'), '%Y-%m-%d')
    FROM landed WHERE NOT (event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0)""")
def typed_from_text_rejects(t):
    key = F.col("event_id")
    landed = t.events.select(
        "event_id",
        F.when(key % 7 == 0, "bad").when(key % 7 == 1, "").otherwise(F.col("value").cast("string")).alias("amount"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("units"),
        F.when(key % 11 == 0, "maybe").when(F.col("event_type") == "error", "Yes").otherwise("No").alias("flag"),
        F.when(key % 13 == 0, "13/45/2024").otherwise(F.date_format("ts", "MM/dd/yyyy")).alias("day"),
    )
    types = {"amount": "double", "units": TY.SOURCE_TYPES["Long Integer"], "flag": TY.SOURCE_TYPES["Yes/No"],
             "day": TY.SOURCE_TYPES["Date/Time"]}
    good, rejects = TY.apply_types(landed, types)
    good = good.select("event_id", F.lit("").alias("failed_columns"), "amount", "units", "flag", F.col("day").cast("string").alias("day"))
    empty = {"amount": "double", "units": "int", "flag": "boolean", "day": "string"}
    return good.unionByName(
        rejects.select("event_id", "failed_columns", *[F.lit(None).cast(kind).alias(c) for c, kind in empty.items()])
    )


@query("""
    SELECT p_partkey, lower(regexp_replace(CASE WHEN regexp_matches(raw, '^[0-9]') THEN '_' || raw ELSE raw END, '[^A-Za-z0-9_]', '_', 'g')) AS identifier
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size || p_name ELSE p_name || '-' || p_brand END AS raw FROM part)""")
def safe_identifiers(t):
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_size").cast("string"), "p_name")).otherwise(
        F.concat_ws("-", "p_name", "p_brand")
    )
    return t.part.select("p_partkey", N.safe_identifier(raw).alias("identifier"))


@query("SELECT doc_id, replace(url_encode(text), '%2F', '/') AS encoded FROM documents")
def percent_encode(t):
    return t.documents.select("doc_id", N.percent_encode("text").alias("encoded"))


@query("""
    SELECT event_id, (json_extract_string(props, '$.k'))::DOUBLE AS total FROM events""")
def json_total(t):
    return t.events.select("event_id", V.json_total("props").alias("total"))


@query("""
    SELECT o_orderkey, isodow(o_orderdate) <= 5 AS is_weekday,
           CASE isodow(o_orderdate) WHEN 1 THEN 'guitar lessons' WHEN 2 THEN 'studying' WHEN 3 THEN 'soccer practice'
             WHEN 4 THEN 'contributing to Airflow' WHEN 5 THEN 'family dinner' WHEN 6 THEN 'going to the beach' ELSE 'sleeping in' END AS activity
    FROM orders""")
def day_type(t):
    return t.orders.select("o_orderkey", V.day_type("o_orderdate").alias("d")).select("o_orderkey", "d.is_weekday", "d.activity")


@query("""
    SELECT doc_id % 10 || '' AS category, doc_id || '.txt' AS name, source || '/' || doc_id || '.txt' AS path,
           sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS length FROM documents""")
def file_manifest(t):
    return _manifest(t.documents)


def _manifest(documents, content="text"):
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return landing.manifest_of(
        documents, (F.col("doc_id") % 10).cast("string"), name, F.concat_ws("/", "source", name),
        F.col(content) if isinstance(content, str) else content,
    )


@query("""
    WITH a AS (SELECT source || '/' || doc_id || '.txt' AS path, sha256(text) AS d FROM documents WHERE source <> 'src0'),
         b AS (SELECT source || '/' || doc_id || '.txt' AS path,
                      sha256(CASE WHEN n_chars > 1000 THEN text || '!' ELSE text END) AS d FROM documents WHERE lang <> 'fr')
    SELECT path, a.d AS old_sha256, b.d AS new_sha256,
           CASE WHEN a.d IS NULL THEN 'added' WHEN b.d IS NULL THEN 'missing' WHEN a.d <> b.d THEN 'changed' ELSE 'same' END AS drift
    FROM a FULL OUTER JOIN b USING (path)""")
def manifest_drift(t):
    """Between the snapshots one source arrives, one language leaves, and long texts change."""
    edited = F.when(F.col("n_chars") > 1000, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    before, after = t.documents.where("source <> 'src0'"), t.documents.where("lang <> 'fr'")
    return landing.manifest_drift(_manifest(before), _manifest(after, edited))


@query("""
    SELECT page_id, name, "table", name || '_' || "table" || '.csv' AS target FROM (
      SELECT page_id, 'page' || page_id AS name, unnest(['Main', '', 'Sect' || page_id % 3]) AS "table" FROM pages) WHERE "table" <> ''""")
def table_fan_out(t):
    """Every page as a multi-table file, one of its table names blank."""
    tables = F.array(F.lit("Main"), F.lit(""), F.concat(F.lit("Sect"), (F.col("page_id") % 3).cast("string")))
    files = t.pages.select("page_id", F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("name"), tables.alias("tables"))
    return landing.fan_out(files).select("page_id", "name", "table", "target")


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def index_column(t):
    from landledger.sources import csvfiles

    return csvfiles.drop_index_column(t.customer.select(F.col("c_custkey").alias("column_"), "*"))


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN true ELSE false END AS flag, regexp_extract(props, '([0-9]+)', 1)::INTEGER AS units,
           strftime(ts, '%Y-%m-%d') AS day FROM events""")
def typed_source(t):
    """Columns typed by the names that the source system gives its types."""
    landed = t.events.select(
        "event_id", F.when(F.col("event_type") == "error", "Yes").otherwise("No").alias("flag"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("units"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    good, _ = TY.typed_from_text(landed, {"flag": "Yes/No", "units": "Long Integer", "day": "Date/Time"})
    return good.withColumn("day", F.col("day").cast("string"))

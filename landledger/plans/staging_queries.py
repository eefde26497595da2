"""Tables written as CSV snapshots and taken back through the staging load."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from landledger.operators import catalog
from landledger.operators import typing as TY
from landledger.plans.registry import query
from landledger.session import scratch_path
from landledger.sources import csvfiles, landing


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _land(t, *names: str) -> str:
    """Spill tables to one snapshot folder, a ``<name>.csv`` folder each."""
    base = scratch_path(t.spark, "landing") + "/2024_01_31_00_00_00"
    for name in names:
        table = getattr(t, name)
        csvfiles.write_csv(table.select(*[F.col(c).cast("string") if kind.startswith("array") else F.col(c) for c, kind in table.dtypes]), f"{base}/{name}.csv")
    return base


def _land_broken(t, base: str) -> None:
    """Customers four times more: rows too long, rows too short, a quote that stays open, and parts with unlike headers."""
    key = F.col("c_custkey")
    first = t.customer.agg(F.min("c_custkey")).head()[0]
    faults = {
        "long": F.when(key % 100 == 50, F.concat(key, F.lit(',"x, y",z'))), "short": F.when(key % 100 == 50, key.cast("string")),
        "open": F.when(key == first, F.concat(key, F.lit(',"x'))),
    }
    header = t.spark.createDataFrame([("c_custkey,c_name",)], "value string")
    for name, fault in faults.items():
        lines = t.customer.select(F.coalesce(fault, F.concat_ws(",", "c_custkey", "c_name")).alias("value"))
        header.unionByName(lines).coalesce(1).write.text(f"{base}/{name}_customer.csv")
    for columns in (["c_custkey", "c_name"], ["c_name", "c_custkey"]):
        t.customer.select(*columns).write.mode("append").csv(f"{base}/unlike_customer.csv", header=True)


@query(" UNION ALL ".join(f"SELECT '{name}' AS \"table\", 'loaded' AS status, count(*) AS \"rows\" FROM {name}" for name in TABLES)
       + " UNION ALL SELECT unnest(['long_customer', 'short_customer', 'open_customer', 'unlike_customer']), unnest(['refused', 'failed', 'failed', 'failed']), NULL::BIGINT")
def staging_load(t):
    """All tables through the staging load, beside files that must not get in."""
    base = _land(t, *TABLES)
    _land_broken(t, base)
    base = landing.newest_landing(t.spark, base.rsplit("/", 1)[0])
    database = f"staging_{uuid.uuid4().hex[:12]}"
    catalog.reset_layer(t.spark, database, scratch_path(t.spark, "staging"))
    report = csvfiles.load_snapshot(t.spark, base, database)
    t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return report.select("table", "status", "rows")


@query("""
    SELECT o_orderkey::INTEGER AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def staging_round_trip(t):
    staged = csvfiles.read_text_csv(t.spark, _land(t, "orders") + "/orders.csv")
    types = TY.type_map(TY.infer_types(staged, force_text=["o_custkey"]))
    good, _ = TY.apply_types(staged, types)
    return good.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("""SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars FROM documents""")
def staging_quoted_text(t):
    return csvfiles.read_text_csv(t.spark, _land(t, "documents") + "/documents.csv")


@query("""
    SELECT 'orders.csv' AS name, count(*) FILTER (o_orderkey % 100 = 50) = 0 AS ok, 3 AS width, count(*) FILTER (o_orderkey % 100 = 50) AS long_rows FROM orders
    UNION ALL SELECT 'documents.csv', count(*) FILTER (doc_id IS NULL) = 0, 5, count(*) FILTER (doc_id IS NULL) FROM documents""")
def csv_gate(t):
    """Documents hold quoted commas and line breaks and pass; orders get short rows, which pass, and long ones."""
    base = _land(t, "documents")
    extra = F.when(F.col("o_orderkey") % 100 == 50, ',"a, ""b""",').when(F.col("o_orderkey") % 100 == 70, "").otherwise(",x")
    # Every part begins with the header, and a regular row first: the width is the larger one of the two.
    lines = t.orders.select(F.concat("o_orderkey", F.lit(",p"), extra).alias("o_orderkey,p,x"), (F.col("o_orderkey") % 100 == 50).alias("long"))
    lines.sortWithinPartitions("long").drop("long").write.csv(f"{base}/orders.csv", header=True, sep="\u0001", quote="", escapeQuotes=False)
    verdicts = [csvfiles.gate_csv(t.spark, f"{base}/{name}.csv") for name in ("documents", "orders")]
    return verdicts[0].unionByName(verdicts[1]).select(F.substring_index("path", "/", -1).alias("name"), "ok", "width", "long_rows")


@query("""
    SELECT 'all_parcels' AS tablename, (SELECT count(*) FROM orders) AS n_loaded, 0::BIGINT AS n_left
    UNION ALL SELECT 'owners', (SELECT count(*) FROM customer), 0""")
def table_lifecycle(t):
    """Load, reload, swap, list and truncate tables of one database."""
    spark, database = t.spark, f"current_{uuid.uuid4().hex[:12]}"
    catalog.create_layer(spark, database, scratch_path(spark, "current"))
    catalog.replace_table(t.customer, database, "owners")
    catalog.replace_table(t.customer, database, "owners")
    catalog.replace_table(t.lineitem, database, "all_parcels")
    catalog.replace_table(t.orders, database, "deduped")
    catalog.swap(spark, database, "deduped", "all_parcels")

    def counts() -> list[tuple[str, int]]:
        names = [row["tablename"] for row in catalog.tables(spark, database).collect()]
        return [(name, spark.table(f"{database}.{name}").count()) for name in names]

    loaded = spark.createDataFrame(counts(), "tablename string, n_loaded bigint")
    catalog.truncate_all(spark, database)
    left = spark.createDataFrame(counts(), "tablename string, n_left bigint")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return loaded.join(left, "tablename")

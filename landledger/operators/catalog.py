"""The typed tables, their keys, and table lifecycle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from landledger.operators import loading

# Table and column names and types of the normalized model; the key comes first.
COLUMNS = {
    "parcel": "parcel_id int, county string, owner_id int, ward int, neighborhood string, zip_code int, "
              "census_block int, frontage int, zoning_class_id int",
    "building": "building_id int, parcel_id int, owner_id int, use_type_id int, sq_footage int, year_built int",
    "unit": "unit_id int, building_id int, owner_id int, use_type_id int, address_id int, ground_floor boolean, "
            "stories double, windows_ac int, central_ac int, full_bath int, half_bath int, garage int",
    "legal_entity": "legal_entity_id int, name string, address_id int",
    "address": "address_id int, street_number int, street_name_prefix string, street_name string, "
               "street_name_suffix string, secondary_designator string, city string, state string, zip int",
    "permit": "permit_id int, permit_type_id int, application_date date, issue_date date, completion_date date, "
              "cancel_date date, description string, cost double, applicant_id int, contractor_id int",
    "service": "service_id int, parcel_id int, building_id int, unit_id int, owner_id int, division_id int, "
               "service_date date, service_type_id int, fee double",
    "condemnation": "condemnation_id int, inspection_id int, letter_date date, condemnation_type string, "
                    "status string",
    "inspection": "inspection_id int, building_id int, inspection_date date, completion_date date, "
                  "inspection_type_id int, number_of_violations int",
    "assessment": "assessment_id int, parcel_id int, assessment_date date, assessment_amount double, "
                  "land_value double, improvement_value double",
    "tax_delinquency": "tax_delinquency_id int, legal_entity_id int, last_paid_year int, amount_delinquent double",
    "municipality": "municipality_id int, municipality string",
    "division": "division_id int, division string",
    "service_type": "service_type_id int, service_type string",
    "zoning_class": "zoning_class_id int, zoning_class string",
    "municipal_parcel_id_mapping": "parcel_id int, municpal_parcel_id string, municipality_id int",
    "use_type": "use_type_id int, use_type int",
    "permit_type": "permit_type_id int, permit_type string",
    "inspection_type": "inspection_type_id int, inspection_type string",
}

# Fixed values: (child, column, parent); the parent column is the parent's key.
FOREIGN_KEYS = [
    ("parcel", "owner_id", "legal_entity"),
    ("parcel", "zoning_class_id", "zoning_class"),
    ("building", "parcel_id", "parcel"),
    ("building", "owner_id", "legal_entity"),
    ("building", "use_type_id", "use_type"),
    ("unit", "building_id", "building"),
    ("unit", "owner_id", "legal_entity"),
    ("unit", "use_type_id", "use_type"),
    ("unit", "address_id", "address"),
    ("legal_entity", "address_id", "address"),
    ("permit", "permit_type_id", "permit_type"),
    ("permit", "applicant_id", "legal_entity"),
    ("permit", "contractor_id", "legal_entity"),
    ("service", "parcel_id", "parcel"),
    ("service", "building_id", "building"),
    ("service", "unit_id", "unit"),
    ("service", "owner_id", "legal_entity"),
    ("service", "division_id", "division"),
    ("service", "service_type_id", "service_type"),
    ("condemnation", "inspection_id", "inspection"),
    ("inspection", "building_id", "building"),
    ("inspection", "inspection_type_id", "inspection_type"),
    ("assessment", "parcel_id", "parcel"),
    ("tax_delinquency", "legal_entity_id", "legal_entity"),
    ("municipal_parcel_id_mapping", "parcel_id", "parcel"),
]

# Column comments.
COMMENTS = {("parcel", "parcel_id"): "Warehouse identifier, not the municipal identifier (handle)"}

# Codes that the designed model widens to text along with every id.
TEXT_CODES = {("parcel", "zip_code"), ("parcel", "census_block"), ("use_type", "use_type"), ("address", "zip")}

LAYERS = ("staging", "current", "history", "updated_records")


TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(),
         "date": T.DateType()}


def schema(table: str, text_ids: bool = False) -> T.StructType:
    """Struct of a table; ``text_ids`` gives the designed variant with text ids and codes."""
    fields = []
    for column in COLUMNS[table].split(", "):
        name, type_name = column.split(" ")
        if text_ids and (name.endswith("_id") or (table, name) in TEXT_CODES):
            type_name = "string"
        comment = COMMENTS.get((table, name))
        fields.append(T.StructField(name, TYPES[type_name], True, {"comment": comment} if comment else None))
    if text_ids and table == "address":
        fields.append(T.StructField("raw_line", T.StringType()))
    return T.StructType(fields)


SCHEMAS = {table: schema(table) for table in COLUMNS}


def primary_key(table: str) -> str:
    return SCHEMAS[table].fields[0].name


def build_order() -> list[str]:
    """Tables in an order that puts every parent before its children."""
    parents: dict[str, set[str]] = {table: set() for table in SCHEMAS}
    for child, _, parent in FOREIGN_KEYS:
        parents[child].add(parent)
    return list(TopologicalSorter(parents).static_order())


def dependents(table: str) -> list[str]:
    """Tables that reference ``table``, directly or through others, children last."""
    found = {table}
    for name in build_order():
        if any(child == name and parent in found for child, _, parent in FOREIGN_KEYS):
            found.add(name)
    return [name for name in build_order() if name in found and name != table]


def create_layer(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def location(spark: SparkSession, database: str) -> str:
    """The folder of a database."""
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def reset_layer(spark: SparkSession, name: str, location_uri: str | None = None) -> None:
    """Drop a layer with all its tables, and the folders of its loads, and create it empty. Meant for staging only."""
    if spark.catalog.databaseExists(name):
        loads = spark._jvm.org.apache.hadoop.fs.Path(f"{location(spark, name)}/_loads")
        spark.sql(f"DROP DATABASE {name} CASCADE")
        loads.getFileSystem(spark._jsc.hadoopConfiguration()).delete(loads, True)
    create_layer(spark, name, location_uri)


def point_to(spark: SparkSession, database: str, table: str, names: Sequence[str], folder: str) -> None:
    """A table of text columns over a folder that is already written; what had its name before is dropped, not its files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    columns = ", ".join(f"`{name}` STRING" for name in names)
    spark.sql(f"DROP TABLE IF EXISTS {database}.`{table}`")
    spark.sql(f"CREATE TABLE {database}.`{table}` ({columns}) USING parquet LOCATION '{folder}'")


def create_all(spark: SparkSession, database: str = "current", text_ids: bool = False) -> None:
    """Create the missing tables, parents first."""
    create_layer(spark, database)
    for table in build_order():
        columns = []
        for field in schema(table, text_ids).fields:
            comment = field.metadata.get("comment")
            columns.append(f"`{field.name}` {field.dataType.simpleString()}" + (f" COMMENT '{comment}'" if comment else ""))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.`{table}` ({', '.join(columns)}) USING parquet")


def truncate_table(spark: SparkSession, database: str, table: str, cascade: bool = True) -> list[str]:
    """Empty a table and, with ``cascade``, the tables of the database that depend on it."""
    wanted = [table, *(dependents(table) if cascade and table in SCHEMAS else [])]
    present = [name for name in wanted if spark.catalog.tableExists(f"{database}.{name}")]
    for name in present:
        spark.sql(f"TRUNCATE TABLE {database}.`{name}`")
    return present


def truncate_all(spark: SparkSession, database: str) -> list[str]:
    """Empty every table of a database."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    for name in names:
        spark.sql(f"TRUNCATE TABLE {database}.`{name}`")
    return names


def replace_table(df: DataFrame, database: str, table: str) -> None:
    """Truncate and reload: the table holds exactly ``df`` afterwards.

    The rows are written to a table of their own first. If that fails, or ``df`` reads the table itself, the old rows are still there.
    """
    made = f"{table}__new_{uuid.uuid4().hex[:8]}"
    try:
        df.write.format("parquet").saveAsTable(f"{database}.{made}")
    except Exception:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {database}.`{made}`")
        raise
    swap(df.sparkSession, database, made, table)


def swap(spark: SparkSession, database: str, new: str, old: str) -> None:
    """Give the name ``old`` to the table ``new``, and drop what had it.

    Catalog steps, not atomic, but none loses rows: the old table is renamed aside, and comes back if the second rename fails.
    Readers that must never miss a table read from a ``versions.Store``.
    """
    aside = f"{old}__old_{uuid.uuid4().hex[:8]}"
    there = spark.catalog.tableExists(f"{database}.`{old}`")
    if there:
        spark.sql(f"ALTER TABLE {database}.`{old}` RENAME TO {database}.`{aside}`")
    try:
        spark.sql(f"ALTER TABLE {database}.`{new}` RENAME TO {database}.`{old}`")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {database}.`{aside}` RENAME TO {database}.`{old}`")
        raise
    if there:
        spark.sql(f"DROP TABLE {database}.`{aside}`")


def layers(spark: SparkSession, names=LAYERS) -> DataFrame:
    """The layers among ``names`` that exist."""
    rows = [(d.name,) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "schema_name string").where(
        "schema_name in (" + ", ".join(f"'{n}'" for n in names) + ")"
    )


def tables(spark: SparkSession, database: str) -> DataFrame:
    rows = [(database, t.name) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(rows, "schemaname string, tablename string")


def integrity(frames: dict[str, DataFrame]) -> DataFrame:
    """(rule, key, n_rows) of all violations of the given tables' keys, in one shuffle; load only if there is none."""
    return loading.integrity_violations(frames, {t: primary_key(t) for t in frames}, FOREIGN_KEYS)


def load_in_order(routed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Routed tables, parents first, with what their lost parents take along; see ``loading.cascade``."""
    found = loading.cascade(routed, {t: primary_key(t) for t in routed}, FOREIGN_KEYS)
    return {t: found[t] for t in build_order() if t in found}

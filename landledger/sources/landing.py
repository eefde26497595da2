"""Landing zone: catalogue, snapshots, file lists, routing, sniffing, manifests."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.functions.names import alnum_only, clean_table, last_segment, swap_extension

# Fixed value: bytes looked at to tell what a file is.
SAMPLE_BYTES = 2048

# Verdicts of the content check.
LOOKS_HTML = "looks like HTML (not data)"
ZIP_OK, ZIP_BAD = "zip signature OK", "not a ZIP signature"
TEXT_OK, TEXT_BAD = "text sample OK", "not UTF-8 text"
UNCLASSIFIED = "unclassified"


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Source catalogue JSON to one row per file: (file_name, file_location)."""
    entries = "gov_files array<struct<file_name:string,file_location:string>>"
    return spark.read.schema(entries).json(path, multiLine=True).select(F.inline("gov_files"))


def snapshot_key(at: Column | None = None) -> Column:
    """Landing prefix ``yyyy_MM_dd_HH_mm_ss``, UTC: it sorts by time."""
    if at is None:
        at = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(at, "yyyy_MM_dd_HH_mm_ss")


def latest_snapshot(df: DataFrame, col: str = "snapshot") -> DataFrame:
    """Rows of the newest snapshot; with none at all, rows outside any snapshot.

    Finding the newest key is a job over ``col`` alone; on a table partitioned by it that reads no data columns, and the
    filter then prunes all other partitions.
    """
    newest = df.agg(F.max(col).alias("m")).head()["m"]
    return df.where(F.col(col).isNull() if newest is None else F.col(col) == newest)


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path``: (path, name, length, modified). Contents are not read.

    Spark plans no task for an empty file, so those are added from the file index: a failed download
    must not vanish from the list.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    seen = files.select("path", "length", F.col("modificationTime").alias("modified"))
    indexed = spark.createDataFrame([(unquote(p),) for p in files.inputFiles()], "path string")
    return indexed.join(seen, "path", "left").select(
        "path", last_segment("path").alias("name"), F.coalesce("length", F.lit(0)).alias("length"), "modified"
    )


def prefix_of(path: Column | str) -> Column:
    """Snapshot folder a landed file is in, or null at the root."""
    path = F.col(path) if isinstance(path, str) else path
    found = F.regexp_extract(path, r"/([0-9]{4}(?:_[0-9]{2}){5})/", 1)
    return F.when(found != "", found)


def newest_landing(spark: SparkSession, path: str) -> str:
    """The newest snapshot folder below ``path``; ``path`` itself when there is none."""
    newest = list_landing(spark, path).agg(F.max(prefix_of("path")).alias("m")).head()["m"]
    return f"{path.rstrip('/')}/{newest}" if newest else path


def action(name: Column | str) -> Column:
    """What to do with a source file, by its extension (case matters)."""
    name = F.col(name) if isinstance(name, str) else name
    return (
        F.when(name.endswith(".zip"), "unpack")
        .when(name.endswith(".mdb"), "export_tables")
        .when(name.endswith(".xls"), "convert_sheet")
        .when(name.endswith(".txt"), "rename")
        .when(name.endswith(".csv"), "land")
        .otherwise("ignore")
    )


def route_files(files: DataFrame, name: str = "name") -> DataFrame:
    """Adds ``action`` and ``target``, the CSV name the file lands under (null when it does not)."""
    act = action(name)
    renamed = swap_extension(name, ".csv")
    return files.withColumns({
        "action": act,
        "target": F.when(act.isin("convert_sheet", "rename"), renamed).when(act == "land", F.col(name)),
    })


def table_file(database: Column | str, table: Column | str) -> Column:
    """CSV name of one table of a database file: ``<stem>_<table>.csv``."""
    table = F.col(table) if isinstance(table, str) else table
    return F.concat(swap_extension(database, "_"), F.translate(table, " ", "_"), F.lit(".csv"))


def fan_out(files: DataFrame, name: str = "name", tables: str = "tables") -> DataFrame:
    """One row per table of a multi-table file; blank table names are skipped."""
    each = files.withColumn("table", F.explode(tables)).where(~F.col("table").isin("", "\n"))
    return each.withColumn("target", table_file(name, "table"))


def landing_key(snapshot: Column | str, name: Column | str) -> Column:
    """Object key of a landed file: blanks in the file name are dropped."""
    snapshot = F.col(snapshot) if isinstance(snapshot, str) else snapshot
    name = F.col(name) if isinstance(name, str) else name
    return F.concat_ws("/", snapshot, F.translate(name, " ", ""))


def work_folder(task: Column | str) -> Column:
    return alnum_only(task)


def table_collisions(files: DataFrame, path: str = "path") -> DataFrame:
    """Table names that more than one path maps to, with the first and last path and their number."""
    return (
        files.select(clean_table(path).alias("table"), F.col(path).alias("path"))
        .distinct()
        .groupBy("table")
        .agg(F.count(F.lit(1)).alias("n_paths"), F.min("path").alias("first_path"), F.max("path").alias("last_path"))
        .where("n_paths > 1")
    )


def sniff(name: Column | str, content_type: Column | str, sample: Column | str) -> Column:
    """Verdict on the first bytes of a file: HTML before ZIP before CSV.

    ``sample`` is binary; only its first 2048 bytes are used.
    """
    name, content_type, sample = (F.col(c) if isinstance(c, str) else c for c in (name, content_type, sample))
    head = F.substring(sample.cast("binary"), 1, SAMPLE_BYTES)
    # Latin-1 maps each byte to one character, so signatures compare even in binary files.
    text = F.lower(F.decode(head, "ISO-8859-1"))
    opening = F.regexp_replace(text, "^[ \t\n\r\f\u000b]+", "")
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    lower_name = F.lower(F.coalesce(name, F.lit("")))
    html = opening.startswith("<!doctype html") | opening.startswith("<html")
    is_zip = lower_name.endswith(".zip") | kind.startswith("application/zip")
    is_csv = lower_name.endswith(".csv") | kind.contains("csv")
    signature = F.when(F.substring(F.decode(head, "ISO-8859-1"), 1, 2) == "PK", ZIP_OK).otherwise(ZIP_BAD)
    utf8 = F.when(F.is_valid_utf8(head.cast("string")), TEXT_OK).otherwise(TEXT_BAD)
    return (
        F.when(html, LOOKS_HTML).when(is_zip, signature).when(is_csv, utf8).otherwise(UNCLASSIFIED)
    )


def manifest_of(files: DataFrame, category: Column, name: Column, path: Column, content: Column) -> DataFrame:
    """Per row of ``files``: category, name, path, sha256, byte count."""
    binary = content.cast("binary")
    return files.select(
        category.alias("category"), name.alias("name"), path.alias("path"), F.sha2(binary, 256).alias("sha256"),
        F.octet_length(binary).cast("bigint").alias("length"),
    )


def manifest(spark: SparkSession, path: str, category: str | None = None) -> DataFrame:
    """Manifest of the files below ``path`` with its UTC run time; a file's folder is its category.

    Meant for reference files: each is hashed as one binary value, so it must be below 2 GB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    folder = F.substring_index(F.substring_index("path", "/", -2), "/", 1)
    listed = manifest_of(files, F.lit(category) if category else folder, last_segment("path"), F.col("path"), F.col("content"))
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return listed.withColumn("run_at", F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def manifest_drift(before: DataFrame, after: DataFrame, key: str = "path") -> DataFrame:
    """Per file: added, missing, changed or same, by digest."""
    joined = before.select(key, F.col("sha256").alias("old_sha256")).join(
        after.select(key, F.col("sha256").alias("new_sha256")), key, "full_outer"
    )
    drift = (
        F.when(F.col("old_sha256").isNull(), "added")
        .when(F.col("new_sha256").isNull(), "missing")
        .when(F.col("old_sha256") != F.col("new_sha256"), "changed")
        .otherwise("same")
    )
    return joined.withColumn("drift", drift)

"""CSV as the database's COPY reads it: all text, by position, with its null and ragged-row rules."""

from __future__ import annotations

import csv
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger.functions.names import clean_headers, clean_table, require_safe
from landledger.operators import catalog
from landledger.session import materialize, scratch_path
from landledger.sources import csvscan
from landledger.sources.landing import list_landing

MAX_COLUMNS = "20000"
_CORRUPT = "_ragged_record"

# An unquoted empty field is null and a quoted one is the empty string; blanks are data.
_OPTIONS = {
    "sep": ",", "quote": '"', "escape": '"', "nullValue": "\u0001", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "enforceSchema": "true", "maxColumns": MAX_COLUMNS, "encoding": "UTF-8",
    # Ragged rows must show whichever columns a query reads.
    "columnPruning": "false",
}


def _reader(spark: SparkSession, multi_line: bool):
    return spark.read.options(**_OPTIONS, multiLine=str(multi_line).lower())


def _first_records(spark: SparkSession, path: str, n: int) -> list[list[str | None]]:
    """The first ``n`` CSV records; only as much of the file is parsed as that takes."""
    first = spark.read.text(path).head(1)
    if not first or first[0]["value"] == "":
        raise ValueError(f"No header row found in {path}")
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(_width(spark, path))])
    return [list(row) for row in _reader(spark, True).schema(wide).csv(path, header=False).head(n)]


def _width(spark: SparkSession, path: str) -> int:
    return len(_reader(spark, True).csv(path, header=False).columns)


def read_headers(spark: SparkSession, path: str) -> list[str]:
    """Clean column names from the file's first record; a blank first line is an error."""
    return require_safe(clean_headers(_first_records(spark, path, 1)[0]))


def has_line_breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    """Whether some line holds an odd number of quotes, so that a record may go on in the next one.

    One scan. A file with an odd number of quotes in all has one that is never closed: it is refused here, before the rest of
    it is taken for one record. Parts of a folder whose first lines differ are refused too: read by position, they would swap
    columns.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value", _quotes("value").alias("quotes"),
    )
    first = F.min_by(F.when(F.col("block") == 0, F.regexp_replace("value", "\r$", "")), F.when(F.col("block") == 0, F.col("line")))
    files = lines.groupBy("file").agg(F.sum("quotes").alias("quotes"), F.max(F.col("quotes") % 2).alias("odd"), first.alias("first"))
    found = files.agg(F.count_if(F.col("quotes") % 2 == 1).alias("open"), F.max("odd").alias("odd"), F.count_distinct("first").alias("heads")).head()
    if found["open"]:
        raise ValueError(f"a quote is never closed in {found['open']} file(s) of {path}")
    if found["heads"] > 1:
        raise ValueError(f"headers differ between the files of {path}")
    return found["odd"] == 1


def _quotes(column: str) -> Column:
    return F.length(column) - F.length(F.translate(column, '"', ""))


def read_text_csv(spark: SparkSession, path: str, mode: str = "load", multi_line: bool | None = None) -> DataFrame:
    """One landed CSV, or a folder of CSV parts with equal headers, as text columns.

    ``load`` aborts on a row with too few or too many fields, as COPY does. ``gate`` keeps such rows
    and adds ``_ragged_record``, null for regular rows.

    Files without line breaks inside quotes are split over tasks by Spark's own reader. For the
    others, ``record_lines`` reassembles records in parallel first.
    """
    names = read_headers(spark, path)
    if multi_line is None:
        multi_line = has_line_breaks_in_quotes(spark, path)
    if mode not in ("load", "gate"):
        raise ValueError(f"unknown mode {mode!r}")
    text = [T.StructField(name, T.StringType()) for name in names]
    gate = T.StructType([*text, T.StructField(_CORRUPT, T.StringType())])
    permissive = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    if not multi_line and mode == "load":
        return _reader(spark, False).schema(T.StructType(text)).csv(path, header=True, mode="FAILFAST")
    if not multi_line:
        return _reader(spark, False).options(**permissive).schema(gate).csv(path, header=True)
    records = record_lines(spark, path).where("record_no > 1")
    parsed = records.select(
        "record", F.from_csv("record", gate.toDDL(), {**_OPTIONS, **permissive, "multiLine": "true"}).alias("r")
    )
    if mode == "gate":
        return parsed.select("r.*")
    # Only the last record can hold an odd number of quotes: one was never closed.
    broken = F.col("r")[_CORRUPT].isNotNull() | (_quotes("record") % 2 == 1)
    message = F.concat(F.lit("ragged or unterminated row: "), F.substring("record", 1, 200))
    checked = F.when(broken, F.raise_error(message)).otherwise(F.col("r"))
    return parsed.select(checked.alias("r")).select(*[F.col("r")[name].alias(name) for name in names])


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSVs with quoted line breaks, as (file, record_no, record); record 1 is the header.

    Lines are read in splits of bounded size. The quotes before a line decide whether it starts
    inside a quoted field: their parity is carried within a split by a window and across splits by
    one total per split. Lines are then grouped by the record they belong to, so no task reads a
    whole file.
    """
    split = ["file", "block"]
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        _quotes("value").cast("bigint").alias("quotes"),
    )

    def carried(rows: DataFrame, total: Column, out: str) -> DataFrame:
        """Per split, ``total`` summed over the earlier splits of its file (one row per split)."""
        prior = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy(*split).agg(total.alias("n"))
        return totals.select(*split, F.coalesce(F.sum("n").over(prior), F.lit(0)).alias(out))

    within = Window.partitionBy(*split).orderBy("line")
    before = F.coalesce(F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opened = lines.withColumn("_before", before).join(carried(lines, F.sum("quotes"), "_carried"), split)
    starts = ((F.col("_before") + F.col("_carried")) % 2 == 0).cast("bigint")
    started = opened.withColumn("_started", F.sum(starts).over(within))
    numbered = started.join(carried(started, F.max("_started"), "_records"), split).withColumn(
        "record_no", F.col("_started") + F.col("_records")
    )
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    text = F.array_join(F.transform(pieces, lambda piece: piece["value"]), "\n")
    records = numbered.groupBy("file", "record_no").agg(F.regexp_replace(text, "\r$", "").alias("record"))
    return records.where("record <> ''")


@dataclass(frozen=True)
class Survey:
    """What one pass over the text of many files has found: a row per landed table, and how splits begin."""

    tables: DataFrame
    splits: DataFrame
    files: DataFrame


def survey(spark: SparkSession, path: str, units: DataFrame | None = None) -> Survey:
    """One scan of all CSVs below ``path``.

    ``tables``: (path, table, header, blank, width, n_fields, n_open, n_heads, records, long_rows, ragged_rows) per landed table. ``width``
    is that of the header or the first data row, whichever is larger; ``ragged_rows`` do not have the header's ``n_fields``.
    """
    units = landed_files(spark, path) if units is None else units
    units = materialize(units.withColumn("file", F.xxhash64(F.regexp_replace("file_path", "^file:/+", "file:/"))), "landed-files")
    found = scratch_path(spark, "csv-summary")
    csvscan.summarised(csvscan.lines(csvscan.steady(spark), path)).write.parquet(found)
    splits, files = csvscan.chained(spark.read.schema(csvscan.SUMMARY).parquet(found))
    splits = materialize(splits, "csv-splits")
    each = materialize(units.join(files, "file", "left"), "csv-files")
    rows = each.select("path", F.explode("counts").alias("fields", "n")).unionByName(
        each.where("first is not null").select("path", F.col("first").alias("fields"), F.lit(-1).cast("long").alias("n"))
    ).groupBy("path", "fields").agg(F.sum("n").alias("n"))
    width = F.greatest(F.max("first"), F.min_by("second", "file_path"))
    tables = each.groupBy("path", "table").agg(
        F.max("header").alias("header"), F.coalesce(F.bool_or("blank"), F.lit(False)).alias("blank"), width.cast("int").alias("width"), F.max("first").cast("int").alias("n_fields"),
        F.count_if("open").alias("n_open"), F.count_distinct("header").alias("n_heads"), F.coalesce(F.sum(F.greatest(F.col("records") - 1, F.lit(0))), F.lit(0)).alias("records"),
    )
    counts = tables.join(rows, "path").groupBy("path").agg(
        F.coalesce(F.sum(F.when(F.col("fields") > F.col("width"), F.col("n"))), F.lit(0)).alias("long_rows"),
        F.coalesce(F.sum(F.when(F.col("fields") != F.col("n_fields"), F.col("n"))), F.lit(0)).alias("ragged_rows"),
    )
    return Survey(materialize(tables.join(counts, "path", "left").na.fill(0, ["long_rows", "ragged_rows"]), "csv-tables"), splits, each)


def _refusal(row: Row) -> str | None:
    """Why a surveyed file can't be read as records at all."""
    if row["n_open"]:
        return f"a quote is never closed in {row['n_open']} file(s) of {row['path']}"
    if row["header"] is None or row["blank"]:
        return f"No header row found in {row['path']}"
    if row["n_heads"] > 1:
        return f"headers differ between the files of {row['path']}"
    return None


def gate_csv(spark: SparkSession, path: str) -> DataFrame:
    """One row: (path, ok, width, long_rows). Rows with extra fields fail the file, short rows do not.

    As in the reader this stands for, the width is that of the header or of the first data row, whichever is larger. Bytes that are
    not UTF-8 are replaced. A file without a header fails; one with an open quote, or parts with unlike headers, raises. One scan.
    """
    files = list_landing(spark, path).where(~_hidden()).select(F.lit(path).alias("path"), F.lit("").alias("table"), F.col("path").alias("file_path"))
    found = survey(spark, path, files).tables.head()
    why = _refusal(found) if found else "empty"
    if why and found and found["header"] is not None and not found["blank"]:
        raise ValueError(why)
    row = (path, False, 0, 0) if why else (path, found["long_rows"] == 0, found["width"], found["long_rows"])
    return spark.createDataFrame([row], "path string, ok boolean, width int, long_rows bigint")


def drop_index_column(df: DataFrame) -> DataFrame:
    """Drop the unnamed row-index column a spreadsheet export puts first (it lands as ``column_``)."""
    return df.drop("column_") if df.columns and df.columns[0] == "column_" else df


def read_vocabularies(spark: SparkSession, path: str) -> DataFrame:
    """Controlled vocabularies of one schema; VOCABULARYID tells them apart."""
    schema = "DATELASTUPDATED string, DEFINITION string, IDENTIFIER string, REFERENCEURL string, TITLE string, VOCABULARYID string"
    return _reader(spark, True).schema(schema).csv(path, header=True)


# What the data type numbers of the published field definitions stand for.
FIELD_KINDS = {"109": "text", "110": "number", "111": "letter", "114": "date", "115": "amount"}


def read_field_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Field definitions plus ``kind`` and ``type``.

    Only amounts without a vocabulary are numeric: a "number" may be an identifier with leading
    zeros or a code, and stays text until a mapping says otherwise.
    """
    schema = "DATAFORMAT string, DATASETID string, DATATYPEID string, DESCRIPTION string, DISTRIBUTIONID string, LABEL string, NAME string, VOCABULARYID string"
    kinds = F.create_map(*[F.lit(part) for pair in FIELD_KINDS.items() for part in pair])
    fields = _reader(spark, True).schema(schema).csv(path, header=True)
    fields = fields.withColumn("kind", F.coalesce(kinds[F.col("DATATYPEID")], F.lit("text")))
    measured = (F.col("kind") == "amount") & (F.col("VOCABULARYID") == "0")
    return fields.withColumn("type", F.when(measured, "double").otherwise("string"))


def write_csv(df: DataFrame, path: str) -> None:
    """Text spill of a frame, one folder, readable by ``read_text_csv`` file by file."""
    df.write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue='""', quote='"', escape='"',
                                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def _hidden() -> Column:
    return F.substring("name", 1, 1).isin("_", ".")


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, path, table) per file: ``path`` is the landed table, a CSV file or a folder named ``*.csv`` with its part files."""
    folder = F.regexp_extract("path", r"(?i)^(.*?[.]csv)/[^/]+$", 1)
    unit = F.when(folder != "", folder).when(F.lower("name").endswith(".csv"), F.col("path"))
    files = list_landing(spark, path).where(~_hidden()).select(F.col("path").alias("file_path"), unit.alias("path")).where("path is not null")
    return files.withColumn("table", clean_table("path"))


def landed_tables(spark: SparkSession, path: str) -> DataFrame:
    """(path, table) per landed table."""
    return landed_files(spark, path).select("path", "table").distinct()


# Columns beside those of a table while it is loaded; no cleaned name has such a letter.
_TABLE, _PART, _BLOCK, _PIECE, _RECORD, _BAD = "@table", "@part", "@block", "@piece", "@record", "@bad"


def _parsed(rows: DataFrame, names: list[str]) -> DataFrame:
    """Records to text columns by position; a record that Spark's reader takes for a different number of fields keeps its text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, _BAD)])
    options = {**_OPTIONS, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    whole = F.col("piece").isNull()
    read = rows.withColumn("r", F.from_csv(F.when(whole, F.col("record")), schema.toDDL(), options))
    bad = F.col("r")[_BAD].isNotNull()
    return read.select(
        *[F.col("r")[c].alias(c) for c in names], F.col("table").alias(_TABLE), F.when(~whole, "piece").when(bad, "bad").otherwise("good").alias(_PART),
        "file", F.col("block").alias(_BLOCK), F.col("piece").alias(_PIECE), F.when(~whole | bad, F.col("record")).alias(_RECORD),
    ).withColumnRenamed("file", "@file")


def _write_layout(spark: SparkSession, names: list[str], units: list[Row], found: Survey, folder: str) -> dict[tuple[str, str], int]:
    """Write all files of one layout in one job: {(table, part): rows}, a folder per table and part."""
    rows = csvscan.lines(csvscan.steady(spark), [u["path"] for u in units])
    inside = found.splits.where("inside").select("file", "block", "inside")
    crossing = not inside.isEmpty()
    rows = rows.join(inside, ["file", "block"], "left") if crossing else rows.withColumn("inside", F.lit(False))
    records = csvscan.records(rows.select("file", "block", "value", "inside"))

    def named(df: DataFrame) -> DataFrame:
        if len(units) == 1:
            return df.withColumn("table", F.lit(units[0]["table"]))
        return df.join(found.files.select("file", "table"), "file")

    def write(df: DataFrame) -> None:
        _parsed(named(df), names).write.mode("append").partitionBy(_TABLE, _PART).parquet(folder)

    write(records)
    if crossing:
        pieces = spark.read.parquet(folder).where(F.col(f"`{_PART}`") == "piece").select(
            F.col("`@file`").alias("file"), F.col(f"`{_BLOCK}`").alias("block"), F.col(f"`{_PIECE}`").alias("piece"), F.col(f"`{_RECORD}`").alias("record"))
        write(csvscan.rejoined(pieces, found.splits).select("file", F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("piece"), "record"))
    written = spark.read.parquet(folder).groupBy(F.col(f"`{_TABLE}`").cast("string").alias("table"), F.col(f"`{_PART}`").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return {(r["table"], r["part"]): r["n"] for r in written.collect()}


def load_snapshot(spark: SparkSession, path: str, database: str, parallel: int = 4) -> DataFrame:
    """Load every CSV below ``path`` into ``database``: (file, table, status, rows, error).

    One scan decides about all files, another reads the good ones: files with the same header are read and written by one job, so jobs grow
    with the number of layouts, not of files; ``parallel`` layouts are written at a time. A file that the gate refuses, or that fails, is reported and does not stop the
    others; files that map to one table are all refused, since one would overwrite the other. Every run writes a folder of its own,
    and tables change over at its end, so a run that dies leaves them as they were. The driver holds a row per table.
    """
    found = survey(spark, path)
    surveyed = found.tables.collect()
    uses = Counter(row["table"] for row in surveyed)
    layouts: dict[tuple[str, ...], list[Row]] = {}
    results: list[tuple] = []
    for row in surveyed:
        problem = "several files map to this table" if uses[row["table"]] > 1 else _refusal(row)
        try:
            require_safe([row["table"]])
            names = tuple(require_safe(clean_headers(next(csv.reader([row["header"]], strict=False))))) if not problem else ()
        except ValueError as error:
            problem, names = str(error), ()
        if problem:
            results.append((row["path"], row["table"], "failed", None, problem))
        elif row["long_rows"]:
            results.append((row["path"], row["table"], "refused", None, f"{row['long_rows']} rows are longer than {row['width']} fields"))
        elif row["ragged_rows"]:
            results.append((row["path"], row["table"], "failed", None, f"{row['ragged_rows']} rows do not have {row['n_fields']} fields"))
        else:
            layouts.setdefault(names, []).append(row)
    home = f"{catalog.location(spark, database)}/_loads/{uuid.uuid4().hex}"
    folders = [f"{home}/{i}" for i in range(len(layouts))]
    with ThreadPoolExecutor(parallel) as pool:
        written = list(pool.map(lambda layout, folder: _write_layout(spark, list(layout[0]), layout[1], found, folder), layouts.items(), folders))
    for (names, units), folder, counts in zip(layouts.items(), folders, written):
        for row in units:
            good, bad = counts.get((row["table"], "good"), 0), counts.get((row["table"], "bad"), 0)
            if bad or good != row["records"]:
                results.append((row["path"], row["table"], "failed", None, f"{bad or row['records'] - good} rows have quotes inside unquoted fields that hide a comma"))
                continue
            catalog.point_to(spark, database, row["table"], names, f"{folder}/{_TABLE}={row['table']}/{_PART}=good")
            results.append((row["path"], row["table"], "loaded", good, None))
    for _, table, status, _, _ in results:
        if status == "failed" and spark.catalog.tableExists(f"{database}.`{table}`"):
            spark.sql(f"DROP TABLE {database}.`{table}`")
    return spark.createDataFrame(sorted(results), "file string, table string, status string, rows bigint, error string")

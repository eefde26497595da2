"""Merging, decoding, unions and the parcel / building / unit / owner / event builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions.values import cast_text
from landledger.operators.ordering import dealt, number_copies, number_rows
from landledger.operators.quality import route
from landledger.session import materialize

# The account key, and the columns both parcel tables are cut to before their union.
ACCOUNT = ("cityblock", "parcel", "ownercode")
PARCEL_COLUMNS = (
    "geom", "parcel_id", "prop_add", "prop_zip", "municipali", "county", "asstlandva", "asstimpval",
    "totassmt", "propclass", "zoning", "yearblt",
)

# How duplicate parcels merge, geometry aside (see ``geo.dissolve``).
PARCEL_MERGE = {
    "prop_add": "texts", "prop_zip": "min", "municipali": "min", "county": "min", "asstlandva": "sum",
    "asstimpval": "sum", "totassmt": "sum", "propclass": "texts", "zoning": "texts", "yearblt": "max",
}


# --- joins ---------------------------------------------------------------------------------------

def left_merge(target: DataFrame, attributes: DataFrame, key: str, attribute_key: str | None = None) -> DataFrame:
    """All target columns plus the attribute columns except their key; target rows always stay.

    A key that repeats on the right fans out, as a LEFT JOIN does: list such keys with
    ``pk_violations(attributes, [attribute_key])``. Clashing names raise.
    """
    attribute_key = attribute_key or key
    extra = [c for c in attributes.columns if c != attribute_key]
    clash = sorted(set(extra) & set(target.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    right = attributes.select(F.col(attribute_key).alias("_key"), *extra)
    return target.join(right, F.col(key) == F.col("_key"), "left").drop("_key")


def composite_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on several columns, each kept once."""
    return left.join(right, list(keys), how)


def decode(df: DataFrame, vocabulary: DataFrame, code: str, out: str,
           identifier: str = "IDENTIFIER", title: str = "TITLE") -> DataFrame:
    """Code to title; rows whose code is unknown keep a null title.

    The vocabulary is reduced to one title per code first, so no row fans out: the first in text order, where
    ``repeated_codes`` lists the codes that have several. Spark broadcasts it
    when it is below the size threshold, and sort-merges with skew handling when it is not.
    """
    words = (
        vocabulary.where(F.col(identifier).cast("string") != "")
        .groupBy(F.col(identifier).alias("_code"))
        .agg(F.min(title).alias(out))
    )
    return df.join(words, F.col(code) == F.col("_code"), "left").drop("_code")


def undecoded(decoded: DataFrame, code: str, out: str) -> DataFrame:
    """Codes that found no title, with their row count."""
    missing = decoded.where(F.col(code).isNotNull() & F.col(out).isNull())
    return missing.groupBy(code).agg(F.count(F.lit(1)).alias("n_rows"))


def repeated_codes(vocabulary: DataFrame, identifier: str = "IDENTIFIER", title: str = "TITLE") -> DataFrame:
    """(code, n_titles, first_title, last_title): codes with more than one title, of which ``decode`` uses the first."""
    filled = vocabulary.where(F.col(identifier).cast("string") != "").groupBy(F.col(identifier).alias("code"), F.col(title).alias("title")).agg(F.lit(1).alias("_one"))
    counted = filled.groupBy("code").agg(F.count("title").alias("n_titles"), F.min("title").alias("first_title"), F.max("title").alias("last_title"))
    return counted.where("n_titles > 1")


# --- unions and merges ---------------------------------------------------------------------------

def union_standard(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """UNION ALL of tables cut to one column list."""
    first, *rest = [frame.select(*columns) for frame in frames]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def union_feeds(feeds: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """Union of differently shaped feeds; ``kind`` names the feed, missing columns become null."""
    tagged = [frame.withColumn(kind, F.lit(name)) for name, frame in feeds.items()]
    first, *rest = tagged
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def texts(column: str | Column) -> Column:
    """Distinct non-null values in text order, joined by ``, ``; null when there is none.

    A set collects with map-side combine in the same single shuffle as the other aggregates;
    several DISTINCT aggregates would multiply the rows before the shuffle instead.
    """
    values = F.collect_set(column)
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), ", "))


def money(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


_MERGE = {
    "texts": texts,
    "min": F.min,
    "max": F.max,
    "sum": lambda c: F.sum(money(c)),
}


def merge_duplicates(df: DataFrame, key: str, spec: Mapping[str, str]) -> DataFrame:
    """One row per key; sums are decimal, so they do not depend on the order of rows."""
    return df.groupBy(key).agg(*[_MERGE[how](column).alias(column) for column, how in spec.items()])


def normalized(column: str | Column) -> Column:
    """Text for comparison: upper case, punctuation dropped, blanks collapsed."""
    column = F.col(column) if isinstance(column, str) else column
    squeezed = F.regexp_replace(F.upper(column), r"[^A-Z0-9 ]", "")
    return F.trim(F.regexp_replace(squeezed, " +", " "))


def display_name(first: str, second: str) -> Column:
    """Name plus second name line when there is one."""
    def filled(column: str) -> Column:
        return F.when(F.trim(column) != "", F.col(column))

    return F.concat_ws(" ", filled(first), filled(second))


def dedup_entities(df: DataFrame, name: str, address: str) -> DataFrame:
    """One owner per normalized (name, address); the spelling kept is the first in text order."""
    return (
        df.groupBy(normalized(name).alias("name_key"), normalized(address).alias("address_key"))
        .agg(F.min(name).alias("name"), F.min(address).alias("raw_line"), F.count(F.lit(1)).alias("n_sources"))
    )


# --- footprints, parcels, buildings, units -------------------------------------------------------

def footprints(accounts: DataFrame) -> DataFrame:
    """Accounts that are the footprint of their plot. Plain equality: a null never matches."""
    return accounts.where("parcel = gisparcel AND ownercode = gisownercode AND cityblock = giscityblock")


def shapes(accounts: DataFrame, key: str = "handle", condo: Column | None = None) -> DataFrame:
    """Per plot: number of accounts, and simple / condo / shared.

    Without a ``condo`` flag every plot with several accounts counts as condo.
    """
    flag = F.bool_or(F.coalesce(condo, F.lit(False))) if condo is not None else F.lit(True)
    counted = accounts.groupBy(key).agg(F.count(F.lit(1)).alias("n_accounts"), flag.alias("_condo"))
    shape = F.when(F.col("n_accounts") == 1, "simple").when(F.col("_condo"), "condo").otherwise("shared")
    return counted.select(key, "n_accounts", shape.alias("shape"))


def not_vacant(accounts: DataFrame, flag: str = "vacantland") -> DataFrame:
    """Drop vacant land; an unknown flag is not vacant."""
    return accounts.where(F.coalesce(F.col(flag) != "Y", F.lit(True)))


def parcels(accounts: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Parcel rows from footprint accounts, target column <- source column."""
    return footprints(accounts).select("handle", *[F.col(s).alias(t) for t, s in columns.items()])


def buildings(accounts: DataFrame, shape: DataFrame, detail: DataFrame, key: str = "handle") -> DataFrame:
    """(handle, account, bldgnum, detail...) rows.

    Simple plots: one per detail row of their account. Condo plots: one synthesized building 1 per
    plot, without account or detail. Both joins are dealt out by the number of their rows.
    """
    extra = [c for c in detail.columns if c not in (*ACCOUNT, "bldgnum")]
    placed = accounts.select(key, *ACCOUNT).join(dealt(shape, accounts.count(), key), key).where("shape = 'simple'")
    simple = (
        dealt(placed, detail.count(), *ACCOUNT)
        .join(detail, list(ACCOUNT))
        .select(key, *ACCOUNT, F.col("bldgnum").try_cast("bigint").alias("bldgnum"), *extra, F.lit("simple").alias("shape"))
    )
    types = dict(simple.dtypes)
    condo = shape.where("shape = 'condo'").select(
        key,
        *[F.lit(None).cast(types[c]).alias(c) for c in ACCOUNT],
        F.lit(1).cast("bigint").alias("bldgnum"),
        *[F.lit(None).cast(types[c]).alias(c) for c in extra],
        F.lit("condo").alias("shape"),
    )
    return simple.unionByName(condo)


def natural_order(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` and the columns that sort it by number where a value reads as one, those first, then by text: 2 before 10 before 1A."""
    added, order = {}, []
    for c in columns:
        number = F.col(c).try_cast("decimal(38,9)")
        added |= {f"_text_{c}": number.isNull(), f"_number_{c}": number}
        order += [f"_text_{c}", f"_number_{c}", c]
    return df.withColumns(added), order


def simple_units(building: DataFrame, sections: DataFrame, residential: DataFrame) -> DataFrame:
    """Units of simple plots: (handle, account, bldgnum, unit_seq, sectnum).

    A residential or at most single-section building is one unit; any other has one per section, in
    section order: by number where they are numbers, staged text or not. Sections and residential rows of other
    buildings leave before they are compared, and every step is dealt out by the building, in tasks of bounded rows.
    """
    keys = [*ACCOUNT, "bldgnum"]
    number = F.col("bldgnum").try_cast("bigint").alias("bldgnum")
    simple = materialize(building.where("shape = 'simple'").select("handle", *keys), "simple-buildings")
    known, n = simple.select(*keys), simple.count()

    def of_simple(part: DataFrame, *columns: str) -> DataFrame:
        dealt_known = dealt(known, max(n, part.count()), *keys)
        return part.select(*ACCOUNT, number, *columns).join(dealt_known, keys, "left_semi").dropDuplicates()

    sections = materialize(of_simple(sections, "sectnum"), "simple-sections")
    homes = of_simple(residential).withColumn("_home", F.lit(True))
    n_sections = sections.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sections"))
    kinds = materialize(
        dealt(simple, n, *keys)
        .join(homes, keys, "left")
        .join(n_sections, keys, "left")
        .select("handle", *keys, (F.coalesce("_home", F.lit(False)) | (F.coalesce("_sections", F.lit(0)) <= 1)).alias("_whole")),
        "unit-kinds",
    )
    whole = kinds.where("_whole").select(
        "handle", *keys, F.lit(1).cast("bigint").alias("unit_seq"), F.lit(None).cast("string").alias("sectnum")
    )
    split = dealt(kinds.where("not _whole").select("handle", *keys), sections.count(), *keys).join(sections, keys)
    split, order = natural_order(split, ["sectnum"])
    split = materialize(split, "sections")
    numbered = number_rows(dealt(split, split.count(), "handle", *keys), ["handle", *keys], order, "unit_seq")
    return whole.unionByName(
        numbered.select("handle", *keys, "unit_seq", F.col("sectnum").cast("string").alias("sectnum"))
    )


def condo_units(accounts: DataFrame, shape: DataFrame, order: Sequence[str], key: str = "handle",
                footprint: Column | None = None) -> DataFrame:
    """One unit per condo account other than the footprint, numbered per plot in ``order``.

    ``order`` is by number where values are numbers, staged text or not. It need not be unique: exact copies
    are told apart by a copy number, and the remaining columns break ties.
    """
    if footprint is None:
        footprint = F.expr("parcel = gisparcel AND ownercode = gisownercode AND cityblock = giscityblock")
    condos = shape.where("shape = 'condo'").select(key)
    members = accounts.where(~F.coalesce(footprint, F.lit(False))).join(condos, key, "left_semi")
    ties = [c for c in accounts.columns if c not in (*order, key)]
    unique, ordered = natural_order(number_copies(members, "_copy"), order)
    unique = materialize(unique, "condo-accounts")
    numbered = number_rows(unique, [key], [*ordered, *ties, "_copy"], "unit_seq")
    return numbered.select(*accounts.columns, "unit_seq", F.lit(1).cast("bigint").alias("bldgnum"))


def secondary_owners(accounts: DataFrame, shape: DataFrame, owner: Sequence[str], key: str = "handle") -> DataFrame:
    """Accounts on shared (non-condo) plots whose owner differs from the footprint's owner."""
    mains = footprints(accounts).groupBy(key).agg(F.min(F.struct(*owner)).alias("_main"))
    shared = accounts.join(shape.where("shape = 'shared'").select(key), key, "left_semi")
    joined = shared.join(mains, key, "left")
    return joined.where(~F.struct(*owner).eqNullSafe(F.col("_main"))).drop("_main")


def buildings_without_units(building: DataFrame, unit: DataFrame, keys: Sequence[str]) -> DataFrame:
    return building.join(unit.select(*keys).distinct(), list(keys), "left_anti")


def explode_count(df: DataFrame, n: Column | str, out: str = "number") -> DataFrame:
    """Rows 1..n per source row; none when n is null or below 1."""
    n = F.col(n) if isinstance(n, str) else n
    return df.where(n >= 1).withColumn(out, F.explode(F.sequence(F.lit(1), n.cast("int"))))


def slots_to_rows(df: DataFrame, keys: Sequence[str], slots: Sequence[str], out: str = "code") -> DataFrame:
    """Numbered slots (zoning1..3) to one row per filled slot; ``0`` and blank mean empty."""
    long = df.select(*keys, *[F.col(s).cast("string").alias(s) for s in slots]).unpivot(
        list(keys), list(slots), "slot", out
    )
    return long.where(F.col(out).isNotNull() & ~F.trim(out).isin("", "0"))


# --- addresses and events ------------------------------------------------------------------------

# Abbreviations of the direction titles.
DIRECTIONS = {"N": "North", "S": "South", "E": "East", "W": "West"}

_LINE = r"(?i)^\s*([0-9]+)[A-Z]?\s+(?:(N|S|E|W|NORTH|SOUTH|EAST|WEST)\s+)?(.+?)(?:\s+(?:UNIT|APT|STE|#)\s*(\S+))?\s*$"


def parse_situs(line: str) -> Column:
    """Street number, direction, name and unit of a one-line site address, as a struct."""

    def part(group: int) -> Column:
        found = F.regexp_extract(line, _LINE, group)
        return F.when(found != "", found)

    return F.struct(
        part(1).try_cast("int").alias("street_number"), F.upper(part(2)).alias("street_name_prefix"),
        part(3).alias("street_name"), part(4).alias("secondary_designator"),
    )


def situs_addresses(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Componentized site addresses, target column <- source column, 1:1."""
    return df.select(*[F.col(s).alias(t) for t, s in columns.items()], F.lit(None).cast("string").alias("raw_line"))


def mailing_addresses(df: DataFrame, line: str, city: str, state: str, zip_code: str) -> DataFrame:
    """Owner addresses: the street line stays verbatim, unparsed."""
    return df.select(F.col(line).alias("raw_line"), F.col(city).alias("city"), F.col(state).alias("state"),
                     F.col(zip_code).cast("string").alias("zip"))


def typed(column: str | Column, type_name: str) -> Column:
    """Staged text to ``type_name``; null where the text does not say one. ``unreadable`` lists those rows."""
    column = F.col(column) if isinstance(column, str) else column
    return cast_text(column.cast("string"), type_name)


def unreadable(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """All rows with route and reason: rejected where a filled column does not read as its type, else loaded."""
    return route(df, rejected_if=[
        (f"unreadable {name}", F.col(name).isNotNull() & (F.trim(F.col(name).cast("string")) != "") & typed(name, kind).isNull())
        for name, kind in types.items()
    ])


def assessments(df: DataFrame, parcel: str, total: str, land: str, improvement: str, snapshot: Column) -> DataFrame:
    """One row per parcel and snapshot; the assessment date has no source and stays null."""
    return df.select(
        F.col(parcel).alias("parcel_id"), F.lit(None).cast("date").alias("assessment_date"),
        typed(total, "double").alias("assessment_amount"), typed(land, "double").alias("land_value"),
        typed(improvement, "double").alias("improvement_value"), snapshot.alias("snapshot"),
    )


def inspections(df: DataFrame, key: str, building: str, on: Column, kind: str) -> DataFrame:
    """Inspections; completion date and number of violations have no source and stay null."""
    return df.select(
        F.col(key).alias("inspection_id"), F.col(building).alias("building_id"), typed(on, "date").alias("inspection_date"),
        F.lit(None).cast("date").alias("completion_date"), F.col(kind).alias("inspection_type"),
        F.lit(None).cast("int").alias("number_of_violations"),
    )


def condemnations(df: DataFrame, key: str, inspection: str, letter: Column, kind: str, status: str) -> DataFrame:
    return df.select(
        F.col(key).alias("condemnation_id"), F.col(inspection).alias("inspection_id"), typed(letter, "date").alias("letter_date"),
        F.col(kind).alias("condemnation_type"), F.col(status).alias("status"),
    )


def delinquencies(df: DataFrame, entity: str, balance: str) -> DataFrame:
    """Owners with a balance due; the last paid year has no source and stays null."""
    due = typed(balance, "double")
    return df.where(due > 0).select(
        F.col(entity).alias("legal_entity_id"), F.lit(None).cast("int").alias("last_paid_year"),
        due.alias("amount_delinquent"),
    )


# --- dictionary-driven mapping -------------------------------------------------------------------

# Mapping states that lead to a column now; the others are reported only.
COPY_STATUS = ("candidate_direct", "proposed")
LOOKUP_STATUS = "needs_lookup"


def apply_mapping(df: DataFrame, mapping: DataFrame, table: str,
                  vocabularies: Mapping[str, DataFrame] | None = None,
                  types: Mapping[str, str] | None = None) -> DataFrame:
    """Select the columns of ``table`` that the mapping dictionary describes.

    ``mapping`` has source_field, current_table, current_column, mapping_status, vocabulary. Lookups
    decode through ``vocabularies``; target columns in ``types`` without a source are null.
    """
    types = types or {}
    rows = mapping.where(F.col("current_table") == table).orderBy("current_column", "source_field").collect()
    present = {c.lower(): c for c in df.columns}
    picked: dict[str, Column] = {}
    for row in rows:
        source, target = present.get((row["source_field"] or "").lower()), row["current_column"]
        if not source or not target or target in picked:
            continue
        if row["mapping_status"] in COPY_STATUS:
            picked[target] = F.col(source)
        elif row["mapping_status"] == LOOKUP_STATUS and row["vocabulary"] in (vocabularies or {}):
            df = decode(df, vocabularies[row["vocabulary"]], source, f"_{target}")
            picked[target] = F.col(f"_{target}")
    for target in types:
        picked.setdefault(target, F.lit(None))
    return df.select(*[
        (column.cast(types[target]) if target in types else column).alias(target) for target, column in picked.items()
    ])


def mapping_coverage(mapping: DataFrame) -> DataFrame:
    """Fields per entity and mapping status."""
    return mapping.groupBy("entity", "mapping_status").agg(F.count(F.lit(1)).alias("n_fields"))



"""Type inference over landed text, and typed loading with rejects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions import values as V
from landledger.functions.names import safe_identifier
from landledger.session import materialize

# Identifier columns of the parcel extract that must stay text.
FORCE_TEXT = (
    "handle", "asrparcelid", "colparcelid", "addrtype", "parcelid", "natregsite", "zip", "ownerzip",
    "cityblock", "giscityblock",
)

# Source-system type names and the types they load as.
SOURCE_TYPES = {
    "Yes/No": "boolean", "Logical": "boolean", "Date/Time": "date", "Date": "date",
    "Long Integer": "int", "Text": "string",
}

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def clean_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Named text columns to double: commas dropped, blanks and non-numbers to null."""
    return df.withColumns({c: V.to_number(c) for c in cols})


# What a value can be read as, one bit each, in the order of preference. A value fits every type whose bit it has.
BITS = {"boolean": 1, "int": 2, "bigint": 4, "double": 8, "timestamp": 16, "date": 32}


def type_bits(value: Column, long: Column, moment: Column) -> Column:
    """The types that a text fits, as bits, given the whole number and the moment that it reads as."""

    def bit(name: str, test: Column) -> Column:
        return F.when(test, F.lit(BITS[name])).otherwise(F.lit(0))

    whole = F.when(long.between(INT_MIN, INT_MAX), BITS["int"] | BITS["bigint"]).when(long.isNotNull(), BITS["bigint"]).otherwise(0)
    timed = F.when(V.has_time(moment), BITS["timestamp"] | BITS["date"]).when(moment.isNotNull(), BITS["date"]).otherwise(0)
    return bit("boolean", V.is_boolean(value)).bitwiseOR(whole).bitwiseOR(bit("double", V.is_float(value))).bitwiseOR(timed)


def first_rows(df: DataFrame, n: int, order: Iterable[str]) -> DataFrame:
    """The ``n`` rows that come first in ``order``, the same whatever the partitioning: ties are broken by all other columns.

    Each task keeps its own first ``n``, and those are merged; nothing is sorted as a whole.
    """
    order = list(order)
    return df.orderBy(*order, *[c for c, kind in df.dtypes if c not in order and not kind.startswith(("map", "variant"))]).limit(n)


def infer_types(
    df: DataFrame, force_text: Iterable[str] = (), sample: int | None = None, order: Iterable[str] | None = None, group: int = 40,
) -> DataFrame:
    """One row per column: (column, position, type, n_values).

    A value gives the set of types that it fits, a few bits; the bits that all values of a column share are its types, and the first
    of them is taken. That is one aggregate without keys for every ``group`` columns, so no cell becomes a row, nothing is
    shuffled but one row a task, and generated code stays small however wide the table is. By default all rows are read; ``sample``
    looks at as many rows only: the first in ``order``, or without one, any.
    """
    forced = {name.strip().lower() for name in force_text}
    source = (first_rows(df, sample, order) if order else df.limit(sample)) if sample else df
    named = [(i, c) for i, c in enumerate((c for c in df.columns if c.strip()), 1)]
    everything = sum(BITS.values())
    parts = []
    for at in range(0, len(named), group):
        # Values are read once each, in columns of their own, before the tests that share them.
        texts = source.select(*[V.value_or_null(F.col(f"`{c}`").cast("string")).alias(f"v{i}") for i, c in named[at:at + group]])
        read = texts.select("*", *[f(f"v{i}").alias(f"{kind}{i}") for i, _ in named[at:at + group] for kind, f in (("l", V.to_integer), ("m", V.to_moment))])
        measures = []
        for i, c in named[at:at + group]:
            value = F.col(f"v{i}")
            measures.append(F.struct(
                F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(c.strip().lower() in forced).alias("forced"), F.count(value).alias("n_values"),
                F.bit_and(F.when(value.isNotNull(), type_bits(value, F.col(f"l{i}"), F.col(f"m{i}")))).alias("bits"),
            ))
        parts.append(read.agg(F.array(*measures).alias("m")).select(F.inline("m")))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, position int, type string, n_values bigint")
    stats = parts[0]
    for part in parts[1:]:
        stats = stats.unionByName(part)
    kind = F.when(F.col("forced") | (F.col("n_values") == 0), "string")
    for name, bit in BITS.items():
        kind = kind.when(F.coalesce("bits", F.lit(everything)).bitwiseAND(F.lit(bit)) != 0, name)
    return stats.select("column", "position", kind.otherwise("string").alias("type"), "n_values")


def type_map(inferred: DataFrame) -> dict[str, str]:
    """Inferred types as a dict in column order (one row per column: metadata)."""
    return {row["column"]: row["type"] for row in inferred.orderBy("position").collect()}


def ddl(types: Mapping[str, str], spark) -> str:
    """``name type, ...`` with safe identifiers."""
    if not types:
        return ""
    names = spark.createDataFrame(list(enumerate(types)), "i int, name string")
    safe = {r["i"]: r["safe"] for r in names.select("i", safe_identifier("name").alias("safe")).collect()}
    return ", ".join(f"{safe[i]} {type_name}" for i, type_name in enumerate(types.values()))


def apply_types(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cast text columns; returns (good, rejects).

    A row with a value that does not fit its type goes to the rejects as landed, with the names of
    the failing columns; it is never loaded with a null in its place.
    """
    # Written once: both results come from one scan and one parse of the landed text.
    flagged = materialize(_flag(df, types), "typed")
    good = flagged.where(F.size("_failed") == 0).select(
        *[F.col("_typed")[c].alias(c) if c in types else F.col(c) for c in df.columns]
    )
    rejects = flagged.where(F.size("_failed") > 0).select(
        *df.columns, F.concat_ws(",", "_failed").alias("failed_columns")
    )
    return good, rejects


def _flag(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    typed = df.withColumn(
        "_typed", F.struct(*[V.cast_text(V.value_or_null(c), t).alias(c) for c, t in types.items()])
    )
    failed = [
        F.when(V.value_or_null(c).isNotNull() & F.col("_typed")[c].isNull(), F.lit(c)) for c in types
    ]
    return typed.withColumn("_failed", F.array_compact(F.array(*failed)))


def typed_from_text(df: DataFrame, mapping: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """``apply_types`` with source-system type names (``Yes/No``, ``Long Integer``, ...)."""
    return apply_types(df, {column: SOURCE_TYPES[name] for column, name in mapping.items()})

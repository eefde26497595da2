"""Street lines with house-number ranges, and the join of addresses to the ranges that hold them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.operators.entities import DIRECTIONS, route
from landledger.session import materialize

# Titles of street types with their postal abbreviations.
STREET_TYPES = {
    "AVE": "Avenue", "BLVD": "Boulevard", "CT": "Court", "DR": "Drive", "LN": "Lane", "MALL": "Mall", "PL": "Place",
    "RR": "Rail Road", "RD": "Road", "ROW": "Row", "ST": "Street", "TER": "Terrace", "WALK": "Walk", "WAY": "Way",
}
# Directions that stand after a street's name only.
CORNERS = {"NE": "Northeast", "NW": "Northwest", "SE": "Southeast", "SW": "Southwest"}

ODD, EVEN, BOTH = "odd", "even", "both"


def _spellings(titles: Mapping[str, str]) -> dict[str, str]:
    return {spelling.upper(): title for short, title in titles.items() for spelling in (short, title)}


def _either(spellings: Mapping[str, str]) -> str:
    return "|".join(sorted((s.replace(" ", r"\s+") for s in spellings), key=lambda s: (-len(s), s)))


def street_line(line: Column | str, types: Mapping[str, str] = STREET_TYPES, directions: Mapping[str, str] = DIRECTIONS) -> Column:
    """The parts of a one-line address as a struct, with titles in place of abbreviations.

    ``low`` and ``high``: the house number twice, or both ends of ``low-high``. A part that is not there is null; a line that
    begins with no house number, or has nothing else, has null in every part. A name that is itself a direction or a type, as in
    ``12 North St`` or ``12 Court``, stays a name. Numbers of more than nine digits are not read.
    """
    line = F.col(line) if isinstance(line, str) else line
    before, kinds, after = _spellings(directions), _spellings(types), _spellings({**directions, **CORNERS})
    pattern = (
        r"(?i)^\s*([0-9]{1,9})(?:\s*-\s*([0-9]{1,9}))?([A-Z]|\s+[0-9]/[0-9])?\s+"
        rf"(?:({_either(before)})\s+(?!(?:{_either(kinds)})\.?\s*(?:$|(?:UNIT|APT|STE)\s|#)))?"
        rf"(\S.*?)(?:\s+({_either(kinds)})\.?)?(?:\s+({_either(after)}))?(?:\s+(?:UNIT\s|APT\s|STE\s|#)\s*(\S+))?\s*$"
    )

    def part(group: int) -> Column:
        return F.nullif(F.trim(F.regexp_extract(line, pattern, group)), F.lit(""))

    def title(group: int, spellings: Mapping[str, str]) -> Column:
        known = F.create_map(*[F.lit(x) for pair in spellings.items() for x in pair])
        return known[F.regexp_replace(F.upper(part(group)), r"\s+", " ")]

    return F.struct(
        part(1).try_cast("int").alias("low"), F.coalesce(part(2), part(1)).try_cast("int").alias("high"),
        F.upper(part(3)).alias("number_suffix"), title(4, before).alias("direction"),
        F.regexp_replace(part(5), r"\s+", " ").alias("street_name"), title(6, kinds).alias("street_type"),
        title(7, after).alias("suffix_direction"), part(8).alias("secondary_designator"),
    )


def street_key(parts: str) -> Column:
    """One text per street of a ``street_line`` column; null where the line was not read."""
    name = F.upper(F.col(f"{parts}.street_name"))
    rest = [F.coalesce(F.col(f"{parts}.{c}"), F.lit("")) for c in ("direction", "street_type", "suffix_direction")]
    return F.when(name.isNotNull(), F.concat_ws("|", name, *rest))


def side_of(low: Column, high: Column) -> Column:
    """Ends of one parity span that side of the street; ends of unlike parity span both."""
    return F.when(low % 2 != high % 2, BOTH).when(low % 2 == 0, EVEN).when(low % 2 == 1, ODD)


def routed_ranges(ranges: DataFrame, parts: str) -> DataFrame:
    """All rows with side, route and reason: ranges that were not read or run backwards are rejected."""
    low, high = F.col(f"{parts}.low"), F.col(f"{parts}.high")
    return route(ranges.withColumn("side", side_of(low, high)), rejected_if=[
        ("unreadable line", low.isNull() | high.isNull()), ("range runs backwards", high < low),
    ])


def _bins(low: Column, high: Column) -> Column:
    """The numbers from ``low`` to ``high`` as whole bins of 2**level numbers: at most two of a level, and no number in two of them."""
    low, end = low.cast("bigint"), high.cast("bigint") + 1

    def of(level: Column) -> Column:
        first = F.call_function("shiftright", low + F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1, level)
        last = F.call_function("shiftright", end, level) - 1

        def taken(bin_: Column, parity: int) -> Column:
            return F.when((first <= last) & (F.pmod(bin_, F.lit(2)) == parity), F.struct(level.alias("level"), bin_.alias("bin")))

        return F.array(taken(first, 1), taken(last, 0))

    levels = F.sequence(F.lit(0), F.length(F.bin(end - low)) - 1)
    return F.filter(F.flatten(F.transform(levels, of)), lambda bin_: bin_.isNotNull())


def match_ranges(addresses: DataFrame, ranges: DataFrame, key: str, parts: str, range_key: str, range_parts: str) -> DataFrame:
    """(key, street, number, n_rows, n_ranges, range_key, reason): each address with the narrowest range that holds its number on its side.

    ``parts`` and ``range_parts`` are ``street_line`` columns. Of ranges as narrow, the one with the lower start, then the smaller key,
    is taken; ``n_ranges`` counts all that hold the number. Without one, ``reason`` says why: the line was
    not read, the street has no range, the number lies on the other side, or outside all ranges. Equal rows of ``addresses`` are one
    row with their number in ``n_rows``. Rejected ranges take no part.

    A range is cut into bins of 2**n numbers that it fills, two of a width at most. All ranges that fill a bin are one row, with their
    count and the best of them for even and for odd numbers. A number lies in one bin of each width, 32 at most, so rows grow with
    ranges and numbers, not with the pairs of both. A number of a street is looked up once, however many addresses have it. Both
    sides meet by (street, width, bin), an equi-join that Spark can split where a street or a number is hot.
    """
    low, high = F.col(f"{range_parts}.low"), F.col(f"{range_parts}.high")
    usable = ranges.select(F.col(range_key).alias("r"), low.alias("low"), high.alias("high"), street_key(range_parts).alias("_street"))
    usable = usable.where("_street is not null and low <= high")
    narrow = F.struct((F.col("high") - F.col("low")).alias("width"), "low", "r").alias("range")
    serves = [((side_of(F.col("low"), F.col("high")) == BOTH) | (F.pmod("low", F.lit(2)) == parity)).alias(f"serves{parity}") for parity in (0, 1)]
    filled = usable.select("_street", narrow, *serves, F.inline(_bins(F.col("low"), F.col("high"))))
    bins = materialize(filled.groupBy("_street", F.col("level").alias("_level"), F.col("bin").alias("_bin")).agg(*[
        c for parity in (0, 1) for c in (
            F.count_if(f"serves{parity}").alias(f"n{parity}"), F.min(F.when(F.col(f"serves{parity}"), F.col("range"))).alias(f"best{parity}"))
    ]), "range-bins")
    levels = [row[0] for row in bins.select("_level").distinct().collect()]  # at most 32 small numbers
    # A row of its own for each street tells streets without ranges from numbers that no range holds.
    streets = bins.select("_street").distinct().select("_street", F.lit(-1).alias("_level"), F.lit(0).cast("bigint").alias("_bin"))
    table = bins.unionByName(streets, allowMissingColumns=True)

    number = F.col(f"{parts}.low")
    given = addresses.select(F.col(key).alias("k"), street_key(parts).alias("street"), number.alias("number"))
    asked = materialize(given.groupBy("k", "street", "number").agg(F.count(F.lit(1)).alias("n_rows")), "addresses")
    own = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("bigint").alias("bin")), *[
        F.struct(F.lit(n).alias("level"), F.shiftright(F.col("number").cast("bigint"), n).alias("bin")) for n in sorted(levels)
    ])
    looked = asked.select("street", "number").dropna().distinct().select("street", "number", F.inline(own))
    found = looked.join(table, (F.col("street") == F.col("_street")) & (F.col("level") == F.col("_level")) & (F.col("bin") == F.col("_bin")))
    even = F.pmod("number", F.lit(2)) == 0
    answers = found.groupBy(F.col("street").alias("_street"), F.col("number").alias("_number")).agg(
        F.min(F.when(even, F.col("best0")).otherwise(F.col("best1"))).alias("best"),
        F.sum(F.when(even, F.col("n0")).otherwise(F.col("n1"))).alias("n_ranges"), F.bool_or(F.col("level") >= 0).alias("held"),
    )
    best = asked.join(materialize(answers, "range-answers"), (F.col("street") == F.col("_street")) & (F.col("number") == F.col("_number")), "left")
    reason = (
        F.when(F.col("best").isNotNull(), F.lit(None).cast("string")).when(F.col("street").isNull() | F.col("number").isNull(), "unreadable line")
        .when(F.col("_street").isNull(), "street without ranges").when(F.col("held"), "other side of the street").otherwise("outside all ranges")
    )
    return best.select(
        F.col("k").alias(key), "street", "number", "n_rows", F.coalesce("n_ranges", F.lit(0)).alias("n_ranges"), F.col("best.r").alias(range_key), reason.alias("reason"))

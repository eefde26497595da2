"""Street lines made from part and order keys: their parts, ranges of house numbers, and addresses within them."""

from __future__ import annotations

from pyspark.sql import functions as F

from landledger.operators import addresses as A
from landledger.plans.registry import query

# What the lines spell, beside the titles that must come of it.
_PREFIXES = (("N ", "North"), ("west ", "West"), ("", ""))
_TYPES = ((" Ave", "Avenue"), (" street", "Street"), (" BLVD.", "Boulevard"), ("", ""))
_UNITS = (("", None), (" Apt 3", "3"), (" # 4b", "4b"), (" SE", None))


def _pick(number, options):
    """The option at a number."""
    return F.array(*[F.lit(o) for o in options])[number.cast("int")]


def _line(numbers, name, by, unit=None):
    tail = _pick(unit % 4, [text for text, _ in _UNITS]) if unit is not None else F.lit("")
    return F.concat(numbers, F.lit(" "), _pick(by % 3, [p for p, _ in _PREFIXES]), name, _pick(by % 4, [t for t, _ in _TYPES]), tail)


def _titles_sql(number: str, titles) -> str:
    return "[" + ", ".join(f"'{t}'" for _, t in titles) + f"][1 + {number} % {len(titles)}]"


def _ranges(t):
    """A range per part: of one side or both, some backwards, some lines without a number."""
    low = F.col("p_size") % 10 * 100 + F.col("p_partkey") % 60 + 5
    high = F.when(F.col("p_partkey") % 17 == 3, low - 4).otherwise(
        low + F.col("p_partkey") % 7 * (F.col("p_partkey") % 9) * 2 + F.when(F.col("p_partkey") % 4 == 0, 1).otherwise(0))
    named = t.part.withColumn("n_nationkey", F.col("p_partkey") % 5).join(t.nation, "n_nationkey")
    numbers = F.when(F.col("p_partkey") % 23 == 5, "Lot").otherwise(F.concat_ws("-", low.cast("string"), high.cast("string")))
    return named.select("p_partkey", A.street_line(_line(numbers, "n_name", F.col("p_partkey"))).alias("line"))


_RANGES_SQL = f"""
    rng AS (SELECT p_partkey AS r, CASE WHEN p_partkey % 23 <> 5 THEN p_size % 10 * 100 + p_partkey % 60 + 5 END AS low,
                   CASE WHEN p_partkey % 17 = 3 THEN -4 ELSE p_partkey % 7 * (p_partkey % 9) * 2 + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END END AS width,
                   upper(n_name) || '|' || {_titles_sql("p_partkey", _PREFIXES)} || '|' || {_titles_sql("p_partkey", _TYPES)} || '|' AS street
            FROM part JOIN nation ON n_nationkey = p_partkey % 5)"""


@query(f"""
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderkey % 10 * 100 + o_custkey % 100 AS number, o_custkey % 4 AS unit, n_name FROM orders JOIN nation ON n_nationkey = o_orderkey % 7)
    SELECT o_orderkey, number::INTEGER AS low, number::INTEGER AS high, nullif({_titles_sql("o_orderkey", _PREFIXES)}, '') AS direction,
           n_name AS street_name, nullif({_titles_sql("o_orderkey", _TYPES)}, '') AS street_type, CASE WHEN unit = 3 THEN 'Southeast' END AS suffix_direction,
           CASE unit WHEN 1 THEN '3' WHEN 2 THEN '4b' END AS secondary_designator FROM o""")
def street_lines(t):
    number = (F.col("o_orderkey") % 10 * 100 + F.col("o_custkey") % 100).cast("string")
    named = t.orders.withColumn("n_nationkey", F.col("o_orderkey") % 7).join(t.nation, "n_nationkey")
    line = A.street_line(_line(number, "n_name", F.col("o_orderkey"), F.col("o_custkey")))
    return named.select("o_orderkey", line.alias("line")).select("o_orderkey", "line.*").drop("number_suffix")


@query(f"""
    WITH {_RANGES_SQL}
    SELECT CASE WHEN width % 2 <> 0 THEN 'both' WHEN low % 2 = 0 THEN 'even' WHEN low % 2 = 1 THEN 'odd' END AS side,
           CASE WHEN low IS NULL OR width < 0 THEN 'rejected' ELSE 'loaded' END AS route,
           CASE WHEN low IS NULL THEN 'unreadable line' WHEN width < 0 THEN 'range runs backwards' END AS reason, count(*) AS n_rows
    FROM (SELECT low, CASE WHEN low IS NOT NULL THEN width END AS width FROM rng) GROUP BY ALL""")
def address_ranges(t):
    return A.routed_ranges(_ranges(t), "line").groupBy("side", "route", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""
    WITH {_RANGES_SQL},
    usable AS (SELECT *, low + width AS high FROM rng WHERE low IS NOT NULL AND width >= 0),
    adr AS (SELECT o_custkey, count(*) AS n_rows, CASE WHEN o_orderkey % 19 > 0 THEN o_orderkey % 10 * 100 + o_custkey % 100 END::INTEGER AS number,
                   CASE WHEN o_orderkey % 19 > 0 THEN upper(n_name) || '|' || {_titles_sql("o_orderkey", _PREFIXES)} || '|' || {_titles_sql("o_orderkey", _TYPES)} || '|' END AS street
            FROM orders JOIN nation ON n_nationkey = o_orderkey % 7 GROUP BY ALL),
    held AS (SELECT o_custkey, a.street, number, r, low, width, width % 2 <> 0 OR number % 2 = low % 2 AS sided
             FROM adr a JOIN usable u ON a.street = u.street AND number BETWEEN low AND high),
    best AS (SELECT o_custkey, street, number, count(*) FILTER (sided) AS n, arg_min(r, [width, low, r]) FILTER (sided) AS r FROM held GROUP BY ALL)
    SELECT a.o_custkey, a.street, a.number, n_rows, coalesce(n, 0) AS n_ranges, r AS p_partkey,
           CASE WHEN r IS NOT NULL THEN NULL WHEN a.street IS NULL THEN 'unreadable line'
                WHEN a.street NOT IN (SELECT street FROM usable) THEN 'street without ranges'
                WHEN n IS NOT NULL THEN 'other side of the street' ELSE 'outside all ranges' END AS reason
    FROM adr a LEFT JOIN best b ON a.o_custkey = b.o_custkey AND a.street = b.street AND a.number = b.number""")
def addresses_in_ranges(t):
    number = (F.col("o_orderkey") % 10 * 100 + F.col("o_custkey") % 100).cast("string")
    named = t.orders.withColumn("n_nationkey", F.col("o_orderkey") % 7).join(t.nation, "n_nationkey")
    line = F.when(F.col("o_orderkey") % 19 == 0, "PO Box 12").otherwise(_line(number, "n_name", F.col("o_orderkey")))
    return A.match_ranges(named.select("o_custkey", A.street_line(line).alias("line")), _ranges(t), "o_custkey", "line", "p_partkey", "line")

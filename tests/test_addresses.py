"""Street lines against golden parts; ranges against a loop over all pairs."""

import random

from pyspark.sql import functions as F

from landledger.operators import addresses as A

# line -> low, high, number suffix, direction, name, type, suffix direction, unit
LINES = {
    "101 N Main St": (101, 101, None, "North", "Main", "Street", None, None),
    "101-119 n. main": (101, 119, None, None, "n. main", None, None, None),
    " 101 - 119  West  Park   Ave. Apt 3 ": (101, 119, None, "West", "Park", "Avenue", None, "3"),
    "12B Oak Rail  Road SE #4": (12, 12, "B", None, "Oak", "Rail Road", "Southeast", "4"),
    "12 1/2 Oak Ln": (12, 12, "1/2", None, "Oak", "Lane", None, None),
    "12 North St": (12, 12, None, None, "North", "Street", None, None),
    "12 North": (12, 12, None, None, "North", None, None, None),
    "12 Court": (12, 12, None, None, "Court", None, None, None),
    "12 East West Blvd": (12, 12, None, "East", "West", "Boulevard", None, None),
    "12 A St Unit 9": (12, 12, None, None, "A", "Street", None, "9"),
    "12 Unity Way": (12, 12, None, None, "Unity", "Way", None, None),
    "Main St": (None,) * 8, "12": (None,) * 8, "": (None,) * 8, None: (None,) * 8, "1234567890 Main St": (None,) * 8,
}


def test_street_line(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "line string")
    got = {r["line"]: tuple(r["p"]) for r in df.select("line", A.street_line("line").alias("p")).collect()}
    assert got == LINES


def test_match_ranges(spark):
    random.seed(5)
    streets = ["Oak St", "N Oak St", "Elm", "Hot Way"]
    pick = [0, 1, 2, 3, 3, 3, 3]  # one street holds more than half
    ranges = [(None, "1-9 Oak St"), (1000, "Lot 5 Oak St"), (1001, "90-10 Oak St"), (1002, "7 Elm"), (1003, "0-999999999 Elm"), (1004, None)]
    for key in range(300):
        low = random.randrange(0, 900)
        ranges.append((key, f"{low}-{low + random.choice([0, 1, 2, 7, 8, 30, 255, 256])} {streets[random.choice(pick)]}"))
    lines = [(n, f"{random.randrange(0, 1200)} {streets[random.choice(pick)]}") for n in range(400)]
    lines += lines[:50] + [(1, "nowhere"), (2, None), (None, "5 Oak St"), (3, "5 Other Row"), (4, "999999999 elm"), (5, "2147483647 Elm")]
    a = spark.createDataFrame(lines, "id long, line string").select("id", A.street_line("line").alias("p"))
    r = spark.createDataFrame(ranges, "rid long, line string").select("rid", A.street_line("line").alias("p"))

    keyed = [(row.id, row.s, row.n) for row in a.select("id", A.street_key("p").alias("s"), F.col("p.low").alias("n")).collect()]
    bounds = [(row.rid, row.s, row.low, row.high) for row in r.select("rid", A.street_key("p").alias("s"), "p.low", "p.high").collect() if row.s and row.low <= row.high]
    want = {}
    for key in keyed:
        _, s, n = key
        held = [b for b in bounds if s == b[1] and b[2] <= n <= b[3]]
        sided = [b for b in held if b[2] % 2 != b[3] % 2 or n % 2 == b[2] % 2]
        best = min(sided, key=lambda b: (b[3] - b[2], b[2], b[0] is not None, b[0]), default=(None,))
        why = None if sided else "unreadable line" if s is None else "street without ranges" if s not in {b[1] for b in bounds} else "other side of the street" if held else "outside all ranges"
        want[key] = (keyed.count(key), len(sided), best[0], why)
    rows = A.match_ranges(a, r, "id", "p", "rid", "p").collect()
    assert {(row.id, row.street, row.number): (row.n_rows, row.n_ranges, row.rid, row.reason) for row in rows} == want and len(rows) == len(want)
    assert len({row.reason for row in rows}) == 5

    none = A.match_ranges(a, r.limit(0), "id", "p", "rid", "p")
    assert {row.reason for row in none.collect()} == {"unreadable line", "street without ranges"}
    assert A.match_ranges(a.limit(0), r, "id", "p", "rid", "p").isEmpty()
    routes = {(row.rid, row.side, row.reason) for row in A.routed_ranges(r, "p").where("route = 'rejected'").select("rid", "side", "reason").collect()}
    assert routes == {(1000, None, "unreadable line"), (1004, None, "unreadable line"), (1001, "even", "range runs backwards")}


def test_ranges_become_few_bins(spark):
    """Every number of a range lies in one of its bins, and a width has two at most: a number meets rows, not ranges."""
    bounds = [(0, 0), (5, 48), (7, 8), (1, 1023), (0, 999_999_999), (100, 163), (64, 127)]
    df = spark.createDataFrame(bounds, "low int, high int")
    for row in df.select("low", "high", A._bins(F.col("low"), F.col("high")).alias("bins")).collect():
        spans = sorted((b.bin << b.level, ((b.bin + 1) << b.level) - 1) for b in row.bins)
        assert spans[0][0] == row.low and spans[-1][1] == row.high
        assert all(after[0] == before[1] + 1 for before, after in zip(spans, spans[1:]))
        levels = [b.level for b in row.bins]
        assert max(levels.count(n) for n in levels) <= 2


def test_many_ranges_over_many_numbers(spark):
    """2,000 ranges that all hold the 2,000 numbers asked for: four million pairs, none of which becomes a row."""
    ranges = spark.range(2000).select(F.col("id").alias("rid"), A.street_line(F.format_string("%d-%d Elm", 5000 - F.col("id"), 10_000 + F.col("id") % 7)).alias("p"))
    asked = spark.range(2000).select("id", A.street_line(F.format_string("%d Elm", 6000 + F.col("id"))).alias("p"))
    found = A.match_ranges(asked, ranges, "id", "p", "rid", "p")
    bounds = [(5000 - i, 10_000 + i % 7, i) for i in range(2000)]
    want = {}
    for parity in (0, 1):
        sided = [(high - low, low, i) for low, high, i in bounds if low % 2 != high % 2 or low % 2 == parity]
        want[parity] = (len(sided), min(sided)[2])
    assert {(r.number % 2, r.n_ranges, r.rid) for r in found.collect()} == {(p, *w) for p, w in want.items()}

"""Shards by a Feistel permutation of row numbers: a reproducible shuffle in which every row's shard and slot can be computed.

Rows are numbered 0 to n - 1 in the order of id and text digest. A Feistel network permutes the numbers of 2h bits, the least even
width that holds n; a number that lands at n or above is permuted again until it lies below (cycle walking), so that 0 to n - 1
map onto themselves, one to one. Position p goes to shard p mod k, slot p div k. Nothing is stored and nothing is drawn: row to
place and place to row are a few multiplications either way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.common import materialize, parts_for

PRIME = (1 << 31) - 1
ROUNDS = 6
# Rows numbered by one task; bears on balance only.
PART_ROWS = 1_000_000


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 to ``rows`` - 1, at most 2^62 rows, that depends on ``rows`` and ``seed`` only."""

    rows: int
    seed: str = "shards"

    @property
    def half(self) -> int:
        """Bits of one half."""
        return max(1, -(-max(self.rows - 1, 1).bit_length() // 2))

    def keys(self) -> list[tuple[int, int, int]]:
        """Three numbers below ``PRIME`` per round, from the seed."""
        found = []
        for i in range(ROUNDS):
            digest = hashlib.sha256(f"{self.seed}/{i}".encode()).digest()
            found.append(tuple(int.from_bytes(digest[8 * j:8 * j + 8], "big") % (PRIME - 1) + 1 for j in range(3)))
        return found

    def mixed(self, value: np.ndarray, key: tuple[int, int, int]) -> np.ndarray:
        """Round function of one half: a cubic modulo a prime. No product reaches 2^63."""
        x = (value * key[0] + key[1]) % PRIME
        return (x * x % PRIME * x + key[2]) % PRIME & ((1 << self.half) - 1)

    def once(self, numbers: np.ndarray, back: bool = False) -> np.ndarray:
        left, right = numbers >> self.half, numbers & ((1 << self.half) - 1)
        for key in reversed(self.keys()) if back else self.keys():
            if back:
                left, right = right ^ self.mixed(left, key), left
            else:
                left, right = right, left ^ self.mixed(right, key)
        return (left << self.half) | right

    def __call__(self, numbers: np.ndarray, back: bool = False) -> np.ndarray:
        """Positions of row numbers, or with ``back`` row numbers of positions."""
        result = self.once(np.asarray(numbers, dtype=np.int64), back)
        while (beyond := np.flatnonzero(result >= self.rows)).size:
            result[beyond] = self.once(result[beyond], back)
        return result

    def place(self, row: int, shards: int) -> tuple[int, int]:
        """(shard, slot) of a row number."""
        position = int(self(np.array([row]))[0])
        return position % shards, position // shards

    def row(self, shard: int, slot: int, shards: int) -> int:
        """The row number at a place."""
        return int(self(np.array([slot * shards + shard]), back=True)[0])


def numbered(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, row): rows numbered from 0 in the order of id (nulls first), then text digest.

    ``row`` is a struct of the ``carry`` columns. Rows equal in both stand next to each other, whatever else is in them, and
    spread over tasks all the same: a number given before the sort tells them apart. Only keys are sorted unless columns are carried.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    keyed = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.struct(*[F.col(c) for c in carry or []], F.lit(0).alias("_")).alias("row"), F.monotonically_increasing_id().alias("tie"),
    )
    keyed = materialize(keyed, "shard-keys")
    order = ["doc_id", "digest", "tie"]
    ranged = keyed.repartitionByRange(parts_for(keyed.count(), PART_ROWS, 8), *order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "shard-order")
    # One row per task of the sort.
    runs = ranged.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(runs.select(F.col("part").alias("of"), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("base")), "shard-runs")
    return ranged.join(bases, F.col("part") == F.col("of")).select("doc_id", "size", "text_crc32", (F.col("at") + F.col("base")).alias("row_number"), "row")


def sharded(
    documents: DataFrame, shards: int = 24, seed: str = "shards", id_column: str = "doc_id", text_column: str = "text", carry: list[str] | None = None,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), and ``row`` with the ``carry`` columns if there are any: every row with
    its place.

    ``size`` is the text's bytes in UTF-8 plus 8; null texts are empty. The law is 'rows': shards differ by one row at most, and
    slots of a shard run from 0 without gaps. The result depends on ids, texts, ``shards`` and ``seed``, not on files or partitions;
    copies are rows like any other. A further shard moves rows between the others, so ``grown_shard`` is null. No documents, no rows.
    """
    rows = numbered(documents, id_column, text_column, carry)
    rows = materialize(rows, "shard-numbers")
    permutation = Permutation(rows.count(), seed)

    @F.pandas_udf("long")
    def position(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for numbers in batches:
            yield pd.Series(permutation(numbers.to_numpy()))

    placed = rows.withColumn("position", position("row_number"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("position") % shards).cast("int").alias("shard"),
        F.expr(f"position div {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *([F.struct(*[F.col("row")[c].alias(c) for c in carry]).alias("row")] if carry else []),
    )


def write_shards(placed: DataFrame, folder: str, file_rows: int = 1_000_000) -> DataFrame:
    """Write the rows of ``sharded`` under ``folder``, a folder per shard, and return (shard, part, first, rows, bytes).

    A file holds the slots ``part * file_rows`` to the next part's first, in order, so a reader finds any slot by division.
    """
    parts = placed.withColumn("part", F.expr(f"slot div {int(file_rows)}"))
    spread = parts.repartition(F.col("shard"), F.col("part")).sortWithinPartitions("shard", "part", "slot")
    spread.write.partitionBy("shard", "part").parquet(folder)
    written = placed.sparkSession.read.schema(spread.schema).parquet(folder)
    return written.groupBy("shard", "part").agg(F.min("slot").alias("first"), F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


def _oracle() -> str:
    table = "list_transform(range(256), lambda b: list_reduce(list_prepend(cast(b as bigint), range(cast(8 as bigint))), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))"
    rounds = "cast({x} >> h.h as bigint) as l0, cast({x} & ((1::bigint << h.h) - 1) as bigint) as r0"

    def network(x: str, source: str) -> str:
        sql = f"(select s.*, h.h, {rounds.format(x=x)} from {source} s, h)"
        for i, (a, b, c) in enumerate(Permutation(1).keys()):
            y = f"((r{i} * {a} + {b}) % {PRIME})"
            mixed = f"((({y} * {y} % {PRIME}) * {y} + {c}) % {PRIME} & ((1::bigint << h) - 1))"
            sql = f"(select *, r{i} as l{i + 1}, xor(l{i}, {mixed}) as r{i + 1} from {sql})"
        return f"(select * exclude ({', '.join(f'l{i}, r{i}' for i in range(ROUNDS + 1))}, h), (l{ROUNDS} << h) | r{ROUNDS} as y from {sql})"

    return f"""
    with recursive crc as (select {table} as t),
    d as (select doc_id, coalesce(text, '') as text, cast(row_number() over (order by doc_id nulls first, sha256(coalesce(text, ''))) - 1 as bigint) as number from documents),
    n as (select cast(count(*) as bigint) as n from d),
    h as (select cast(min(i) as integer) as h from (select unnest(range(1, 32)) as i), n where (1::hugeint << (2 * i)) >= n.n),
    walk as (
        select number, y as pos from {network('s.number', 'd')}
        union all
        select number, y as pos from {network('s.pos', '(select number, pos from walk, n where pos >= n.n)')}
    ), b as (
        select doc_id, number, octet_length(encode(text)) as n_bytes, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: cast('0x' || x as bigint)) as bytes from d
    ), c as (
        select doc_id, number, n_bytes, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as crc from b, crc
    )
    select doc_id, cast(n_bytes + 8 as bigint) as size, cast(crc as bigint) as text_crc32, 'rows' as law, cast(pos % 24 as integer) as shard, pos // 24 as slot,
        cast(null as integer) as grown_shard from c join walk using (number), n where pos < n.n
    """


ORACLE = _oracle()

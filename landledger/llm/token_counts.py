"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once and counted by length. The histogram has one row per distinct length, however many documents there
are; sums over it from the long end answer totals, quantiles and totals cut at any context limit.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.common import materialize

# Lengths that share a block; sums run within a block, then over the blocks.
BLOCK = 1024


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def token_count(ranks: bytes, pattern: str):
    """A column function from text to its number of tokens; ``ranks`` is the content of a rank file. Null counts as empty: 0.

    Names of special tokens inside a text are ordinary text. Equal texts of a batch are encoded once.
    """

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoding(ranks, pattern)
        for texts in batches:
            texts = texts.where(texts.notna(), "")
            known = {text: len(coder.encode_ordinary(text)) for text in texts.unique()}
            yield texts.map(known).astype("int64")

    return count


def histogram(documents: DataFrame, ranks: bytes, pattern: str, text_column: str = "text") -> DataFrame:
    """(n_tokens, n_docs): one row per distinct length. The counts are combined before the shuffle; no table, no rows."""
    return documents.select(token_count(ranks, pattern)(F.col(text_column)).alias("n_tokens")).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length L of the histogram: the documents of L tokens and more (``docs_from``) and their tokens (``tokens_from``),
    those below (``docs_below``, ``tokens_below``), and the tokens left when every document is cut to L (``tokens_cut``).

    No window holds more than ``BLOCK`` lengths or one row per block. The histogram is written first, so that no text is
    encoded twice.
    """
    hist = materialize(hist, "token-histogram")
    block = F.floor(F.col("n_tokens") / BLOCK)
    rows = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("n_total"), block.alias("block"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("n_total").alias("b_total")).select(
        "block",
        F.coalesce(F.sum("b_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("b_total").over(later), F.lit(0)).alias("later_total"),
        F.sum("b_docs").over(everything).alias("all_docs"), F.sum("b_total").over(everything).alias("all_total"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    docs_from = F.col("later_docs") + F.sum("n_docs").over(within)
    tokens_from = F.col("later_total") + F.sum("n_total").over(within)
    summed = rows.join(blocks, "block").select("n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "all_docs", "all_total")
    return summed.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from",
        (F.col("all_docs") - F.col("docs_from")).alias("docs_below"),
        (F.col("all_total") - F.col("tokens_from")).alias("tokens_below"),
        (F.col("all_total") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("tokens_cut"),
    )


def at_limit(sums: DataFrame, limit: int) -> dict[str, int]:
    """Totals when documents are cut to ``limit`` tokens, from the two rows around it: any limit, not only lengths that occur."""
    above = sums.where(F.col("n_tokens") >= limit).orderBy("n_tokens").head()
    last = sums.orderBy(F.desc("n_tokens")).head() if above is None else None
    if above is None:
        total = 0 if last is None else last.tokens_below + last.tokens_from
        return {"limit": limit, "docs_cut": 0, "tokens_cut": total}
    longer = above.docs_from - (above.n_docs if above.n_tokens == limit else 0)
    return {"limit": limit, "docs_cut": longer, "tokens_cut": above.tokens_below + limit * above.docs_from}


def quantile(sums: DataFrame, share: float) -> int | None:
    """The least length that at least ``share`` of the documents do not exceed; None if there are no documents."""
    row = sums.where(F.col("docs_below") + F.col("n_docs") >= F.ceil(share * (F.col("docs_below") + F.col("docs_from")))).orderBy("n_tokens").head()
    return None if row is None else row.n_tokens

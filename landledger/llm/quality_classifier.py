"""Quality by compression: which of two dictionaries, built from good or from bad text, shrinks a text more.

Two zstandard dictionaries are built from a bounded sample of labelled texts. A text is compressed in pieces with either one;
the difference of both sizes, divided by the text's bytes, says which class it resembles. A logistic curve, fitted on other
labelled rows, turns that difference (and the size under the good dictionary) into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import as_bytes, give_back, materialize

PIECE = 4096
LEVEL = 3
GROUP = 256


@dataclass(frozen=True)
class Model:
    """``good`` and ``bad``: dictionary bytes. ``weights``: of [1, difference, ratio], on features less ``mean`` over ``scale``."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


def dictionary(texts: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; where there is too little text to train one, the text itself."""
    pieces = [text[i:i + PIECE] for text in texts for i in range(0, len(text), PIECE)]
    if not pieces:
        return b""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


def without_shared_lines(good: list[bytes], bad: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Both samples less the lines that stand in both: a passage that is spread over all texts says nothing of their quality."""
    shared = {line for text in good for line in text.split(b"\n")} & {line for text in bad for line in text.split(b"\n")}
    return tuple([b"\n".join(line for line in text.split(b"\n") if line not in shared) for text in texts] for texts in (good, bad))


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(**plain)
    shared = zstandard.ZstdCompressionDict(content)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=shared, **plain)


def features(texts: list[bytes], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """Per text: (size with bad - size with good) / (bytes + 100), and size with good / bytes. Empty texts: 0 and 0.

    The 100 draw very short texts, where a few bytes are chance, to no difference.
    """
    out = np.zeros((len(texts), 2))
    for row, text in enumerate(texts):
        if text:
            pieces = [text[i:i + PIECE] for i in range(0, len(text), PIECE)]
            small_good = sum(len(good.compress(piece)) for piece in pieces)
            small_bad = sum(len(bad.compress(piece)) for piece in pieces)
            out[row] = (small_bad - small_good) / (len(text) + 100), small_good / len(text)
    return out


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; ``x`` has a column of ones."""
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def sampled(labelled: DataFrame, rows: int, max_bytes: int, salt: str) -> list[tuple[bytes, int]]:
    """Whole texts with their label: at most ``rows`` a class, in the order of a hash, as long as ``max_bytes`` hold them."""
    taken = []
    for label in (0, 1):
        some = (
            labelled.where(F.col("label") == label)
            .select(F.encode("text", "UTF-8").alias("text"), F.xxhash64("text", F.lit(salt)).alias("place"))
            .where(F.octet_length("text") <= max_bytes // 16)
            .orderBy("place").limit(rows)
        )
        room = max_bytes // 2
        for row in some.toLocalIterator():
            room -= len(row.text)
            if room < 0:
                break
            taken.append((bytes(row.text), label))
    return taken


def fit(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
    rows: int = 2000, max_bytes: int = 32 << 20, dictionary_bytes: int = 112 << 10,
) -> Model:
    """Fit on at most ``rows`` labelled texts a class, half for the dictionaries and half for the curve.

    ``labels`` may hold any number of rows: those of each class that come first in the order of a hash of the id are joined to
    the documents. Rows with a null id, text or label, and ids labelled both ways, teach nothing. Without both classes
    the curve is flat, at the share of good labels (0.5 if there are none).
    """
    one_label = (
        labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    )
    first = one_label.where("label = 0").orderBy(F.xxhash64("id"), "id").limit(2 * rows).unionAll(
        one_label.where("label = 1").orderBy(F.xxhash64("id"), "id").limit(2 * rows)
    )
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(F.col("text").isNotNull())
    # At most 4 * rows pairs of an id and a label: written, so that Spark sees how small they are and broadcasts them.
    labelled = texts.join(materialize(first, "labelled-sample"), "id").select("text", "label")
    sample = sampled(labelled, rows, max_bytes, "sample")
    teach, check = sample[::2], sample[1::2]
    good, bad = without_shared_lines([text for text, label in teach if label == 1], [text for text, label in teach if label == 0])
    good, bad = dictionary(good, dictionary_bytes), dictionary(bad, dictionary_bytes)
    y = np.array([label for _, label in check], dtype=float)
    if not len(y) or y.min() == y.max():
        share = (sum(label for _, label in sample) + 1) / (len(sample) + 2)
        return Model(good, bad, (0.0, 0.0), (1.0, 1.0), (float(np.log(share / (1 - share))), 0.0, 0.0))
    x = features([text for text, _ in check], compressor(good), compressor(bad))
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    weights = logistic(np.column_stack([np.ones(len(x)), (x - mean) / scale]), y)
    # The sample has as many rows of either class as it can get: no correction to the true share, so 0.5 is even odds.
    return Model(good, bad, tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, weights)))


def scorer(model: Model):
    """A column function from text to the probability that its label is 1. Null counts as the empty text."""

    def scores(raw: list[bytes], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
        z = np.column_stack([np.ones(len(raw)), (features(raw, good, bad) - np.array(model.mean)) / np.array(model.scale)])
        z[[not text for text in raw], 1:] = 0  # an empty text has no evidence: the odds of an average one
        return 1 / (1 + np.exp(-np.clip(z @ np.array(model.weights), -30, 30)))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        good, bad = compressor(model.good), compressor(model.bad)
        try:
            for whole in batches:
                # A group of rows at a time, so that a batch does not stand in memory twice.
                groups = (as_bytes(whole.slice(start, GROUP)) for start in range(0, len(whole), GROUP))
                yield pa.array(np.concatenate([np.zeros(0), *(scores(raw, good, bad) for raw in groups)]))
        finally:
            give_back()

    return score


def classify(documents: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.3, name: str = "score") -> DataFrame:
    """All columns and rows of ``documents`` with the score as ``name`` and the decision as ``predicted``.

    A column of either name that was there before is replaced. Nothing is shuffled.
    """
    scored = documents.withColumn(name, scorer(model)(F.col(text_column)))
    return scored.withColumn("predicted", (F.col(name) >= threshold).cast("int"))

"""SentencePiece models run by the ``tokenizers`` library: rebuilt from the model's protobuf, checked against the original.

The protobuf gives the pieces with their scores and kinds, the normaliser and the flags. From them follow a ``tokenizers`` model
(unigram scores, or the merges that a BPE model's scores imply), byte fallback, the marker that stands for a space, and the decoder.
Each Spark task builds it once, encodes Arrow batches on several threads, and compares every text with SentencePiece.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from sentencepiece import sentencepiece_model_pb2

from landledger.llm.common import as_bytes, tidy

MARKER = "▁"
# Kinds in the protobuf (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Kinds of result columns.
SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string, round_trip boolean, checked boolean, differed boolean"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, checked boolean, differed boolean"


def parse(serialized: bytes) -> sentencepiece_model_pb2.ModelProto:
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(serialized)
    return proto


def merges(proto) -> list[tuple[str, str]]:
    """The merges of a BPE model: every split of a piece into two pieces, best score first."""
    ids = {p.piece: i for i, p in enumerate(proto.pieces)}
    usable = {p.piece for p in proto.pieces if p.type in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for i, p in enumerate(proto.pieces):
        if p.piece in usable:
            for cut in range(1, len(p.piece)):
                left, right = p.piece[:cut], p.piece[cut:]
                if left in usable and right in usable:
                    found.append((-p.score, i, ids[left], ids[right], left, right))
    return [pair[4:] for pair in sorted(found)]


def rebuild(proto) -> tokenizers.Tokenizer:
    """The same model for the ``tokenizers`` library.

    A normaliser with a precompiled table is carried over as it is. Models that mark spaces at the end of words, and
    user-defined pieces (which match before all else), have no counterpart here and are refused.
    """
    if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == USER_DEFINED for p in proto.pieces):
        raise ValueError("models with a space suffix or user-defined pieces are not supported")
    unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
    fallback = proto.trainer_spec.byte_fallback
    if proto.trainer_spec.model_type == UNIGRAM:
        model = tokenizers.models.Unigram([(p.piece, p.score) for p in proto.pieces], unknown, fallback)
    elif proto.trainer_spec.model_type == BPE:
        vocabulary = {p.piece: i for i, p in enumerate(proto.pieces)}
        model = tokenizers.models.BPE(
            vocabulary, merges(proto), unk_token=proto.pieces[unknown].piece, fuse_unk=True, byte_fallback=fallback,
        )
    else:
        raise ValueError("only unigram and BPE models are supported")
    tokenizer = tokenizers.Tokenizer(model)
    steps = []
    if proto.normalizer_spec.precompiled_charsmap:
        steps.append(tokenizers.normalizers.Precompiled(proto.normalizer_spec.precompiled_charsmap))
    if proto.normalizer_spec.remove_extra_whitespaces:
        steps += [tokenizers.normalizers.Replace(tokenizers.Regex("^ +| +$"), ""), tokenizers.normalizers.Replace(tokenizers.Regex(" {2,}"), " ")]
    if proto.normalizer_spec.add_dummy_prefix:
        steps.append(tokenizers.normalizers.Prepend(" "))
    steps.append(tokenizers.normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = tokenizers.normalizers.Sequence(steps)
    undo = [tokenizers.decoders.ByteFallback(), tokenizers.decoders.Fuse()]
    # If the marker is a piece, no text is encoded as the bytes that spell it, so one replacement in the joined text will do. Else
    # those bytes must not become a space, and each token is replaced by itself.
    undo.insert(2 if any(p.piece == MARKER and p.type == NORMAL for p in proto.pieces) else 0, tokenizers.decoders.Replace(MARKER, " "))
    if proto.normalizer_spec.add_dummy_prefix:
        undo.append(tokenizers.decoders.Strip(" ", 1, 0))
    tokenizer.decoder = tokenizers.decoders.Sequence(undo)
    # Names of control pieces inside a text are ordinary text.
    tokenizer.encode_special_tokens = True
    return tokenizer


def backends(serialized: bytes, threads: int) -> tuple[tokenizers.Tokenizer, sentencepiece.SentencePieceProcessor]:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    return rebuild(parse(serialized)), sentencepiece.SentencePieceProcessor(model_proto=serialized)


def encode(texts: list[str], tokenizer: tokenizers.Tokenizer) -> list[list[int]]:
    return [encoding.ids for encoding in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def decode(ids: list[list[int]], tokenizer: tokenizers.Tokenizer) -> list[str]:
    return tokenizer.decode_batch(ids, skip_special_tokens=False)


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def compared(
    texts: list[str], compare: set[str], tokenizer: tokenizers.Tokenizer, original: sentencepiece.SentencePieceProcessor, threads: int,
) -> list[tuple[bytes, str, bool]]:
    """(ids, decoded, differed) of each text; SentencePiece's own ids and text where it differs on one that ``compare`` names."""
    coded = encode(texts, tokenizer)
    back = decode(coded, tokenizer)
    rows = [n for n, text in enumerate(texts) if text in compare]
    differed = set()
    for n, ids in zip(rows, original.encode([texts[n] for n in rows], num_threads=threads)):
        if ids != coded[n]:
            differed.add(n)
            coded[n], back[n] = ids, original.decode(ids)
    return [(packed(ids), text, n in differed) for n, (ids, text) in enumerate(zip(coded, back))]


def round_trip(
    documents: DataFrame, serialized: bytes, id_column: str = "doc_id", text_column: str = "text",
    threads: int = 2, check_every: int = 1, group: int = 256, digests: bool = False, carry: list[str] | None = None,
) -> DataFrame:
    """Every text encoded and decoded again: one row per row of ``documents``, with no shuffle.

    ``ids``: the token ids as little-endian 32-bit integers. ``round_trip``: whether decoding gave the text back.
    Every text is compared with SentencePiece (``checked``), or with ``check_every``, that of one row of so many. Where the rebuilt
    model differs, the row has SentencePiece's ids and ``differed`` is true, so no wrong ids go out. Equal texts of a group are
    encoded once. Null counts as the empty text, which has no tokens. A very long text is encoded whole, in one call.
    ``digests`` gives SHA-256 of the ids and of the decoded text in place of both. The columns of ``carry`` come last, as they are.
    """
    carry = carry or []

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, original = backends(serialized, threads)
        for whole in batches:
            for start in range(0, whole.num_rows, group):
                batch = whole.slice(start, group)
                texts = [value.decode() for value in as_bytes(batch.column(1))]
                checked = [row % check_every == 0 for row in range(len(texts))]
                compare = {text for text, check in zip(texts, checked) if check}
                different = list(dict.fromkeys(texts))
                coded = dict(zip(different, compared(different, compare, tokenizer, original, threads)))
                own = [batch.column(0), pa.array([len(coded[text][0]) // 4 for text in texts], pa.int64())]
                if digests:
                    sums = {text: (hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest()) for text, (ids, back, _) in coded.items()}
                    own += [pa.array([sums[text][0] for text in texts]), pa.array([sums[text][1] for text in texts])]
                else:
                    own += [pa.array([coded[text][0] for text in texts], pa.binary()), pa.array([coded[text][1] for text in texts], pa.string())]
                own += [pa.array([coded[text][1] == text for text in texts]), pa.array(checked), pa.array([coded[text][2] for text in texts])]
                names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")), "round_trip", "checked", "differed"]
                yield pa.RecordBatch.from_arrays([*own, *batch.columns[2:]], names=[*names, *carry])

    rows = documents.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{text_column}` as string) as text", *(f"`{c}`" for c in carry))
    kinds = "".join(f", `{c}` {documents.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(run, (DIGESTS if digests else SCHEMA) + kinds)


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, read by Spark so that any store will do."""
    return bytes(spark.read.format("binaryFile").load(path).head().content)

"""Registered queries of the operators, each over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.llm import (
    divergence,
    filter_audit,
    jaccard_join,
    licenses,
    mixing,
    pieces,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    token_counts,
    topk,
    warc,
)
from landledger.llm.common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Public vocabularies; both functions of a query that need another place can be called with it.
TOKENIZERS = "/opt/tokenizers"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = textwrap.dedent(sql).strip()
        return build

    return register


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def held_out(column: str = "doc_id") -> Column:
    """Rows that teach nothing: crc32 of the id's text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query()
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality_classifier.fit(documents, labels.where(~held_out()))
    scored = quality_classifier.classify(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query()
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(table(spark, folder, "documents"), file_bytes(PIECES), digests=True)


@query()
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("matches").alias("n_matches"),
        F.expr("transform(matches, m -> m.license)").alias("licenses"), F.expr("transform(matches, m -> m.coverage)").alias("coverages"),
        F.expr("transform(matches, m -> m.start)").alias("starts"), F.expr("transform(matches, m -> m.end)").alias("ends"),
    )


@query("""
    with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
        where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    c as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
        from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0)
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
    from c qualify rank <= 10
""")
def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    hist = token_counts.histogram(table(spark, folder, "documents"), file_bytes(RANKS), public_tokenizers.PATTERN)
    return token_counts.suffix_sums(hist)


@query(quality_rules.ORACLE)
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(jaccard_join.ORACLE)
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


@query(mixing.ORACLE)
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.interleaved(documents).drop("text")


@query(suffix_dedup.ORACLE)
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query("""
    with p as (select page_id, coalesce(html, '') as html from pages),
    f as (select html, min(page_id) as first from p where octet_length(encode(html)) >= 100 group by html)
    select p.page_id, cast(octet_length(encode(p.html)) as bigint) as payload_bytes, sha256(p.html) as payload_digest,
           case when p.page_id > f.first then 'revisit' else 'response' end as record_type,
           case when p.page_id > f.first then f.first end as refers_to
    from p left join f using (html)
""")
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    written = warc.write(table(spark, folder, "pages"), scratch_path(spark, "warc"))
    records = warc.read(written, payloads=False).where("reason is null")
    return records.select(
        warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )


@query(filter_audit.ORACLE)
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(divergence.ORACLE)
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


@query(sharding.ORACLE)
def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))

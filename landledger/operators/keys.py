"""Crosswalk keys: stable sequences per region, and the ids built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.operators.ordering import number_rows
from landledger.operators.quality import pk_violations
from landledger.session import materialize

CROSSWALK = "region string, native_ref string, seq bigint"


def empty_crosswalk(spark) -> DataFrame:
    return spark.createDataFrame([], CROSSWALK)


def native_refs(df: DataFrame, region: Column | str, ref: Column | str) -> DataFrame:
    """Distinct (region, native_ref) pairs of a feed, nulls left out."""
    region = F.col(region) if isinstance(region, str) else region
    ref = F.col(ref) if isinstance(ref, str) else ref
    return (
        df.select(region.cast("string").alias("region"), ref.cast("string").alias("native_ref"))
        .dropna()
        .distinct()
    )


def unminted(refs: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return refs.join(crosswalk, ["region", "native_ref"], "left_anti")


def mint(crosswalk: DataFrame, refs: DataFrame) -> DataFrame:
    """The rows to append for refs not in ``crosswalk`` yet.

    New refs of a region are numbered in text order after its highest sequence, so the outcome
    depends neither on arrival order nor on partitioning; minted rows are never changed.
    """
    last = crosswalk.groupBy("region").agg(F.max("seq").alias("start"))
    new = materialize(unminted(refs, crosswalk), "new-refs")
    return number_rows(new, ["region"], ["native_ref"], "seq", start=last)


def extend(crosswalk: DataFrame, refs: DataFrame) -> DataFrame:
    """The crosswalk with the new refs added."""
    return crosswalk.unionByName(mint(crosswalk, refs))


def lookup(df: DataFrame, crosswalk: DataFrame, region: Column, ref: str, out: str) -> DataFrame:
    """Left join of a feed to its sequences; unminted refs get null."""
    right = crosswalk.select(
        F.col("region").alias("_region"), F.col("native_ref").alias("_ref"), F.col("seq").alias(out)
    )
    keyed = df.withColumn("_feed_region", region.cast("string"))
    on = (F.col("_feed_region") == F.col("_region")) & (F.col(ref).cast("string") == F.col("_ref"))
    return keyed.join(right, on, "left").drop("_feed_region", "_region", "_ref")


def crosswalk_violations(crosswalk: DataFrame) -> DataFrame:
    """Breaches of the two uniqueness rules, labelled."""
    by_ref = pk_violations(crosswalk, ["region", "native_ref"]).select(
        F.lit("native_ref").alias("rule"), "region", F.col("native_ref").alias("value"), "n_rows"
    )
    by_seq = pk_violations(crosswalk, ["region", "seq"]).select(
        F.lit("seq").alias("rule"), "region", F.col("seq").cast("string").alias("value"), "n_rows"
    )
    return by_ref.unionByName(by_seq)


def federate(*deployments: DataFrame) -> DataFrame:
    """Union of tables keyed by global ids; namespaces keep the keys apart."""
    first, *rest = deployments
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def municipal_mapping(crosswalk: DataFrame, country: int, municipality: Column | str) -> DataFrame:
    """Native parcel number, verbatim, next to the id minted for it."""
    municipality = F.col(municipality) if isinstance(municipality, str) else municipality
    return crosswalk.select(
        ids.global_id(country, "region", "seq", grows=ids.MINTED).alias("parcel_id"),
        F.col("native_ref").alias("municpal_parcel_id"),
        municipality.alias("municipality_id"),
    )

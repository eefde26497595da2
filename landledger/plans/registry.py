"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``tables.orders`` reads ``<folder>/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            ORACLES[build.__name__] = textwrap.dedent(sql).strip()
        return build

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from landledger.plans import (  # noqa: F401
        address_queries,
        entity_queries,
        geometry_queries,
        history_queries,
        key_queries,
        quality_queries,
        staging_queries,
        text_queries,
        usecase_queries,
    )

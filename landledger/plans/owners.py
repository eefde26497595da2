"""Owners and their addresses from several feeds, deduplicated and keyed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.operators import entities as E
from landledger.operators import keys as K
from landledger.session import materialize

# What every owner feed is cut to.
SOURCE = ("name", "raw_line", "city", "state", "zip")


@dataclass(frozen=True)
class Owners:
    legal_entity: DataFrame
    address: DataFrame
    crosswalk: DataFrame


def _key(*columns: str) -> Column:
    """Normalized text of the columns, nulls as blanks, as one native reference."""
    return F.concat_ws("|", *[F.coalesce(E.normalized(c), F.lit("")) for c in columns])


def build(feeds: Sequence[DataFrame], crosswalk: DataFrame, country: int, region: int) -> Owners:
    """One address per normalized address, one legal entity per normalized (name, address).

    Both are numbered through the crosswalk, under the entity's name as its region, so a re-run gives
    the same ids. The street line kept is verbatim, the first in text order among equal ones.
    """
    stacked = E.union_standard(feeds, SOURCE).withColumn("address_ref", _key("raw_line", "city", "state", "zip"))
    owners = (
        stacked.withColumn("entity_ref", F.concat_ws("|", _key("name"), "address_ref"))
        .groupBy("entity_ref", "address_ref")
        .agg(*[F.min(c).alias(c) for c in SOURCE])
    )
    owners = materialize(owners, "owners")
    addresses = owners.groupBy("address_ref").agg(*[F.min(c).alias(c) for c in SOURCE if c != "name"])
    refs = K.native_refs(owners, F.lit("legal_entity"), "entity_ref").unionByName(
        K.native_refs(owners, F.lit("address"), "address_ref")
    )
    crosswalk = materialize(K.extend(crosswalk, refs), "crosswalk")

    def keyed(df: DataFrame, entity: str, ref: str) -> DataFrame:
        found = K.lookup(df, crosswalk, F.lit(entity), ref, "seq")
        return found.withColumn(f"{entity}_id", ids.namespaced_id(country, region, entity, "seq")).drop("seq")

    address = keyed(addresses, "address", "address_ref")
    entity = keyed(keyed(owners, "legal_entity", "entity_ref"), "address", "address_ref")
    return Owners(
        legal_entity=entity.select("legal_entity_id", "name", "address_id"),
        address=address.select("address_id", "raw_line", "city", "state", "zip"),
        crosswalk=crosswalk,
    )

"""Staged accounts to parcels, buildings, units and owners with global ids.

Order of work: route every account, register the plots of the loaded ones in the crosswalk, route the feeds below them, then
build parcel, building and unit rows. What several steps read is written to the shared folder once.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions import ids
from landledger.operators import entities as E
from landledger.operators import keys as K
from landledger.operators import quality as Q
from landledger.operators.loading import integrity_violations
from landledger.operators.ordering import number_copies, number_rows
from landledger.operators.versions import Store
from landledger.session import materialize, passing, settled


@dataclass(frozen=True)
class Region:
    """The deployment's namespace: country and region codes, and the municipality's name."""

    country: int
    code: int
    municipality: str = ""


@dataclass(frozen=True)
class Feeds:
    """Staged tables. ``accounts`` has handle, the account key and its gis twin, landuse, vacantland."""

    accounts: DataFrame
    buildings: DataFrame
    residential: DataFrame
    sections: DataFrame


@dataclass(frozen=True)
class Spine:
    parcel: DataFrame
    building: DataFrame
    unit: DataFrame
    crosswalk: DataFrame
    mapping: DataFrame
    routed: DataFrame
    secondary_owners: DataFrame
    details: DataFrame
    sections: DataFrame
    residential: DataFrame

    def logs(self) -> DataFrame:
        """Accounts that were not loaded, with route and reason."""
        return self.routed.where("route <> 'loaded'")

    def feeds(self) -> DataFrame:
        """(feed, account key, bldgnum, route, reason) of every row of every feed."""
        frames = [
            ("accounts", self.routed.withColumn("bldgnum", F.lit(None))), ("buildings", self.details),
            ("sections", self.sections), ("residential", self.residential),
        ]
        parts = [
            frame.select(F.lit(name).alias("feed"), *[F.col(c).cast("string").alias(c) for c in (*E.ACCOUNT, "bldgnum")], "route", "reason")
            for name, frame in frames
        ]
        return E.union_standard(parts, parts[0].columns)


# Parcel column <- account column.
PARCEL_SOURCE = {
    "ward": "ward20", "neighborhood": "nbrhd", "zip_code": "zip", "census_block": "censblock20",
    "frontage": "frontage", "zoning_class_id": "zoning",
}


def route_accounts(accounts: DataFrame, not_real_estate: Collection[str]) -> DataFrame:
    """Out-of-scope land uses are excluded, accounts without a plot or account key are rejected."""
    outside = F.col("landuse").isin(*not_real_estate) if not_real_estate else F.lit(False)
    incomplete = F.col("cityblock").isNull() | F.col("parcel").isNull() | F.col("ownercode").isNull()
    return Q.route(
        accounts,
        excluded_if=[("not real estate", outside)],
        rejected_if=[("no handle", F.col("handle").isNull()), ("incomplete account key", incomplete)],
    )


FOOTPRINT = "parcel = gisparcel AND ownercode = gisownercode AND cityblock = giscityblock"


def one_footprint_each(routed: DataFrame) -> DataFrame:
    """Routes again what the plots need: each account key once, and one account per plot that is its footprint.

    Of rows with one account key the first in the order of all columns stays; of several footprints of a plot, the first by
    account key. The others are rejected, and so are all accounts of a plot without a footprint.
    """
    columns = [c for c in routed.columns if c not in ("route", "reason")]
    ties = [c for c in columns if c not in E.ACCOUNT]

    def numbered() -> DataFrame:
        loaded = materialize(number_copies(routed.where("route = 'loaded'"), "_copy"), "loaded-accounts")
        return number_rows(loaded, E.ACCOUNT, [*ties, "_copy"], "_nth")

    nth = settled(numbered, "account-copies")
    marked = nth.withColumn("_foot", F.coalesce(F.expr(FOOTPRINT), F.lit(False)) & (F.col("_nth") == 1))
    main = marked.where("_foot").groupBy("handle").agg(F.min(F.struct(*E.ACCOUNT)).alias("_main")).withColumnRenamed("handle", "_plot")
    placed = marked.join(main, F.col("handle") == F.col("_plot"), "left")
    second = F.col("_foot") & (F.struct(*E.ACCOUNT) != F.col("_main"))
    again = Q.route(placed.drop("route", "reason"), rejected_if=[
        ("repeated account key", F.col("_nth") > 1), ("plot without footprint", F.col("_main").isNull()), ("second footprint of its plot", second),
    ])
    kept = [*columns, "route", "reason"]
    return again.select(*kept).unionByName(routed.where("route <> 'loaded'").select(*kept))


def route_details(detail: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every building row with its route: ``accounts`` has one row per account key with _route, shape and _vacant."""
    number = F.col("bldgnum").try_cast("bigint")
    keyed = materialize(number_copies(detail, "_copy"), "detail-copies")
    ties = [c for c in detail.columns if c not in (*E.ACCOUNT, "bldgnum")]
    nth = number_rows(keyed, [*E.ACCOUNT, "bldgnum"], [*ties, "_copy"], "_nth")
    joined = nth.join(accounts, list(E.ACCOUNT), "left")
    return Q.route(
        joined,
        excluded_if=[
            ("account excluded", F.col("_route") == "excluded"), ("vacant land", F.col("_vacant")),
            ("condo plot, its one building is synthesized", F.col("shape") == "condo"),
        ],
        rejected_if=[
            ("no such account", F.col("_route").isNull()), ("account rejected", F.col("_route") == "rejected"),
            ("plot shared by several accounts", F.col("shape") == "shared"), ("no building number", number.isNull()),
            ("building number out of range", ~number.between(1, ids.MOST_BUILDINGS)),
            ("repeated building number", F.col("_nth") > 1),
        ],
    ).select(*detail.columns, "route", "reason")


def route_parts(part: DataFrame, building: DataFrame) -> DataFrame:
    """Every row of a feed below buildings: loaded where its building is."""
    known = building.where("shape = 'simple'").select(*E.ACCOUNT, F.col("bldgnum").alias("_number")).distinct().withColumn("_known", F.lit(True))
    number = F.col("bldgnum").try_cast("bigint")
    joined = part.withColumn("_number", number).join(known, [*E.ACCOUNT, "_number"], "left")
    return Q.route(joined, rejected_if=[("no such building loaded", F.col("_known").isNull())]).select(*part.columns, "route", "reason")


def build(feeds: Feeds, crosswalk: DataFrame, where: Region, not_real_estate: Collection[str] = (),
          condo: Column | None = None, unit_order: tuple[str, ...] = ("parcel", "ownercode")) -> Spine:
    """Every row of every feed is loaded, excluded or rejected, with a reason; see ``Spine.feeds``.

    Vacant land keeps its parcel and gets no building: a single account by its flag, a condo plot when all its unit accounts
    are vacant; vacant unit accounts of other condo plots get no unit. Plots shared by several accounts without a condo
    flag get a parcel, and their buildings are rejected.
    """
    routed = settled(lambda: one_footprint_each(route_accounts(feeds.accounts, not_real_estate)), "routed-accounts")
    loaded = routed.where("route = 'loaded'").drop("route", "reason")
    shape = materialize(E.shapes(loaded, condo=condo), "shapes")
    region = F.lit(f"{where.code:05d}")
    before = crosswalk
    crosswalk = settled(lambda: K.extend(before, K.native_refs(loaded, region, "handle")), "crosswalk")

    def with_seq(df: DataFrame) -> DataFrame:
        return K.lookup(df, crosswalk, region, "handle", "parcel_seq")

    def gid(building=0, unit=0) -> Column:
        return ids.global_id(where.country, F.lit(where.code), "parcel_seq", building, unit, grows=ids.MINTED)

    present = {target: source for target, source in PARCEL_SOURCE.items() if source in loaded.columns}
    parcel = with_seq(E.parcels(loaded, present)).select(gid().alias("parcel_id"), "handle", *present)

    standing = E.not_vacant(loaded)
    unit_accounts = standing.where(~F.coalesce(F.expr(FOOTPRINT), F.lit(False)))
    used = standing.join(shape.where("shape <> 'condo'"), "handle", "left_semi").select("handle").unionByName(
        unit_accounts.join(shape.where("shape = 'condo'"), "handle", "left_semi").select("handle")
    ).distinct()
    built_shape = materialize(shape.join(used, "handle", "left_semi"), "built-shapes")
    kept = F.col("route") == "loaded"
    flagged = routed.join(shape, "handle", "left").groupBy(*E.ACCOUNT).agg(
        F.min_by(F.struct(F.col("route").alias("_route"), F.when(kept, F.col("shape")).alias("shape"), F.when(kept, F.col("vacantland") == "Y").alias("_vacant")),
                 F.array_position(F.array(F.lit("loaded"), F.lit("rejected"), F.lit("excluded")), F.col("route"))).alias("_account"),
    ).select(*E.ACCOUNT, "_account.*")
    details = settled(lambda: route_details(feeds.buildings, flagged), "routed-details")
    used_details = details.where("route = 'loaded'").drop("route", "reason").withColumn("bldgnum", F.col("bldgnum").try_cast("bigint"))
    built = materialize(E.buildings(standing, built_shape, used_details), "buildings")
    building = with_seq(built).select(
        gid("bldgnum").alias("building_id"), gid().alias("parcel_id"), "handle", "bldgnum", "shape",
        *[c for c in feeds.buildings.columns if c not in (*E.ACCOUNT, "bldgnum")],
    )
    sections = materialize(route_parts(feeds.sections, built), "routed-sections")
    residential = materialize(route_parts(feeds.residential, built), "routed-residential")

    def loaded_of(routed_part: DataFrame) -> DataFrame:
        return routed_part.where("route = 'loaded'").drop("route", "reason")

    def units() -> DataFrame:
        simple = E.simple_units(built, loaded_of(sections), loaded_of(residential)).select("handle", "bldgnum", "unit_seq")
        condos = E.condo_units(standing, built_shape, unit_order).select("handle", "bldgnum", "unit_seq")
        return with_seq(simple.unionByName(condos)).select(
            gid("bldgnum", "unit_seq").alias("unit_id"), gid("bldgnum").alias("building_id"), "handle"
        )

    return Spine(
        parcel=materialize(parcel, "parcel"), building=materialize(building, "building"), unit=settled(units, "unit"), crosswalk=crosswalk,
        mapping=K.municipal_mapping(crosswalk, where.country, F.lit(f"{where.code:05d}")),
        routed=routed, secondary_owners=E.secondary_owners(loaded, shape, ["ownercode"]),
        details=details, sections=sections, residential=residential,
    )


def checks(spine: Spine) -> dict[str, DataFrame]:
    """Violations by check; all must be empty before the tables are published. ``keys`` holds those of all keys, with their rule."""
    tables = {"parcel": spine.parcel, "building": spine.building, "unit": spine.unit}
    links = [("building", "parcel_id", "parcel"), ("unit", "building_id", "building")]
    return {
        "keys": integrity_violations(tables, {t: f"{t}_id" for t in tables}, links),
        "building without unit": E.buildings_without_units(spine.building, spine.unit, ["building_id"]),
        "crosswalk": K.crosswalk_violations(spine.crosswalk),
    }


def violations(spine: Spine) -> DataFrame:
    """(rule, n): the rules that are broken, with the number of their violations."""
    found = checks(spine)
    parts = [bad.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, bad in found.items() if rule != "keys"]
    parts.append(found["keys"].groupBy("rule").agg(F.count(F.lit(1)).alias("n")))
    return E.union_standard(parts, ["rule", "n"]).where("n > 0")


def publish(spine: Spine, store: Store) -> int:
    """Publish the spine's tables as one version once every check is clean; returns its number.

    New rows of the crosswalk are appended first. A run that ends half way leaves the version before it in place, and ids that
    the next run finds in ``store.crosswalk()``, so no id moves. A crosswalk that grew since the build is a ``Conflict``: build again.
    """
    with passing():
        broken = {row["rule"]: row["n"] for row in materialize(violations(spine), "violations").collect()}
    if broken:
        raise ValueError(f"not published: {broken}")
    store.append(spine.crosswalk)
    return store.publish({
        "parcel": spine.parcel, "building": spine.building, "unit": spine.unit, "municipal_parcel_id_mapping": spine.mapping,
        "exclusion_log": spine.feeds().where("route <> 'loaded'"), "secondary_owner_log": spine.secondary_owners,
    })

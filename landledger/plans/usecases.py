"""Questions the warehouse is for: vacancy, timelines, blight, demolition, exploration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.operators.entities import money
from landledger.operators.ordering import number_rows


def vacancy_list(parcels: DataFrame, vacant: Column, columns: Sequence[str]) -> DataFrame:
    return parcels.where(vacant).select(*columns)


def vacancy_by_neighborhood(parcels: DataFrame, vacant: Column, neighborhood: str) -> DataFrame:
    flag = F.coalesce(vacant, F.lit(False))
    return parcels.groupBy(neighborhood).agg(
        F.count(F.lit(1)).alias("n_parcels"), F.count_if(flag).alias("n_vacant")
    ).withColumn("vacancy_rate", F.round(F.col("n_vacant") / F.col("n_parcels"), 6))


def timeline(events: Mapping[str, DataFrame], property_id: str = "property_id") -> DataFrame:
    """All events of every property in date order: (property_id, seq, event_date, kind, ref, detail).

    One row per event, numbered; a property's events are not gathered into one cell, so a property
    with a very long history is as good as any other.
    """
    parts = [frame.select(property_id, "event_date", F.lit(kind).alias("kind"), "ref", "detail") for kind, frame in events.items()]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return number_rows(first, [property_id], ["event_date", "kind", "ref"], "seq")


def blight_gap(parcels: DataFrame, features: Sequence[str], value: str, active: Column, neighborhood: str) -> DataFrame:
    """Value lost to vacancy: a model of active parcels values all others as if they were active.

    Per neighborhood: inactive parcels, their assessed and their modelled value, and the gap. Rows
    with a missing feature or value cannot be modelled; they are counted in ``n_skipped``.
    """
    usable, intercept, weights = fitted(parcels, features, value, active)
    modelled = F.lit(intercept)
    for name, weight in weights.items():
        modelled = modelled + F.col(name) * weight
    idle = usable.where("not _active")
    return idle.groupBy(neighborhood).agg(
        F.count(F.lit(1)).alias("n_inactive"), F.count_if(~F.col("_usable")).alias("n_skipped"),
        F.sum(F.when(F.col("_usable"), money(value))).cast("double").alias("assessed"),
        F.round(F.sum(F.when(F.col("_usable"), modelled)), 1).alias("modelled"),
    ).withColumn("gap", F.round(F.col("modelled") - F.col("assessed"), 1))


def residual_sums(parcels: DataFrame, features: Sequence[str], value: str, active: Column) -> DataFrame:
    """(feature, share): the sum of residual times feature over the active parcels, as a share of value times feature.

    Least squares leaves none: every share is 0, that of the intercept included.
    """
    usable, intercept, weights = fitted(parcels, features, value, active)
    left = F.col(value) - F.lit(intercept)
    for name, weight in weights.items():
        left = left - F.col(name) * weight
    train = usable.where("_usable and _active")
    terms = {"(intercept)": F.lit(1.0), **{name: F.col(name).cast("double") for name in features}}
    sums = train.agg(F.array(*[
        F.struct(F.lit(name).alias("feature"), (F.sum(left * term) / F.sum(F.col(value) * term)).alias("share")) for name, term in terms.items()
    ]).alias("sums"))
    return sums.select(F.inline("sums"))


def fitted(parcels: DataFrame, features: Sequence[str], value: str, active: Column) -> tuple[DataFrame, float, dict[str, float]]:
    """The parcels with _active and _usable, and the intercept and weights of a linear model of the usable active ones."""
    flagged = parcels.withColumn("_active", F.coalesce(active, F.lit(False)))
    complete = F.lit(True)
    for column in (*features, value):
        complete = complete & F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    usable = flagged.withColumn("_usable", complete)
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    train = assembler.transform(usable.where("_usable and _active").select(*features, F.col(value).cast("double").alias("_label")))
    model = LinearRegression(featuresCol="_features", labelCol="_label", solver="normal").fit(train)
    return usable, float(model.intercept), {name: float(weight) for name, weight in zip(features, model.coefficients.toArray())}


def demolition_effect(values: DataFrame, demolitions: DataFrame, levels: DataFrame, area: str = "area") -> DataFrame:
    """Difference in differences per blight level.

    ``values`` (area, at, value) are compared before and after an area's first demolition; areas
    without one are the controls and are cut at their level's first demolition. ``levels`` has one
    row per area.
    """
    first = demolitions.groupBy(area).agg(F.min("at").alias("_own"))
    treated = levels.join(first, area, "left")
    opening = treated.groupBy("level").agg(F.min("_own").alias("_level"))
    cut = treated.join(opening, "level").select(
        area, "level", F.col("_own").isNotNull().alias("_treated"), F.coalesce("_own", "_level").alias("_cut")
    )

    def mean(is_treated: bool, after: bool) -> Column:
        chosen = (F.col("_treated") == is_treated) & ((F.col("at") >= F.col("_cut")) == after)
        total = F.sum(F.when(chosen, money("value"))).cast("double")
        return F.round(total / F.count_if(chosen), 6)

    means = values.join(cut, area).where("_cut is not null").groupBy("level").agg(
        mean(True, False).alias("treated_before"), mean(True, True).alias("treated_after"),
        mean(False, False).alias("control_before"), mean(False, True).alias("control_after"),
    )
    change = (F.col("treated_after") - F.col("treated_before")) - (F.col("control_after") - F.col("control_before"))
    return means.withColumn("effect", F.round(change, 5))


def explorer(parcels: DataFrame, owners: DataFrame, owner_key: str, held_by: Column, columns: Sequence[str]) -> DataFrame:
    """Properties of the selected owners, with owner columns."""
    return parcels.join(owners.where(held_by), owner_key).select(*columns)


def dashboard(facts: DataFrame, dimensions: Sequence[str], value: str) -> DataFrame:
    """Rollup of count and value; ``depth`` is the number of dimensions a row is grouped by."""
    level = F.lit(len(dimensions)) - F.bit_count(F.grouping_id())
    return facts.rollup(*dimensions).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money(value)).cast("double").alias("total"), level.cast("int").alias("depth")
    )

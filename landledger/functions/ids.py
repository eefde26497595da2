"""Hierarchical ids ``country.region.parcel.building.unit`` and legacy parcel numbers."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment names and widths, top down.
SEGMENTS = (("country", 3), ("region", 5), ("parcel", 6), ("building", 4), ("unit", 5))
# Building 0 stands for the parcel itself.
MOST_BUILDINGS = 9999
# Parcels are minted without an upper bound: a region has as many as it registers, a million or more included.
MINTED = ("parcel",)


def _text(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _zero_filled(value: Column | str | int, name: str, width: int, grows: bool = False) -> Column:
    """Digits filled to ``width``. A wider number raises, since padding alone would cut it silently; with ``grows`` it stays whole.

    A building or unit that is null has none and reads 0; any other missing or unreadable number raises.
    """
    number = F.lit(value) if isinstance(value, int) else _text(value)
    read = number.try_cast("bigint")
    number = read if name not in ("building", "unit") else F.when(number.isNotNull(), read).otherwise(F.lit(0))
    message = F.concat(F.lit(f"{name} does not fit {width} digits: "), F.coalesce(number.cast("string"), F.lit("none")))
    digits, fits = number.cast("string"), number >= 0 if grows else number.between(0, 10**width - 1)
    return F.when(
        fits, F.lpad(digits, F.greatest(F.length(digits), F.lit(width)) if grows else width, "0")
    ).otherwise(F.raise_error(message).cast("string"))


def global_id(country, region, parcel, building=0, unit=0, grows: Collection[str] = ()) -> Column:
    """Zero-filled text id; a segment wider than its slot raises, since cutting it would merge parcels.

    Segments named in ``grows`` stay whole instead: points part the segments, so ids differ and read back all the same.
    """
    values = (country, region, parcel, building, unit)
    return F.concat_ws(".", *[_zero_filled(value, name, width, name in grows) for value, (name, width) in zip(values, SEGMENTS)])


def parse_global_id(value: Column | str) -> Column:
    """Struct of the five segments as numbers."""
    parts = F.split(_text(value), "[.]")
    return F.struct(*(F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint").alias(name)
                      for i, (name, _) in enumerate(SEGMENTS)))


def parcel_of(value: Column | str) -> Column:
    """Id of the parcel a building or unit belongs to."""
    return F.concat(F.substring_index(_text(value), ".", 3), F.lit(".0000.00000"))


def building_of(value: Column | str) -> Column:
    return F.concat(F.substring_index(_text(value), ".", 4), F.lit(".00000"))


def parent_id(value: Column | str) -> Column:
    """Unit to building, building to parcel, parcel to null."""
    value = _text(value)
    return F.when(~value.endswith(".00000"), building_of(value)).when(
        ~value.endswith(".0000.00000"), parcel_of(value)
    )


def in_region(value: Column | str, country: int, region: int) -> Column:
    """Prefix test; reaches the parquet scan as a StartsWith filter."""
    return _text(value).startswith(f"{country:03d}.{region:05d}.")


def namespaced_id(country: int, region: int, entity: str, seq: Column | str) -> Column:
    return F.concat(F.lit(f"{country:03d}.{region:05d}.{entity}."), _text(seq).cast("string"))


def _block(value: Column | str) -> Column:
    """City block ``#.##`` as six digits, the decimal point dropped; null if it is no number."""
    hundredths = F.round(_text(value).try_cast("decimal(10,2)") * 100)
    return F.when(hundredths.isNotNull(), _zero_filled(hundredths, "city block", 6))


def parcel9(block: Column | str, parcel: Column | str) -> Column:
    return F.concat(_block(block), _at_least(parcel, 3))


def parcel11(block: Column | str, parcel: Column | str, owner: Column | str) -> Column:
    return F.concat(parcel9(block, parcel), _text(owner).cast("string"))


def handle(block: Column | str, condo: Column, parcel: Column | str, owner: Column | str) -> Column:
    """Block without its point, ``8`` for condominiums or ``0``, four-digit parcel, owner code."""
    return F.concat(_block(block), F.when(condo, F.lit("8")).otherwise(F.lit("0")), _at_least(parcel, 4),
                    _text(owner).cast("string"))


def _at_least(value: Column | str, width: int) -> Column:
    """Digits zero-filled to ``width``; longer ones stay whole, and what is no number is null."""
    digits = _text(value).try_cast("bigint").cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def is_condo_placeholder(parcel: Column | str) -> Column:
    """Parcel numbers of four or more digits mark condo buildings."""
    return F.length(_text(parcel).cast("string")) >= 4

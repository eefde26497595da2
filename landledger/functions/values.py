"""Typed values out of text, and small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "no value" in landed text.
NULL_TOKENS = ("", "null", "NULL")

# Accepted date spellings besides ISO, by shape.
DATE_FORMATS = (
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2}$", "M/d/yyyy H:mm:ss"),
    ("^[0-9]{2}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "MM/dd/yy HH:mm:ss"),
    ("^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "yyyy/MM/dd"),
)

_ISO = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"
_INTEGER = "^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_TRUE = ("true", "yes", "y", "1", "t")
_FALSE = ("false", "no", "n", "0", "f")


def _text(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def value_or_null(value: Column | str) -> Column:
    """Null tokens to null; everything else verbatim."""
    value = _text(value)
    return F.when(~value.isin(*NULL_TOKENS), value)


def plain_number(value: Column | str) -> Column:
    """Thousands commas and outer blanks removed."""
    return F.trim(F.translate(_text(value), ",", ""))


def is_boolean(value: Column | str) -> Column:
    return F.lower(F.trim(_text(value))).isin("true", "false", "yes", "no")


def is_integer(value: Column | str) -> Column:
    return plain_number(value).rlike(_INTEGER)


def to_integer(value: Column | str, type_name: str = "bigint") -> Column:
    """Comma-tolerant integer, else null. Only well-formed text is cast: a failing cast is costly."""
    number = plain_number(value)
    return F.when(number.rlike(_INTEGER), number.try_cast(type_name))


def is_float(value: Column | str) -> Column:
    return plain_number(value).rlike(f"{_NUMBER}|(?i)^[+-]?(nan|inf|infinity)$")


def to_number(value: Column | str) -> Column:
    """Comma-tolerant double; anything else is null. Java's ``1d`` spellings are not numbers here."""
    number = plain_number(value)
    return F.when(number.rlike(_NUMBER), number.try_cast("double"))


def to_moment(value: Column | str) -> Column:
    """Timestamp without time zone, else null. The shape of the text picks the one format to parse."""
    value = F.trim(_text(value))
    moment = F.when(value.rlike(_ISO), value.try_cast("timestamp_ntz"))
    for shape, pattern in DATE_FORMATS:
        moment = moment.when(value.rlike(shape), F.try_to_timestamp(value, F.lit(pattern)).cast("timestamp_ntz"))
    return moment


def has_time(moment: Column | str) -> Column:
    """Whether a moment says a time other than midnight; false when it is null."""
    moment = _text(moment)
    return F.coalesce(moment != moment.cast("date").cast("timestamp_ntz"), F.lit(False))


def is_date(value: Column | str) -> Column:
    return to_moment(value).isNotNull()


def is_timestamp(value: Column | str) -> Column:
    """A date that also says a time other than midnight."""
    return has_time(to_moment(value))


def to_boolean(value: Column | str) -> Column:
    word = F.lower(F.trim(_text(value)))
    return F.when(word.isin(*_TRUE), True).when(word.isin(*_FALSE), False)


def cast_text(value: Column | str, type_name: str) -> Column:
    """Text to ``type_name``; null when the text does not fit."""
    value = _text(value)
    if type_name == "string":
        return value
    if type_name == "boolean":
        return to_boolean(value)
    if type_name == "double":
        return to_number(value)
    if type_name == "timestamp":
        return to_moment(value)
    if type_name == "date":
        return to_moment(value).cast("date")
    if type_name in ("int", "bigint"):
        return to_integer(value, type_name)
    return plain_number(value).try_cast(type_name)


def digest(value: Column | str) -> Column:
    return F.sha2(_text(value), 256)


def json_total(value: Column | str) -> Column:
    """Sum of the values of a flat JSON object."""
    pairs = F.from_json(_text(value), "map<string,double>")
    return F.aggregate(F.map_values(pairs), F.lit(0.0), lambda total, item: total + item)


# What each day is for.
DAY_ACTIVITY = {
    "monday": (True, "guitar lessons"),
    "tuesday": (True, "studying"),
    "wednesday": (True, "soccer practice"),
    "thursday": (True, "contributing to Airflow"),
    "friday": (True, "family dinner"),
    "saturday": (False, "going to the beach"),
    "sunday": (False, "sleeping in"),
}


def day_type(day: Column | str) -> Column:
    """Struct ``(is_weekday, activity)`` for a date."""
    name = F.lower(F.date_format(_text(day), "EEEE"))
    table = F.create_map(
        *(
            part
            for key, (weekday, activity) in DAY_ACTIVITY.items()
            for part in (F.lit(key), F.struct(F.lit(weekday).alias("is_weekday"), F.lit(activity).alias("activity")))
        )
    )
    return table[name]

"""Names: identifiers, file and table names, percent encoding."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain, count

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: longest identifier the target database keeps.
MAX_NAME = 63

# Reserved words that get a trailing underscore.
RESERVED = """
all analyse analyze and any array as asc asymmetric authorization binary both case cast check
collate collation column concurrently constraint create cross current_catalog current_date
current_role current_time current_timestamp current_user default deferrable desc distinct do else
end except false fetch for foreign freeze from full grant group having ilike in initially inner
intersect into is isnull join lateral leading left like limit localtime localtimestamp natural not
notnull null offset on only or order outer overlaps placing primary references returning right
select session_user similar some symmetric table then to trailing true union unique user using
variadic verbose when where window with
""".split()

SAFE_NAME = "^[A-Za-z0-9_]+$"

_DROP_UNSAFE = ("[^a-z0-9_]", "")
_LEADING_DIGIT = ("^(?=[0-9])", "_")
_RESERVED_WORD = "^(" + "|".join(RESERVED) + ")$"

# One rule table for both the column expression and header lists, so they cannot drift apart.
_COLUMN_RULES = [_DROP_UNSAFE, ("^$", "column"), _LEADING_DIGIT]
_TABLE_RULES = [("[.]csv$", ""), ("-", "_"), _DROP_UNSAFE, ("^$", "table"), _LEADING_DIGIT]


def _text(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _rewrite(value: Column, rules: Iterable[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        value = F.regexp_replace(value, pattern, replacement)
    return value


def clean_name(value: Column | str) -> Column:
    """Any header text to a legal column name; a null or blank one becomes ``column_``."""
    lowered = F.translate(F.lower(F.coalesce(_text(value), F.lit(""))), " ", "_")
    name = _rewrite(lowered, _COLUMN_RULES)
    return F.substring(F.regexp_replace(name, _RESERVED_WORD, "$1_"), 1, MAX_NAME)


def clean_header(text: str | None) -> str:
    """``clean_name`` for one header on the driver (headers are metadata, not data)."""
    name = (text or "").lower().replace(" ", "_")
    for pattern, replacement in _COLUMN_RULES:
        name = re.sub(pattern, replacement, name)
    return re.sub(_RESERVED_WORD, r"\1_", name)[:MAX_NAME]


def clean_headers(headers: Iterable[str | None]) -> list[str]:
    """Clean a header list in order; later duplicates get ``_1``, ``_2``... within the length limit."""
    names: dict[str, None] = {}
    for header in headers:
        base = clean_header(header)
        tags = (f"_{i}" for i in count(1))
        options = chain([base], (base[: MAX_NAME - len(tag)] + tag for tag in tags))
        names[next(option for option in options if option not in names)] = None
    return list(names)


def clean_table(path: Column | str) -> Column:
    """File path to table name. Distinct paths may collide: see ``landing.table_collisions``."""
    return F.substring(_rewrite(F.lower(last_segment(path)), _TABLE_RULES), 1, MAX_NAME)


def safe_identifier(value: Column | str) -> Column:
    """The parcel loader's naming: non-word characters to ``_``, Unicode letters kept."""
    return F.lower(F.regexp_replace(_text(value), r"(?U)\W|^(?=\d)", "_"))


def require_safe(names: Iterable[str]) -> list[str]:
    """Raise unless every name is plain ASCII word characters."""
    names = list(names)
    unsafe = [name for name in names if not re.fullmatch(SAFE_NAME, name)]
    if unsafe:
        raise ValueError(f"unsafe names: {unsafe}")
    return names


def last_segment(path: Column | str) -> Column:
    return F.substring_index(_text(path), "/", -1)


def stem(path: Column | str) -> Column:
    """Last path segment without its final extension; a leading dot is not an extension."""
    return F.regexp_replace(last_segment(path), r"(?<=.)(?<!^\.)\.[^.]*$", "")


def swap_extension(path: Column | str, extension: str) -> Column:
    return F.concat(stem(path), F.lit(extension))


def ellipsize(value: Column | str, width: int = 80) -> Column:
    value = F.coalesce(_text(value), F.lit(""))
    return F.when(F.length(value) > width, F.concat(F.substring(value, 1, width - 1), F.lit("…"))).otherwise(value)


def alnum_only(value: Column | str, width: int = 99) -> Column:
    return F.substring(F.regexp_replace(_text(value), r"(?U)[^\p{Alnum}]", ""), 1, width)


# Where form encoding differs from percent encoding that keeps "/".
_FORM_TO_PERCENT = [("[+]", "%20"), ("[*]", "%2A"), ("%7E", "~"), ("%2F", "/")]


def percent_encode(value: Column | str) -> Column:
    return _rewrite(F.url_encode(_text(value)), _FORM_TO_PERCENT)

"""Scalar helpers: parsing of text settings and whitelisted expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)|([A-Za-z_][A-Za-z0-9_.]*)|([-+*/()]))")


def parse_any_timestamp(text: Column, formats: tuple[str, ...] = ("yyyyMMdd", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMddHH", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd_HH:mm")) -> Column:
    """First of the formats that reads the text; null where none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parse_bool(text: Column) -> Column:
    """Accepted spellings of true; anything else is false."""
    return F.coalesce(F.lower(F.trim(text)).isin("true", "t", "yes", "y", "1", "on"), F.lit(False))


def parse_list(text: Column, kind: str = "double") -> Column:
    """Comma-separated list as an array; items that don't cast are null."""
    return F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast(kind))


def arithmetic(expression: str, names: list[str]) -> Column:
    """SPC-01. Column of an arithmetic expression over the given names: numbers, names, + - * / ( ).

    The text is cut into tokens and anything else is refused, so no other SQL can be written in it.
    """
    at, parts = 0, []
    while at < len(expression.rstrip()):
        found = _TOKEN.match(expression, at)
        if not found:
            raise ValueError(f"not an arithmetic expression: {expression!r}")
        number, name, sign = found.groups()
        if name is not None and name not in names:
            raise ValueError(f"unknown name {name!r} in {expression!r}")
        parts.append(f"{number}D" if number else f"`{name}`" if name else sign)
        at = found.end()
    if not parts:
        raise ValueError("an empty expression")
    return F.expr(" ".join(parts)).cast("double")


def names_in(expression: Column) -> Column:
    """CHK-16. Names that stand in an expression, as whole words."""
    return F.array_distinct(F.regexp_extract_all(expression, F.lit(r"([A-Za-z_][A-Za-z0-9_.]*)"), 1))

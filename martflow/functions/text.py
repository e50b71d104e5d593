"""Splitting and extracting text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part_at(c: Column | str, separator: str, index: int) -> Column:
    """The ``index``-th part of a separated key, NULL where there is no such part."""
    return F.get(F.split(c, _literal(separator)), index)


# Fixed value: a run of four digits that stands alone.
YEAR = r"\b(\d{4})\b"


def four_digit_year(c: Column | str, empty_as_null: bool = False) -> Column:
    """First stand-alone run of exactly four digits; '' (or NULL) when there is none."""
    year = F.regexp_extract(c, YEAR, 1)
    return F.nullif(year, F.lit("")) if empty_as_null else year


def fields(line: Column | str, separator: str = ",") -> Column:
    """Split a line the way text tools do: trailing empty fields do not count."""
    sep = _literal(separator)
    return F.split(F.regexp_replace(line, f"(?:{sep})+$", ""), sep)


def _literal(separator: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch not in "_, " else ch for ch in separator)

"""Whole rows compared by fingerprint: copies are found without moving the rows.

A row's fingerprint is 128 bits of its values and of which of them are missing. Fingerprints are
counted; only rows whose fingerprint comes more than once are compared in full, so the result is exact
whatever the hash does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.session import materialize

FINGERPRINT = ("_h1", "_h2")
SEEDS = (1, 2)


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit numbers that are equal for equal rows (NULL equals NULL, 0.0 equals -0.0)."""
    values = [F.col(f"`{c}`") for c in columns]
    # The hash passes NULLs by: without the flags, (1, NULL) and (NULL, 1) would be the same to it.
    missing = F.array(*[v.isNull() for v in values])
    return [F.xxhash64(F.lit(s), missing, *values).alias(n) for s, n in zip(SEEDS, FINGERPRINT)]


def with_fingerprint(df: DataFrame) -> DataFrame:
    return df.select("*", *fingerprint(df.columns))


def repeated_fingerprints(df: DataFrame) -> DataFrame:
    """Fingerprints of ``df`` that more than one row has, stored; 24 bytes a row are dealt out for it."""
    counts = df.select(*fingerprint(df.columns)).groupBy(*FINGERPRINT).agg(F.count("*").alias("_n"))
    return materialize(counts.filter("_n > 1").select(*FINGERPRINT), "repeated")


def repeated_rows(df: DataFrame) -> DataFrame:
    """Each row that occurs more than once, with ``_n``, how often.

    The stored fingerprints are broadcast where their size allows it, and then only copies move.
    """
    suspects = with_fingerprint(df).join(repeated_fingerprints(df), list(FINGERPRINT), "left_semi")
    counted = suspects.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count("*").alias("_n"))
    return counted.filter("_n > 1")


def row_condition(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Whether two rows with fingerprints are the same in full."""
    test = F.lit(True)
    for name in FINGERPRINT:
        test = test & (left[name] == right[name])
    for c in columns:
        test = test & left[c].eqNullSafe(right[c])
    return test

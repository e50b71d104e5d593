"""Line de-duplication: lines that several documents share stay in one of them only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bound_batches, fresh, materialize, utf8

STRIPPED = b" \t\n\x0b\x0c\r"


def line_keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(doc, row, text) -> (doc, row, h1, h2, at): each normalised line of a row, with its positions."""
    for batch in batches:
        owner: list[int] = []
        high: list[int] = []
        low: list[int] = []
        places: list[list[int]] = []
        for i, data in enumerate(batch.column(2).to_pylist()):
            found: dict[bytes, list[int]] = {}
            for at, line in enumerate((data or b"").split(b"\n")):
                key = line.strip(STRIPPED).lower()
                if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                    found.setdefault(key, []).append(at)
            for key, at in found.items():
                digest = xxhash.xxh3_128_digest(key)
                owner.append(i)
                high.append(int.from_bytes(digest[:8], "big", signed=True))
                low.append(int.from_bytes(digest[8:], "big", signed=True))
                places.append(at)
        rows = pa.array(np.array(owner, np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array(places, pa.list_(pa.int32())),
            ],
            names=["doc", "row", "h1", "h2", "at"],
        )


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 10, min_docs: int = 2, into: str = "lines", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: ``kept`` (text), ``n_lines``, ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased; keys are compared by
    128-bit hashes. Keys of at least ``min_chars`` code points that at least ``min_docs`` distinct ids hold
    lose their lines everywhere but in the smallest id. Null and empty texts are one empty line. A row
    without an id keeps all lines and counts for no document. Repeated rows lose the same lines.

    Lines travel as hashes. The text is moved once, to meet the positions it loses; a document's
    positions meet in one group, a line's documents never do.
    """
    bound_batches(docs.sparkSession)
    keep = keep or list(docs.columns)
    own, row, into = fresh(docs, "_doc"), fresh(docs, "_row"), fresh(docs, into)
    docs = docs.select(
        *[f"`{c}`" for c in keep],
        F.col(f"`{doc_id}`").alias(own),
        F.xxhash64(F.col(f"`{text}`")).alias(row),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(into),
    )
    kind = docs.schema[own].dataType.simpleString()
    lines = materialize(
        docs.where(F.col(own).isNotNull())
        .select(own, row, utf8(F.col(into)).alias(into))
        .mapInArrow(lambda b: line_keys(b, min_chars), f"doc {kind}, row bigint, h1 bigint, h2 bigint, at array<int>"),
        "line-keys",
    )
    shared = lines.groupBy("h1", "h2")
    if min_docs == 2:
        shared = shared.agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first <> last")
    else:
        shared = (
            lines.select("h1", "h2", "doc").distinct().groupBy("h1", "h2")
            .agg(F.min("doc").alias("first"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
        )
    # Stored, so that the join deals both sides anew and a line of very many documents can be split.
    shared = materialize(shared.select("h1", "h2", "first"), "shared-lines")
    lost = (
        lines.join(shared, ["h1", "h2"])
        .where("doc <> first")
        .groupBy("doc", "row")
        .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("lost"))
    )
    gone = fresh(docs, "_lost")
    met = docs.join(
        lost.select(F.col("doc").alias(f"{own}2"), F.col("row").alias(f"{row}2"), F.col("lost").alias(gone)),
        (F.col(own) == F.col(f"{own}2")) & (F.col(row) == F.col(f"{row}2")),
        "left",
    )
    parts = fresh(met, "_parts")
    met = met.select("*", F.split(F.col(into), "\n").alias(parts))
    stay = f"array_except(sequence(0, size({parts}) - 1), {gone})"
    return met.select(
        *[f"`{c}`" for c in keep],
        F.struct(
            F.when(F.col(gone).isNull(), F.col(into))
            .otherwise(F.expr(f"array_join(transform({stay}, i -> get({parts}, i)), '\\n')"))
            .alias("kept"),
            F.size(parts).cast("long").alias("n_lines"),
            F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
        ).alias(into),
    )


def replace_text(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``; other columns unchanged."""
    into = fresh(docs, "lines")
    done = drop_repeated_lines(docs, text, doc_id, into=into, **options)
    return done.select(*[F.col(into)["kept"].alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])

"""Importance resampling: draw the documents that look most like a target text collection.

Features (runs of words) fall into hashed buckets. An array of one number for each bucket tells how
much likelier the bucket is in the target than in the raw texts; a document's weight is the mean of
that array over its features. Adding Gumbel noise to the weights and taking the greatest sums draws
without replacement in proportion to the weights. The greatest k are found by a distributed
quickselect: random pivots, exact counts on both sides of each, and only rows between the two pivots
around the k-th are looked at again. Only the drawn rows are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import bound_batches, fresh, materialize, places, utf8
from martflow.llm.words import plain_words
from martflow.operators.buckets import dense_ids

PIVOTS = 64


@dataclass(frozen=True)
class Draw:
    """What is drawn and how features are made."""

    percent: int = 10  # of the documents with at least min_words words
    min_words: int = 20
    max_run: int = 1  # features are runs of 1 to max_run words
    buckets: int = 10_000
    seed: int = 2024


class Buckets(dict):
    """Remembers the bucket of each feature; forgets all when it holds ``limit`` features."""

    def __init__(self, buckets: int, limit: int = 400_000):
        super().__init__()
        self.buckets, self.limit = buckets, limit

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % self.buckets
        return value

    def of(self, words: list[bytes], max_run: int) -> np.ndarray:
        """The buckets of all runs of 1 to ``max_run`` words."""
        parts = []
        for size in range(1, min(max_run, len(words)) + 1):
            runs = words if size == 1 else map(b" ".join, zip(*(words[k:] for k in range(size))))
            parts.append(np.fromiter(map(self.__getitem__, runs), np.int64, len(words) - size + 1))
        return np.concatenate(parts) if parts else np.empty(0, np.int64)


def count_buckets(batches: Iterator[pa.RecordBatch], draw: Draw) -> Iterator[pa.RecordBatch]:
    """(text) -> (bucket, features): one array of counts for each task."""
    known, total = Buckets(draw.buckets), np.zeros(draw.buckets, np.int64)
    for batch in batches:
        for data in batch.column(0):
            found = known.of(plain_words(data.as_py() or b""), draw.max_run)
            total += np.bincount(found, minlength=draw.buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=places(2))


def bucket_counts(texts: DataFrame, text: str, draw: Draw) -> np.ndarray:
    """Features in each bucket over all rows; ``draw.buckets`` numbers at most are collected."""
    counted = texts.select(utf8(F.col(f"`{text}`")).alias("t")).mapInArrow(
        lambda b: count_buckets(b, draw), "bucket bigint, n bigint"
    )
    out = np.zeros(draw.buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket, 1000 times the log of its smoothed share in the target over that in the raw texts, floored."""
    size, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    ratios = [
        (float(t + 1) * float(all_raw + size)) / (float(s + 1) * float(all_target + size))
        for s, t in zip(raw.tolist(), target.tolist())
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weigh(batches: Iterator[pa.RecordBatch], draw: Draw, gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(..., text) -> (..., words, features, weight)."""
    known = Buckets(draw.buckets)
    for batch in batches:
        words, features, weights = [], [], []
        for data in batch.column(batch.num_columns - 1):
            split = plain_words(data.as_py() or b"")
            found = known.of(split, draw.max_run)
            words.append(len(split))
            features.append(len(found))
            weights.append(int(gain[found].sum()) // len(found) if len(found) else 0)
        made = [pa.array(x, pa.int64()) for x in (words, features, weights)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=places(batch.num_columns + 2))


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel number made from the SHA-256 of ``seed:id``, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


# -- the k smallest composite keys -----------------------------------------------------


def ahead(columns: list[str], key: tuple) -> Column:
    """Whether a row's composite key is smaller than ``key`` (no nulls)."""
    test = F.lit(False)
    for c, v in zip(reversed(columns), reversed(key)):
        test = (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & test)
    return test


def kth_key(rows: DataFrame, columns: list[str], k: int, pivots: int = PIVOTS, seed: int = 0) -> tuple | None:
    """The k-th smallest composite key of ``rows`` (1 is the smallest); None if k is 0.

    Keys must be unique and free of nulls. Every round draws ``pivots`` random rows, counts the rows before
    each, and keeps the rows strictly between the two pivots around the k-th: some ``pivots``-th part of
    them. Only pivots and their counts come to the driver; the rows are read from where they are stored.
    """
    if k <= 0:
        return None
    low: tuple | None = None  # the k-th is after this key ...
    high: tuple | None = None  # ... and before this one
    turn = 0
    while True:
        left = rows
        if low is not None:
            left = left.where(~ahead(columns, low)).where(~same(columns, low))
        if high is not None:
            left = left.where(ahead(columns, high))
        chance = F.xxhash64(F.lit(seed + turn), *columns)
        found = sorted(tuple(r) for r in left.select(*columns).orderBy(chance).limit(pivots).collect())
        if not found:
            raise ValueError("there are fewer rows than k")
        # The first column alone cuts most files off; the rows before ``low`` need not be read again.
        counted = left.agg(*[F.count_if(ahead(columns, p)).alias(f"n{i}") for i, p in enumerate(found)]).first()
        before = [counted[f"n{i}"] for i in range(len(found))]
        for p, n in zip(found, before):
            if n == k - 1:
                return p
        inside = [i for i, n in enumerate(before) if n < k - 1]
        if inside:
            low = found[inside[-1]]
        beyond = [i for i, n in enumerate(before) if n > k - 1]
        if beyond:
            high = found[beyond[0]]
        if inside:
            k -= before[inside[-1]] + 1
        turn += 1


def same(columns: list[str], key: tuple) -> Column:
    test = F.lit(True)
    for c, v in zip(columns, key):
        test = test & (F.col(c) == F.lit(v))
    return test


# -- the operator ----------------------------------------------------------------------


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", draw: Draw | None = None, into: str = "drawn", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with a struct ``into``: ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` (1, 2, 3, ... for the drawn rows, null for others).

    Drawn are ``draw.percent`` percent (rounded down) of the rows with at least ``draw.min_words`` words: those of
    the greatest scores, ties by smaller id; rows without an id come last among ties, rows of equal score and
    id in any order, each with a rank of its own. Null and empty texts have no words, weight 0, and are not
    drawn. Ids must be integers. An empty target or an empty table is fine: all weights count what is there.

    Counts of buckets cover all texts of both tables. Weights are stored once, with a number for each row; the
    quickselect reads that table, and only drawn rows are dealt out and sorted.
    """
    draw = draw or Draw()
    bound_batches(docs.sparkSession)
    keep = keep or list(docs.columns)
    into = fresh(docs, into)
    gain = gains(bucket_counts(docs, text, draw), bucket_counts(target, target_text, draw))
    own = [fresh(docs, x) for x in ("_words", "_features", "_weight", "_score", "_id", "_row", "_rank")]
    words, features, weight, score, key, number, rank = own
    body = fresh(docs, "_text")
    inner = docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
        noise(F.col(f"`{doc_id}`"), draw.seed).alias("noise"),
        F.col(f"`{doc_id}`").cast("bigint").alias("id"),
        utf8(F.col(f"`{text}`")).alias(body),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[:-1])
    weighed = inner.mapInArrow(lambda b: weigh(b, draw, gain), f"{schema}, words bigint, features bigint, weight bigint")
    rows = weighed.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("words").alias(words),
        F.col("features").alias(features),
        F.col("weight").alias(weight),
        (F.col("weight") + F.col("noise")).alias(score),
        # The composite key, smallest first: minus the score, no id, the id, the row.
        F.struct(
            (-(F.col("weight") + F.col("noise"))).alias("a"),
            F.col("id").isNull().cast("int").alias("b"),
            F.coalesce("id", F.lit(0)).alias("c"),
            F.monotonically_increasing_id().alias("d"),
        ).alias(key),
    )
    rows = materialize(rows, "weighed")
    fits = F.col(words) >= draw.min_words
    order = ["a", "b", "c", "d"]
    keys = rows.where(fits).select(*[F.col(key)[x].alias(x) for x in order])
    last = kth_key(keys, order, keys.count() * draw.percent // 100, seed=draw.seed)
    flat = rows.select("*", *[F.col(key)[x].alias(f"{key}{x}") for x in order])
    columns = [f"{key}{x}" for x in order]
    wins = fits & (ahead(columns, last) | same(columns, last)) if last else F.lit(False)
    drawn = dense_ids(flat.where(wins), columns, rank) if last else flat.where(wins).withColumn(rank, F.lit(None).cast("bigint"))
    others = flat.where(~wins).withColumn(rank, F.lit(None).cast("bigint"))
    return drawn.unionByName(others).select(
        *[f"`{c}`" for c in keep],
        F.struct(
            F.col(words).alias("n_words"),
            F.col(features).alias("n_features"),
            F.col(weight).alias("weight"),
            F.col(score).alias("score"),
            F.col(rank).alias("rank"),
        ).alias(into),
    )


def drawn_documents(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs``, with their columns unchanged."""
    into = fresh(docs, "drawn")
    done = resample(docs, target, text, doc_id, into=into, **options)
    return done.where(F.col(into)["rank"].isNotNull()).drop(into)

"""Incremental loading by high-water mark or by key, with durable marks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.operators.ledger import Ledger, not_loaded
from martflow.session import materialize
from martflow.sources.files import read_csv
from martflow.sources.sinks import write_csv_if_any


def high_water_mark(df: DataFrame, mark: str, key: str | None = None) -> DataFrame:
    """One row with the greatest mark, and the greatest key among the rows that carry it.

    An empty table gives NULLs, which ``fetch_since`` reads as "everything is new".
    """
    if key is None:
        return df.agg(F.max(mark).alias(mark))
    return df.agg(F.max(F.struct(mark, key)).alias("m")).select(f"m.{mark}", f"m.{key}")


def newer_than(mark: str, value, key: str | None = None, key_value=None) -> Column | None:
    """Filter for rows past a mark. Equal marks are told apart by the key, if one is given."""
    if value is None:
        return None
    since = value if isinstance(value, Column) else F.lit(value)
    test = F.col(mark) > since
    if key is not None and key_value is not None:
        test = test | ((F.col(mark) == since) & (F.col(key) > key_value))
    return test


def fetch_since(
    df: DataFrame,
    mark: str,
    value=None,
    n: int | None = None,
    key: str | None = None,
    key_value=None,
) -> DataFrame:
    """Rows past the mark at full precision; with ``n`` the oldest n of them."""
    test = newer_than(mark, value, key, key_value)
    out = df if test is None else df.filter(test)
    if n is None:
        return out
    order = [F.col(mark).asc()] + ([F.col(key).asc()] if key else [])
    return out.orderBy(*order).limit(n)


def stamp_new(
    df: DataFrame,
    n: int | None,
    order_by: Sequence[str],
    stamp: datetime | None = None,
    name: str = "last_modified",
) -> DataFrame:
    """At most n rows in a fixed order, each with the time of loading."""
    out = df if n is None else df.orderBy(*order_by).limit(n)
    return out.withColumn(name, F.lit(stamp) if stamp else F.current_timestamp())


def load_by_key(df: DataFrame, key: str, last=None, ordered: bool = True) -> DataFrame:
    """Distinct rows with a key above the last one loaded, in key order."""
    out = df if last is None else df.filter(F.col(key) > last)
    out = out.distinct()
    return out.orderBy(key) if ordered else out


def new_last_key(df: DataFrame, key: str, last=None) -> DataFrame:
    """One row: the last key after loading ``df``; the old one if nothing came."""
    return df.agg(F.coalesce(F.max(key), F.lit(last)).alias(key))


class MarkStore:
    """Marks as one-row Parquet tables in numbered folders; the highest number counts.

    A new mark never replaces an old file, and a job that dies while writing leaves no
    visible file behind, so the previous mark stays valid.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = schema

    def _latest(self):
        try:
            table = self.spark.read.schema(f"{self.schema}, version long").parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":  # nothing stored yet
                return None
            raise
        return table.orderBy(F.desc("version")).first()

    def load(self, default=None):
        """The stored row as a dict, or the default."""
        row = self._latest()
        if row is None:
            return default
        values = row.asDict()
        values.pop("version")
        return values

    def save(self, **values) -> None:
        row = self._latest()
        number = 0 if row is None else row["version"] + 1
        mark = self.spark.createDataFrame([values], self.schema)
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={number}")


@dataclass
class Feed:
    """One table of an incremental job.

    ``target`` reads the stored table, ``append`` adds rows to it. ``order_by`` starts with the
    unique key. A run loads the source's rows whose key is not stored yet, late ones too, at most
    ``n`` of them in that order (all by default); rows without a key are never loaded. With a
    ``ledger``, only key ranges that differ from what it knows are compared. ``marks`` keeps the last
    *extracted* row, so that rows which a run stored but did not extract come with the next one.
    """

    name: str
    source_path: str
    target: Callable[[], DataFrame]
    append: Callable[[DataFrame], None]
    extract_path: str
    order_by: Sequence[str]
    mark: str = "last_modified"
    n: int | None = None
    marks: MarkStore | None = None
    ledger: Ledger | None = None
    read_options: dict = field(default_factory=dict)


def run_incremental(
    spark: SparkSession, feeds: Sequence[Feed], stamp: datetime | None = None
) -> dict[str, bool]:
    """Append what is new, extract, move the mark, for each feed. Tells which feeds wrote an extract.

    The rows of a run are written once; the table, the extract and the mark all take them from there.
    Stamps must grow from run to run, as extracts go by them.
    """
    wrote = {}
    for feed in feeds:
        key = feed.order_by[0]
        stored = feed.target()
        known = feed.marks.load() if feed.marks else None
        if known is None:
            known = high_water_mark(stored, feed.mark, key).first().asDict()
        if stamp is not None and known[feed.mark] is not None and stamp <= known[feed.mark]:
            raise ValueError(f"the stamp {stamp} is not after that of an earlier run")
        source = read_csv(spark, feed.source_path, infer=True, **feed.read_options)
        ledger = feed.ledger
        opened = ledger.open_spans(source) if ledger else None
        ahead = not_loaded(source, stored, key, opened, ledger.width) if ledger else not_loaded(source, stored, key)
        batch = materialize(stamp_new(ahead, feed.n, feed.order_by, stamp, feed.mark), "batch")
        if not batch.isEmpty():
            feed.append(batch)
        if ledger:
            ledger.record(feed.target(), opened)
        # Everything stored past the mark: this batch, and what an interrupted run left behind.
        news = fetch_since(feed.target(), feed.mark, known[feed.mark], None, key, known[key])
        news = materialize(news, "extract")
        wrote[feed.name] = write_csv_if_any(news, feed.extract_path)
        if feed.marks and wrote[feed.name]:
            feed.marks.save(**high_water_mark(news, feed.mark, key).first().asDict())
    return wrote

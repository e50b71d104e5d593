"""A cleaned table that grows by increments, with what its cleaning needs kept beside it.

Stored under one path:

* ``rows/step=k``: the rows that increment k added, without copies, sentinels as NULL, nothing filled;
* ``open/step=k``: all rows up to step k whose date is missing, with the date carried to them;
* ``values/step=k``: how often each text occurs in the columns filled by their mode;
* ``last/step=k``: the last known date of each group;
* ``marks``: one row for each step, written last: counts, means and squared deviations, modes.

Everything but the rows is small or grows with what is missing, and is merged, not counted anew. A value
is filled when the table is read: the fill of every earlier row follows the merged numbers. A step
that dies leaves nothing behind that counts; run again, it replaces its own folders.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from martflow.functions.dates import leading_date
from martflow.functions.missing import SENTINELS, blank_to_null
from martflow.operators.buckets import forward_fill
from martflow.operators.fingerprint import FINGERPRINT, row_condition, with_fingerprint
from martflow.operators.ingest import MarkStore
from martflow.session import materialize

STATE = (
    "step int, added bigint, columns array<string>, counts array<bigint>, means array<double>, "
    "squares array<double>, modes array<string>"
)


@dataclass(frozen=True)
class Rules:
    """What is filled how: numbers by their mean, texts by their mode, a date by the latest earlier one
    of the same ``partition_by``. ``order_by`` must be unique within it."""

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    date: str | None = None
    order_by: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    sentinels: Sequence[str] = SENTINELS


@dataclass(frozen=True)
class Moments:
    """Count, mean and sum of squared deviations: two of them merge into that of both parts."""

    n: int = 0
    mean: float = 0.0
    square: float = 0.0

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        return Moments(
            n,
            self.mean + apart * other.n / n,
            self.square + other.square + apart * apart * self.n * other.n / n,
        )

    def bounds(self, k: float) -> tuple[float, float] | None:
        if self.n < 2:
            return None
        spread = k * math.sqrt(self.square / (self.n - 1))
        return self.mean - spread, self.mean + spread


class Curated:
    """The stored table. ``schema`` is that of the raw rows; increments are read by column name."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, rules: Rules):
        self.spark, self.path, self.schema, self.rules = spark, path.rstrip("/"), schema, rules
        self.marks = MarkStore(spark, f"{self.path}/marks", STATE)

    # -- what is stored ----------------------------------------------------------------

    def _table(self, name: str, schema: StructType, step: int | None = None) -> DataFrame:
        folder = f"{self.path}/{name}" + ("" if step is None else f"/step={step}")
        return self.spark.read.schema(schema).parquet(folder)

    def _row_schema(self) -> StructType:
        made = StructType(list(self.schema.fields))
        for name in FINGERPRINT:
            made = made.add(name, "long")
        return made.add("_open", "boolean").add("step", "integer")

    def _rows(self, step: int, open_too: bool = True) -> DataFrame:
        """Rows of all steps up to ``step``; those of steps that never ended are passed by."""
        rows = self._table("rows", self._row_schema()).filter(F.col("step") <= step)
        return rows if open_too else rows.filter(~F.col("_open"))

    def _known_type(self) -> StructType:
        order = StructType([self.schema[c] for c in self.rules.order_by])
        return StructType([StructField("at", order), StructField("date", DateType())])

    def _open_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField("_fill", self._known_type())])

    def _last_schema(self) -> StructType:
        return StructType([*self._group_fields(), StructField("_last", self._known_type())])

    def _group_fields(self) -> list[StructField]:
        return [StructField(f"_g{i}", self.schema[c].dataType) for i, c in enumerate(self.rules.partition_by)]

    def _group(self) -> list[Column]:
        return [F.col(c).alias(f"_g{i}") for i, c in enumerate(self.rules.partition_by)]

    def _known(self) -> Column:
        """Where and what a row's own date is; NULL if it has none."""
        date = leading_date(F.col(self.rules.date).cast("string"))
        at = F.struct(*[F.col(c).alias(c) for c in self.rules.order_by])
        return F.when(date.isNotNull(), F.struct(at.alias("at"), date.alias("date")))

    # -- adding ------------------------------------------------------------------------

    def append(self, increment: DataFrame) -> int:
        """Clean an increment, add the rows that the table does not have yet, merge the numbers.

        Returns how many rows came in. The stored rows are read for two things only, both cut down by
        the file statistics to where the increment lies: copies of its rows, and dates before rows that
        arrive late.
        """
        state = self.marks.load()
        step = 0 if state is None else state["step"] + 1
        self._store_rows(increment, step)
        fresh = self._table("rows", self._row_schema()).filter(F.col("step") == step)
        r = self.rules
        numbers = {c: F.col(c).try_cast("double") for c in r.numeric}
        row = fresh.agg(
            F.count("*").alias("added"),
            *[F.count(v).alias(f"n_{c}") for c, v in numbers.items()],
            *[F.avg(v).alias(f"m_{c}") for c, v in numbers.items()],
            *[(F.var_pop(v) * F.count(v)).alias(f"s_{c}") for c, v in numbers.items()],
        ).first()
        old = self._moments(state)
        new = {
            c: old[c].merged(Moments(row[f"n_{c}"], row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0))
            for c in r.numeric
        }
        modes = self._store_values(fresh, step)
        if r.date:
            self._store_dates(fresh, step)
        self.marks.save(
            step=step,
            added=row["added"],
            columns=list(r.numeric),
            counts=[new[c].n for c in r.numeric],
            means=[new[c].mean for c in r.numeric],
            squares=[new[c].square for c in r.numeric],
            modes=modes,
        )
        return row["added"]

    def _moments(self, state: dict | None) -> dict[str, Moments]:
        if state is None:
            return {c: Moments() for c in self.rules.numeric}
        parts = zip(state["columns"], state["counts"], state["means"], state["squares"])
        return {c: Moments(n, m, s) for c, n, m, s in parts}

    def _store_rows(self, increment: DataFrame, step: int) -> None:
        r = self.rules
        named = increment.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        rows = with_fingerprint(blank_to_null(named, r.sentinels).dropDuplicates())
        if step:
            rows = materialize(rows, "increment")
            stored = self._rows(step - 1)
            for c in r.order_by[:1]:
                ends = rows.agg(F.min(c).alias("a"), F.max(c).alias("b"), F.count_if(F.col(c).isNull()).alias("n")).first()
                near = F.lit(False) if ends["a"] is None else F.col(c).between(F.lit(ends["a"]), F.lit(ends["b"]))
                stored = stored.filter(near | F.col(c).isNull() if ends["n"] else near)
            names = [f"`{c}`" for c in self.schema.fieldNames()]
            stored = stored.select(*[F.col(c) for c in (*names, *FINGERPRINT)])
            rows = rows.join(stored, row_condition(rows, stored, self.schema.fieldNames()), "left_anti")
        missing = self._known().isNull() if r.date else F.lit(False)
        rows = rows.withColumn("_open", missing)
        if r.order_by:
            rows = rows.repartitionByRange(*r.order_by).sortWithinPartitions("_open", *r.order_by)
        rows.write.mode("overwrite").partitionBy("_open").parquet(f"{self.path}/rows/step={step}")

    def _store_values(self, fresh: DataFrame, step: int) -> list[str | None]:
        """Merge the counts of texts; returns the mode of each column (the lowest of a tie)."""
        r = self.rules
        if not r.categorical:
            return []
        schema = StructType().add("column", "string").add("value", "string").add("n", "long")
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in r.categorical])
        counted = (
            fresh.select(F.inline(cells)).filter("value IS NOT NULL")
            .groupBy("column", "value").agg(F.count("*").alias("n"))
        )
        if step:
            both = self._table("values", schema, step - 1).unionByName(counted)
            counted = both.groupBy("column", "value").agg(F.sum("n").alias("n"))
        counted.write.mode("overwrite").parquet(f"{self.path}/values/step={step}")
        rank = F.struct((-F.col("n")).alias("n"), "value")
        best = self._table("values", schema, step).agg(
            *[F.min(F.when(F.col("column") == c, rank))["value"].alias(c) for c in r.categorical]
        )
        return list(best.first())

    def _store_dates(self, fresh: DataFrame, step: int) -> None:
        """Carry dates to the rows without one: those of this step, and earlier ones that it overtakes."""
        r = self.rules
        names = self.schema.fieldNames()
        none = F.lit(None).cast(self._known_type())
        own = fresh.select(*names, self._known().alias("_known"))
        # Rows with a date take part with nothing but their place and date.
        kept = {*r.partition_by, *r.order_by}
        slim = [F.when(F.col("_known").isNull() | F.lit(c in kept), F.col(c)).alias(c) for c in names]
        marked = own.select(*slim, "_known", none.alias("_fill"), F.lit(True).alias("_new"), F.col("_known").isNull().alias("_wanted"))
        if step:
            before = self._table("open", self._open_schema(), step - 1)
            marked = marked.unionByName(
                before.select(*names, none.alias("_known"), "_fill", F.lit(False).alias("_new"), F.lit(True).alias("_wanted"))
            )
        carried = forward_fill(marked, "_known", r.order_by, r.partition_by).filter("_wanted")
        latest = F.greatest("_fill", "_known")
        if step:
            carried = materialize(carried, "carried")
            carried = self._from_stored(carried, step)
            latest = F.greatest("_fill", "_known", "_before")
        carried.select(*names, latest.alias("_fill")).write.mode("overwrite").parquet(f"{self.path}/open/step={step}")
        ends = own.filter("_known IS NOT NULL").select(*self._group(), F.col("_known").alias("_last"))
        if step:
            ends = ends.unionByName(self._table("last", self._last_schema(), step - 1))
        groups = [f.name for f in self._group_fields()]
        ends.groupBy(*groups).agg(F.max("_last").alias("_last")).filter("_last IS NOT NULL").write.mode(
            "overwrite"
        ).parquet(f"{self.path}/last/step={step}")

    def _from_stored(self, carried: DataFrame, step: int) -> DataFrame:
        """New rows without a date get the stored one before them as ``_before``.

        Mostly that is the last one of the group. Only for rows that lie before it (late ones) the
        stored rows of their groups are looked at.
        """
        r = self.rules
        last = self._table("last", self._last_schema(), step - 1)
        test = F.lit(True)
        for f, c in zip(self._group_fields(), r.partition_by):
            test = test & F.col(f.name).eqNullSafe(F.col(c))
        new = carried.filter("_new")
        groups = [f.name for f in self._group_fields()]
        met = new.join(last, test, "left") if groups else new.withColumn("_last", last.select("_last").scalar())
        at = F.struct(*[F.col(c).alias(c) for c in r.order_by])
        met = materialize(met.drop(*groups).withColumn("_late", F.coalesce(F.col("_last")["at"] >= at, F.lit(False))), "met")
        on_time = met.filter("NOT _late").select(*carried.columns, F.col("_last").alias("_before"))
        late = met.filter("_late")
        none = F.lit(None).cast(self._known_type())
        out = carried.filter("NOT _new").withColumn("_before", none).unionByName(on_time)
        if late.isEmpty():
            return out
        stored = self._rows(step - 1, open_too=False)
        ends = late.agg(F.max(F.struct(*r.order_by))).first()[0] if not r.partition_by else None
        if ends is not None:
            stored = stored.filter(at <= F.struct(*[F.lit(ends[c]).alias(c) for c in r.order_by]))
        else:
            wanted = late.select(*self._group()).distinct()
            stored = stored.join(wanted, test, "left_semi")
        names = self.schema.fieldNames()
        kept = {*r.partition_by, *r.order_by}
        slim = [(F.col(c) if c in kept else F.lit(None).cast(self.schema[c].dataType)).alias(c) for c in names]
        plain = [F.lit(None).cast(carried.schema[c].dataType).alias(c) for c in carried.columns if c not in names]
        both = stored.select(*slim, *plain, self._known().alias("_before"), F.lit(False).alias("_asked")).unionByName(
            late.select(*carried.columns, none.alias("_before"), F.lit(True).alias("_asked"))
        )
        found = forward_fill(both, "_before", r.order_by, r.partition_by).filter("_asked").drop("_asked")
        return out.unionByName(found)

    # -- reading -----------------------------------------------------------------------

    def read(self, outliers: float | None = None) -> DataFrame:
        """All rows with everything filled; one scan of the stored rows.

        ``outliers=k`` leaves out rows beyond k standard deviations of the known values in any number
        column (and those with no number at all). Bounds and fills are numbers of the last step.
        """
        state = self.marks.load()
        names, r = self.schema.fieldNames(), self.rules
        if state is None:
            rows = self.spark.createDataFrame([], self.schema)
            fills: dict = {}
        else:
            rows = self._rows(state["step"], open_too=not r.date).select(*names)
            fills = {c: m.mean for c, m in self._moments(state).items() if m.n}
            fills |= dict(zip(r.categorical, state["modes"]))
        if r.date:
            rows = rows.withColumn(r.date, leading_date(F.col(r.date).cast("string")))
            if state is not None:
                opened = self._table("open", self._open_schema(), state["step"])
                rows = rows.unionByName(opened.withColumn(r.date, F.col("_fill")["date"]).drop("_fill"))
        filled = {c: F.coalesce(F.col(c).try_cast("double"), F.lit(fills.get(c)).cast("double")) for c in r.numeric}
        filled |= {c: F.coalesce(F.col(c), F.lit(fills.get(c))) for c in r.categorical}
        rows = rows.withColumns(filled) if filled else rows
        if outliers is not None:
            for c, m in self._moments(state).items():
                ends = m.bounds(outliers)
                rows = rows.filter(F.col(c).between(*map(F.lit, ends)) if ends else F.lit(False))
        return rows

"""Star schema over retail tables: dimensions, facts and wide tables.

Inputs: ``past_sales`` and ``new_sales(store, dept, date, weekly_sales, isholiday, ...)``,
``features(store, date, measures...)``, ``store(store, type, size, ...)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.dates import day_parts, guarded_date, stamp_date
from martflow.operators.buckets import dense_ids
from martflow.operators.mapping import apply_mapping, typed

# Renaming that keeps the keys of the right side apart in a join.
RIGHT_SALES_FIELDS = [
    ("store", "bigint", "right_store", "bigint"),
    ("dept", "bigint", "right_dept", "bigint"),
    ("date", "string", "right_date", "string"),
    ("weekly_sales", "double", "right_weekly_sales", "double"),
    ("isholiday", "boolean", "right_isholiday", "boolean"),
]


# -- loading -------------------------------------------------------------------------


def typed_load(raw: DataFrame, schema, stamp: str = "last_modified") -> DataFrame:
    """Raw text columns to a declared schema by name; incomplete rows go, the stamp is a date.

    A value that does not parse makes its row incomplete.
    """
    rows = typed(raw, schema).dropna("any")
    if stamp in rows.columns:
        rows = rows.withColumn(stamp, stamp_date(stamp))
    return rows


def load_summary(raw: DataFrame, schema) -> DataFrame:
    """One row: rows read, kept and dropped by ``typed_load``."""
    complete = F.lit(True)
    rows = typed(raw, schema)
    for c in rows.columns:
        complete = complete & F.col(c).isNotNull()
    return rows.agg(
        F.count("*").alias("rows_read"),
        F.count_if(complete).alias("rows_kept"),
        F.count_if(~complete).alias("rows_dropped"),
    )


# -- dimensions ----------------------------------------------------------------------


def dim_store(store: DataFrame) -> DataFrame:
    """One row per different store record."""
    names = {"store": "store_id", "type": "store_type", "size": "store_size"}
    kept = [c for c in (*names, "last_modified") if c in store.columns]
    return store.select(*kept).withColumnsRenamed(names).distinct()


def dim_date(*sales: DataFrame) -> DataFrame:
    """All different days of the given sales tables with year, month and day."""
    return _dates([s.select(F.col("date").alias("date_id")) for s in sales])


def dim_date_guarded(*sales: DataFrame) -> DataFrame:
    """The same from text dates: whatever is not a real ``yyyy-MM-dd`` day becomes NULL."""
    return _dates([s.select(guarded_date("date").alias("date_id")) for s in sales])


def _dates(parts: Sequence[DataFrame]) -> DataFrame:
    days = parts[0]
    for p in parts[1:]:
        days = days.unionByName(p)
    return days.distinct().withColumns(day_parts("date_id"))


def dim_department(past_sales: DataFrame) -> DataFrame:
    """One row per department with its latest modification."""
    return _latest(past_sales, "dept", "dept_id")


def dim_holiday(*sales: DataFrame) -> DataFrame:
    """One row per holiday flag with its latest modification over all sales tables."""
    flags = sales[0].select("isholiday", "last_modified")
    for s in sales[1:]:
        flags = flags.unionByName(s.select("isholiday", "last_modified"))
    return _latest(flags, "isholiday", "holiday_id")


def _latest(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys must be unique in a dimension, or joining it multiplies the facts."""
    return df.groupBy(F.col(key).alias(name)).agg(F.max("last_modified").alias("last_modified"))


def feature_key(store: Column | str = "store", day: Column | str = "date") -> Column:
    """Surrogate key computed from (store, date): 32 bits of store, 32 bits of day number.

    The same in every job, free of collisions, and known without a shuffle or a lookup.
    """
    store = F.col(store) if isinstance(store, str) else store
    shifted = F.shiftleft(store.cast("bigint"), 32)
    return shifted + F.unix_date(F.col(day) if isinstance(day, str) else day).cast("bigint")


def dim_features(features: DataFrame, ids: str = "packed") -> DataFrame:
    """Feature measures with a ``feature_id``.

    ``ids="packed"`` uses ``feature_key``; ``ids="dense"`` counts 1, 2, 3, ... by store and
    date.
    """
    measures = [c for c in features.columns if c not in ("store", "date", "isholiday")]
    return with_feature_id(features, ids).select("feature_id", *measures)


def with_feature_id(features: DataFrame, ids: str = "packed") -> DataFrame:
    if ids == "packed":
        return features.withColumn("feature_id", feature_key())
    if ids != "dense":
        raise ValueError("ids is 'packed' or 'dense'")
    return dense_ids(features, ["store", "date"], "feature_id")


# -- facts ---------------------------------------------------------------------------

# Columns of the fact table.
FACT_NAMES = {"store": "store_id", "dept": "dept_id", "date": "date_id", "isholiday": "holiday_id"}
FACT_COLUMNS = ("store", "dept", "date", "feature_id", "weekly_sales", "isholiday")


def fact_sales(past_sales: DataFrame, features_with_id: DataFrame) -> DataFrame:
    """Sales with the id of their (store, date) features; sales without features are left out."""
    ids = features_with_id.select("store", "date", "feature_id")
    kept = [*FACT_COLUMNS, *(["last_modified"] if "last_modified" in past_sales.columns else [])]
    return past_sales.join(ids, ["store", "date"]).select(*kept).withColumnsRenamed(FACT_NAMES)


def fact_sales_all(
    past_sales: DataFrame,
    new_sales: DataFrame,
    features_with_id: DataFrame,
    store_dimension: DataFrame,
    date_dimension: DataFrame | None = None,
) -> DataFrame:
    """Old and new sales together, limited to known features, stores and days.

    The dimensions only filter, so they are semi joins: duplicate dimension rows cannot
    multiply sales. Without a date dimension all days are known but the missing one, as they are
    to a dimension made from the same sales.
    """
    columns = [c for c in FACT_COLUMNS if c != "feature_id"]
    sales = past_sales.select(*columns).unionByName(new_sales.select(*columns))
    fact = fact_sales(sales.filter("date IS NOT NULL"), features_with_id).join(
        store_dimension.select("store_id"), "store_id", "left_semi"
    )
    if date_dimension is not None:
        fact = fact.join(date_dimension.select("date_id"), "date_id", "left_semi")
    return fact.select(*[FACT_NAMES.get(c, c) for c in FACT_COLUMNS])


def known_totals(past_sales: DataFrame, features: DataFrame) -> DataFrame:
    """Sales that have features, summed by store, day and flag under the names of the fact.

    For reports that need no single sale: rows are summed before they meet the features, of which
    only the existence counts.
    """
    total = F.sum(F.col("weekly_sales").cast("decimal(18,2)")).cast("decimal(18,2)")
    sums = past_sales.groupBy("store", "date", "isholiday").agg(total.alias("weekly_sales"))
    return sums.join(features.select("store", "date"), ["store", "date"], "left_semi").select(
        *[F.col(c).alias(FACT_NAMES.get(c, c)) for c in ("store", "date", "weekly_sales", "isholiday")]
    )


# -- wide tables ---------------------------------------------------------------------


def wide_sales(past_sales: DataFrame, features: DataFrame, store: DataFrame) -> DataFrame:
    """Sales, features and store side by side; only rows complete in every column.

    Rows without a partner would be dropped as incomplete anyway, so the joins are inner
    and NULLs are removed from each side before it is shuffled.
    """
    past = past_sales.withColumnsRenamed(
        {c: f"past_{c}" for c in ("store", "dept", "date", "weekly_sales", "isholiday")}
    ).dropna()
    info = store.withColumnRenamed("store", "store_info").dropna()
    sides = features.dropna()
    joined = past.join(
        sides, (past["past_store"] == sides["store"]) & (past["past_date"] == sides["date"])
    )
    return joined.join(info, joined["past_store"] == info["store_info"])


def renamed_sales(past_sales: DataFrame) -> DataFrame:
    """The mapping step: typed fields under ``right_*`` names."""
    return apply_mapping(past_sales, RIGHT_SALES_FIELDS)


def store_join_summary(
    features: DataFrame, past_sales: DataFrame, measure: str = "fuel_price"
) -> DataFrame:
    """Per store, what the right join of features to sales *on the store alone* holds.

    Every sale meets every features row of its store, so the joined table grows with the
    product of both sides. Its counts and sums follow from one grouped row per side:
    each sale appears ``f`` times (once if the store has no features) and each features
    row as often as there are sales.
    """
    right = renamed_sales(past_sales).groupBy("right_store").agg(
        F.count("*").alias("_s"),
        F.sum(F.col("right_weekly_sales").cast("decimal(18,2)")).alias("_sales"),
    )
    left = features.groupBy(F.col("store").cast("bigint").alias("store")).agg(
        F.count("*").alias("_f"),
        F.sum(F.col(measure).cast("decimal(18,2)")).alias("_measure"),
    )
    joined = left.join(right, left["store"] == right["right_store"], "right")
    copies = F.coalesce("_f", F.lit(1))
    return joined.select(
        "right_store",
        (F.col("_s") * copies).alias("joined_rows"),
        (F.col("_sales") * copies).cast("decimal(38,2)").alias("sum_weekly_sales"),
        (F.col("_measure") * F.col("_s")).cast("decimal(38,2)").alias(f"sum_{measure}"),
    )

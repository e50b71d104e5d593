"""The driver's tables seen as inputs of this package.

Each function takes ``(spark, folder)`` and returns a lazy view over whole tables. Missing
values and copies are put in by integer arithmetic on ids, so that SQL can repeat them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.rules import money


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- loyalty -------------------------------------------------------------------------


def sales(spark, folder) -> DataFrame:
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
    )


def menu(spark, folder) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        money("p_retailprice").alias("price"),
    )


def menu_partial(spark, folder) -> DataFrame:
    """The menu with every fiftieth product id unknown, so that some sales find no price."""
    known = F.when(F.col("product_id") % 50 != 0, F.col("product_id"))
    return menu(spark, folder).withColumn("product_id", known)


def members(spark, folder) -> DataFrame:
    """All customers; those of other segments never joined and have no date."""
    joined = F.date_add(F.lit("1996-01-01").cast("date"), F.col("c_nationkey") * 60)
    date = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), joined)
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), date.alias("join_date")
    )


# -- products and sensors ------------------------------------------------------------


def products(spark, folder) -> DataFrame:
    return table(spark, folder, "part").select(
        F.regexp_replace("p_brand", "#", "_").alias("product_number"),
        F.concat_ws(" ", "p_name", (F.col("p_partkey") % 30 + 1990).cast("string")).alias(
            "product_name"
        ),
        F.col("p_type").alias("product_category"),
        (F.col("p_size") * 100).cast("double").alias("length"),
        F.col("p_retailprice").alias("width"),
    )


def reading_lines(spark, folder) -> DataFrame:
    day = F.to_date("ts").cast("string")
    text = F.when(
        F.col("event_id") % 31 == 0, F.concat_ws(",", F.col("user_id").cast("string"), day)
    ).otherwise(
        F.concat_ws(",", F.col("user_id").cast("string"), day, F.col("value").cast("string"))
    )
    tail = F.when(F.col("event_id") % 29 == 0, ",").otherwise("")
    return table(spark, folder, "events").select(F.concat(text, tail).alias("value"))


# -- cleaning ------------------------------------------------------------------------


def raw_events(spark, folder) -> DataFrame:
    """Events with sentinels, missing dates, and every hundredth row twice."""
    n = F.col("event_id")
    copies = F.when(n % 100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.when(n % 13 == 0, "NA").otherwise(F.col("event_type")).alias("event_type"),
        F.when(n % 17 == 0, "na").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(n % 29 != 0, F.to_date("ts").cast("string")).alias("date"),
        "ts",
        "props",
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def raw_documents(spark, folder) -> DataFrame:
    """Whole documents with sentinels in every text column."""
    n = F.col("doc_id")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.when(n % 29 == 0, "na").otherwise(F.col("text")).alias("text"),
        F.when(n % 13 == 0, "NA").otherwise(F.col("lang")).alias("lang"),
        F.when(n % 17 == 0, "na").otherwise(F.col("source")).alias("source"),
    )


# -- retail --------------------------------------------------------------------------

SPLIT_DAY = "2000-01-01"


def _all_sales(spark, folder) -> DataFrame:
    hours = F.make_dt_interval(hours=F.col("l_linenumber"))
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("store"),
        F.col("l_linenumber").alias("dept"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("weekly_sales"),
        (F.col("l_returnflag") == "R").alias("isholiday"),
        (F.col("l_shipdate") + hours).alias("last_modified"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_shipdate").alias("_day"),
    )


def past_sales(spark, folder) -> DataFrame:
    rows = _all_sales(spark, folder).filter(F.col("_day") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    return rows.drop("_day", "order_key")


def new_sales(spark, folder) -> DataFrame:
    rows = _all_sales(spark, folder).filter(F.col("_day") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    return rows.drop("_day", "order_key")


def features(spark, folder) -> DataFrame:
    """Measures of each store and week under the week's first day; sales of other days have none."""
    week = F.to_date(F.date_trunc("week", "l_shipdate"))
    return table(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey").cast("int").alias("store"), week.alias("date")
    ).agg(
        F.max("l_quantity").alias("temperature"),
        F.max("l_discount").alias("fuel_price"),
        F.max("l_tax").alias("cpi"),
        F.min("l_quantity").alias("unemployment"),
    )


def store(spark, folder) -> DataFrame:
    kind = F.substring(F.lit("ABC"), F.col("s_nationkey") % 3 + 1, F.lit(1))
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("store"),
        kind.alias("type"),
        F.floor(F.abs("s_acctbal")).cast("int").alias("size"),
    )


def _with_text_dates(rows: DataFrame) -> DataFrame:
    """Some days are unreadable: 'NA' or an empty text."""
    n = F.col("order_key")
    text = F.when(n % 11 == 0, "NA").when(n % 13 == 0, "").otherwise(F.col("date").cast("string"))
    return rows.withColumn("date", text)


def past_sales_text(spark, folder) -> DataFrame:
    rows = _all_sales(spark, folder).filter(F.col("_day") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    return _with_text_dates(rows)


def new_sales_text(spark, folder) -> DataFrame:
    rows = _all_sales(spark, folder).filter(F.col("_day") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    return _with_text_dates(rows)


def all_sales_text(spark, folder) -> DataFrame:
    """Past and new sales in one table, told apart by ``past``."""
    rows = _with_text_dates(_all_sales(spark, folder))
    past = F.col("_day") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return rows.select("store", "dept", "date", "weekly_sales", "isholiday", past.alias("past"))


def past_sales_raw(spark, folder) -> DataFrame:
    """Past sales as the text columns of a CSV file, some days unreadable."""
    rows = past_sales_text(spark, folder)
    stamp = F.date_format("last_modified", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return rows.select(
        F.col("store").cast("string").alias("store"),
        F.col("dept").cast("string").alias("dept"),
        "date",
        F.col("weekly_sales").cast("decimal(18,2)").cast("string").alias("weekly_sales"),
        F.col("isholiday").cast("string").alias("isholiday"),
        stamp.alias("last_modified"),
    )


# -- change feed ---------------------------------------------------------------------


def event_messages(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Events as JSON messages; every second one is encoded twice, as some senders do."""
    once = F.to_json(
        F.struct("event_id", "user_id", "event_type", "value", F.col("ts").cast("string").alias("ts"))
    )
    # A JSON string literal of the message: quotes and backslashes escaped, in quotes.
    escaped = F.regexp_replace(F.regexp_replace(once, r"\\", r"\\\\"), '"', '\\\\"')
    twice = F.concat(F.lit('"'), escaped, F.lit('"'))
    message = F.when(F.col("event_id") % 2 == 0, twice).otherwise(once).alias("value")
    return events.select(*(keep or []), message)


def event_feed(events: DataFrame) -> DataFrame:
    """Messages of events as a live feed has them: some come twice, some had an earlier version,
    and some are followed by a text that is no message."""
    n = F.col("event_id")
    older = F.struct((F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("ts"), F.lit(0.0).alias("value"))
    same = F.struct("ts", "value")
    versions = F.concat(
        F.array(same),
        F.when(n % 50 == 0, F.array(same)).otherwise(F.array()),
        F.when(n % 20 == 0, F.array(older)).otherwise(F.array()),
    )
    sent = events.select("event_id", "user_id", "event_type", F.explode(versions).alias("v"))
    sent = sent.select("event_id", "user_id", "event_type", "v.value", "v.ts")
    noise = F.concat(F.lit('{"event_id": '), (n % 7).cast("string"))
    parts = F.when(n % 37 == 0, F.array(F.col("value"), noise)).otherwise(F.array(F.col("value")))
    messages = event_messages(sent, keep=["event_id"])
    return messages.select(F.explode(parts).alias("value"))


def event_stream(spark, folder) -> DataFrame:
    """The events table as a file stream, whether it is one file or a folder of files."""
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")


# -- orders --------------------------------------------------------------------------


def items(spark, folder, opening: int = 500) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("item"),
        money("p_retailprice").alias("cost"),
        F.lit(opening).alias("quantity"),
    )


def lines(spark, folder) -> DataFrame:
    """Order lines; ``(order_id, line_no, supplier, item_id)`` tells them apart."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )


def deliveries(spark, folder) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("c_nationkey") * 1.5).cast("double").alias("distance_km"),
    )

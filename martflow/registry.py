"""All named queries as ``name -> f(spark, folder)``, run over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from martflow import fixtures as fx
from martflow import schemas
from martflow.functions.text import four_digit_year
from martflow.operators import clean, curated, ingest, ledger, quality
from martflow.plans import jobs, loyalty, orders, products, reports, sensors, star
from martflow.session import materialize, run_folder
from martflow.sources import checked, files, sinks, tables, versioned
from martflow.streaming import changes, discovery

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROMOTION_END = date(1999, 12, 31)
MARK = datetime(2001, 1, 1)
LAST_KEY = 12_000
BUCKETS = 8  # of stored tables that are joined on their key; on a cluster, a file size of some 200 MB
RAW_SALES = [f for f in schemas.PAST_SALES.fieldNames()]


def query(f: Query) -> Query:
    """Register under the function's name; exact decimals leave as doubles."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = f(spark, folder)
        return df.select(
            *[
                F.col(c.name).cast("double").alias(c.name)
                if isinstance(c.dataType, DecimalType)
                else F.col(f"`{c.name}`")
                for c in df.schema.fields
            ]
        )

    QUERIES[f.__name__] = run
    return f


# -- loyalty -------------------------------------------------------------------------


@query
def customer_total_spent(spark, folder):
    return loyalty.total_spent(fx.sales(spark, folder), fx.menu_partial(spark, folder))


@query
def customer_visit_days(spark, folder):
    return loyalty.visit_days(fx.sales(spark, folder))


@query
def customer_first_product(spark, folder):
    return loyalty.first_product(
        fx.sales(spark, folder),
        fx.menu_partial(spark, folder),
        ("order_key", "line_no", "product_id"),
    )


@query
def top_product(spark, folder):
    return loyalty.top_product(fx.sales(spark, folder), fx.menu(spark, folder))


@query
def favourite_products_by_name(spark, folder):
    return loyalty.favourite_products(fx.sales(spark, folder), fx.menu(spark, folder))


@query
def favourite_products_by_id(spark, folder):
    return loyalty.favourite_products(
        fx.sales(spark, folder), fx.menu_partial(spark, folder), by="product_id"
    )


def _loyalty(spark, folder, menu=fx.menu):
    return fx.sales(spark, folder), menu(spark, folder), fx.members(spark, folder)


@query
def first_purchase_after_join(spark, folder):
    return loyalty.first_purchase_after_join(*_loyalty(spark, folder))


@query
def first_purchase_after_join_partial_menu(spark, folder):
    return loyalty.first_purchase_after_join(*_loyalty(spark, folder, fx.menu_partial))


@query
def first_purchase_before_join(spark, folder):
    return loyalty.first_purchase_before_join(*_loyalty(spark, folder))


@query
def first_purchase_before_join_dates(spark, folder):
    return loyalty.first_purchase_before_join(*_loyalty(spark, folder), dates=True)


@query
def spend_before_join(spark, folder):
    return loyalty.spend_before_join(*_loyalty(spark, folder))


@query
def loyalty_points(spark, folder):
    return loyalty.loyalty_points(fx.sales(spark, folder), fx.menu(spark, folder))


@query
def promo_points_as_written(spark, folder):
    return loyalty.promotion_points(*_loyalty(spark, folder), until=PROMOTION_END)


@query
def promo_points_first_week(spark, folder):
    return loyalty.promotion_points(
        *_loyalty(spark, folder), until=PROMOTION_END, window="first_week"
    )


# -- products ------------------------------------------------------------------------


@query
def product_key_parts(spark, folder):
    parts = products.with_key_parts(fx.products(spark, folder))
    return parts.groupBy("product_number", "storeid", "productid").agg(
        F.count("*").alias("products")
    )


@query
def product_year(spark, folder):
    rows = fx.products(spark, folder)
    return rows.select(
        "product_number", "product_name", "length", four_digit_year("product_name").alias("year")
    )


@query
def product_size_bucket(spark, folder):
    sized = products.with_size(fx.products(spark, folder))
    return sized.groupBy("product_size").agg(F.count("*").alias("products"))


@query
def cleaned_products(spark, folder):
    return products.cleaned_products(fx.products(spark, folder))


@query
def category_size_pivot(spark, folder):
    return products.size_pivot(products.cleaned_products(fx.products(spark, folder)))


@query
def second_longest_per_category(spark, folder):
    return products.nth_longest(products.cleaned_products(fx.products(spark, folder)))


# -- sensors -------------------------------------------------------------------------


@query
def sensor_max(spark, folder):
    return sensors.highest_reading(sensors.readings(fx.reading_lines(spark, folder)))


@query
def sensor_hot_counts(spark, folder):
    return sensors.hot_counts(sensors.readings(fx.reading_lines(spark, folder)))


@query
def sensor_rejects(spark, folder):
    parsed = files.parse_delimited(fx.reading_lines(spark, folder), schemas.READINGS)
    return files.reject_counts(parsed)


# -- cleaning and quality ------------------------------------------------------------


def _events_typed(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "user_id",
        "event_type",
        F.round(F.col("value").cast("double"), 6).alias("value"),
        F.col("date").cast("date").alias("date"),
    )


def _impute(df: DataFrame) -> DataFrame:
    return clean.clean_impute(
        df, ["value"], ["event_type"], "date", order_by=["event_id"], partition_by=["user_id"]
    )


@query
def missing_profile(spark, folder):
    return quality.missing_counts(fx.raw_events(spark, folder))


@query
def duplicate_profile(spark, folder):
    return quality.duplicate_counts(fx.raw_events(spark, folder))


@query
def full_profile(spark, folder):
    return quality.profile(fx.raw_events(spark, folder))


@query
def label_profile(spark, folder):
    docs, labels = fx.table(spark, folder, "documents"), fx.table(spark, folder, "labels")
    return quality.missing_counts(docs.join(labels, "doc_id", "left"))


@query
def outliers_removed(spark, folder):
    events = fx.table(spark, folder, "events")
    return clean.drop_outliers(events.select("event_id", "value"), ["value"])


@query
def outlier_report(spark, folder):
    events = fx.table(spark, folder, "events")
    return quality.outlier_counts(events, ["value", "user_id"])


@query
def quality_checks(spark, folder):
    events = fx.table(spark, folder, "events")
    return quality.validate(events, ["value"])


@query
def quality_verdict(spark, folder):
    events = fx.table(spark, folder, "events")
    return quality.verdict(quality.validate(events, ["value"]))


@query
def clean_drop_rows(spark, folder):
    return _events_typed(clean.clean_drop(fx.raw_events(spark, folder)))


@query
def impute_mean(spark, folder):
    raw = clean.blank_to_null(fx.raw_events(spark, folder)).dropDuplicates()
    filled = clean.impute_mean(raw, ["value"])
    return filled.select("event_id", F.round("value", 6).alias("value"))


@query
def impute_mode(spark, folder):
    raw = clean.blank_to_null(fx.raw_events(spark, folder)).dropDuplicates()
    raw = materialize(raw.select("event_id", "event_type"), "without-copies")
    return clean.impute_mode(raw, ["event_type"])


@query
def impute_mode_events(spark, folder):
    """All text columns of the raw events, blanks as missing."""
    raw = clean.blank_to_null(fx.raw_events(spark, folder).select("event_id", "event_type", "props"))
    return clean.impute_mode(raw, ["event_type", "props"])


@query
def impute_mode_documents(spark, folder):
    """All text columns of the documents, whole texts included, blanks as missing."""
    docs = clean.blank_to_null(fx.raw_documents(spark, folder))
    return clean.impute_mode(docs, ["text", "lang", "source"])


@query
def forward_fill_date(spark, folder):
    raw = clean.blank_to_null(fx.raw_events(spark, folder)).dropDuplicates()
    return clean.fill_dates(raw, "date", ["event_id"], ["user_id"]).select("event_id", "date")


@query
def forward_fill_date_global(spark, folder):
    raw = clean.blank_to_null(fx.raw_events(spark, folder)).dropDuplicates()
    return clean.fill_dates(raw, "date", ["event_id"]).select("event_id", "date")


@query
def clean_impute_rows(spark, folder):
    return _events_typed(_impute(fx.raw_events(spark, folder)))


@query
def merge_increment(spark, folder):
    raw = fx.raw_events(spark, folder)
    late = F.coalesce(F.col("date") >= "2024-01-20", F.lit(False))
    return _events_typed(clean.merge_increment(raw.filter(~late), raw.filter(late), _impute))


@query
def merge_increment_drop(spark, folder):
    raw = fx.raw_events(spark, folder)
    late = F.coalesce(F.col("date") >= "2024-01-20", F.lit(False))
    return _events_typed(
        clean.merge_increment(raw.filter(~late), raw.filter(late), clean.clean_drop)
    )


@query
def merge_increment_stateful(spark, folder):
    """A history and two increments; the second sends some of the first rows again."""
    raw = fx.raw_events(spark, folder)
    rules = curated.Rules(["value"], ["event_type"], "date", ["event_id"], ["user_id"])
    store = curated.Curated(spark, run_folder(spark, "curated"), raw.schema, rules)
    day = F.coalesce("date", F.lit("2024-01-01"))
    store.append(raw.filter(day < "2024-01-10"))
    store.append(raw.filter((day >= "2024-01-10") & (day < "2024-01-20")))
    store.append(raw.filter((day >= "2024-01-20") | (F.col("event_id") % 100 == 0)))
    return _events_typed(store.read())


@query
def constraint_violations(spark, folder):
    docs, labels = fx.table(spark, folder, "documents"), fx.table(spark, folder, "labels")
    rows = docs.select("doc_id", "lang").join(labels, "doc_id", "left")
    return quality.check_constraints(
        rows, not_null=["lang", "quality"], unique=[["doc_id"]], foreign={"doc_id": (labels, "doc_id")}
    )


# -- incremental loading -------------------------------------------------------------


@query
def high_water_mark(spark, folder):
    return ingest.high_water_mark(fx.table(spark, folder, "orders"), "o_orderdate", "o_orderkey")


@query
def fetch_since_mark(spark, folder):
    src = fx.table(spark, folder, "orders")
    return ingest.fetch_since(src, "o_orderdate", MARK, 100, key="o_orderkey").select(
        "o_orderkey", "o_orderdate"
    )


@query
def all_since_mark(spark, folder):
    src = fx.table(spark, folder, "orders")
    return ingest.fetch_since(
        src, "o_orderdate", MARK, key="o_orderkey", key_value=LAST_KEY
    ).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query
def stamped_batch(spark, folder):
    src = fx.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    batch = ingest.stamp_new(src, 100, ["o_orderdate", "o_orderkey"], MARK)
    return batch.withColumn("last_modified", F.col("last_modified").cast("timestamp_ntz"))


@query
def load_by_key(spark, folder):
    src = fx.table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    return ingest.load_by_key(src, "l_orderkey", LAST_KEY, ordered=False)


@query
def next_load_key(spark, folder):
    src = fx.table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    loaded = ingest.load_by_key(src, "l_orderkey", LAST_KEY, ordered=False)
    return ingest.new_last_key(loaded, "l_orderkey", LAST_KEY).select(
        F.col("l_orderkey").cast("bigint").alias("last_key")
    )


@query
def incremental_job(spark, folder):
    """Two runs over a growing file: the second finds the rows of the first in it again, and late ones
    whose keys lie between and below them."""
    run = run_folder(spark, "incremental")
    orders = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, last_modified timestamp"
    target = f"{run}/target"
    spark.createDataFrame([], schema).write.parquet(target)
    marks = ingest.MarkStore(spark, f"{run}/marks", "last_modified timestamp, o_orderkey bigint")
    known = ledger.Ledger(spark, f"{run}/ledger", "o_orderkey", width=1000)
    extracts = []
    early = (F.col("o_orderkey") > 100) & (F.col("o_orderkey") % 7 != 0)
    for k, rows in enumerate((orders.filter(early & (F.col("o_orderkey") <= LAST_KEY)), orders)):
        sinks.write_csv(rows, f"{run}/source{k}")
        feed = ingest.Feed(
            name="orders",
            source_path=f"{run}/source{k}",
            target=lambda: spark.read.schema(schema).parquet(target),
            append=lambda df: df.select(*[f.split()[0] for f in schema.split(", ")])
            .write.mode("append").parquet(target),
            extract_path=f"{run}/extract{k}",
            order_by=["o_orderkey"],
            marks=marks,
            ledger=known,
        )
        if ingest.run_incremental(spark, [feed])["orders"]:
            extracts.append(f"{run}/extract{k}")
    found = files.read_csv(spark, extracts, schema=schema)
    return found.drop("last_modified")


@query
def incremental_files(spark, folder):
    """Three runs over a folder that grows; each reads new files only, and keys stored before stay out."""
    run = run_folder(spark, "files")
    orders = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    n = F.col("o_orderkey")
    for k, test in enumerate((n % 3 == 0, n % 3 == 1, (n % 3 == 2) | (n % 6 == 0))):
        sinks.write_csv(orders.filter(test), f"{run}/source/part{k}")
        found = discovery.new_files(spark, f"{run}/source", orders.schema)
        discovery.load_new_files(found, f"{run}/target", f"{run}/checkpoint", "o_orderkey").awaitTermination()
    stored = discovery.stored_rows(spark, f"{run}/target", found.schema)
    named = F.regexp_extract(discovery.SOURCE_FILE, "part([0-9])/", 1).cast("bigint")
    return stored.withColumn("part", named).drop(discovery.SOURCE_FILE)


# -- star schema ---------------------------------------------------------------------


@query
def typed_load(spark, folder):
    return star.typed_load(fx.past_sales_raw(spark, folder), schemas.PAST_SALES).withColumn(
        "weekly_sales", F.round(F.col("weekly_sales").cast("double"), 2)
    )


@query
def typed_load_summary(spark, folder):
    return star.load_summary(fx.past_sales_raw(spark, folder), schemas.PAST_SALES)


@query
def dim_store(spark, folder):
    return star.dim_store(fx.store(spark, folder))


@query
def dim_date(spark, folder):
    return star.dim_date(fx.past_sales(spark, folder))


@query
def dim_date_guarded(spark, folder):
    return star.dim_date_guarded(
        fx.past_sales_text(spark, folder), fx.new_sales_text(spark, folder)
    )


@query
def dim_department(spark, folder):
    return star.dim_department(fx.past_sales(spark, folder))


@query
def dim_holiday(spark, folder):
    return star.dim_holiday(fx.past_sales(spark, folder), fx.new_sales(spark, folder))


@query
def dim_features(spark, folder):
    return star.dim_features(fx.features(spark, folder))


@query
def dim_features_dense(spark, folder):
    return star.dim_features(fx.features(spark, folder), ids="dense")


def _fact(spark, folder):
    return star.fact_sales(
        fx.past_sales(spark, folder), star.with_feature_id(fx.features(spark, folder))
    )


@query
def fact_sales(spark, folder):
    return _fact(spark, folder)


def _bucketed_facts(spark, folder):
    """Facts from sales and features stored by (store, date), and the names of those tables."""
    sides = {
        "sales": fx.past_sales(spark, folder),
        "features": star.with_feature_id(fx.features(spark, folder)),
    }
    stored = []
    for kind, rows in sides.items():
        path, name = _fresh_table(spark, kind)
        stored.append(name)
        tables.write_table(rows, name, "parquet", path, bucket_by=(BUCKETS, ["store", "date"]))
    return star.fact_sales(*map(spark.table, stored)), stored


@query
def fact_sales_bucketed(spark, folder):
    """The join finds each bucket's rows together."""
    facts, stored = _bucketed_facts(spark, folder)
    facts = materialize(facts, "facts")
    for name in stored:
        tables.drop_table(spark, name)
    return facts


@query
def fact_sales_all(spark, folder):
    # One narrow stored table serves both sales tables.
    sales = fx.all_sales_text(spark, folder)
    sales = materialize(sales.withColumn("date", star.guarded_date("date")), "sales")
    return star.fact_sales_all(
        sales.filter("past"),
        sales.filter("NOT past"),
        star.with_feature_id(fx.features(spark, folder)),
        star.dim_store(fx.store(spark, folder)),
    )


@query
def wide_sales(spark, folder):
    return star.wide_sales(
        fx.past_sales(spark, folder).drop("last_modified"),
        fx.features(spark, folder),
        fx.store(spark, folder),
    )


@query
def renamed_sales(spark, folder):
    return star.renamed_sales(fx.past_sales(spark, folder))


@query
def right_join_by_store(spark, folder):
    return star.store_join_summary(fx.features(spark, folder), fx.past_sales(spark, folder))


# -- reports -------------------------------------------------------------------------


def _known_totals(spark, folder):
    return star.known_totals(fx.past_sales(spark, folder), fx.features(spark, folder))


@query
def sales_over_time(spark, folder):
    return reports.sales_over_time(_known_totals(spark, folder))


@query
def sales_by_month(spark, folder):
    return reports.sales_by_month(_known_totals(spark, folder))


@query
def holiday_sales(spark, folder):
    return reports.holiday_sales(
        _known_totals(spark, folder), star.dim_holiday(fx.past_sales(spark, folder))
    )


def _driven(spark, folder):
    # The stored dimension serves the fact and the report; it is aggregated once.
    features = materialize(star.with_feature_id(fx.features(spark, folder)), "features")
    return reports.sales_with_drivers(star.fact_sales(fx.past_sales(spark, folder), features), features)


@query
def sales_with_drivers(spark, folder):
    return _driven(spark, folder).select(
        "store_id", "date_id", "weekly_sales", "fuel_price", "cpi", "unemployment"
    )


@query
def driver_correlations(spark, folder):
    return reports.driver_correlations(_driven(spark, folder)).select(
        "driver",
        "pairs",
        F.round("correlation", 6).alias("correlation"),
        F.round("slope", 3).alias("slope"),
    )


@query
def driver_bins(spark, folder):
    return reports.driver_bins(_driven(spark, folder), "unemployment", 5).withColumn(
        "mean_sales", F.round(F.col("mean_sales").cast("double"), 2)
    )


# -- orders --------------------------------------------------------------------------


@query
def cart_lines(spark, folder):
    return orders.order_lines(
        fx.lines(spark, folder).select("order_id", "line_no", "item_id", "quantity"),
        fx.items(spark, folder),
    )


REQUEST_ORDER = ("order_id", "line_no", "supplier", "quantity")


def _placed(spark, folder):
    """Lines that went into a cart. A returned line asks for nothing, which is refused."""
    asked = F.when(~F.col("returned"), F.col("quantity"))
    requests = fx.lines(spark, folder).withColumn("quantity", asked).drop("returned")
    settled = orders.allocate_stock(requests, fx.items(spark, folder), REQUEST_ORDER)
    return materialize(orders.accepted_lines(settled), "accepted")


def _totals(spark, folder):
    return orders.order_totals(_placed(spark, folder), fx.items(spark, folder))


@query
def order_totals(spark, folder):
    return _totals(spark, folder)


@query
def order_bills(spark, folder):
    return orders.order_bills(_totals(spark, folder), fx.deliveries(spark, folder))


@query
def undeliverable_orders(spark, folder):
    return orders.undeliverable_orders(_totals(spark, folder), fx.deliveries(spark, folder))


@query
def stock_allocation(spark, folder):
    requests = fx.lines(spark, folder).drop("returned")
    return orders.allocate_stock(requests, fx.items(spark, folder), REQUEST_ORDER)


def _cart(spark, folder):
    signed = F.when(F.col("returned"), -F.col("quantity")).otherwise(F.col("quantity"))
    requests = fx.lines(spark, folder).withColumn("quantity", signed).drop("returned")
    limits = fx.items(spark, folder, 200).select("item_id", F.col("quantity").alias("opening"))
    return orders.settle_cart(requests, limits, ["item_id"], REQUEST_ORDER)


@query
def cart_requests(spark, folder):
    return _cart(spark, folder)


@query
def cart_after_removals(spark, folder):
    return orders.cart_contents(_cart(spark, folder), ["item_id"])


def _headers(spark, folder, lines):
    totals = orders.order_totals(lines, fx.items(spark, folder))
    bills = orders.order_bills(totals, fx.deliveries(spark, folder))
    stamp = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    return orders.placed_orders(bills, stamp)


@query
def placed_orders(spark, folder):
    return _headers(spark, folder, _placed(spark, folder))


@query
def placed_order_lines(spark, folder):
    lines = _placed(spark, folder)
    return orders.placed_order_lines(_headers(spark, folder, lines), lines)


@query
def remaining_stock(spark, folder):
    return orders.remaining_stock(fx.items(spark, folder), _placed(spark, folder))


# -- change feed ---------------------------------------------------------------------

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, ts string"


def _decoded(messages: DataFrame) -> DataFrame:
    rows = changes.decode(messages, EVENT_SCHEMA)
    return rows.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        changes.leading_date("ts").alias("date"),
    )


@query
def changes_encoded(spark, folder):
    return fx.event_messages(fx.table(spark, folder, "events"))


@query
def changes_decoded(spark, folder):
    return _decoded(fx.event_messages(fx.table(spark, folder, "events")))


@query
def sales_changes_decoded(spark, folder):
    past = fx.past_sales(spark, folder).withColumnRenamed("store", "store_id")
    rows = changes.decode_changes(changes.change_messages(past))
    return rows.select(
        "store_id",
        "dept",
        "date",
        F.round(F.col("weekly_sales").cast("double"), 2).alias("weekly_sales"),
        "isholiday",
        F.col("last_modified").cast("timestamp_ntz").alias("last_modified"),
    )


@query
def captured_changes(spark, folder):
    run = run_folder(spark, "capture")
    marks = ingest.MarkStore(
        spark, f"{run}/marks", "step int, o_orderdate timestamp_ntz, o_orderkey bigint"
    )
    src = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sent = changes.capture_changes(src, f"{run}/outbox", marks, "o_orderdate", "o_orderkey", MARK)
    return changes.decode(sent, "o_orderkey bigint, o_custkey bigint")


@query
def stream_changes_to_table(spark, folder):
    """Messages in three batches, versions of one key spread over them; read from the kept state."""
    run = run_folder(spark, "changes")
    messages = fx.event_feed(fx.table(spark, folder, "events"))
    for k in range(3):
        part = F.pmod(F.xxhash64("value"), F.lit(3)) == k
        messages.filter(part).write.mode("append").text(f"{run}/topic")
        feed = changes.readable(changes.read_changes(spark, "text", {"path": f"{run}/topic"}))
        rows = changes.decode(feed, EVENT_SCHEMA)
        changes.keep_latest(rows, ["event_id"], "ts", f"{run}/table", f"{run}/checkpoint").awaitTermination()
    latest = changes.current_versions(spark, f"{run}/checkpoint", rows.columns)
    return latest.withColumn("date", changes.leading_date("ts")).drop("ts")


@query
def stream_changes_logged(spark, folder):
    """Every message stored by batch; the latest version of a key is looked for when the table is read."""
    run = run_folder(spark, "changes")
    feed = changes.readable(fx.event_feed(fx.event_stream(spark, folder)))
    rows = changes.decode(feed, EVENT_SCHEMA)
    schema = rows.schema
    changes.to_table(rows, f"{run}/table", f"{run}/checkpoint").awaitTermination()
    stored = spark.read.schema(schema).parquet(f"{run}/table").drop("batch")
    latest = changes.unique_changes(stored, ["event_id"], "ts")
    return latest.withColumn("date", changes.leading_date("ts")).drop("ts")


@query
def published_changes(spark, folder):
    """All events sent as messages to files, then read from there as a consumer does."""
    run = run_folder(spark, "topic")
    sinks.publish(fx.table(spark, folder, "events").drop("props"), "text", path=f"{run}/topic")
    return _decoded(spark.read.text(f"{run}/topic"))


@query
def unreadable_changes(spark, folder):
    return changes.unreadable(fx.event_feed(fx.table(spark, folder, "events")))


@query
def stream_changes_to_json(spark, folder):
    run = run_folder(spark, "changes")
    rows = _decoded(fx.event_messages(fx.event_stream(spark, folder)))
    schema = rows.schema
    changes.to_json_files(rows, f"{run}/json", f"{run}/checkpoint").awaitTermination()
    return spark.read.schema(schema).json(f"{run}/json")


# -- sources and sinks ---------------------------------------------------------------


@query
def csv_roundtrip(spark, folder):
    path = run_folder(spark, "csv")
    rows = fx.past_sales_raw(spark, folder)
    sinks.write_csv(rows, path)
    return files.read_csv(spark, path)


@query
def typed_csv_roundtrip(spark, folder):
    path = run_folder(spark, "csv")
    rows = fx.past_sales(spark, folder).drop("last_modified")
    sinks.write_csv(rows, path)
    return files.read_csv(spark, path, schema=rows.schema)


def _scanned(spark, name):
    """What a scan of the table finds; the definition goes, so that calls leave no tables behind."""
    rows = materialize(tables.scan(spark, name), "scan")
    tables.drop_table(spark, name)
    return rows


def _fresh_table(spark, kind):
    path = run_folder(spark, kind)
    return path, "martflow_" + path.rsplit("-", 1)[1]


@query
def orc_table_roundtrip(spark, folder):
    path, name = _fresh_table(spark, "orc")
    store = star.dim_store(fx.store(spark, folder))
    tables.load_table(store, name, store.schema, path)
    return _scanned(spark, name)


@query
def external_csv_table(spark, folder):
    path, name = _fresh_table(spark, "csv")
    rows = star.dim_date(fx.past_sales(spark, folder))
    sinks.write_csv(rows, path, header=False)
    files.register_external_csv(spark, name, rows.schema, path)
    return _scanned(spark, name)


def _catalogued(spark, folder, fmt):
    path, name = _fresh_table(spark, fmt)
    rows = fx.past_sales(spark, folder).drop("last_modified")
    for _ in range(2):  # written over: the second time replaces the first
        tables.write_table(rows, name, fmt, path)
    return _scanned(spark, name)


@query
def csv_table_with_catalog(spark, folder):
    return _catalogued(spark, folder, "csv")


@query
def parquet_table_with_catalog(spark, folder):
    return _catalogued(spark, folder, "parquet")


@query
def orc_table_overwritten(spark, folder):
    return _catalogued(spark, folder, "orc")


@query
def inferred_csv(spark, folder):
    path = run_folder(spark, "csv")
    sinks.write_csv(fx.past_sales(spark, folder).drop("last_modified", "date"), path)
    return files.read_csv(spark, path, infer=True)


@query
def ddl_csv(spark, folder):
    path = run_folder(spark, "csv")
    sinks.write_csv(fx.store(spark, folder), path)
    return files.read_csv(spark, path, schema="store int, type string, size int")


@query
def csv_rejects(spark, folder):
    """All order lines as delimited text with planted faults, read under their declared types."""
    path, n = run_folder(spark, "csv"), F.col("l_orderkey")
    lines = fx.table(spark, folder, "lineitem")
    cells = [
        n.cast("string"),
        F.col("l_linenumber").cast("string"),
        F.when(n % 97 == 0, "n/a").otherwise(F.col("l_quantity").cast("string")),
        F.when(n % 89 == 0, "2024-13-45").otherwise(F.to_date("l_shipdate").cast("string")),
        F.when(n % 73 == 0, "").otherwise(F.col("l_returnflag")),
    ]
    whole = F.concat_ws(",", *cells)
    short = F.concat_ws(",", *cells[:4])
    text = F.when(n % 83 == 0, short).when(n % 79 == 0, F.concat(whole, F.lit(",more"))).otherwise(whole)
    lines.select(text).write.text(path)
    schema = StructType.fromDDL("l_orderkey bigint, l_linenumber int, l_quantity double, l_shipdate date, l_returnflag string")
    return checked.reject_summary(checked.read_csv_checked(spark, path, schema, header=False))


def _pinned(spark, folder):
    """Two files of orders: the second has a wider price, texts among the customers, a new and no old column."""
    run, n = run_folder(spark, "pinned"), F.col("o_orderkey")
    orders = fx.table(spark, folder, "orders").withColumn("price", F.floor("o_totalprice").cast("int"))
    first = orders.filter(n % 2 == 0).select("o_orderkey", "o_custkey", "price", F.lit(1).alias("lane"))
    odd = F.when(n % 11 == 0, "unknown").otherwise(F.col("o_custkey").cast("string"))
    second = orders.filter(n % 2 == 1).select(
        F.lit("web").alias("channel"), "o_orderkey", odd.alias("o_custkey"), (F.col("price") + 0.5).alias("price")
    )
    pins = checked.PinnedSchema(spark, f"{run}/types")
    found = []
    for k, rows in enumerate((first, second)):
        sinks.write_csv(rows, f"{run}/file{k}")
        found.append(pins.read(f"{run}/file{k}"))
    return found


@query
def pinned_rows(spark, folder):
    (one, _), (two, _) = _pinned(spark, folder)
    rows = checked.fitting(one).unionByName(checked.fitting(two), allowMissingColumns=True)
    return rows.select("o_orderkey", "o_custkey", F.col("price").cast("double").alias("price"), "lane", "channel")


@query
def schema_drift(spark, folder):
    """How the second file differs from the pinned types, and how many of its cells did not fit."""
    _, (rows, changes_found) = _pinned(spark, folder)
    misfits = checked.reject_summary(rows).filter("kind = 'type'").select("column", "cells")
    return changes_found.join(misfits, "column", "left").fillna({"cells": 0})


@query
def recursive_csv(spark, folder):
    path = run_folder(spark, "csv")
    rows = fx.past_sales(spark, folder).drop("last_modified")
    for flag in (True, False):
        part = rows.filter(F.col("isholiday") == flag)
        sinks.write_csv(part, f"{path}/sales/holiday_{flag}".lower())
    return files.read_csv(spark, path, schema=rows.schema, recursive=True)


@query
def replaced_if_any(spark, folder):
    """Replaced by all rows, then by none of them, which leaves the table as it is."""
    store = star.dim_store(fx.store(spark, folder))
    table = versioned.VersionedTable(spark, run_folder(spark, "csv"), store.schema, "csv", header="true")
    for rows in (store.filter("store_id < 3"), store, store.filter("store_id IS NULL")):
        table.replace_if_any(rows)
    return table.read()


@query
def replaced_csv_if_any(spark, folder):
    """The same with a plain folder, which is replaced in place."""
    path = run_folder(spark, "csv")
    store = star.dim_store(fx.store(spark, folder))
    for rows in (store.filter("store_id < 3"), store, store.filter("store_id IS NULL")):
        sinks.write_csv_if_any(rows, path)
    return files.read_csv(spark, path, schema=store.schema)


@query
def fact_sales_by_month(spark, folder):
    """Facts stored by year and month, every second month first without its amounts and then replaced."""
    path = run_folder(spark, "facts")
    facts = _fact(spark, folder).drop("last_modified")
    facts = materialize(facts.withColumns({"year": F.year("date_id"), "month": F.month("date_id")}), "facts")
    even = F.col("month") % 2 == 0
    wrong = F.when(~even, F.col("weekly_sales"))
    versioned.replace_partitions(facts.withColumn("weekly_sales", wrong), path, ["year", "month"])
    versioned.replace_partitions(facts.filter(even), path, ["year", "month"])
    return spark.read.schema(facts.schema).parquet(path)


@query
def unloaded_tables(spark, folder):
    path = run_folder(spark, "unload")
    past = fx.past_sales(spark, folder)
    parts = {"dim_date": star.dim_date(past), "dim_date_again": star.dim_date(past)}
    jobs.unload(parts, path)
    return files.read_csv(spark, f"{path}/*", schema=parts["dim_date"].schema, header=False)


@query
def appended_extract(spark, folder):
    path = run_folder(spark, "csv")
    orders = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    for part in (F.col("o_orderkey") <= LAST_KEY, F.col("o_orderkey") > LAST_KEY):
        sinks.write_csv(ingest.load_by_key(orders.filter(part), "o_orderkey"), path, mode="append")
    return files.read_csv(spark, path, schema=orders.schema)


@query
def seeded_table(spark, folder):
    """A declared table with two seed rows, the items appended, and its description counted."""
    path, name = _fresh_table(spark, "items")
    tables.create_external(spark, name, schemas.ITEMS, path, "PARQUET")
    tables.append_rows(spark, name, [(-1, "sample one"), (-2, "sample two")], ["id", "item"])
    items = fx.items(spark, folder).select(
        F.col("item_id").cast("int").alias("id"), "item", F.col("cost").cast("decimal(10,2)").alias("cost"), "quantity"
    )
    items.write.insertInto(name)
    columns = tables.describe(spark, name).count()
    return _scanned(spark, name).withColumn("columns", F.lit(columns).cast("bigint"))


@query
def json_roundtrip(spark, folder):
    path = run_folder(spark, "json")
    rows = _decoded(fx.event_messages(fx.table(spark, folder, "events")))
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)

"""Loyalty, products, sensors, star schema, reports and orders on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martflow import schemas
from martflow.operators.quality import check_constraints
from martflow.plans import loyalty, orders, products, reports, sensors, star
from martflow.sources.files import accepted, parse_delimited, reject_counts


def d(text):
    return date.fromisoformat(text)


@pytest.fixture(scope="module")
def shop(spark):
    sales = [
        # customer, day, product
        ("A", "2021-01-01", 1),
        ("A", "2021-01-01", 2),
        ("A", "2021-01-07", 2),
        ("A", "2021-01-14", 3),
        ("A", "2021-01-15", 3),
        ("B", "2021-01-01", 2),
        ("B", "2021-01-01", 2),  # twice on one day
        ("B", "2021-02-01", 1),
        ("C", "2021-01-03", 4),  # ids 3 and 4 share a name; C is not a member
        ("C", "2021-01-03", 3),
        ("C", "2021-01-04", 9),  # not on the menu
        ("C", "2021-01-05", 9),
        ("D", "2020-12-01", 9),
        ("D", "2021-01-20", 1),
    ]
    menu = [(1, "sushi", "10"), (2, "curry", "15"), (3, "ramen", "12"), (4, "ramen", "13")]
    members = [("A", "2021-01-07"), ("B", "2021-01-09"), ("D", "2021-01-05")]
    return (
        spark.createDataFrame(sales, "customer_id string, order_date string, product_id int").withColumn(
            "order_date", F.to_date("order_date")
        ),
        spark.createDataFrame(menu, "product_id int, product_name string, price string").withColumn(
            "price", F.col("price").cast("decimal(10,2)")
        ),
        spark.createDataFrame(members, "customer_id string, join_date string").withColumn(
            "join_date", F.to_date("join_date")
        ),
    )


def test_spending_keeps_customers_without_known_products(shop):
    sales, menu, _ = shop
    got = dict(map(tuple, loyalty.total_spent(sales, menu).collect()))
    assert got == {"A": Decimal(64), "B": Decimal(40), "C": Decimal(25), "D": Decimal(10)}
    only_unknown = loyalty.total_spent(sales.filter("product_id = 9"), menu)
    assert {r.total_spent for r in only_unknown.collect()} == {None}


def test_visits_and_first_products(shop, rows):
    sales, menu, _ = shop
    assert rows(loyalty.visit_days(sales)) == [("A", 4), ("B", 2), ("C", 3), ("D", 2)]
    stamped = sales.withColumn("order_date", F.col("order_date").cast("timestamp") + F.expr("interval 5 hours"))
    assert rows(loyalty.visit_days(stamped.union(sales))) == [("A", 4), ("B", 2), ("C", 3), ("D", 2)]
    assert rows(loyalty.first_product(sales, menu)) == [
        ("A", "sushi"),
        ("B", "curry"),
        ("C", "ramen"),
        ("D", "sushi"),
    ]


def test_top_product_breaks_ties_and_may_be_unknown(shop, rows):
    sales, menu, _ = shop
    assert rows(loyalty.top_product(sales, menu)) == [("curry", 4)]
    tied = sales.filter("product_id in (1, 3)")
    assert rows(loyalty.top_product(tied, menu)) == [("sushi", 3)]
    assert rows(loyalty.top_product(sales.filter("product_id = 9"), menu)) == []


def test_favourites_by_name_and_by_id_differ(shop, rows):
    sales, menu, _ = shop
    assert rows(loyalty.favourite_products(sales, menu)) == [
        ("A", "curry", 2),
        ("A", "ramen", 2),
        ("B", "curry", 2),
        ("C", "ramen", 2),
        ("D", "sushi", 1),
    ]
    by_id = rows(loyalty.favourite_products(sales, menu, by="product_id"))
    assert ("C", "ramen", 2) in by_id and ("C", None, 2) in by_id
    assert ("D", None, 1) in by_id
    # ids 3 and 4 together are bought more often than any single id: no name matches
    more = sales.filter("product_id in (3, 4) and customer_id = 'C'")
    assert rows(loyalty.favourite_products(more, menu, by="product_id")) == []
    with pytest.raises(ValueError):
        loyalty.favourite_products(sales, menu, by="x")


def test_first_purchases_around_joining(shop, rows):
    sales, menu, members = shop
    after = loyalty.first_purchase_after_join(sales, menu, members)
    assert rows(after) == [
        ("A", "curry", d("2021-01-07"), d("2021-01-07")),
        ("B", "sushi", d("2021-01-09"), d("2021-02-01")),
        ("D", "sushi", d("2021-01-05"), d("2021-01-20")),
    ]
    before = loyalty.first_purchase_before_join(sales, menu, members)
    assert rows(before) == [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("B", "curry")]
    dated = loyalty.first_purchase_before_join(sales, menu, members, dates=True)
    assert dated.columns == ["customer_id", "product_name", "join_date", "order_date"]
    # an unknown product on an earlier day does not count as the first purchase
    early = sales.unionByName(
        sales.filter("customer_id = 'A'").limit(1).withColumns(
            {"order_date": F.lit(d("2021-01-07")), "product_id": F.lit(9)}
        )
    )
    assert rows(loyalty.first_purchase_after_join(early, menu, members)) == rows(after)


def test_spend_before_joining_and_points(shop, rows):
    sales, menu, members = shop
    assert rows(loyalty.spend_before_join(sales, menu, members)) == [
        ("A", 2, Decimal("25.00")),
        ("B", 2, Decimal("30.00")),
    ]
    got = dict(map(tuple, loyalty.loyalty_points(sales, menu).collect()))
    assert got == {"A": Decimal(740), "B": Decimal(500), "C": Decimal(250), "D": Decimal(200)}


def test_promotion_windows(shop, rows):
    sales, menu, members = shop
    as_is = dict(map(tuple, loyalty.promotion_points(sales, menu, members).collect()))
    # A: joining day 15 * 20, then 12 * 10 twice; D: sushi always doubles; B bought too late
    assert as_is == {"A": Decimal(540), "D": Decimal(200)}
    week = dict(
        map(tuple, loyalty.promotion_points(sales, menu, members, window="first_week").collect())
    )
    # day 7 after joining (14th) still doubles, day 8 (15th) does not
    assert week == {"A": Decimal(300 + 240 + 120), "D": Decimal(200)}
    with pytest.raises(ValueError):
        loyalty.promotion_points(sales, menu, members, window="x")


def test_products(spark, rows):
    data = [
        ("s_1", "pen 1999", "c1", 900.0, 1.0),
        ("s_2", "pen", "c1", 2000.0, 1.0),
        ("s", "cup 2001", "c1", 2000.0, 1.0),
        ("t_1", "mug 12345", "c2", 3500.0, 1.0),
    ]
    df = spark.createDataFrame(
        data, "product_number string, product_name string, product_category string, length double, width double"
    )
    sized = products.with_size(products.with_year(products.with_key_parts(df)))
    pivot = {r[0]: tuple(r)[1:] for r in products.size_pivot(sized).collect()}
    assert pivot == {"c1": (1, 2, None, None), "c2": (None, None, None, 1)}
    assert sum(v or 0 for row in pivot.values() for v in row) == df.count()
    assert rows(products.nth_longest(sized)) == [("c1", "pen", 2000.0)]  # c2 has no second
    assert {r.year for r in sized.collect()} == {"1999", "", "2001"}
    assert products.cleaned_products(df).count() == 4


LINES = ["s1,d,50", "s1,d,50.1", "s1,d,70,", "s2,d,-3", "s2,d,", ",,", "", "a,b,c,4", "s3,d,hot", "s2,d,-1"]


def test_sensor_lines(spark, rows):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    parsed = parse_delimited(lines, schemas.READINGS)
    assert rows(reject_counts(parsed)) == [("arity", 4), ("none", 5), ("type", 1)]
    assert accepted(parsed).columns == ["sensor_id", "date", "temperature"]
    values = sensors.readings(lines)
    assert sensors.highest_reading(values).first()[0] == 70.0
    assert [tuple(r) for r in sensors.hot_counts(values).collect()] == [("s1", 2)]
    cold = values.filter("sensor_id = 's2'")
    assert sensors.highest_reading(cold).first()[0] == -1.0


@pytest.fixture(scope="module")
def retail(spark):
    sales = spark.createDataFrame(
        [
            (1, 1, "2010-02-05", 10.5, False, "2010-02-06 00:00:00"),
            (1, 2, "2010-02-05", 20.0, False, "2010-02-07 00:00:00"),
            (1, 1, "2010-02-12", 30.0, True, "2010-02-13 00:00:00"),
            (2, 1, "2010-02-05", None, False, "2010-02-06 00:00:00"),
            (3, 1, "2010-03-05", 50.0, True, "2010-03-06 00:00:00"),
        ],
        "store int, dept int, date string, weekly_sales double, isholiday boolean, last_modified string",
    ).withColumns({"date": F.to_date("date"), "last_modified": F.to_timestamp("last_modified")})
    features = spark.createDataFrame(
        [(1, "2010-02-05", 3.0, 7.0, 8.0), (1, "2010-02-12", 4.0, 7.5, 8.0), (2, "2010-02-05", 5.0, 7.0, None)],
        "store int, date string, fuel_price double, cpi double, unemployment double",
    ).withColumn("date", F.to_date("date"))
    store = spark.createDataFrame([(1, "A", 10), (1, "A", 10), (2, "B", 20)], "store int, type string, size int")
    return sales, features, store


def test_dimensions_have_unique_keys(retail, spark, rows):
    sales, features, store = retail
    assert rows(star.dim_store(store)) == [(1, "A", 10), (2, "B", 20)]
    assert rows(star.dim_date(sales))[0] == (d("2010-02-05"), 2010, 2, 5)
    holidays = star.dim_holiday(sales, sales)
    assert rows(holidays) == [
        (False, datetime(2010, 2, 7)),
        (True, datetime(2010, 3, 6)),
    ]
    assert star.dim_department(sales).count() == 2
    dims = star.dim_features(features)
    broken = check_constraints(dims, not_null=["feature_id"], unique=[["feature_id"]])
    assert broken.filter("violations > 0").isEmpty()


def test_guarded_dates_keep_one_row_for_all_bad_texts(spark, rows):
    texts = ["2010-02-05", "2010-2-5", "2010-13-45", "", "NA", "2010-02-05"]
    df = spark.createDataFrame([(t,) for t in texts], "date string")
    assert rows(star.dim_date_guarded(df, df)) == [
        (d("2010-02-05"), 2010, 2, 5),
        (None, None, None, None),
    ]


def test_feature_ids(retail, spark):
    _, features, _ = retail
    dense = star.with_feature_id(features, "dense").orderBy("store", "date").collect()
    assert [r.feature_id for r in dense] == [1, 2, 3]
    old = spark.createDataFrame([(-1, d("1960-01-01")), (0, d("1960-01-01"))], "store int, date date")
    packed = star.with_feature_id(old).select("feature_id").distinct()
    assert packed.count() == 2
    with pytest.raises(ValueError):
        star.with_feature_id(features, "random")


def test_facts(retail, rows):
    sales, features, store = retail
    with_id = star.with_feature_id(features)
    fact = star.fact_sales(sales, with_id)
    assert fact.columns == list(schemas.FACT_SALES.fieldNames())
    assert fact.count() == 4  # store 3 has no features
    keys = star.dim_features(features).select("feature_id")
    assert fact.join(keys, "feature_id", "left_anti").isEmpty()
    both = star.fact_sales_all(
        sales.filter("dept = 1"),
        sales.filter("dept = 2"),
        with_id,
        star.dim_store(store),
        star.dim_date(sales),
    )
    assert both.count() == 4


def test_wide_rows_are_complete(retail):
    sales, features, store = retail
    one_row_per_store = store.distinct()
    wide = star.wide_sales(sales, features, one_row_per_store)
    assert wide.count() == 3  # the NULL sale and the store without features are gone
    assert wide.dropna().count() == 3


def test_store_join_summary_equals_the_joined_rows(retail, rows):
    sales, features, _ = retail
    right = star.renamed_sales(sales)
    joined = features.join(right, features["store"] == right["right_store"], "right")
    want = joined.groupBy("right_store").agg(
        F.count("*"),
        F.sum(F.col("right_weekly_sales").cast("decimal(18,2)")).cast("decimal(38,2)"),
        F.sum(F.col("fuel_price").cast("decimal(18,2)")).cast("decimal(38,2)"),
    )
    assert rows(star.store_join_summary(features, sales)) == rows(want)


def test_typed_load_drops_incomplete_rows(spark, rows):
    raw = spark.createDataFrame(
        [
            ("A", "1", "10", "2010-02-05T00:00:00.000Z"),
            ("B", "x", "10", "2010-02-05T00:00:00.000Z"),
            (None, "1", "10", "2010-02-05T00:00:00.000Z"),
            ("C", "2", "5", "not a stamp"),
        ],
        "type string, store string, size string, last_modified string",
    )
    loaded = star.typed_load(raw, schemas.STORE)
    assert rows(loaded) == [(1, "A", 10, d("2010-02-05")), (2, "C", 5, None)]
    assert tuple(star.load_summary(raw, schemas.STORE).first()) == (4, 2, 2)


def test_reports_agree_with_the_facts(retail):
    sales, features, _ = retail
    fact = star.fact_sales(sales, star.with_feature_id(features))
    total = Decimal("60.50")
    assert reports.sales_over_time(fact).agg(F.sum("total_sales")).first()[0] == total
    assert [tuple(r) for r in reports.sales_by_month(fact).collect()] == [(2010, 2, total)]
    by_flag = reports.holiday_sales(fact, star.dim_holiday(sales))
    assert by_flag.agg(F.sum("total_sales")).first()[0] == total
    joined = reports.sales_with_drivers(fact, star.dim_features(features))
    assert joined.count() == fact.count()
    pairs = {r.driver: r.pairs for r in reports.driver_correlations(joined).collect()}
    assert pairs == {"fuel_price": 3, "cpi": 3, "unemployment": 3}
    bins = reports.driver_bins(joined, "fuel_price", 1.0)
    assert bins.agg(F.sum("sales_rows")).first()[0] == 4


@pytest.fixture(scope="module")
def basket(spark):
    items = spark.createDataFrame(
        [(1, "pen", "2.50", 10), (2, "cup", "4.00", 1), (3, "hat", "9.99", 5)],
        "item_id int, item string, cost string, quantity int",
    )
    lines = spark.createDataFrame(
        [(7, 1, 4), (7, 2, 1), (8, 1, 2), (8, 1, 1), (9, 3, 1), (10, 3, 1)],
        "order_id bigint, item_id int, quantity int",
    )
    deliveries = spark.createDataFrame(
        [(7, 15.0), (8, 30.0), (9, 30.01), (10, -2.0)], "order_id bigint, distance_km double"
    )
    return items, lines, deliveries


def test_bills_and_refused_orders(basket, rows):
    items, lines, deliveries = basket
    totals = orders.order_totals(lines, items)
    assert rows(totals) == [
        (10, 1, Decimal("9.99")),
        (7, 2, Decimal("14.00")),
        (8, 2, Decimal("7.50")),
        (9, 1, Decimal("9.99")),
    ]
    bills = orders.order_bills(totals, deliveries)
    assert [(r.order_id, r.total_amount) for r in bills.orderBy("order_id").collect()] == [
        (7, Decimal("64.00")),
        (8, Decimal("107.50")),
    ]
    refused = orders.undeliverable_orders(totals, deliveries)
    assert rows(refused, "order_id", "reason") == [(10, "invalid distance"), (9, "too far")]


def test_placed_orders_get_gapless_ids(basket, rows):
    items, lines, deliveries = basket
    bills = orders.order_bills(orders.order_totals(lines, items), deliveries)
    headers = orders.placed_orders(bills, start_after=100)
    assert rows(headers, "id", "order_id") == [(101, 7), (102, 8)]
    placed = orders.placed_order_lines(headers, lines)
    assert rows(placed) == [(1, 101, 1, 4), (2, 101, 2, 1), (3, 102, 1, 3)]


def test_remaining_stock_keeps_items_without_movements(basket, rows):
    items, lines, _ = basket
    moved = lines.filter("item_id = 1")
    assert rows(orders.remaining_stock(items, moved)) == [
        (1, "pen", 3),
        (2, "cup", 1),
        (3, "hat", 5),
    ]

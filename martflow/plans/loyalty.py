"""Customer loyalty: ten questions over sales, menu and members.

Inputs: ``sales(customer_id, product_id, order_date, ...)``, ``menu(product_id,
product_name, price)``, ``members(customer_id, join_date)``. Results are relations without
an order; sort at the point of display.

Joins name no strategy: the small side of a join is broadcast when its *measured* size is
below the threshold, otherwise both sides are shuffled and AQE splits oversized partitions
of a hot customer or product. Equal purchases are counted before anything is joined, and
purchases are dealt anew after the members' join, so that a hot customer can be split there.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.rules import BONUS_DAYS, is_bonus_product, points
from martflow.operators.picks import leaders_per_group, nth_per_group, top_k

# The product with extra points and the end of the promotion.
BONUS_PRODUCTS = (1,)
PROMOTION_END = date(2021, 1, 31)


def total_spent(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Amount spent per customer; products missing from the menu add nothing."""
    priced = _bought(sales).join(menu.select("product_id", "price"), "product_id", "left")
    return priced.groupBy("customer_id").agg(
        F.sum(F.col("price") * F.col("times")).cast("decimal(38,2)").alias("total_spent")
    )


def _bought(sales: DataFrame, *more: str) -> DataFrame:
    """How often a customer bought a product: one row for all of a hot customer's equal purchases."""
    return sales.groupBy("customer_id", "product_id", *more).agg(F.count("*").alias("times"))


def visit_days(sales: DataFrame) -> DataFrame:
    """Number of different days on which a customer bought something."""
    days = F.countDistinct(F.to_date("order_date"))
    return sales.groupBy("customer_id").agg(days.alias("visit_days"))


def first_product(
    sales: DataFrame, menu: DataFrame, tie_keys: Sequence[str] = ("product_id",)
) -> DataFrame:
    """The first known product each customer bought; ``tie_keys`` settle equal dates."""
    known = menu.filter("product_id IS NOT NULL")
    sold = sales.join(known.select("product_id"), "product_id", "left_semi")
    order = [F.col(c).asc() for c in ("order_date", *tie_keys)]
    first = nth_per_group(sold, ["customer_id"], order).select("customer_id", "product_id")
    return first.join(known.select("product_id", "product_name"), "product_id").select(
        "customer_id", "product_name"
    )


def top_product(sales: DataFrame, menu: DataFrame, k: int = 1) -> DataFrame:
    """The k most bought products by id. One missing from the menu takes its place unseen."""
    counts = sales.groupBy("product_id").agg(F.count("*").alias("total_purchases"))
    best = top_k(counts, [F.desc("total_purchases"), F.asc("product_id")], k)
    return best.join(menu, "product_id").select("product_name", "total_purchases")


def favourite_products(sales: DataFrame, menu: DataFrame, by: str = "product_name") -> DataFrame:
    """Most frequent product names per customer, all ties.

    ``by="product_name"`` compares names with names. ``by="product_id"`` keeps the names
    bought exactly as often as the customer's most frequent product *id*, unknown products
    included under a NULL name; the two differ when ids share a name.
    """
    if by == "product_name":
        named = _bought(sales).join(menu.select("product_id", "product_name"), "product_id")
        counts = named.groupBy("customer_id", "product_name").agg(F.sum("times").alias("frequency"))
        return leaders_per_group(counts, ["customer_id"], [F.desc("frequency")])
    if by != "product_id":
        raise ValueError("by is 'product_name' or 'product_id'")

    by_id = sales.groupBy("customer_id", "product_id").agg(
        F.count("product_id").alias("id_frequency")
    )
    by_name = (
        by_id.join(menu.select("product_id", "product_name"), "product_id", "left")
        .groupBy("customer_id", "product_name")
        .agg(F.sum("id_frequency").alias("frequency"))
    )
    most = by_id.groupBy("customer_id").agg(F.max("id_frequency").alias("frequency"))
    return by_name.join(most, ["customer_id", "frequency"], "left_semi").select(
        "customer_id", "product_name", "frequency"
    )


def _member_sales(
    sales: DataFrame, menu: DataFrame, members: DataFrame, when: Column
) -> DataFrame:
    """Purchases of members that satisfy a date test, with product name and price.

    One row for each customer, product and day, with the number of ``times``. They are dealt anew
    after they met the members: that lets AQE split a hot customer in this join also where the menu
    is broadcast, and no shuffle by product would follow.
    """
    theirs = _bought(sales, "order_date").join(members, "customer_id").filter(when)
    return theirs.repartition("customer_id", "product_id").join(menu, "product_id")


def _each_time() -> Column:
    """One element for each time, to get a row for each purchase again."""
    return F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))


def _since_joining() -> Column:
    return F.col("order_date") >= F.col("join_date")


def _before_joining() -> Column:
    return F.col("order_date") < F.col("join_date")


def first_purchase_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """All products of a member's first buying day on or after joining."""
    bought = _member_sales(sales, menu, members, _since_joining())
    first = leaders_per_group(bought, ["customer_id"], [F.asc("order_date")])
    return first.select(
        "customer_id", "product_name", "join_date", "order_date", _each_time().alias("_")
    ).drop("_")


def first_purchase_before_join(
    sales: DataFrame, menu: DataFrame, members: DataFrame, dates: bool = False
) -> DataFrame:
    """All products of a member's first buying day, if that is before joining."""
    bought = _member_sales(sales, menu, members, _before_joining())
    shown = ["customer_id", "product_name"] + (["join_date", "order_date"] if dates else [])
    first = leaders_per_group(bought, ["customer_id"], [F.asc("order_date")])
    return first.select(*shown, _each_time().alias("_")).drop("_")


def spend_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Items and amount per member before joining."""
    bought = _member_sales(sales, menu, members, _before_joining())
    return bought.groupBy("customer_id").agg(
        F.sum("times").alias("total_items_purchased"),
        F.sum(F.col("price") * F.col("times")).cast("decimal(38,2)").alias("total_amount_spent"),
    )


def loyalty_points(
    sales: DataFrame, menu: DataFrame, bonus_products: Sequence[int] = BONUS_PRODUCTS
) -> DataFrame:
    """Points per customer over all known products."""
    worth = menu.select(
        "product_id",
        points(F.col("price"), is_bonus_product("product_id", bonus_products)).alias("worth"),
    )
    earned = _bought(sales).join(worth, "product_id")
    return earned.groupBy("customer_id").agg(F.sum(F.col("worth") * F.col("times")).alias("points"))


def promotion_points(
    sales: DataFrame,
    menu: DataFrame,
    members: DataFrame,
    until: date = PROMOTION_END,
    bonus_products: Sequence[int] = BONUS_PRODUCTS,
    window: str = "join_day",
) -> DataFrame:
    """Points of members from joining to the end of the promotion.

    ``window="join_day"`` doubles purchases with 0..7 days *from purchase to joining*, which
    for purchases on or after joining means the join day itself. ``window="first_week"``
    doubles the first week after joining.
    """
    if window == "join_day":
        days = F.datediff("join_date", "order_date")
    elif window == "first_week":
        days = F.datediff("order_date", "join_date")
    else:
        raise ValueError("window is 'join_day' or 'first_week'")
    counted = _since_joining() & (F.col("order_date") <= F.lit(until))
    bought = _member_sales(sales, menu, members, counted)
    bonus = days.between(0, BONUS_DAYS) | is_bonus_product("product_id", bonus_products)
    return bought.groupBy("customer_id").agg(
        F.sum(points(F.col("price"), bonus) * F.col("times")).alias("total_points")
    )

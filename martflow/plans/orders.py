"""Shop orders: pricing, billing, stock requests, placed orders, remaining stock.

Inputs: ``items(item_id, item, cost, quantity)``, cart or order lines ``(order_id,
item_id, quantity)``, delivery data ``(order_id, distance_km)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.rules import delivery_charge, money, valid_distance
from martflow.operators.buckets import dense_ids
from martflow.operators.stock import settle


def order_lines(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Lines with item name, unit cost and line total."""
    priced = lines.join(items.select("item_id", "item", "cost"), "item_id")
    total = (money("cost") * F.col("quantity").cast("bigint")).cast("decimal(18,2)")
    return priced.withColumn("line_total", total)


def order_totals(lines: DataFrame, items: DataFrame) -> DataFrame:
    return order_lines(lines, items).groupBy("order_id").agg(
        F.count("*").alias("line_count"), F.sum("line_total").alias("items_total")
    )


def order_bills(totals: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Item total plus delivery charge; orders that cannot be delivered are left out."""
    return _charged(totals, deliveries).filter(
        F.col("delivery_charge").isNotNull() & valid_distance("distance_km")
    ).select(
        "order_id",
        "items_total",
        "delivery_charge",
        (F.col("items_total") + F.col("delivery_charge")).alias("total_amount"),
    )


def undeliverable_orders(totals: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Orders refused at checkout, with the reason."""
    charged = _charged(totals, deliveries)
    reason = F.when(~valid_distance("distance_km"), "invalid distance").when(
        F.col("delivery_charge").isNull(), "too far"
    )
    return charged.select(
        "order_id", "items_total", "distance_km", reason.alias("reason")
    ).filter("reason IS NOT NULL")


def _charged(totals: DataFrame, deliveries: DataFrame) -> DataFrame:
    return totals.join(deliveries.select("order_id", "distance_km"), "order_id").withColumn(
        "delivery_charge", delivery_charge("distance_km")
    )


def allocate_stock(
    requests: DataFrame, items: DataFrame, order_by: Sequence[str], **kwargs
) -> DataFrame:
    """Additions to carts in order: accepted while the item's stock lasts, else refused.

    A refused request leaves the stock as it is, so a later, smaller one can still fit.
    """
    stock = items.select("item_id", F.col("quantity").alias("opening"))
    return settle(requests, stock, ["item_id"], order_by, **kwargs)


def accepted_lines(settled: DataFrame) -> DataFrame:
    """The requests that went into a cart: what is billed, placed and taken from stock."""
    return settled.filter("accepted").drop("accepted", "held")


def settle_cart(
    requests: DataFrame,
    limits: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    **kwargs,
) -> DataFrame:
    """Additions (positive) and removals (negative) of a cart, in order.

    ``keys`` is the cart and item, or the item alone where one cart uses the stock;
    ``limits(keys..., opening)`` says how many units may be held. A removal of more than
    is held is refused; an accepted one goes back to stock.
    """
    return settle(requests, limits, keys, order_by, **kwargs)


def cart_contents(settled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units held per key after all requests; emptied entries disappear."""
    held = F.sum(F.when(F.col("accepted"), F.col("quantity").cast("bigint")).otherwise(0))
    return settled.groupBy(*keys).agg(held.alias("held")).filter("held > 0")


def placed_orders(
    bills: DataFrame, stamp: Column | None = None, start_after: int = 0
) -> DataFrame:
    """Order headers with gapless new ids; the stored total includes delivery."""
    numbered = dense_ids(bills, ["order_id"], "id", start_after)
    return numbered.select(
        "id",
        "order_id",
        "total_amount",
        "delivery_charge",
        (F.current_timestamp() if stamp is None else stamp).alias("order_date"),
    )


def placed_order_lines(
    headers: DataFrame, lines: DataFrame, start_after: int = 0
) -> DataFrame:
    """Line rows of placed orders: one per order and item, quantities added up.

    ``lines`` are those in the cart (see ``accepted_lines``).
    """
    per_item = lines.groupBy("order_id", "item_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("quantity")
    )
    placed = per_item.join(
        headers.select("order_id", F.col("id").alias("new_order_id")), "order_id"
    )
    placed = placed.select(F.col("new_order_id").alias("order_id"), "item_id", "quantity")
    numbered = dense_ids(placed, ["order_id", "item_id"], "id", start_after)
    return numbered.select("id", "order_id", "item_id", "quantity")


def remaining_stock(items: DataFrame, movements: DataFrame) -> DataFrame:
    """Stock after movements ``(item_id, quantity)``; positive takes, negative returns.

    Movements are accepted requests, so that no stock goes below zero.
    """
    moved = movements.groupBy("item_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("_moved")
    )
    left = F.col("quantity").cast("bigint") - F.coalesce("_moved", F.lit(0))
    return items.join(moved, "item_id", "left").select("item_id", "item", left.alias("remaining"))

"""Business rules: size classes, loyalty points, delivery charges, money."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper ends of the size classes, first match wins.
SIZE_LABELS = ("Small", "Medium", "Large", "Extra Large")
SMALL_BELOW = 1000
MEDIUM_UP_TO = 2000
LARGE_UP_TO = 3000

# Points per unit of price.
POINTS = 10
BONUS_POINTS = 20
BONUS_DAYS = 7

# Delivery distance limits (km) and charges.
NEAR_KM, NEAR_CHARGE = 15, 50
FAR_KM, FAR_CHARGE = 30, 100


def money(c: Column | str) -> Column:
    """Exact two-digit amount, so that sums do not depend on the order of rows."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(18,2)")


def size_class(length: Column | str) -> Column:
    """Size label of a length. NULL lengths fall into the last class."""
    x = F.col(length) if isinstance(length, str) else length
    small, medium, large, rest = SIZE_LABELS
    return (
        F.when(x < SMALL_BELOW, small)
        .when(x <= MEDIUM_UP_TO, medium)
        .when(x <= LARGE_UP_TO, large)
        .otherwise(rest)
    )


def points(price: Column, bonus: Column) -> Column:
    """Loyalty points of one sale; a NULL bonus test counts as no bonus."""
    return price * F.when(bonus, F.lit(BONUS_POINTS)).otherwise(F.lit(POINTS))


def is_bonus_product(product_id: Column | str, bonus_products: Sequence[int]) -> Column:
    product_id = F.col(product_id) if isinstance(product_id, str) else product_id
    return product_id.isin(*bonus_products)


def delivery_charge(distance_km: Column | str) -> Column:
    """Charge by distance; NULL where the order cannot be delivered."""
    d = F.col(distance_km) if isinstance(distance_km, str) else distance_km
    return (
        F.when(d <= NEAR_KM, F.lit(NEAR_CHARGE))
        .when(d <= FAR_KM, F.lit(FAR_CHARGE))
        .cast("decimal(10,2)")
    )


def valid_distance(distance_km: Column | str) -> Column:
    d = F.col(distance_km) if isinstance(distance_km, str) else distance_km
    return F.coalesce(d >= 0, F.lit(False))

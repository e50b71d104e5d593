"""Declared schemas of the input and output tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


def _money() -> DecimalType:
    return DecimalType(10, 2)


# Columns of the tables, in table order.

# Loyalty
SALES = _table(customer_id=StringType, order_date=DateType, product_id=IntegerType)
MENU = _table(product_id=IntegerType, product_name=StringType, price=_money)
MEMBERS = _table(customer_id=StringType, join_date=DateType)

# Products and sensors
PRODUCTS = _table(
    product_number=StringType,
    product_name=StringType,
    product_category=StringType,
    product_scale=StringType,
    product_manufacturer=StringType,
    product_description=StringType,
    length=DoubleType,
    width=DoubleType,
    height=DoubleType,
)
READINGS = {"sensor_id": "string", "date": "string", "temperature": "float"}

# Retail files as they are typed on loading
NEW_SALES = _table(
    store=IntegerType, dept=IntegerType, date=DateType, isholiday=BooleanType, last_modified=StringType
)
PAST_SALES = _table(
    store=IntegerType,
    dept=IntegerType,
    date=DateType,
    weekly_sales=FloatType,
    isholiday=BooleanType,
    last_modified=StringType,
)
FEATURES = _table(
    store=IntegerType,
    date=DateType,
    temperature=FloatType,
    fuel_price=FloatType,
    markdown1=FloatType,
    markdown2=FloatType,
    markdown3=FloatType,
    markdown4=FloatType,
    markdown5=FloatType,
    cpi=FloatType,
    unemployment=FloatType,
    isholiday=BooleanType,
    last_modified=StringType,
)
STORE = _table(store=IntegerType, type=StringType, size=IntegerType, last_modified=StringType)

# Star schema
DIM_STORE = _table(
    store_id=IntegerType, store_type=StringType, store_size=IntegerType, last_modified=TimestampType
)
DIM_DATE = _table(date_id=DateType, year=IntegerType, month=IntegerType, day=IntegerType)
DIM_DEPARTMENT = _table(dept_id=IntegerType, last_modified=TimestampType)
DIM_HOLIDAY = _table(holiday_id=BooleanType, last_modified=TimestampType)
DIM_FEATURES = _table(
    feature_id=LongType,
    temperature=FloatType,
    fuel_price=FloatType,
    markdown1=FloatType,
    markdown2=FloatType,
    markdown3=FloatType,
    markdown4=FloatType,
    markdown5=FloatType,
    cpi=FloatType,
    unemployment=FloatType,
    last_modified=TimestampType,
)
FACT_SALES = _table(
    store_id=IntegerType,
    dept_id=IntegerType,
    date_id=DateType,
    feature_id=LongType,
    weekly_sales=FloatType,
    holiday_id=BooleanType,
    last_modified=TimestampType,
)

# Change feed: message fields, all dates still text, and the table they end up in
CHANGE_MESSAGE = _table(
    Store=IntegerType,
    Dept=IntegerType,
    Date=StringType,
    Weekly_Sales=FloatType,
    IsHoliday=BooleanType,
    last_modified=StringType,
)
SALES_CHANGES = _table(
    store_id=IntegerType,
    dept=IntegerType,
    date=DateType,
    weekly_sales=FloatType,
    isholiday=BooleanType,
    last_modified=TimestampType,
)

# Key-based import
IMPORT_PRODUCTS = _table(
    product_id=IntegerType,
    name=StringType,
    category=StringType,
    effective_date=DateType,
    last_modified=TimestampType,
)

# Shop
ITEMS = _table(id=IntegerType, item=StringType, cost=_money, quantity=IntegerType)
ORDERS = _table(
    id=LongType, total_amount=_money, delivery_charge=_money, order_date=TimestampType
)
ORDER_ITEMS = _table(id=LongType, order_id=LongType, item_id=IntegerType, quantity=IntegerType)

"""Typed schemas of the bronze / silver / gold tables."""

from __future__ import annotations

from pyspark.sql.types import (FloatType, IntegerType, StringType, StructField, StructType,
                               TimestampType)


def _s(name: str, nullable: bool = True) -> StructField:
    return StructField(name, StringType(), nullable)


CUSTOMERS = StructType([
    _s("clientid"), _s("firstname"), _s("lastname"), _s("email"), _s("address"),
    _s("country"), _s("phone"), _s("channel"),
    StructField("creation_date", TimestampType()),
])

ORDERS = StructType([
    _s("orderid"),
    StructField("transactiondate", TimestampType()),
    StructField("items", IntegerType()),
    StructField("amount", IntegerType()),
    _s("customerid"),
])

MARKETING = StructType([
    _s("marketingid"),
    StructField("marketingdate", TimestampType()),
    StructField("discount", FloatType()),
    StructField("clicked", IntegerType()),
    _s("targetedcustomerid"),
])


def with_not_null(schema: StructType, *keys: str) -> StructType:
    """Silver variant: the primary-key columns are declared NOT NULL."""
    return StructType([StructField(f.name, f.dataType, f.name not in keys, f.metadata)
                       for f in schema.fields])


CUSTOMERS_SILVER = with_not_null(CUSTOMERS, "clientid")
ORDERS_SILVER = with_not_null(ORDERS, "orderid")
MARKETING_SILVER = with_not_null(MARKETING, "marketingid")

# table name -> (schema, primary key, (foreign key, parent table, parent key) or None)
TABLES = {
    "customers_bronze": (CUSTOMERS, None, None),
    "orders_bronze": (ORDERS, None, None),
    "marketing_bronze": (MARKETING, None, None),
    "customers_silver": (CUSTOMERS_SILVER, "clientid", None),
    "orders_silver": (ORDERS_SILVER, "orderid", ("customerid", "customers_silver", "clientid")),
    "marketing_silver": (MARKETING_SILVER, "marketingid",
                         ("targetedcustomerid", "customers_silver", "clientid")),
}

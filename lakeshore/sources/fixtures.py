"""Mapping of the driver's test tables onto the three landing entities.

The test tables carry no duplicates, NULLs or orphan keys, so the mapping plants them
deterministically (the same rules are written as SQL in ``lakeshore.plans.fixture_sql``).
``with_nulls=True`` blanks emails and customer references, ``with_nulls="refs"`` only the
references:
every 25th customer is repeated, customers ``50k`` and ``50k+1`` share an email, every 21st
purchase is repeated. The NULL variant also blanks ``email`` where ``c_custkey % 97 = 0`` and
the customer reference where ``event_id % 97 = 0``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_where(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def customers_base(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    email = F.concat(F.lit("u"), F.when(k % 50 == 1, k - 1).otherwise(k).cast("string"),
                     F.lit("@example.com"))
    if with_nulls and with_nulls != "refs":
        email = _null_where(k % 97 == 0, email)
    channel = (F.when(k % 10 < 3, F.lit("Web")).when(k % 10 < 5, F.lit("Call Center"))
               .otherwise(F.lit("App")))
    created = (F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")
               + F.make_dt_interval(days=(k % 20).cast("int")))
    return (cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(k.alias("clientid"), email.alias("email"), F.col("n_name").alias("country"),
                    channel.alias("channel"), created.alias("creation_date")))


def repeat_where(df: DataFrame, cond: Column) -> DataFrame:
    """``df UNION ALL (df WHERE cond)`` in one scan: rows meeting ``cond`` are emitted twice."""
    n = F.when(cond, F.lit(2)).otherwise(F.lit(1))
    return df.withColumn("__r", F.explode(F.sequence(F.lit(1), n))).drop("__r")


def customers_bronze(spark: SparkSession, sf_dir: str, with_nulls: bool = False) -> DataFrame:
    return repeat_where(customers_base(spark, sf_dir, with_nulls), F.col("clientid") % 25 == 0)


def _customer_ref(with_nulls, hot_customer: int | None) -> Column:
    cust = F.col("user_id")
    if hot_customer is not None:
        # every third event goes to one customer: a key holding a third of all rows
        cust = F.when(F.col("event_id") % 3 == 0, F.lit(hot_customer).cast("bigint")).otherwise(cust)
    return cust


def orders_base(spark: SparkSession, sf_dir: str, with_nulls: bool = False,
                hot_customer: int | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    cust = _customer_ref(with_nulls, hot_customer)
    if with_nulls:
        cust = _null_where(F.col("event_id") % 97 == 0, cust)
    return (ev.filter(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("orderid"), F.col("ts").alias("transactiondate"),
                    (F.col("event_id") % 4 + 1).cast("int").alias("items"),
                    F.floor("value").cast("int").alias("amount"), cust.alias("customerid")))


def orders_bronze(spark: SparkSession, sf_dir: str, with_nulls: bool = False,
                  hot_customer: int | None = None) -> DataFrame:
    return repeat_where(orders_base(spark, sf_dir, with_nulls, hot_customer),
                        F.col("orderid") % 21 == 0)


def marketing_bronze(spark: SparkSession, sf_dir: str, with_nulls: bool = False,
                     hot_customer: int | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    cust = _customer_ref(with_nulls, hot_customer)
    if with_nulls:
        cust = _null_where(F.col("event_id") % 97 == 0, cust)
    return (ev.filter(F.col("event_type").isin("click", "view"))
            .select(F.col("event_id").alias("marketingid"), F.col("ts").alias("marketingdate"),
                    ((F.col("event_id") % 42).cast("double") / 100).alias("discount"),
                    F.when(F.col("event_type") == "click", 1).otherwise(0).alias("clicked"),
                    cust.alias("targetedcustomerid")))


@dataclass(frozen=True)
class Bronze:
    customers: DataFrame
    orders: DataFrame
    marketing: DataFrame


def bronze(spark: SparkSession, sf_dir: str, with_nulls: bool = False,
           hot_customer: int | None = None) -> Bronze:
    return Bronze(customers_bronze(spark, sf_dir, with_nulls),
                  orders_bronze(spark, sf_dir, with_nulls, hot_customer),
                  marketing_bronze(spark, sf_dir, with_nulls, hot_customer))

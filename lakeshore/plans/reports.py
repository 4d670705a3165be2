"""Reports on the gold table and exploration listings on the landing data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import TimestampNTZType

from ..functions.text import month_text
from ..operators.joins import semi_join
from ..operators.quality import dedup_rows, duplicate_keys, shared_values


def _attributed_amount() -> F.Column:
    return F.when(F.col("marketingid").isNotNull(), F.col("amount")).otherwise(F.lit(0))


def revenue_by_month_country(gold: DataFrame) -> DataFrame:
    """Order revenue per (year-month of the order, country), ordered by both."""
    ntz = isinstance(gold.schema["transactiondate"].dataType, TimestampNTZType)
    return (gold.groupBy(month_text("transactiondate", ntz).alias("year_month"),
                         F.col("country"))
            .agg(F.sum("amount").alias("order_revenue"))
            .orderBy("year_month", "country"))


def marketing_effectiveness(gold: DataFrame, safe: bool = False) -> DataFrame:
    """Per country: revenue of attributed orders and its share of all revenue.

    The share is ``float(attributed) / total``; a zero total raises under ANSI mode as
    in SQL, unless ``safe`` (then NULL).
    """
    attributed = F.sum(_attributed_amount())
    num, den = attributed.cast("float"), F.sum("amount")
    share = F.try_divide(num, den) if safe else num / den
    return (gold.groupBy("country")
            .agg(attributed.alias("marketing_revenue"), share.alias("marketing_share"))
            .orderBy("marketing_revenue"))


def duplicate_records(df: DataFrame, key: str = "clientid") -> DataFrame:
    """Every row whose key occurs more than once, ordered by key."""
    return semi_join(df, duplicate_keys(df, key), key).orderBy(key)


def shared_value_records(df: DataFrame, value: str = "email",
                         newest_first: str = "creation_date") -> DataFrame:
    """Distinct rows whose value is held by more than one row, by value then newest first."""
    d0 = dedup_rows(df)
    return (semi_join(d0, shared_values(d0, value), value)
            .orderBy(F.col(value).asc(), F.col(newest_first).desc()))


def customers_by_channel(df: DataFrame, alias: str = "customers") -> DataFrame:
    return df.groupBy("channel").agg(F.count(F.lit(1)).alias(alias)).orderBy("channel")

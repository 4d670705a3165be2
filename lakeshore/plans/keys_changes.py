"""Merges into bucketed tables, and row changes that rewrite only the touched key buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sources.bucketed import KeyedTable, create_bucketed, merge_insert
from . import silver as S
from .fixture_sql import with_flow
from .keys_tables import DELETED_KEY, NULLED_KEYS, dml_files, dml_sql
from .registry import bronze, register, silver_layer

BUCKETS = 8


def _merged(spark, name: str, target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` as a bucketed table, ``source`` merged into it twice (the second run adds nothing)."""
    database = f"lakeshore_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{fresh_path(spark, database)}'")
    table = f"`{database}`.`{name}`"
    create_bucketed(target, table, key, BUCKETS, fresh_path(spark, name))
    for _ in range(2):
        out = merge_insert(spark, table, source, key, BUCKETS)
    return out


@register("merge_bucketed_customers", with_flow("""select clientid, email, country,
    case when clientid % 3 = 0 then 'kept' else channel end as channel, creation_date from customers_silver"""))
def merge_bucketed_customers(spark, d):
    """Cleaned customers merged into a bucketed silver table that holds a third of them."""
    clean = S.customers_clean(bronze(spark, d).customers)
    target = clean.filter(F.col("clientid") % 3 == 0).withColumn("channel", F.lit("kept"))
    return _merged(spark, "customers", target, clean, "clientid")


@register("merge_bucketed_orders", with_flow("""select orderid, transactiondate, items,
    case when orderid % 2 = 0 then -1 else amount end as amount, customerid from orders_silver"""))
def merge_bucketed_orders(spark, d):
    src = S.validated(bronze(spark, d).orders, "customerid", silver_layer(spark, d).customers, "clientid")
    return _merged(spark, "orders", src.filter(F.col("orderid") % 2 == 0).withColumn("amount", F.lit(-1)), src, "orderid")


@register("merge_bucketed_marketing", with_flow("""select marketingid, marketingdate,
    case when marketingid % 2 = 0 then cast(-1 as double) else discount end as discount, clicked,
    targetedcustomerid from marketing_silver"""))
def merge_bucketed_marketing(spark, d):
    src = S.validated(bronze(spark, d).marketing, "targetedcustomerid", silver_layer(spark, d).customers, "clientid")
    target = src.filter(F.col("marketingid") % 2 == 0).withColumn("discount", F.lit(-1.0))
    return _merged(spark, "marketing", target, src, "marketingid")


# ---- the row-change script, each statement in place ---------------------------------------

def _script(spark, d, through: int) -> DataFrame:
    first, second = dml_files(spark, d)
    t = KeyedTable(spark, fresh_path(spark, "customers_keyed"), first.schema, "clientid", BUCKETS).create(first.distinct())
    steps = [lambda: t.update(F.col("clientid").isin(*NULLED_KEYS), {"email": F.lit(None).cast("string")}),
             lambda: t.merge(second.distinct(), {"email": "email"}, F.col("email").isNull(), F.col("email").isNotNull()),
             lambda: t.delete_in("email", t.read().groupBy("email").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")),
             lambda: t.delete(F.col("clientid") == DELETED_KEY)]
    for step in steps[:through]:
        step()
    return t.read()


@register("in_place_update", dml_sql("select * from v2"))
def in_place_update(spark, d):
    """Emails of six customers set to NULL: at most six key buckets are written."""
    return _script(spark, d, 1)


@register("in_place_merge", dml_sql("select * from v3"))
def in_place_merge(spark, d):
    """The second file merged (fill a missing email, insert new customers) into the buckets it changes."""
    return _script(spark, d, 2)


@register("in_place_delete_shared", dml_sql("select * from v4"))
def in_place_delete_shared(spark, d):
    """Holders of a shared email deleted in their buckets."""
    return _script(spark, d, 3)


@register("in_place_delete_key", dml_sql("select * from v5"))
def in_place_delete_key(spark, d):
    """One customer deleted: one bucket is written."""
    return _script(spark, d, 4)

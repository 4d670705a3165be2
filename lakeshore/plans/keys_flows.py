"""Composite flows, aggregations, joins, windows and reports over the mapped test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attribution as attr
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import sweep
from . import gold as G
from . import reports as R
from . import silver as S
from .fixture_sql import bronze_ctes, with_flow
from .registry import bronze, gold_table, register, silver_layer

PAIR_COLS = ("orderid, transactiondate, items, amount, customerid, marketingid, marketingdate, "
             "discount, clicked, targetedcustomerid")
DUP_ORDERS = """select orderid from flagged where marketingid is not null
  group by orderid having count(distinct marketingid) > 1"""

# ---- C2 - C5: the medallion flow ----------------------------------------------------------


@register("silver_customers", with_flow("select * from customers_silver"))
def silver_customers(spark, d):
    return silver_layer(spark, d).customers


@register("silver_orders", with_flow("select * from orders_silver"))
def silver_orders(spark, d):
    return silver_layer(spark, d).orders


@register("silver_marketing", with_flow("select * from marketing_silver"))
def silver_marketing(spark, d):
    return silver_layer(spark, d).marketing


@register("gold_attribution", with_flow("select * from gold", gold=True))
def gold_attribution(spark, d):
    return gold_table(spark, d, 7)


@register("gold_attribution_10d", with_flow("select * from gold", gold=True, days=10))
def gold_attribution_10d(spark, d):
    return gold_table(spark, d, 10)


@register("gold_attribution_with_nulls",
          with_flow("select * from gold", gold=True, with_nulls=True))
def gold_attribution_with_nulls(spark, d):
    return G.gold_attribution(silver_layer(spark, d, with_nulls=True), 7)


@register("gold_attribution_null_refs",
          with_flow("select * from gold", gold=True, with_nulls="refs"))
def gold_attribution_null_refs(spark, d):
    """Orders and campaigns with NULL customer references (never attributed, never in silver)."""
    return G.gold_attribution(silver_layer(spark, d, with_nulls="refs"), 7)


# Fixed value: the customer that receives every third event in the skewed variant (its email
# is not shared, so it stays in silver).
HOT_CUSTOMER = 2


@register("gold_attribution_hot_customer",
          with_flow("select * from gold", gold=True, hot_customer=HOT_CUSTOMER))
def gold_attribution_hot_customer(spark, d):
    """Gold when one customer holds a third of all orders and campaigns."""
    return G.gold_attribution(silver_layer(spark, d, hot_customer=HOT_CUSTOMER), 7)


@register("revenue_by_month_country_hot_customer", with_flow(
    """select strftime(transactiondate, '%Y-%m') as year_month, country,
              cast(sum(amount) as bigint) as order_revenue
       from gold group by 1, 2 order by 1, 2""", gold=True, hot_customer=HOT_CUSTOMER))
def revenue_by_month_country_hot_customer(spark, d):
    return R.revenue_by_month_country(
        G.gold_attribution(silver_layer(spark, d, hot_customer=HOT_CUSTOMER), 7))


@register("multi_attribution_orders_hot_customer", with_flow(
    """select orderid, count(distinct marketingid) as m_rec from flagged
       where marketingid is not null group by orderid having count(distinct marketingid) > 1""",
    gold=True, hot_customer=HOT_CUSTOMER))
def multi_attribution_orders_hot_customer(spark, d):
    """Distinct campaigns per order when one customer holds a third of orders and campaigns."""
    return G.multi_attribution_orders(silver_layer(spark, d, hot_customer=HOT_CUSTOMER), 7)


# ---- J2, W1, W2, C6: attribution internals ------------------------------------------------

@register("interval_join_left", with_flow("select * from candidates", gold=True))
def interval_join_left(spark, d):
    return G.attribution_pairs(silver_layer(spark, d), 7)


@register("double_attribution_flag", with_flow("select * from flagged", gold=True))
def double_attribution_flag(spark, d):
    return G.attribution_staging(silver_layer(spark, d), 7)


@register("best_match_per_order", with_flow(
    f"select {PAIR_COLS} from flagged where double_attribution = 0", gold=True))
def best_match_per_order(spark, d):
    """No order x campaign join: windows over the union of orders and campaigns."""
    s = silver_layer(spark, d)
    best = attr.best_in_window(s.orders, G.clicked(s.marketing), days=7)
    return attr.first_per_key(best, key="orderid")


@register("best_in_window_orders", with_flow(
    f"select {PAIR_COLS} from flagged where double_attribution = 0", gold=True))
def best_in_window_orders(spark, d):
    """The same result as ``best_match_per_order``, computed without forming pairs."""
    return G.best_attribution(silver_layer(spark, d), 7)


@register("multi_attribution_orders", with_flow(
    """select orderid, count(distinct marketingid) as m_rec from flagged
       where marketingid is not null group by orderid having count(distinct marketingid) > 1""",
    gold=True))
def multi_attribution_orders(spark, d):
    return G.multi_attribution_orders(silver_layer(spark, d), 7)


@register("double_attribution_rows", with_flow(
    f"select * from flagged where orderid in ({DUP_ORDERS})", gold=True))
def double_attribution_rows(spark, d):
    return G.double_attribution_rows(silver_layer(spark, d), 7)


@register("campaigns_per_order", with_flow(
    """select orderid, customerid, transactiondate, cast(count(distinct marketingid) as bigint) as m_rec
       from candidates where customerid is not null and transactiondate is not null group by all""", gold=True))
def campaigns_per_order(spark, d):
    """How many distinct campaigns each order falls under (0 included), by the sweep."""
    s = silver_layer(spark, d)
    return sweep.campaigns_per_order(s.orders, G.clicked(s.marketing), days=7)


@register("double_attribution_rows_hot_customer", with_flow(
    f"select * from flagged where orderid in ({DUP_ORDERS})", gold=True, hot_customer=HOT_CUSTOMER))
def double_attribution_rows_hot_customer(spark, d):
    return G.double_attribution_rows(silver_layer(spark, d, hot_customer=HOT_CUSTOMER), 7)


@register("parameterized_window", with_flow(
    "select count(*) as gold_rows, count(marketingid) as attributed, "
    "cast(sum(amount) as bigint) as revenue from gold", gold=True, days=10))
def parameterized_window(spark, d):
    """The attribution window is a run-time parameter (allowed 7 or 10 days)."""
    g = gold_table(spark, d, days=10)
    return g.agg(F.count(F.lit(1)).alias("gold_rows"), F.count("marketingid").alias("attributed"),
                 F.sum("amount").alias("revenue"))


# ---- J1, J3, P12: joins to customers ------------------------------------------------------

@register("left_outer_join", with_flow("select * from flagged_customers", gold=True))
def left_outer_join(spark, d):
    s = silver_layer(spark, d)
    st = G.attribution_staging(s, 7)
    return st.join(s.customers, F.col("customerid") == F.col("clientid"), "left")


@register("outer_to_inner", with_flow(
    "select * from flagged_customers where clientid is not null", gold=True))
def outer_to_inner(spark, d):
    s = silver_layer(spark, d)
    st = G.attribution_staging(s, 7)
    return st.join(s.customers, F.col("customerid") == F.col("clientid"), "inner")


@register("filter_date_compare", with_flow(
    """select o.orderid, o.customerid, o.transactiondate, c.creation_date
       from orders_silver o join customers_silver c on o.customerid = c.clientid
       where cast(c.creation_date as date) <= cast(o.transactiondate as date)"""))
def filter_date_compare(spark, d):
    s = silver_layer(spark, d)
    j = s.orders.join(s.customers, F.col("customerid") == F.col("clientid"))
    return (j.filter(F.to_date("creation_date") <= F.to_date("transactiondate"))
            .select("orderid", "customerid", "transactiondate", "creation_date"))


# ---- J4 - J8: membership and FK validation -----------------------------------------------

@register("semi_join_in", with_flow(
    "select * from orders_bronze where customerid in (select clientid from customers_silver)"))
def semi_join_in(spark, d):
    s = silver_layer(spark, d)
    return J.semi_join(bronze(spark, d).orders, s.customers, "customerid", "clientid")


_NOT_IN_SQL = """, d0 as (select distinct * from customers_bronze),
shared as (select email from d0 group by email having count(distinct clientid) > 1)
select * from customers_bronze where email not in (select email from shared{where})"""


def _not_in_case(spark, d, with_nulls, drop_null_probe=False):
    b = bronze(spark, d, with_nulls).customers
    shared = Q.shared_values(Q.dedup_rows(b), "email", "clientid")
    if drop_null_probe:
        shared = shared.filter(F.col("email").isNotNull())
    return J.not_in(b, "email", shared, "email")


def _not_in_sql(with_nulls, where=""):
    return "with " + bronze_ctes(with_nulls) + _NOT_IN_SQL.format(where=where)


@register("null_aware_anti_join", _not_in_sql(False))
def null_aware_anti_join(spark, d):
    return _not_in_case(spark, d, False)


@register("null_aware_anti_join_with_nulls", _not_in_sql(True))
def null_aware_anti_join_with_nulls(spark, d):
    """A shared NULL email (two clients without email) makes NOT IN reject every row."""
    return _not_in_case(spark, d, True)


@register("null_aware_anti_join_null_keys", _not_in_sql(True, " where email is not null"))
def null_aware_anti_join_null_keys(spark, d):
    """No NULL in the subquery: rows whose own email is NULL are dropped, others kept."""
    return _not_in_case(spark, d, True, drop_null_probe=True)


@register("anti_join_keeps_null_keys", "with " + bronze_ctes(True) + """,
d0 as (select distinct * from customers_bronze),
shared as (select email from d0 where email is not null group by email having count(*) > 1)
select * from customers_bronze c where not exists (select 1 from shared s where s.email = c.email)""")
def anti_join_keeps_null_keys(spark, d):
    """The plain (not null-aware) anti join: a NULL email matches nothing and stays."""
    b = bronze(spark, d, True).customers
    shared = Q.shared_values(Q.dedup_rows(b).filter(F.col("email").isNotNull()), "email")
    return J.not_in(b, "email", shared, "email", null_aware=False)


def _flag_sql(table, fk):
    return with_flow(f"""select *, case when {fk} in (select clientid from customers_silver)
        then 'Y' else 'N' end as customerid_is_valid from {table} where {fk} is not null""")


@register("fk_flag_orders", _flag_sql("orders_bronze", "customerid"))
def fk_flag_orders(spark, d):
    s = silver_layer(spark, d)
    o = bronze(spark, d).orders.filter(F.col("customerid").isNotNull())
    return J.membership_flag(o, "customerid", s.customers, "clientid")


@register("fk_flag_marketing", _flag_sql("marketing_bronze", "targetedcustomerid"))
def fk_flag_marketing(spark, d):
    s = silver_layer(spark, d)
    m = bronze(spark, d).marketing.filter(F.col("targetedcustomerid").isNotNull())
    return J.membership_flag(m, "targetedcustomerid", s.customers, "clientid")


def _valid_sql(table, fk, neg=""):
    return with_flow(f"""select * from {table} where {fk} is not null
        and {fk} {neg} in (select clientid from customers_silver)""")


@register("fk_valid_orders", _valid_sql("orders_bronze", "customerid"))
def fk_valid_orders(spark, d):
    return J.valid_members(bronze(spark, d).orders, "customerid",
                           silver_layer(spark, d).customers, "clientid")


@register("fk_valid_marketing", _valid_sql("marketing_bronze", "targetedcustomerid"))
def fk_valid_marketing(spark, d):
    return J.valid_members(bronze(spark, d).marketing, "targetedcustomerid",
                           silver_layer(spark, d).customers, "clientid")


@register("fk_orphans_orders", _valid_sql("orders_bronze", "customerid", "not"))
def fk_orphans_orders(spark, d):
    return J.orphans(bronze(spark, d).orders, "customerid",
                     silver_layer(spark, d).customers, "clientid")


@register("fk_orphans_marketing", _valid_sql("marketing_bronze", "targetedcustomerid", "not"))
def fk_orphans_marketing(spark, d):
    return J.orphans(bronze(spark, d).marketing, "targetedcustomerid",
                     silver_layer(spark, d).customers, "clientid")


@register("fk_orphans_recheck", with_flow("""select * from customers_silver where clientid in (
    select distinct customerid from orders_bronze where customerid is not null
      and customerid not in (select clientid from customers_silver))"""))
def fk_orphans_recheck(spark, d):
    """Orphan keys looked up again among the customers (empty by construction)."""
    s = silver_layer(spark, d)
    orph = J.orphans(bronze(spark, d).orders, "customerid", s.customers, "clientid")
    return J.semi_join(s.customers, orph, "clientid", "customerid")


# ---- A1 - A13: aggregations ---------------------------------------------------------------

@register("count_all", with_flow("select count(*) as total_rows from gold", gold=True))
def count_all(spark, d):
    return Q.count_rows(gold_table(spark, d), "total_rows")


@register("count_vs_distinct", with_flow(
    "select count(*) as tot_recs, count(distinct clientid) as tot_distinct from customers_bronze",
    silver=False))
def count_vs_distinct(spark, d):
    return Q.count_vs_distinct(bronze(spark, d).customers, "clientid")


@register("count_after_dedup", with_flow(
    """select count(*) as recs_, count(distinct clientid) as distinct_
       from (select distinct * from customers_bronze) d0""", silver=False))
def count_after_dedup(spark, d):
    return Q.count_vs_distinct(Q.dedup_rows(bronze(spark, d).customers), "clientid",
                               "recs_", "distinct_")


@register("dup_keys", with_flow(
    "select clientid, count(*) as n from customers_bronze group by 1 having count(*) > 1",
    silver=False))
def dup_keys(spark, d):
    return Q.duplicate_keys(bronze(spark, d).customers, "clientid", "n")


@register("dup_values_having_alias", with_flow(
    """select email, count(*) as recs from (select distinct * from customers_bronze) d0
       group by 1 having recs > 1""", silver=False))
def dup_values_having_alias(spark, d):
    return Q.shared_values(Q.dedup_rows(bronze(spark, d).customers), "email")


@register("shared_email_groups", with_flow("select * from shared_emails"))
def shared_email_groups(spark, d):
    return Q.shared_values(Q.dedup_rows(bronze(spark, d).customers), "email", "clientid")


@register("distinct_rows", with_flow("select distinct * from customers_bronze", silver=False))
def distinct_rows(spark, d):
    return Q.dedup_rows(bronze(spark, d).customers)


@register("distinct_projection", with_flow(
    """select distinct orderid, transactiondate, items, amount, customerid
       from orders_bronze where customerid is not null""", silver=False))
def distinct_projection(spark, d):
    o = bronze(spark, d).orders.filter(F.col("customerid").isNotNull())
    return o.select("orderid", "transactiondate", "items", "amount", "customerid").distinct()


@register("distinct_key", with_flow("select distinct clientid from customers_silver"))
def distinct_key(spark, d):
    return silver_layer(spark, d).customers.select("clientid").distinct()


@register("revenue_by_month_country", with_flow(
    """select strftime(transactiondate, '%Y-%m') as year_month, country,
              cast(sum(amount) as bigint) as order_revenue
       from gold group by 1, 2 order by 1, 2""", gold=True))
def revenue_by_month_country(spark, d):
    return R.revenue_by_month_country(gold_table(spark, d))


_ATTR = "sum(case when marketingid is not null then amount else 0 end)"


@register("marketing_revenue_by_country", with_flow(
    f"select country, cast({_ATTR} as bigint) as marketing_revenue from gold group by 1 order by 2",
    gold=True))
def marketing_revenue_by_country(spark, d):
    return R.marketing_effectiveness(gold_table(spark, d)).select("country", "marketing_revenue")


@register("marketing_share_by_country", with_flow(
    f"""select country, round(cast(cast({_ATTR} as float) as double) / sum(amount), 6) as marketing_share
        from gold group by 1 order by 2""", gold=True))
def marketing_share_by_country(spark, d):
    r = R.marketing_effectiveness(gold_table(spark, d))
    return r.select("country", F.round("marketing_share", 6).alias("marketing_share"))


@register("marketing_effectiveness", with_flow(
    f"""select country, cast({_ATTR} as bigint) as marketing_revenue,
          round(cast(cast({_ATTR} as float) as double) / sum(amount), 6) as marketing_share
        from gold group by 1 order by 2""", gold=True))
def marketing_effectiveness(spark, d):
    r = R.marketing_effectiveness(gold_table(spark, d))
    return r.withColumn("marketing_share", F.round("marketing_share", 6))


@register("customers_by_channel", with_flow(
    "select channel, count(*) as customers from customers_silver group by 1 order by 1"))
def customers_by_channel(spark, d):
    return R.customers_by_channel(silver_layer(spark, d).customers)


# ---- C7, C8: exploration listings --------------------------------------------------------

@register("duplicate_records", with_flow(
    """select * from customers_bronze where clientid in (
         select clientid from customers_bronze group by 1 having count(*) > 1) order by 1""",
    silver=False))
def duplicate_records(spark, d):
    return R.duplicate_records(bronze(spark, d).customers, "clientid")


@register("shared_email_records", with_flow(
    """select * from (select distinct * from customers_bronze) d0 where email in (
         select email from (select distinct * from customers_bronze) d1
         group by 1 having count(*) > 1)
       order by email asc, creation_date desc""", silver=False))
def shared_email_records(spark, d):
    return R.shared_value_records(bronze(spark, d).customers, "email", "creation_date")


# ---- O15, O16: key audits -------------------------------------------------------------------

@register("audit_primary_key", with_flow(
    """select orderid, count(*) as n_rows,
              case when orderid is null then 'null_key' else 'duplicate_key' end as violation
       from orders_bronze group by orderid having orderid is null or count(*) > 1""",
    silver=False))
def audit_primary_key(spark, d):
    """PRIMARY KEY (orderid) checked on the landing rows: NULL or repeated keys."""
    return Q.audit_primary_key(bronze(spark, d).orders, "orderid")


@register("audit_foreign_key", with_flow(
    """select * from marketing_bronze m where targetedcustomerid is not null
       and not exists (select 1 from customers_silver c where c.clientid = m.targetedcustomerid)""",
    with_nulls=True))
def audit_foreign_key(spark, d):
    """FOREIGN KEY (targetedcustomerid) REFERENCES customers_silver (clientid), on the
    landing rows of the NULL variant: NULL references are not violations."""
    s = silver_layer(spark, d, with_nulls=True)
    return Q.audit_foreign_key(bronze(spark, d, with_nulls=True).marketing, "targetedcustomerid",
                               s.customers, "clientid")


@register("audit_silver_keys", with_flow(
    """select 'orders_silver' as table_name, count(*) - count(distinct orderid) as duplicate_keys,
              count(*) - count(orderid) as null_keys from orders_silver
       union all select 'marketing_silver', count(*) - count(distinct marketingid),
              count(*) - count(marketingid) from marketing_silver
       union all select 'customers_silver', count(*) - count(distinct clientid),
              count(*) - count(clientid) from customers_silver"""))
def audit_silver_keys(spark, d):
    """Silver uniqueness probe per table: rows beyond one per key, and NULL keys."""
    s = silver_layer(spark, d)
    parts = [df.agg(F.lit(name).alias("table_name"),
                    (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_keys"),
                    (F.count(F.lit(1)) - F.count(key)).alias("null_keys"))
             for name, df, key in (("orders_silver", s.orders, "orderid"),
                                   ("marketing_silver", s.marketing, "marketingid"),
                                   ("customers_silver", s.customers, "clientid"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- SQL front: report statements as text over the registered layers ------------------------

def _sql_layers(spark, d):
    from .sql_views import register_layers
    register_layers(spark, bronze(spark, d), silver_layer(spark, d))


@register("sql_revenue_by_month_country", with_flow(
    """select strftime(transactiondate, '%Y-%m') as year_month, country,
              cast(sum(amount) as bigint) as order_revenue
       from gold group by 1, 2 order by 1, 2""", gold=True))
def sql_revenue_by_month_country(spark, d):
    from .sql_views import REVENUE_BY_MONTH_COUNTRY
    _sql_layers(spark, d)
    return spark.sql(REVENUE_BY_MONTH_COUNTRY)


@register("sql_marketing_effectiveness", with_flow(
    f"""select country, cast({_ATTR} as bigint) as marketing_revenue,
          round(cast(cast({_ATTR} as float) as double) / sum(amount), 6) as marketing_share
        from gold group by 1 order by 2""", gold=True))
def sql_marketing_effectiveness(spark, d):
    from .sql_views import MARKETING_EFFECTIVENESS
    _sql_layers(spark, d)
    r = spark.sql(MARKETING_EFFECTIVENESS)
    return r.withColumn("marketing_share", F.round("marketing_share", 6))

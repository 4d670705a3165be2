"""Projections, filters, scalar functions, ordering, governed views and user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.predict import batch_predict, echo_upper_model
from ..functions.udfs import (pandas_membership_flag, register_mask_function,
                              register_row_filter_function)
from ..operators import governance as Gv
from ..operators import ordering as O
from ..operators import profile as Pr
from ..operators import quality as Q
from ..operators.joins import band_join
from ..sources import fixtures
from . import gold as G
from . import silver as S
from .fixture_sql import with_flow
from .registry import bronze, gold_table, register, silver_layer

# Group names of the governed views and the excluded channel.
MASK_GROUP = "pii_readers"
ADMIN_GROUP = "ultra-admin"
EXCLUDED_CHANNELS = ("Call Center",)
PROMPT = "Write a short holiday promotion, in the language of this country: "
FILTER_KEYS = (1, 3, 4, 6, 7, 10)

_MASK_SQL = "left(email, 2) || repeat('*', cast(length(email) - 2 as integer))"

# ---- P2, P3, P7 - P11, P14 -------------------------------------------------------------


@register("qualified_star_join", with_flow(
    "select a.*, b.* from orders_silver a join customers_silver b on a.customerid = b.clientid"))
def qualified_star_join(spark, d):
    s = silver_layer(spark, d)
    j = s.orders.alias("a").join(s.customers.alias("b"), F.col("a.customerid") == F.col("b.clientid"))
    return j.select("a.*", "b.*")


@register("star_except", with_flow(
    "select * exclude (double_attribution) from flagged", gold=True))
def star_except(spark, d):
    return G.attribution_staging(silver_layer(spark, d), 7).drop("double_attribution")


@register("filter_not_null", with_flow(
    "select * from orders_bronze where customerid is not null", silver=False, with_nulls=True))
def filter_not_null(spark, d):
    return bronze(spark, d, with_nulls=True).orders.filter(F.col("customerid").isNotNull())


@register("filter_equality", with_flow("select * from marketing_silver where clicked = 1"))
def filter_equality(spark, d):
    return G.clicked(silver_layer(spark, d).marketing)


@register("filter_in_list", with_flow(
    f"select * from customers_silver where clientid in {FILTER_KEYS}"))
def filter_in_list(spark, d):
    return silver_layer(spark, d).customers.filter(F.col("clientid").isin(*FILTER_KEYS))


@register("filter_not_in_list", with_flow(
    "select * from customers_bronze where channel not in ('Call Center')", silver=False))
def filter_not_in_list(spark, d):
    return bronze(spark, d).customers.filter(~F.col("channel").isin(*EXCLUDED_CHANNELS))


@register("filter_between_columns", with_flow("""
select a.*, b.* from orders_silver a join marketing_silver b
  on a.customerid = b.targetedcustomerid
 and a.transactiondate between b.marketingdate and b.marketingdate + interval '7' day"""))
def filter_between_columns(spark, d):
    s = silver_layer(spark, d)
    return band_join(s.orders, s.marketing, left_key="customerid", right_key="targetedcustomerid",
                     left_ts="transactiondate", right_ts="marketingdate", days=7, how="inner")


@register("cte_chain", with_flow(
    "select country, count(*) as customers from customers_silver group by country"))
def cte_chain(spark, d):
    """distinct rows -> shared emails -> NOT IN -> per-country count."""
    c = S.customers_clean(bronze(spark, d).customers)
    return c.groupBy("country").agg(F.count(F.lit(1)).alias("customers"))


# ---- F1, F3, F8, F12 - F15 ----------------------------------------------------------------

@register("case_when", with_flow(
    "select orderid, case when marketingid is not null then amount else 0 end as marketing_amount "
    "from gold", gold=True))
def case_when(spark, d):
    g = gold_table(spark, d)
    return g.select("orderid", F.when(F.col("marketingid").isNotNull(), F.col("amount"))
                    .otherwise(0).alias("marketing_amount"))


@register("interval_add_days", with_flow(
    "select marketingid, marketingdate, marketingdate + interval '7' day as window_end "
    "from marketing_silver"))
def interval_add_days(spark, d):
    m = silver_layer(spark, d).marketing
    return m.select("marketingid", "marketingdate",
                    T.in_window_end("marketingdate", 7).alias("window_end"))


@register("clean_text_columns", """
select doc_id, length(text) as n_chars_in, length(t) as n_chars_out, md5(t) as text_md5
from (select doc_id, text, replace(replace(text, ',', ''), chr(10), ' ') as t from documents)""")
def clean_text_columns(spark, d):
    """Whole document texts cleaned (',' removed, newline -> space); per document the
    lengths before / after and a digest of the cleaned text."""
    docs = fixtures.table(spark, d, "documents")
    t = T.clean_text("text")
    return docs.select("doc_id", F.length("text").cast("bigint").alias("n_chars_in"),
                       F.length(t).cast("bigint").alias("n_chars_out"), F.md5(t).alias("text_md5"))


@register("prefixed_keys", with_flow("""
select 'customers' as entity, 'c-' || cast(clientid as varchar) as surrogate_key from customers_silver
union all select 'orders', 'o-' || cast(orderid as varchar) from orders_silver
union all select 'marketing', 'a-' || cast(marketingid as varchar) from marketing_silver"""))
def prefixed_keys(spark, d):
    s = silver_layer(spark, d)
    parts = [df.select(F.lit(ent).alias("entity"),
                       T.prefixed_key(key, T.KEY_PREFIXES[ent]).alias("surrogate_key"))
             for ent, df, key in (("customers", s.customers, "clientid"),
                                  ("orders", s.orders, "orderid"),
                                  ("marketing", s.marketing, "marketingid"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("timestamp_text_roundtrip", with_flow("""
select orderid, strftime(transactiondate, '%Y-%m-%d %H:%M:%S') as ts_text,
       strptime(strftime(transactiondate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as ts_back
from orders_silver"""))
def timestamp_text_roundtrip(spark, d):
    o = silver_layer(spark, d).orders
    txt = T.ts_to_text("transactiondate", ntz=True)
    return o.select("orderid", txt.alias("ts_text"), T.text_to_ts(txt, ntz=True).alias("ts_back"))


@register("round_half_even", """
select event_id, round_even(value, 0) as value_rounded,
       cast(round_even(value * 4, 0) as bigint) as quarters from events""")
def round_half_even(spark, d):
    ev = fixtures.table(spark, d, "events")
    return ev.select("event_id", T.round_half_even("value", 0).alias("value_rounded"),
                     T.round_half_even(F.col("value") * 4, 0).cast("bigint").alias("quarters"))


@register("prompt_concat", with_flow(
    f"select clientid, email, country, '{PROMPT}' || country as prompt from customers_silver "
    "where country is not null"))
def prompt_concat(spark, d):
    c = silver_layer(spark, d).customers.filter(F.col("country").isNotNull())
    return c.select("clientid", "email", "country", T.prompt(PROMPT, "country").alias("prompt"))


@register("batch_predict", with_flow(
    f"select clientid, email, country, '{PROMPT}' || country as prompt, "
    f"upper('{PROMPT}' || country) as response from customers_silver where country is not null"))
def batch_predict_key(spark, d):
    """Model enrichment of every customer with a country (stand-in model, one per task)."""
    c = prompt_concat(spark, d)
    return batch_predict(c, "prompt", echo_upper_model)


# ---- T1 - T5, U2 ---------------------------------------------------------------------------

@register("order_by_ordinal", with_flow(
    "select country, channel, count(*) as customers from customers_silver group by 1, 2 "
    "order by 1, 2"))
def order_by_ordinal(spark, d):
    c = silver_layer(spark, d).customers
    return c.groupBy("country", "channel").agg(F.count(F.lit(1)).alias("customers")) \
        .orderBy("country", "channel")


@register("order_by_mixed", with_flow(
    "select * from customers_silver order by country asc, creation_date desc"))
def order_by_mixed(spark, d):
    return silver_layer(spark, d).customers.orderBy(F.col("country").asc(),
                                                    F.col("creation_date").desc())


@register("preview_limit", with_flow("select * from gold order by orderid limit 6", gold=True))
def preview_limit(spark, d):
    """Six rows of gold; by order id, so that the preview is the same on every run."""
    return gold_table(spark, d).orderBy("orderid").limit(6)


@register("top_k_by_key", with_flow(
    "select * from customers_bronze order by clientid limit 7", silver=False))
def top_k_by_key(spark, d):
    return O.top_k(bronze(spark, d).customers, "clientid", 7)


@register("drop_last_n", with_flow("""select * exclude (rn) from (
    select *, row_number() over (order by clientid desc nulls first) as rn from customers_bronze)
    where rn > 22""", silver=False))
def drop_last_n(spark, d):
    return O.drop_last_n(bronze(spark, d).customers, "clientid", 22)


@register("bootstrap_duplicates", with_flow("select * from customers_bronze", silver=False))
def bootstrap_duplicates(spark, d):
    """Planted repeats chosen by a key rule (every 25th customer appears twice)."""
    base = fixtures.customers_base(spark, d)
    return O.append_repeats(base, F.col("clientid") % 25 == 0)


@register("bootstrap_duplicates_drawn", with_flow("""
  (select * from base) union all
  (select b.* from draws join ranked r on r.place = draws.place join base b on b.clientid = r.clientid)""",
  silver=False, extra="""
base as (select * from cust0),
ranked as (select clientid, row_number() over (order by md5(cast(clientid as varchar))) - 1 as place from base),
rows_ as (select count(*) as n from base),
numbers as (select i, n from rows_, range(100000000) t(i) where i < round_even(n * 0.04, 0)),
draws as (select cast(floor(cast('0x' || substr(md5('310:' || i), 1, 13) as bigint) / 4503599627370496.0 * n) as bigint) as place
          from numbers)"""))
def bootstrap_duplicates_drawn(spark, d):
    """Exactly round(0.04 N) repeats drawn with replacement, the same ones however the table is partitioned."""
    return O.append_drawn_repeats(fixtures.customers_base(spark, d), 0.04, seed=310, identity=F.col("clientid").cast("string"))


# ---- A14 -------------------------------------------------------------------------------------

def _profile_sql():
    cols = [("clientid", True), ("email", False), ("country", False), ("channel", False),
            ("creation_date", False)]
    parts = []
    for c, numeric in cols:
        mean = f"round(avg({c}), 6)" if numeric else "cast(null as double)"
        parts.append(f"select '{c}' as column_name, count({c}) as count, "
                     f"count(*) - count({c}) as nulls, cast(min({c}) as varchar) as min, "
                     f"cast(max({c}) as varchar) as max, {mean} as mean from customers_silver")
    return with_flow("\nunion all ".join(parts))


@register("table_profile", _profile_sql())
def table_profile(spark, d):
    """Exact part of the profile (counts, NULLs, min, max, mean); the approximate distinct
    count and type names are left out of the comparison."""
    p = Q.table_profile(silver_layer(spark, d).customers)
    return p.select(F.col("column").alias("column_name"), "count", "nulls", "min", "max",
                    F.round("mean", 6).alias("mean"))


_PROFILED = {"customers_silver": [("clientid", True), ("email", False), ("country", False), ("channel", False), ("creation_date", False)],
             "orders_silver": [("orderid", True), ("transactiondate", False), ("items", True), ("amount", True), ("customerid", True)]}


def _profiled(spark, d):
    s = silver_layer(spark, d)
    return {"customers_silver": s.customers, "orders_silver": s.orders}


def _each_column(sql) -> str:
    return with_flow("\nunion all ".join(sql(t, c, n) for t, cols in _PROFILED.items() for c, n in cols))


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_MOMENTS = "round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev"


@register("table_profile_merged", _each_column(lambda t, c, n: f"""
select '{t}' as table_name, '{c}' as column_name, count(*) as num_rows, count(*) - count({c}) as nulls,
       {f"cast(min({c}) as varchar)" if n else "null::varchar"} as lo, {f"cast(max({c}) as varchar)" if n else "null::varchar"} as hi,
       {_MOMENTS.format(c=c) if n else "null::double as mean, null::double as stddev"} from {t}"""))
def table_profile_merged(spark, d):
    """Exact part of the sketch profile, taken per channel (customers) and per number of items (orders) and then merged."""
    parts = []
    for name, df in _profiled(spark, d).items():
        p = Pr.summary(Pr.merged(Pr.sketches(df.withColumn("part", df[{"customers_silver": "channel", "orders_silver": "items"}[name]]), by="part")))
        number = F.col("data_type").isin("bigint", "int")
        parts.append(p.select(
            F.lit(name).alias("table_name"), F.col("column").alias("column_name"), F.col("rows").alias("num_rows"), "nulls",
            F.when(number, F.col("min")).alias("lo"), F.when(number, F.col("max")).alias("hi"),
            F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev")))
    return _union(parts)


@register("frequent_values", with_flow("\nunion all ".join(f"""
select '{t}' as table_name, '{c}' as column_name, cast({c} as varchar) as value, count(*) as n from {t} group by {c}
having count(*) >= 0.01 * (select count(*) from {t})""" for t, cols in _PROFILED.items() for c, _ in cols if not c.endswith("date"))))
def frequent_values(spark, d):
    """Every value that at least 1 % of a column's rows hold, found by a frequency sketch and counted exactly."""
    parts = []
    for name, df in _profiled(spark, d).items():
        df = df.select(*[c for c in df.columns if not c.endswith("date")])
        found = Pr.frequent_values(df, Pr.merged(Pr.sketches(df)), 0.01)
        parts.append(found.select(F.lit(name).alias("table_name"), F.col("column").alias("column_name"), "value", "n"))
    return _union(parts)


@register("profile_quantile_ranks", _each_column(lambda t, c, n: f"""
select '{t}' as table_name, '{c}' as column_name, q as quantile, true as within_bound from {t}, (values (0.25::double), (0.5), (0.75)) v(q)
group by q""" if n or c.endswith("date") else f"""
select '{t}', '{c}', 0.0::double, true from {t} where false"""))
def profile_quantile_ranks(spark, d):
    """For each column on the number line, whether the sketch's quartiles have their rank to within 2 %, counted exactly."""
    parts = []
    for name, df in _profiled(spark, d).items():
        e = Pr.rank_errors(df, Pr.merged(Pr.sketches(df)))
        parts.append(e.select(F.lit(name).alias("table_name"), F.col("column").alias("column_name"), "quantile", (F.col("error") < 0.02).alias("within_bound")))
    return _union(parts)


# ---- G1 - G3, X1 - X3 -----------------------------------------------------------------------

def _masked(spark, d, groups):
    c = silver_layer(spark, d).customers
    return Gv.secured_view(c, groups, masks={"email": Gv.prefix_mask(2, "*", MASK_GROUP)})


@register("mask_email_column", with_flow(
    f"select clientid, {_MASK_SQL} as email, country, channel, creation_date from customers_silver"))
def mask_email_column(spark, d):
    return _masked(spark, d, [MASK_GROUP])


@register("mask_email_nonmember", with_flow("select * from customers_silver"))
def mask_email_nonmember(spark, d):
    return _masked(spark, d, [])


def _filtered(spark, d, groups):
    c = silver_layer(spark, d).customers
    return Gv.secured_view(c, groups, row_filters=[
        Gv.exclude_values("channel", EXCLUDED_CHANNELS, ADMIN_GROUP)])


@register("row_filter_channel", with_flow(
    "select * from customers_silver where channel not in ('Call Center')"))
def row_filter_channel(spark, d):
    return _filtered(spark, d, [])


@register("row_filter_admin", with_flow("select * from customers_silver"))
def row_filter_admin(spark, d):
    return _filtered(spark, d, [ADMIN_GROUP])


@register("filtered_customers_by_channel", with_flow(
    "select channel, count(*) as customers from customers_silver "
    "where channel not in ('Call Center') group by 1 order by 1"))
def filtered_customers_by_channel(spark, d):
    v = _filtered(spark, d, [])
    return v.groupBy("channel").agg(F.count(F.lit(1)).alias("customers")).orderBy("channel")


@register("sql_udf_mask", with_flow(
    f"select clientid, {_MASK_SQL} as email, country, channel, creation_date from customers_silver"))
def sql_udf_mask(spark, d):
    silver_layer(spark, d).customers.createOrReplaceTempView("customers_view")
    fn = register_mask_function(spark, [MASK_GROUP], group=MASK_GROUP)
    return spark.sql(f"SELECT clientid, {fn}(email) AS email, country, channel, creation_date "
                     "FROM customers_view")


@register("sql_udf_row_filter", with_flow(
    "select * from customers_silver where channel not in ('Call Center')"))
def sql_udf_row_filter(spark, d):
    silver_layer(spark, d).customers.createOrReplaceTempView("customers_view")
    fn = register_row_filter_function(spark, [], admin_group=ADMIN_GROUP,
                                      excluded=EXCLUDED_CHANNELS)
    return spark.sql(f"SELECT * FROM customers_view WHERE {fn}(channel)")


@register("pandas_udf_flag", with_flow("""select *, case when customerid in
    (select clientid from customers_silver) then 'Y' else 'N' end as customerid_is_valid
    from orders_bronze where customerid is not null"""))
def pandas_udf_flag(spark, d):
    s = silver_layer(spark, d)
    o = bronze(spark, d).orders.filter(F.col("customerid").isNotNull())
    return pandas_membership_flag(o, "customerid", s.customers, "clientid")


@register("double_attribution_lag_only", with_flow(
    "select orderid, marketingid, double_attribution from flagged", gold=True))
def double_attribution_lag_only(spark, d):
    st = G.attribution_staging(silver_layer(spark, d), 7)
    return st.select("orderid", "marketingid", "double_attribution")


@register("bootstrap_duplicates_sampled")
def bootstrap_duplicates_sampled(spark, d):
    """Random repeats: a 4 % sample with replacement (fixed seed) appended (rows-only)."""
    return O.append_sampled_repeats(fixtures.customers_base(spark, d), 0.04, seed=310)


@register("sql_named_parameter", with_flow("""
select country, count(*) as orders_in_window from gold
where marketingdate is not null and transactiondate <= marketingdate + interval '3' day
group by country""", gold=True))
def sql_named_parameter(spark, d):
    """A run-time parameter bound by name in SQL text (``:days``), over the gold view."""
    from .sql_views import register_layers
    register_layers(spark, bronze(spark, d), silver_layer(spark, d))
    return spark.sql("""select country, count(*) as orders_in_window from gold_order_attribution
        where marketingdate is not null
          and transactiondate <= marketingdate + make_dt_interval(:days)
        group by country""", args={"days": 3})

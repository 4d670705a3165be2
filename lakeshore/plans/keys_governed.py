"""Policies attached to a name, model calls on distinct prompts, and refreshes without a gap."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predict import predict_distinct
from ..operators import policies as Po
from ..session import fresh_path, materialize
from ..sources import refresh as R
from .fixture_sql import with_flow
from .keys_functions import ADMIN_GROUP, EXCLUDED_CHANNELS, MASK_GROUP, PROMPT
from .registry import bronze, register, silver_layer

# ---- G1 - G3: attach and detach ------------------------------------------------------------

#: Session states under which one query text is run: the caller's groups, and which policies are attached.
STATES = [("plain", [], False, False), ("member", [MASK_GROUP], True, False), ("other", [], True, True),
          ("admin", [MASK_GROUP, ADMIN_GROUP], True, True), ("detached", [MASK_GROUP], False, False)]


def _by_state(spark, d, query: str) -> DataFrame:
    """The rows of ``query`` over the governed view ``customers``, once per state, each with the state's name."""
    suffix = uuid.uuid4().hex[:8]
    silver_layer(spark, d).customers.createOrReplaceTempView(f"customers_{suffix}")
    view = Po.GovernedView(spark, f"governed_{suffix}", f"customers_{suffix}")
    parts = []
    for name, groups, masked, filtered in STATES:
        Po.set_caller(spark, groups)
        view.set_mask("email", Po.prefix_mask("email", MASK_GROUP)) if masked else view.drop_mask("email")
        if filtered:
            view.set_row_filter("channel", Po.exclude_values("channel", EXCLUDED_CHANNELS, ADMIN_GROUP))
        else:
            view.drop_row_filter("channel")
        rows = spark.sql(query.format(view=f"governed_{suffix}")).withColumn("state", F.lit(name))
        parts.append(materialize(rows, "governed"))  # the state changes before the result is read
    view.drop()
    Po.set_caller(spark, [])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _states_sql(select: str, group: str = "") -> str:
    masked = "left(email, 2) || repeat('*', cast(length(email) - 2 as integer))"
    hidden = " and ".join(f"channel <> '{c}'" for c in EXCLUDED_CHANNELS)
    sql = []
    for name, groups, mask, filtered in STATES:
        email = masked if mask and MASK_GROUP in groups else "email"
        where = f" where {hidden}" if filtered and ADMIN_GROUP not in groups else ""
        sql.append(f"select {select}, '{name}' as state from (select * replace ({email} as email) from customers_silver{where}){group}")
    return with_flow("\nunion all ".join(sql))


@register("policy_states", _states_sql("*"))
def policy_states(spark, d):
    """One query text over a governed name: plain, masked, filtered, both for an admin, and detached again."""
    return _by_state(spark, d, "SELECT * FROM {view}")


@register("policy_channel_counts", _states_sql(
    "channel, count(*) as customers, count(*) filter (email like '__*%') as masked", " group by channel"))
def policy_channel_counts(spark, d):
    """Customers per channel as each caller sees them."""
    return _by_state(spark, d, """SELECT channel, count(*) AS customers, count_if(email LIKE '__*%') AS masked
        FROM {view} GROUP BY channel""")


# ---- X4: model calls -----------------------------------------------------------------------

#: A country whose prompt the stand-in model cannot answer.
UNANSWERED = "FRANCE"


def _stand_in():
    def model(prompts: pd.Series) -> pd.Series:
        if prompts.str.endswith(UNANSWERED).any():
            raise RuntimeError("no answer")
        return prompts.str.upper()
    return model


@register("predict_distinct", with_flow(f"""select clientid, email, country,
    case when country <> '{UNANSWERED}' then upper('{PROMPT}' || country) end as response,
    case when country = '{UNANSWERED}' then 'RuntimeError: no answer' end as error
    from customers_silver where country is not null"""))
def predict_distinct_prompts(spark, d):
    """A promotion per customer: the model sees each country once, and the one it fails on costs no other row."""
    c = silver_layer(spark, d).customers.filter(F.col("country").isNotNull()).select("clientid", "email", "country")
    return predict_distinct(c.withColumn("prompt", F.concat(F.lit(PROMPT), "country")), "prompt", _stand_in).drop("prompt")


# ---- K3, K4: full refresh --------------------------------------------------------------------

NOTES = {"clientid": "customer key", "email": "personal data", "channel": "first contact"}


def _refreshed(spark, d):
    """Bronze customers as a table, then refreshed to the distinct ones; a reader was planned in between."""
    database = f"lakeshore_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{fresh_path(spark, database)}'")
    rows, table = bronze(spark, d).customers, f"`{database}`.`customers`"
    R.full_refresh(rows, table, "customers of the landing files", NOTES)
    early = spark.table(table)
    R.full_refresh(rows.distinct(), table)
    return early, table


@register("full_refresh", with_flow("select distinct * from customers_bronze", silver=False))
def full_refresh(spark, d):
    """A table after its full refresh through the catalog, read by name."""
    return spark.table(_refreshed(spark, d)[1])


@register("full_refresh_readers", with_flow("""
select 'began before' as reader, count(*) as num_rows from customers_bronze
union all select 'began after', count(*) from (select distinct * from customers_bronze)""", silver=False))
def full_refresh_readers(spark, d):
    """What a reader sees that was planned before the switch, and one after it."""
    early, table = _refreshed(spark, d)
    count = lambda df, name: df.agg(F.lit(name).alias("reader"), F.count(F.lit(1)).alias("num_rows"))
    return count(early, "began before").unionByName(count(spark.table(table), "began after"))


@register("full_refresh_columns", with_flow("\nunion all ".join(
    f"select '{c}' as col_name, '{t}' as data_type, {repr(NOTES[c]) if c in NOTES else 'null'}::varchar as comment, count({c}) as filled from customers_bronze0"
    for c, t in (("clientid", "bigint"), ("email", "string"), ("country", "string"), ("channel", "string"), ("creation_date", "timestamp_ntz"))),
    silver=False, extra="customers_bronze0 as (select distinct * from customers_bronze)"))
def full_refresh_columns(spark, d):
    """Columns, types and comments of the refreshed table as the catalog tells them, with the rows that have a value."""
    return R.column_profile(spark, _refreshed(spark, d)[1])

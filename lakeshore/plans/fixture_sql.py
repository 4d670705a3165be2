"""The test-table mapping and the bronze -> silver -> gold flow as plain SQL.

Written once and shared by every oracle string: it is the specification the Spark
operators are checked against (DuckDB's dialect).
"""

from __future__ import annotations


def bronze_ctes(with_nulls: bool = False, string_type: str = "varchar",
                hot_customer: int | None = None) -> str:
    email = ("concat('u', cast(case when c_custkey % 50 = 1 then c_custkey - 1 else c_custkey end "
             f"as {string_type}), '@example.com')")
    cust_ref = "user_id"
    if with_nulls and with_nulls != "refs":
        email = f"case when c_custkey % 97 = 0 then null else {email} end"
    if hot_customer is not None:
        cust_ref = f"case when event_id % 3 = 0 then cast({hot_customer} as bigint) else user_id end"
    if with_nulls:
        cust_ref = f"case when event_id % 97 = 0 then null else {cust_ref} end"
    return f"""
cust0 as (
  select c_custkey as clientid,
    {email} as email,
    n_name as country,
    case when c_custkey % 10 < 3 then 'Web' when c_custkey % 10 < 5 then 'Call Center' else 'App' end as channel,
    timestamp '2024-01-01 00:00:00' + interval '1' day * cast(c_custkey % 20 as int) as creation_date
  from customer join nation on c_nationkey = n_nationkey),
customers_bronze as (select * from cust0 union all select * from cust0 where clientid % 25 = 0),
ord0 as (
  select event_id as orderid, ts as transactiondate, cast(event_id % 4 + 1 as int) as items,
    cast(floor(value) as int) as amount, {cust_ref} as customerid
  from events where event_type = 'purchase'),
orders_bronze as (select * from ord0 union all select * from ord0 where orderid % 21 = 0),
marketing_bronze as (
  select event_id as marketingid, ts as marketingdate, cast(event_id % 42 as double) / 100 as discount,
    case when event_type = 'click' then 1 else 0 end as clicked, {cust_ref} as targetedcustomerid
  from events where event_type in ('click', 'view'))"""


# Silver, by its definition. A customer row (taken once) leaves if its email is held by several
# clients. That test is SQL's NOT IN: once any email is shared a missing email is never kept, and
# if the missing email itself is shared nothing is. Orders and campaigns (taken once) stay if
# their customer is in silver.
SILVER_CTES = """
email_holders as (
  select email, count(distinct clientid) as recs from customers_bronze group by email),
shared_emails as (select email, recs from email_holders where recs > 1),
shared_facts as (select count(*) as n, count(*) - count(email) as without_email from shared_emails),
customers_silver as (
  select distinct c.clientid, c.email, c.country, c.channel, c.creation_date
  from customers_bronze c cross join shared_facts f
  left join shared_emails s on s.email = c.email
  where f.n = 0 or (f.without_email = 0 and c.email is not null and s.email is null)),
orders_silver as (
  select o.orderid, o.transactiondate, o.items, o.amount, o.customerid
  from orders_bronze o semi join customers_silver c on c.clientid = o.customerid
  group by all),
marketing_silver as (
  select m.marketingid, m.marketingdate, m.discount, m.clicked, m.targetedcustomerid
  from marketing_bronze m semi join customers_silver c on c.clientid = m.targetedcustomerid
  group by all)"""


def gold_ctes(days: int = 7) -> str:
    """Gold, by its definition: every order with each clicked campaign sent to its customer in
    the ``days`` before it (or none); of these the one with the highest discount, then the
    latest date, then the highest id; the customer must exist on the order's day."""
    return f"""
clicked_campaigns as (
  select *, marketingdate + interval '{days}' day as last_moment from marketing_silver where clicked = 1),
candidates as (
  select o.*, m.* exclude (last_moment)
  from orders_silver o left join clicked_campaigns m
    on m.targetedcustomerid = o.customerid
   and m.marketingdate <= o.transactiondate and m.last_moment >= o.transactiondate),
placed as (
  select *, row_number() over (partition by orderid
      order by discount desc nulls last, marketingdate desc nulls last, marketingid desc nulls last) as place
  from candidates),
flagged as (
  select * exclude (place), cast(orderid is not null and place > 1 as integer) as double_attribution
  from placed),
flagged_customers as (select f.*, c.* from flagged f left join customers_silver c on c.clientid = f.customerid),
gold as (
  select f.* exclude (double_attribution), c.*
  from flagged f join customers_silver c
    on c.clientid = f.customerid and c.creation_date < date_trunc('day', f.transactiondate) + interval '1' day
  where f.double_attribution = 0)"""


def with_flow(select: str, *, silver: bool = True, gold: bool = False, days: int = 7,
              with_nulls: bool = False, extra: str = "", hot_customer: int | None = None) -> str:
    """``with <bronze>[, <silver>][, <gold>][, extra] <select>``."""
    parts = [bronze_ctes(with_nulls, hot_customer=hot_customer)]
    if silver or gold:
        parts.append(SILVER_CTES)
    if gold:
        parts.append(gold_ctes(days))
    if extra:
        parts.append(extra)
    return "with " + ",".join(parts) + "\n" + select

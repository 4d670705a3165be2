"""The pair-free attribution against brute force on random data with a hot customer."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeshore.operators.attribution import best_in_window
from lakeshore.operators.joins import band_join


def _brute(orders, camps, days):
    w = dt.timedelta(days=days)
    out = {}
    for o in orders:
        cands = [c for c in camps if c[4] == o[4] and c[3] == 1 and c[1] <= o[1] <= c[1] + w]
        best = max(cands, key=lambda c: (c[2], c[1], c[0]), default=None)
        out[o[0]] = best[0] if best else None
    return out


@pytest.mark.parametrize("seed,days,split", [(1, 7, None), (2, 1, None), (3, 10, None), (4, 2, None), (5, 7, 86_400_000_000), (6, 1, 86_400_000_000), (7, 3, 600_000_000)])
def test_random_against_brute_force(spark, seed, days, split):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    # customer 0 holds about a third of everything (a hot key); times hit day edges often
    def cust():
        return 0 if rnd.random() < 0.33 else rnd.randint(1, 20)

    def when():
        r = rnd.random()
        if r < 0.2:
            return base + dt.timedelta(days=rnd.randint(0, 30))            # midnight
        if r < 0.35:
            return base + dt.timedelta(hours=rnd.randint(0, 30 * 24))     # on the hour
        if r < 0.45:   # the last microsecond of an hour
            return base + dt.timedelta(hours=rnd.randint(1, 30 * 24)) - dt.timedelta(microseconds=1)
        return base + dt.timedelta(seconds=rnd.randint(0, 30 * 86400), microseconds=rnd.randint(0, 999999))

    camps = []
    for i in range(400):
        t = when()
        camps.append((1000 + i, t, rnd.choice([0.1, 0.2, 0.3]), rnd.choice([0, 1, 1]), cust()))
    orders = []
    for i in range(300):
        if rnd.random() < 0.15 and camps:      # exactly on a window edge of a campaign
            c = rnd.choice(camps)
            t = c[1] + dt.timedelta(days=days) if rnd.random() < 0.5 else c[1]
            orders.append((i, t, 1, 5, c[4]))
        else:
            orders.append((i, when(), 1, 5, cust()))
    o = spark.createDataFrame(orders, "orderid int, transactiondate timestamp_ntz, items int, "
                                      "amount int, customerid int")
    m = spark.createDataFrame(camps, "marketingid int, marketingdate timestamp_ntz, discount double, "
                                     "clicked int, targetedcustomerid int").filter("clicked = 1")
    kw = {"split_us": split} if split else {}
    got = {r.orderid: r.marketingid for r in best_in_window(o, m, days=days, **kw).collect()}
    assert got == _brute(orders, camps, days)
    pairs = band_join(o, m, left_key="customerid", right_key="targetedcustomerid",
                      left_ts="transactiondate", right_ts="marketingdate", days=days, how="inner")
    w = dt.timedelta(days=days)
    want = sum(1 for x in orders for c in camps
               if c[4] == x[4] and c[3] == 1 and c[1] <= x[1] <= c[1] + w)
    assert pairs.count() == want
    daily = band_join(o, m, left_key="customerid", right_key="targetedcustomerid",
                      left_ts="transactiondate", right_ts="marketingdate", days=days, how="inner",
                      bucket_days=1)
    assert daily.count() == want


@pytest.mark.parametrize("days", [1, 2, 7])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_calendar_days_across_clock_changes(spark, kind, days):
    """Both interval operators equal plain SQL in a zone with clock changes, on the declared types
    (STRING ids, FLOAT discounts that tie)."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")
    try:
        rnd = random.Random(days)
        # around 2024-03-31 01:00 UTC and 2024-10-27 01:00 UTC, on quarters of an hour
        bases = [dt.datetime(2024, 3, 30), dt.datetime(2024, 10, 26)]

        def times(n, spread):
            return [(str(i), str(rnd.choice(bases) + dt.timedelta(minutes=15 * rnd.randint(-spread, 192))),
                     rnd.choice([0.1, 0.2]), str(rnd.randint(1, 3))) for i in range(n)]

        def load(rows, names):
            t = "cast(t || 'Z' as timestamp)" if kind == "timestamp" \
                else "cast(t as timestamp_ntz)"
            df = spark.createDataFrame(rows, "i string, t string, d double, c string")
            return df.selectExpr("i", f"{t} as t", "cast(d as float) as d", "c").toDF(*names)

        o = load(times(300, 96), ["orderid", "transactiondate", "o_d", "customerid"])
        m = load(times(300, 96 * (days + 1)), ["marketingid", "marketingdate", "discount", "targetedcustomerid"])
        o.createOrReplaceTempView("o_")
        m.createOrReplaceTempView("m_")
        sql = spark.sql(f"""select o_.*, m_.* from o_ left join m_ on customerid = targetedcustomerid
            and transactiondate between marketingdate and marketingdate + interval '{days}' day""")
        want = sorted((r.orderid, r.marketingid or "") for r in sql.collect())
        pairs = band_join(o, m, left_key="customerid", right_key="targetedcustomerid",
                          left_ts="transactiondate", right_ts="marketingdate", days=days)
        assert sorted((r.orderid, r.marketingid or "") for r in pairs.collect()) == want
        first = {}
        for r in sql.collect():
            at = None if r.marketingid is None else (r.discount, r.marketingdate, r.marketingid)
            if r.orderid not in first or (at and at > first[r.orderid]):
                first[r.orderid] = at
        for split in (3_600_000_000, 43_200_000_000):
            got = {r.orderid: None if r.marketingid is None else (r.discount, r.marketingdate, r.marketingid)
                   for r in best_in_window(o, m, days=days, split_us=split).collect()}
            assert got == first
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_one_customer_and_one_hour_grows_linearly(spark):
    """8 times the rows of one customer and one hour take far less than the 64 times of pairs."""
    import time

    def run(n):
        at = F.expr("timestamp_ntz'2024-01-01 10:00:00'") + F.make_dt_interval(
            secs=(F.col("id") * 3000.0 / n).cast("decimal(18,6)"))
        o = spark.range(n).select(F.col("id").alias("orderid"), at.alias("transactiondate"),
                                  F.lit(1).alias("customerid"))
        m = spark.range(n).select(F.col("id").alias("marketingid"), at.alias("marketingdate"),
                                  (F.col("id") % 7).alias("discount"), F.lit(1).alias("targetedcustomerid"))
        start = time.monotonic()
        assert best_in_window(o, m, days=7).filter("marketingid is not null").count() == n
        return time.monotonic() - start

    run(4000)
    small, large = run(4000), run(32000)
    assert large < 16 * small, (small, large)

"""Pairs of orders and campaigns with their flag, straight out of the join."""

import datetime as dt
import random

import pytest

from lakeshore import session
from lakeshore.operators import attribution
from lakeshore.operators.attribution import double_attribution_flag
from lakeshore.plans import gold as G

BASE = dt.datetime(2024, 1, 1)


def _silver(spark, orders, camps, typ="timestamp_ntz"):
    o = spark.createDataFrame(orders, f"orderid long, transactiondate {typ}, items int, amount int, customerid long")
    c = spark.createDataFrame(camps, f"marketingid long, marketingdate {typ}, discount double, clicked int, "
                                     "targetedcustomerid long")
    return G.Silver(None, o, c)


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("busy,typ", [(1, "timestamp_ntz"), (60, "timestamp"), (10_000, "timestamp_ntz")])
def test_flags_equal_those_over_all_pairs(spark, monkeypatch, busy, typ):
    """Repeated and NULL keys, repeated rows, NaN and both zeros among the ranks; few or all customers busy."""
    monkeypatch.setattr(attribution, "BUSY_ORDERS", busy)
    rnd = random.Random(busy)
    at = lambda: BASE + dt.timedelta(hours=rnd.randint(0, 480)) if rnd.random() < .95 else None
    camps = [(rnd.randint(0, 60) if rnd.random() < .95 else None, at(), rnd.choice([.1, .2, 0.0, -0.0, float("nan"), None]),
              rnd.choice([1, 1, 1, 0]), rnd.choice([0, 0, 0, 1, 2, None])) for _ in range(150)]
    orders = [(rnd.randint(0, 70) if rnd.random() < .9 else None, at(), rnd.randint(1, 3), 1,
               rnd.choice([0, 0, 1, 2, 3, None])) for _ in range(120)]
    s = _silver(spark, orders + orders[:20], camps + camps[:20], typ)
    assert _rows(G.attribution_staging(s, 7)) == _rows(double_attribution_flag(G.attribution_pairs(s, 7)))


def test_no_pairs_are_written_or_shuffled(spark):
    orders = [(k, BASE + dt.timedelta(days=2, minutes=k), 1, 1, 2) for k in range(40)]
    camps = [(k, BASE + dt.timedelta(minutes=k), k / 100, 1, 2) for k in range(40)]
    s = _silver(spark, orders, camps)
    mark = session.intermediates_mark(spark)
    found = G.double_attribution_rows(s, 7)
    written = session._WRITTEN[spark.sparkContext.applicationId][mark:]
    assert max(spark.read.parquet(p).count() for p in written) <= 2 * len(camps)  # a campaign's copies, not 1600 pairs
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join LeftOuter")]
    assert "Window" not in above and "Aggregate" not in above
    assert found.count() == 1600 and found.filter("double_attribution = 0").count() == 40

"""Semantics the operators must keep (NULLs, ties, window edges, merges, masks)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import changes as X
from lakeshore.operators import governance as Gv
from lakeshore.operators.attribution import double_attribution_flag, first_per_key
from lakeshore.operators.joins import band_join_left, membership_flag, not_in
from lakeshore.plans import gold as G
from lakeshore.plans import silver as S

T = dt.datetime


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


# ---- H1: NOT IN is null-aware ------------------------------------------------------------

@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "a@x"), (2, "b@x"), (3, None), (4, "c@x")], "clientid int, email string")


def _sql_not_in(spark, left, right):
    left.createOrReplaceTempView("l_")
    right.createOrReplaceTempView("r_")
    return spark.sql("select * from l_ where email not in (select email from r_)")


@pytest.mark.parametrize("probe", [[], ["a@x"], ["a@x", None], [None]])
def test_not_in_matches_sql(spark, people, probe):
    right = spark.createDataFrame([(e,) for e in probe], "email string")
    got = rows(not_in(people, "email", right, "email"))
    want = rows(_sql_not_in(spark, people, right))
    assert got == want
    if not probe:
        assert len(got) == 4                      # empty subquery keeps NULL emails too
    if None in probe:
        assert got == []                          # a NULL in the subquery rejects all


def test_plain_anti_join_keeps_null(spark, people):
    right = spark.createDataFrame([("a@x",)], "email string")
    assert rows(not_in(people, "email", right, null_aware=False), "clientid") == [(2,), (3,), (4,)]


def test_not_in_is_not_a_broadcast_nested_loop(spark, people):
    right = spark.createDataFrame([("a@x",)], "email string")
    plan = not_in(people, "email", right)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


# ---- H3, H5: shared values, whole-row dedup ------------------------------------------------

def test_all_holders_of_a_shared_email_leave(spark):
    b = spark.createDataFrame(
        [(1, "s@x", "IT"), (2, "s@x", "IT"), (3, "u@x", "IT"), (3, "u@x", "IT"), (3, "u@x", "PT")],
        "clientid int, email string, country string")
    out = rows(S.customers_clean(b, "clientid", "email"))
    # both holders of s@x removed; key 3 keeps its two different rows (dedup is per row)
    assert out == [(3, "u@x", "IT"), (3, "u@x", "PT")]


def test_two_clients_without_email_empty_the_silver_table(spark):
    b = spark.createDataFrame([(1, None), (2, None), (3, "u@x")], "clientid int, email string")
    assert rows(S.customers_clean(b, "clientid", "email")) == []


# ---- H4, O7, O8: deletes ------------------------------------------------------------------

def test_delete_in_never_deletes_null(spark):
    t = spark.createDataFrame([(1, None), (2, None), (3, "s"), (4, "s"), (5, "u")],
                              "clientid int, email string")
    shared = t.groupBy("email").count().filter("count > 1")       # holds NULL and 's'
    assert rows(X.delete_in(t, "email", shared), "clientid") == [(1,), (2,), (5,)]


def test_delete_where_keeps_null_predicate_rows(spark):
    t = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    assert rows(X.delete_where(t, F.col("k") == 1)) == sorted([(None,), (3,)], key=repr)


def test_update_only_where_true(spark):
    t = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, e string")
    out = X.update_where(t, F.col("k").isin(1, 3), {"e": F.lit(None).cast("string")})
    assert sorted(out.collect(), key=str) == sorted(
        [(1, None), (None, "b"), (3, None)], key=str)


# ---- H16, H17: merges -----------------------------------------------------------------------

def test_merge_fill_null(spark):
    tgt = spark.createDataFrame([(1, None), (2, "old"), (3, None), (None, None)],
                                "clientid int, email string")
    src = spark.createDataFrame([(1, "new1"), (2, "new2"), (3, None), (4, "n4"), (None, "nk")],
                                "clientid int, email string")
    out = sorted(X.merge_fill_null(tgt, src, "clientid", "email").collect(), key=str)
    assert out == sorted([(1, "new1"), (2, "old"), (3, None), (None, None), (4, "n4"),
                          (None, "nk")], key=str)


def test_merge_multi_match_raises(spark):
    tgt = spark.createDataFrame([(1, None)], "clientid int, email string")
    src = spark.createDataFrame([(1, "a"), (1, "b")], "clientid int, email string")
    with pytest.raises(Exception, match="several source rows"):
        X.merge_fill_null(tgt, src, "clientid", "email").collect()


def test_merge_multi_match_not_applicable_is_fine(spark):
    tgt = spark.createDataFrame([(1, "set")], "clientid int, email string")
    src = spark.createDataFrame([(1, "a"), (1, "b")], "clientid int, email string")
    assert X.merge_fill_null(tgt, src, "clientid", "email").collect() == [(1, "set")]


def test_merge_insert_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a")], "clientid int, email string")
    src = spark.createDataFrame([(1, "z"), (2, "b"), (2, "c")], "clientid int, email string")
    once = X.merge_insert(tgt, src, "clientid")
    twice = X.merge_insert(once, src, "clientid")
    assert rows(once) == rows(twice) == [(1, "a"), (2, "b"), (2, "c")]


# ---- H7, H8, H10, H11, H12: attribution ---------------------------------------------------

def _silver(spark, orders, campaigns, customers=None):
    o = spark.createDataFrame(orders, "orderid int, transactiondate timestamp_ntz, items int, "
                                      "amount int, customerid int")
    m = spark.createDataFrame(campaigns, "marketingid int, marketingdate timestamp_ntz, "
                                         "discount double, clicked int, targetedcustomerid int")
    c = spark.createDataFrame(customers or [(1, "e", "IT", "Web", T(2023, 1, 1))],
                              "clientid int, email string, country string, channel string, "
                              "creation_date timestamp_ntz")
    return G.Silver(c, o, m)


def test_window_is_closed_at_both_ends(spark):
    t = T(2024, 3, 10, 12, 0, 0)
    eps = dt.timedelta(microseconds=1)
    orders = [(1, t, 1, 5, 1)]
    camps = [(10, t, 0.1, 1, 1),                          # exactly at the order: in
             (11, t - dt.timedelta(days=7), 0.2, 1, 1),   # exactly 7 days before: in
             (12, t - dt.timedelta(days=7) - eps, 0.9, 1, 1),  # one microsecond too early
             (13, t + eps, 0.9, 1, 1),                    # after the order
             (14, t - dt.timedelta(days=3), 0.3, 0, 1)]   # not clicked: ignored, order kept
    s = _silver(spark, orders, camps)
    pairs = rows(G.attribution_pairs(s, 7), "marketingid")
    assert pairs == [(10,), (11,)]
    best = G.best_attribution(s, 7).collect()
    assert [(r.orderid, r.marketingid) for r in best] == [(1, 11)]


def test_ties_and_no_campaign(spark):
    t = T(2024, 3, 10, 12, 0, 0)
    orders = [(1, t, 1, 5, 1), (2, t, 1, 5, 2)]
    camps = [(10, t - dt.timedelta(days=1), 0.2, 1, 1),
             (11, t - dt.timedelta(days=1), 0.2, 1, 1),     # same discount and date: id wins
             (12, t - dt.timedelta(days=2), 0.2, 1, 1)]
    s = _silver(spark, orders, camps)
    best = {r.orderid: r.marketingid for r in G.best_attribution(s, 7).collect()}
    assert best == {1: 11, 2: None}
    flags = rows(double_attribution_flag(G.attribution_pairs(s, 7)),
                 "orderid", "marketingid", "double_attribution")
    assert flags == [(1, 10, 1), (1, 11, 0), (1, 12, 1), (2, None, 0)]


def test_null_order_key_flag_is_zero(spark):
    t = T(2024, 3, 10)
    s = _silver(spark, [(None, t, 1, 5, 1)],
                [(10, t - dt.timedelta(days=1), 0.1, 1, 1), (11, t - dt.timedelta(days=2), 0.2, 1, 1)])
    flags = rows(double_attribution_flag(G.attribution_pairs(s, 7)), "double_attribution")
    assert flags == [(0,), (0,)]


def test_duplicate_order_key_variant_with_better_campaign_wins_then_date_filter(spark):
    # the same orderid twice (different dates); the pick happens before the customer date test
    t1, t2 = T(2024, 3, 10), T(2024, 1, 5)
    orders = [(1, t1, 1, 5, 1), (1, t2, 1, 5, 1)]
    camps = [(10, t1 - dt.timedelta(days=1), 0.1, 1, 1), (11, t2 - dt.timedelta(days=1), 0.4, 1, 1)]
    cust = [(1, "e", "IT", "Web", T(2024, 2, 1))]     # created after t2, before t1
    s = _silver(spark, orders, camps, cust)
    assert [(r.transactiondate, r.marketingid) for r in G.best_attribution(s, 7).collect()] == \
        [(t2, 11)]
    assert G.gold_attribution(s, 7).count() == 0     # the picked variant fails the date test


# ---- H13 - H15: masks and row filters -----------------------------------------------------

def test_mask_values(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",), ("ab",), ("abcdef",)], "email string")
    m = Gv.prefix_mask(2, "*", "g")
    member = [r.email for r in Gv.secured_view(df, ["g"], masks={"email": m}).collect()]
    other = [r.email for r in Gv.secured_view(df, [], masks={"email": m}).collect()]
    assert member == [None, "", "a", "ab", "ab****"]
    assert other == [None, "", "a", "ab", "abcdef"]


def test_row_filter_hides_null_channel(spark):
    df = spark.createDataFrame([("Web",), ("Call Center",), (None,)], "channel string")
    f = Gv.exclude_values("channel", ["Call Center"], "admin")
    assert [r.channel for r in Gv.secured_view(df, [], row_filters=[f]).collect()] == ["Web"]
    assert len(Gv.secured_view(df, ["admin"], row_filters=[f]).collect()) == 3


# ---- J6: membership flag is an existence join, not Python ---------------------------------

def test_membership_flag_plan_has_no_python(spark):
    o = spark.createDataFrame([(1,), (2,), (None,)], "customerid int")
    c = spark.createDataFrame([(1,), (1,)], "clientid int")
    df = membership_flag(o, "customerid", c, "clientid")
    assert sorted(df.collect(), key=str) == sorted([(1, "Y"), (2, "N"), (None, "N")], key=str)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_band_join_null_keys_pass_through(spark):
    left = spark.createDataFrame([(None, T(2024, 1, 1)), (1, None)], "k int, t timestamp_ntz")
    right = spark.createDataFrame([(1, T(2024, 1, 1))], "rk int, rt timestamp_ntz")
    out = band_join_left(left, right, left_key="k", right_key="rk", left_ts="t", right_ts="rt",
                         days=1)
    assert out.count() == 2 and out.filter(F.col("rk").isNotNull()).count() == 0


def test_first_per_key_uses_window_group_limit(spark):
    df = spark.createDataFrame([(1, 0.1, T(2024, 1, 1), 5)],
                               "orderid int, discount double, marketingdate timestamp_ntz, marketingid int")
    plan = first_per_key(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_ntz_text_is_zone_free(spark):
    from lakeshore.functions import text as T
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.5' as t, "
                       "'2024-03-10 02:30:00' as s, '2024-02-30 00:00:00' as bad")
        r = df.select(T.ts_to_text("t").alias("a"), T.month_text("t").alias("m"),
                      T.text_to_ts("s").alias("b"), T.text_to_ts("bad").alias("c")).first()
        assert r.a == "2024-03-10 02:30:00" and r.m == "2024-03"
        assert r.b == dt.datetime(2024, 3, 10, 2, 30) and r.c is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_flag_gives_zero_to_one_of_identical_first_rows(spark):
    df = spark.createDataFrame(
        [(1, 0.5, T(2024, 1, 1), 7), (1, 0.5, T(2024, 1, 1), 7), (1, 0.1, T(2024, 1, 1), 8),
         (2, None, None, None), (None, 0.3, T(2024, 1, 1), 9), (None, 0.2, T(2024, 1, 1), 9)],
        "orderid int, discount double, marketingdate timestamp_ntz, marketingid int")
    flags = sorted((r.orderid, r.marketingid, r.double_attribution)
                   for r in double_attribution_flag(df).collect() if r.orderid is not None)
    assert flags == [(1, 7, 0), (1, 7, 1), (1, 8, 1), (2, None, 0)]
    nulls = [r.double_attribution for r in double_attribution_flag(df).collect() if r.orderid is None]
    assert nulls == [0, 0]


def test_merge_upsert_several_columns_no_insert(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (2, "b2", 21)],
                                "k int, s string, n int")
    src = spark.createDataFrame([(2, "z", 99), (3, "new", 3)], "k int, s string, n int")
    out = X.merge_upsert(tgt, src, "k", set_cols={"s": "s", "n": "n"},
                         target_cond=F.col("n") > 20, insert=False)
    # only the target row meeting the condition changes; the unmatched source row is not added
    assert rows(out) == sorted([(1, "a", 10), (2, "b", 20), (2, "z", 99)], key=repr)

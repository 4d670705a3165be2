"""Silver -> gold: attribute every order to its best clicked campaign within the window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sweep
from ..operators.attribution import RANK, best_in_window, first_per_key, flagged_pairs
from ..operators.joins import band_join_left, semi_join
from ..session import materialize


@dataclass(frozen=True)
class Silver:
    customers: DataFrame
    orders: DataFrame
    marketing: DataFrame


def clicked(marketing: DataFrame) -> DataFrame:
    """The ``b.clicked = 1`` of the ON clause: restricts campaigns, never orders."""
    return marketing.filter(F.col("clicked") == 1)


def attribution_pairs(s: Silver, days: int = 7) -> DataFrame:
    """``orders LEFT JOIN clicked campaigns`` on customer and closed time window (all pairs)."""
    return band_join_left(s.orders, clicked(s.marketing), left_key="customerid",
                          right_key="targetedcustomerid", left_ts="transactiondate",
                          right_ts="marketingdate", days=days)


def attribution_staging(s: Silver, days: int = 7) -> DataFrame:
    """All pairs with the ``double_attribution`` flag (0 on the first pair of each order).

    The first pair of an order is found without pairs, so the pairs stream out of the interval join.
    """
    return flagged_pairs(s.orders, clicked(s.marketing), days=days)


def multi_attribution_orders(s: Silver, days: int = 7) -> DataFrame:
    """Orders under more than one distinct clicked campaign, with their number; no pairs."""
    return sweep.multi_attribution_orders(s.orders, clicked(s.marketing), days=days)


def double_attribution_rows(s: Silver, days: int = 7) -> DataFrame:
    """Staging rows of the orders matched to more than one distinct campaign.

    The orders are found by the sweep; only they meet their campaigns as pairs, and the flag is
    about the pairs of one order, so it is the same as over all orders.
    """
    found = materialize(semi_join(s.orders, multi_attribution_orders(s, days), "orderid"), "multi_attribution")
    return attribution_staging(Silver(s.customers, found, s.marketing), days)


def best_attribution(s: Silver, days: int = 7) -> DataFrame:
    """One row per order: the order with its first-ranked campaign (NULLs when none).

    No order x campaign pairs are formed. If an order key occurs with different attributes
    (whole-row dedup keeps both), the variant with the better campaign wins, as in the
    flag-based definition. Silver declares ``orderid NOT NULL``; a row that breaks it
    anyway is kept with its own best campaign (``audit_primary_key`` reports it).
    """
    best = best_in_window(s.orders, clicked(s.marketing), days=days)
    return first_per_key(best, key="orderid", rank=RANK,
                         tie_break=[c for c in s.orders.columns if c != "orderid"])


def gold_attribution(s: Silver, days: int = 7) -> DataFrame:
    """Gold table: best campaign per order, joined to its customer, customer created no later
    than the order's day. The date test runs after the pick, as in the staged definition.
    The outer join to customers followed by ``clientid IS NOT NULL`` is an inner join."""
    a = best_attribution(s, days)
    c = s.customers
    j = a.join(c, F.col("customerid") == F.col("clientid"), "inner")
    return (j.filter(F.to_date("creation_date") <= F.to_date("transactiondate"))
            .select(*a.columns, *c.columns))

"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL oracles."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize, ship_package
from ..sources import fixtures
from . import gold, silver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query key {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def bronze(spark: SparkSession, sf_dir: str, with_nulls: bool = False,
           hot_customer: int | None = None) -> fixtures.Bronze:
    return fixtures.bronze(spark, sf_dir, with_nulls, hot_customer)


class SilverLayer:
    """The three silver tables, each built on first use.

    Materialized (the default) a table is written once to the shared folder and read back,
    as the job hands layers over by table: the customers table feeds three later joins and
    would otherwise be recomputed by each. Only the tables a query touches are built.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, with_nulls: bool = False,
                 materialized: bool = True, hot_customer: int | None = None):
        self._b = bronze(spark, sf_dir, with_nulls, hot_customer)
        self._keep = (lambda df, name: materialize(df, name)) if materialized \
            else (lambda df, name: df)
        self._cache: dict = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = self._keep(build(), f"{name}_silver")
        return self._cache[name]

    @property
    def customers(self) -> DataFrame:
        return self._get("customers", lambda: silver.customers_silver(self._b.customers))

    @property
    def orders(self) -> DataFrame:
        return self._get("orders", lambda: silver.orders_silver(self._b.orders, self.customers))

    @property
    def marketing(self) -> DataFrame:
        return self._get("marketing",
                         lambda: silver.marketing_silver(self._b.marketing, self.customers))

    def build_all(self) -> "SilverLayer":
        """Customers first, then orders and marketing written concurrently (two jobs from two
        driver threads: independent, so their stages overlap on the executors)."""
        from concurrent.futures import ThreadPoolExecutor
        self.customers
        with ThreadPoolExecutor(max_workers=2) as pool:
            for f in [pool.submit(lambda: self.orders), pool.submit(lambda: self.marketing)]:
                f.result()
        return self


def silver_layer(spark: SparkSession, sf_dir: str, with_nulls: bool = False,
                 materialized: bool = True, hot_customer: int | None = None) -> SilverLayer:
    return SilverLayer(spark, sf_dir, with_nulls, materialized, hot_customer)


def gold_table(spark: SparkSession, sf_dir: str, days: int = 7) -> DataFrame:
    return gold.gold_attribution(silver_layer(spark, sf_dir).build_all(), days)

"""SQL front: the layers as temporary views, so that reports can be written in SQL.

``register_layers`` binds ``customers_silver``, ``orders_silver``, ``marketing_silver`` and
``gold_order_attribution`` (and the bronze tables) to the DataFrames this library builds;
report queries written against those table names then run through ``spark.sql`` and are
planned by Catalyst like any DataFrame query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import materialize
from . import gold as G

# Order revenue of each month and country.
REVENUE_BY_MONTH_COUNTRY = """
SELECT substr(CAST(transactiondate AS string), 1, 7) AS year_month, country, sum(amount) AS order_revenue
FROM gold_order_attribution
GROUP BY ALL
ORDER BY year_month, country"""

# Revenue of the orders that a campaign led to, and its share of the country's revenue.
MARKETING_EFFECTIVENESS = """
WITH by_country AS (
  SELECT country, sum(amount) AS revenue,
         coalesce(sum(amount) FILTER (WHERE marketingid IS NOT NULL), 0) AS marketing_revenue
  FROM gold_order_attribution GROUP BY country)
SELECT country, marketing_revenue, CAST(marketing_revenue AS float) / revenue AS marketing_share
FROM by_country
ORDER BY marketing_revenue"""


def register_layers(spark: SparkSession, bronze, silver, days: int = 7,
                    write_gold: bool = True) -> None:
    for name, df in (("customers_bronze", bronze.customers), ("orders_bronze", bronze.orders),
                     ("marketing_bronze", bronze.marketing), ("customers_silver", silver.customers),
                     ("orders_silver", silver.orders), ("marketing_silver", silver.marketing)):
        df.createOrReplaceTempView(name)
    g = G.gold_attribution(silver, days)
    if write_gold:
        g = materialize(g, "gold_order_attribution")
    g.createOrReplaceTempView("gold_order_attribution")

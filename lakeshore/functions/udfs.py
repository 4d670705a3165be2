"""User functions: SQL temporary functions and a vectorized pandas membership flag."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_mask_function(spark: SparkSession, groups=(), name: str = "mask_email",
                           group: str = "pii_readers", keep: int = 2) -> str:
    """``CREATE TEMPORARY FUNCTION name(email STRING) RETURNS STRING RETURN IF(member, ...)``.

    Group membership is resolved for the caller here and enters the body as a literal.
    """
    member = "true" if group in set(groups) else "false"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(email STRING) RETURNS STRING
        RETURN IF({member}, CONCAT(LEFT(email, {keep}), REPEAT('*', LENGTH(email) - {keep})), email)""")
    return name


def register_row_filter_function(spark: SparkSession, groups=(), name: str = "filter_channel",
                                 admin_group: str = "ultra-admin",
                                 excluded=("Call Center",)) -> str:
    """``CREATE TEMPORARY FUNCTION name(c STRING) RETURN IF(admin, true, c NOT IN (...))``."""
    admin = "true" if admin_group in set(groups) else "false"
    vals = ", ".join("'" + v.replace("'", "''") + "'" for v in excluded)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING)
        RETURN IF({admin}, true, c NOT IN ({vals}))""")
    return name


def pandas_membership_flag(df: DataFrame, col: str, keys: DataFrame, key_col: str,
                           name: str = "customerid_is_valid") -> DataFrame:
    """'Y'/'N' flag by a left join on the distinct keys and a scalar pandas UDF on the hit.

    One path for every number of keys: nothing is collected, and Python sees a boolean that is
    never NULL, so the ids keep their type. A NULL id is no member.
    """
    @F.pandas_udf("string")
    def yes_no(hit: pd.Series) -> pd.Series:
        return hit.map({True: "Y", False: "N"})

    distinct = (keys.select(F.col(key_col).alias("__key")).filter(F.col("__key").isNotNull())
                .distinct().withColumn("__hit", F.lit(True)))
    return (df.join(distinct, F.col(col) == F.col("__key"), "left")
            .withColumn(name, yes_no(F.coalesce(F.col("__hit"), F.lit(False))))
            .drop("__key", "__hit"))

"""Data-quality operators: counts, duplicates, shared values, key audits, profile.

All of them are aggregations that Spark runs as partial (map-side) + final hash
aggregates, so a key or value that holds a large share of the rows is collapsed on every
map task before it is shuffled. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, alias: str = "count") -> DataFrame:
    """Global ``count(*)``: one row."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_vs_distinct(df: DataFrame, key: str, total: str = "tot_recs",
                      distinct: str = "tot_distinct") -> DataFrame:
    """``count(*)`` next to ``count(distinct key)``: the uniqueness probe of a key."""
    return df.agg(F.count(F.lit(1)).alias(total), F.count_distinct(F.col(key)).alias(distinct))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row ``SELECT DISTINCT *`` (not per key: rows that differ elsewhere all stay)."""
    return df.distinct()


def duplicate_keys(df: DataFrame, key: str, alias: str = "count") -> DataFrame:
    """Keys that occur more than once: ``group by key having count(*) > 1``."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
            .filter(F.col(alias) > 1))


def shared_values(df: DataFrame, value: str, key: str | None = None,
                  alias: str = "recs") -> DataFrame:
    """Values held by more than one record.

    With ``key`` the records are counted as ``count(distinct key)`` (the silver rule), without
    it as ``count(*)`` (the exploration rule). The NULL value forms a group like any other.
    The distinct count is planned by Spark as a two-level aggregate (value, key) -> value,
    so a hot value is spread over the (value, key) partitions first.
    """
    n = F.count_distinct(F.col(key)) if key else F.count(F.lit(1))
    return df.groupBy(value).agg(n.alias(alias)).filter(F.col(alias) > 1)


def rows_with_keys_in(df: DataFrame, keys: DataFrame, col: str,
                      key_col: str | None = None) -> DataFrame:
    """``select * from df where col in (select key_col from keys)``: a left semi join."""
    key_col = key_col or col
    k = keys.select(F.col(key_col).alias("__k"))
    return df.join(k, F.col(col) == F.col("__k"), "left_semi")


def audit_primary_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that break a PRIMARY KEY: NULL key, or a key held by more than one row.

    Returns (key, n_rows, violation) with violation in {'null_key', 'duplicate_key'}.
    """
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return (g.filter(F.col(key).isNull() | (F.col("n_rows") > 1))
            .withColumn("violation", F.when(F.col(key).isNull(), F.lit("null_key"))
                        .otherwise(F.lit("duplicate_key"))))


def audit_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (left anti join)."""
    p = parent.select(F.col(pk).alias("__pk"))
    return (child.filter(F.col(fk).isNotNull())
            .join(p, F.col(fk) == F.col("__pk"), "left_anti"))


def table_profile(df: DataFrame) -> DataFrame:
    """Per-column statistics, one row per column.

    (column, data_type, count, nulls, distinct_approx, min, max, mean). Built as one
    aggregate over the table (a single pass, partial aggregation) and then unpivoted
    with ``stack``, so the work grows with rows, not with anything on the driver.
    min / max are rendered as strings; mean only for numeric columns.
    """
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    aggs, names = [], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType.simpleString()
        i = len(names)
        names.append((f.name, t))
        aggs += [
            F.count(c).alias(f"c{i}"),
            F.count_if(c.isNull()).alias(f"n{i}"),
            F.approx_count_distinct(c).alias(f"d{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
            (F.avg(c) if t in numeric or t.startswith("decimal") else F.lit(None).cast("double"))
            .alias(f"m{i}"),
        ]
    wide = df.agg(*aggs)
    rows = ", ".join(
        f"'{n.replace(chr(39), chr(39) * 2)}', '{t}', c{i}, n{i}, d{i}, lo{i}, hi{i}, m{i}"
        for i, (n, t) in enumerate(names))
    return wide.selectExpr(
        f"stack({len(names)}, {rows}) as (column, data_type, count, nulls, distinct_approx, "
        "min, max, mean)")

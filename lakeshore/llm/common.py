"""Helpers shared by the operators: stable hashes, written intermediates, global ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

TWO53 = 1 << 53


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uniform(*cols) -> Column:
    """A number in [0, 1) that depends on the values alone, so reruns and retries agree."""
    return F.pmod(F.xxhash64(*cols), F.lit(TWO53)) / F.lit(float(TWO53))


def crc32_mod(col: Column, m: int) -> Column:
    """crc32 of the value's decimal text, modulo ``m``; 0 for null."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(m)), F.lit(0))


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    """The column if ``df`` has it, else ``default``."""
    return F.col(f"`{name}`") if name in df.columns else default


def global_rank(df: DataFrame, order: list[Column], name: str, rank: str = "rank") -> DataFrame:
    """``df`` with a 0-based rank over the whole table, without one task seeing every row.

    The rows are dealt by ranges of the sort key, sorted inside each range and written to the
    shared folder; a row's rank is its place inside its range plus the number of rows in the
    ranges before it (one count per range). The written copy fixes the ranges, so a retried
    task cannot move a row. Equal keys may take any order among themselves.
    """
    aliased = [o.asc_nulls_first() if not _sorted(o) else o for o in order]
    dealt = materialize(df.repartitionByRange(*aliased).withColumn("__range", F.spark_partition_id()), name)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))  # a row per range
               .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base")))
    inside = Window.partitionBy("__range").orderBy(*aliased)
    return (dealt.withColumn("__place", F.row_number().over(inside))
            .join(offsets, "__range")
            .withColumn(rank, F.col("__base") + F.col("__place") - 1)
            .drop("__range", "__place", "__base"))


def sorted_copy(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` written in sorted order, read back with ``rank``: the 0-based place in the whole table.

    The rows are dealt by ranges of the sort key, each range is sorted and written as one file, so
    a row's rank is its place in its file plus the rows of the files before: no window, and one
    shuffle. Rows with equal keys are told apart by where they were read, so a heavy key is spread
    over ranges too; they may take any order among themselves. The files fix the ranks for good.
    ``order`` must not hold long strings: range boundaries are sampled to the driver.
    """
    keys = [o.asc_nulls_first() for o in order] + [F.col("__at").asc()]
    dealt = (df.withColumn("__at", F.monotonically_increasing_id())
             .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__at")
             .withColumn("__range", F.spark_partition_id()))
    kept = materialize(dealt, name)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = (kept.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))  # a row per file
             .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base")))
    return (kept.withColumn("rank", F.col("_metadata.row_index")).join(bases, "__range")
            .withColumn("rank", F.col("__base") + F.col("rank")).drop("__range", "__base"))


def join_same(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that are equal or both null; the right side's copies of them go."""
    other = right.withColumnsRenamed({n: f"__right_{k}" for k, n in enumerate(names)})
    keys = [f"__right_{k}" for k in range(len(names))]
    on = F.lit(True)
    for n, k in zip(names, keys):
        on = on & F.col(n).eqNullSafe(F.col(k))
    return left.join(other, on, how).drop(*keys)


def _sorted(c: Column) -> bool:
    text = str(c)
    return " ASC" in text or " DESC" in text

"""Stored tables that changes touch in part: bucketed for merges, split by key bucket for rewrites.

``merge_insert`` works on a catalog table written with ``bucketBy`` / ``sortBy`` on its key. The stored side of the
join is read bucket by bucket, as it lies, and only the batch is shuffled, to the table's buckets. Before the
join, stored keys pass a bloom filter of the batch's keys, so that the join sees about as many stored keys as the batch has.

``KeyedTable`` is a Parquet table with one partition per key bucket. UPDATE, DELETE and MERGE find the buckets
with a row to change, read those alone and overwrite them dynamically; all other files stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..operators import changes as X
from ..operators.joins import anti_join, semi_join
from ..session import materialize
from .landing import drop_partition

# --- merges into a bucketed catalog table ---------------------------------------------------


def create_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """``CREATE TABLE table CLUSTERED BY (key) SORTED BY (key) INTO n BUCKETS`` with the rows of ``df``."""
    (df.repartition(buckets, key).write.mode("error").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def bloom_filter(keys: DataFrame, key: str, words: int = 1 << 14) -> Callable[[Column], Column]:
    """A test that is true for every key of ``keys`` and false for most others.

    Two bits per key in ``words`` 64-bit words, or'ed together in the tasks; the result is one array of that fixed size, a scalar
    subquery. Beyond about 10 * ``words`` keys it lets more and more through, which costs time, not rows.
    """
    bits = 64 * words

    def places(k: Column) -> list[Column]:
        h = F.xxhash64(k)
        return [F.pmod(x, F.lit(bits)) for x in (h, F.shiftrightunsigned(h, 32))]

    word = lambda p: F.shiftright(p, 6).cast("int")
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(p, F.lit(64)).cast("int"))
    set_bits = (keys.filter(F.col(key).isNotNull()).select(F.explode(F.array(*places(F.col(key)))).alias("p"))
                .groupBy(word(F.col("p")).alias("w")).agg(F.bit_or(bit(F.col("p"))).alias("b")))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("w"))
    whole = (every.join(set_bits, "w", "left").agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("a"))
             .select(F.col("a.b").alias("a"))).scalar()

    def might_hold(k: Column) -> Column:
        tests = [F.get(whole, word(p)).bitwiseAND(bit(p)) != 0 for p in places(k)]
        return tests[0] & tests[1]  # equal subqueries: Spark runs one
    return might_hold


def new_rows(spark: SparkSession, table: str, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key the bucketed table does not hold (a NULL key matches nothing)."""
    stored = spark.table(table)
    known = stored.select(key).filter(bloom_filter(source, key)(F.col(key)))
    return anti_join(source.select(*stored.columns), known, key)


def merge_insert(spark: SparkSession, table: str, source: DataFrame, key: str, buckets: int) -> DataFrame:
    """Insert-only merge: rows whose key is not there are appended to their buckets; no stored row is written again.

    Keys must not be NULL, as silver declares: such a row matches nothing and would be appended by every run."""
    rows = source.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"NULL in key {key}"))).otherwise(F.col(key)))
    fresh = new_rows(spark, table, rows, key)
    # bucketBy and sortBy lay the rows out; dealt by key first, a bucket gets one file per merge
    fresh.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


# --- changes that rewrite only what they touch ----------------------------------------------

BUCKET = "key_bucket"


class KeyedTable:
    """A Parquet table at ``path`` with ``buckets`` partitions by a hash of ``key`` (NULL keys share one).

    One writer at a time. A change is computed from the touched partitions into a copy, then replaces them; one
    that fails midway is repeated as it is, since a partition either still holds its old rows or its new ones.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets

    def _bucket(self, key: Column) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int"), F.lit(0))

    def create(self, rows: DataFrame) -> "KeyedTable":
        self._write(rows, "errorifexists")
        return self

    def _write(self, rows: DataFrame, mode: str) -> None:
        bucketed = rows.select(*self.schema.names, self._bucket(F.col(self.key)).alias(BUCKET))
        (bucketed.repartition(BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, IntegerType())).parquet(self.path)

    def read(self) -> DataFrame:
        return self._rows().drop(BUCKET)

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most as many as there are buckets

    def _rewrite(self, buckets: list[int], change: Callable[[DataFrame], DataFrame]) -> list[int]:
        if not buckets:
            return buckets
        part = self._rows().filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)  # other partitions are not read
        changed = materialize(change(part), "changed_buckets")
        left = set(self._touched(changed.select(self._bucket(F.col(self.key)).alias(BUCKET))))
        self._write(changed, "overwrite")
        for n in buckets:  # nothing replaces a partition that has lost all its rows
            if n not in left:
                drop_partition(self.spark, self.path, BUCKET, n)
        return buckets

    def update(self, cond: Column, set_cols: Mapping[str, Column]) -> list[int]:
        """``UPDATE .. SET .. WHERE cond``; returns the buckets that were written. Keys may not be set."""
        if self.key in set_cols:
            raise ValueError("the key decides the bucket and cannot be updated")
        hit = self._touched(self._rows().filter(cond))
        return self._rewrite(hit, lambda rows: X.update_where(rows, cond, set_cols))

    def delete(self, cond: Column) -> list[int]:
        """``DELETE .. WHERE cond``: rows where it is TRUE go."""
        return self._rewrite(self._touched(self._rows().filter(cond)), lambda rows: X.delete_where(rows, cond))

    def delete_in(self, col: str, values: DataFrame, value_col: str | None = None) -> list[int]:
        """``DELETE .. WHERE col IN (select value_col from values)``."""
        values = materialize(values.select(F.col(value_col or col).alias(col)).distinct(), "deleted_values")
        hit = self._touched(semi_join(self._rows(), values, col))
        return self._rewrite(hit, lambda rows: X.delete_in(rows, col, values))

    def merge(self, source: DataFrame, set_cols: Mapping[str, str], target_cond: Column | None = None,
              source_cond: Column | None = None) -> list[int]:
        """``MERGE .. WHEN MATCHED AND .. THEN UPDATE SET .. WHEN NOT MATCHED THEN INSERT *`` on the key.

        The batch's keys name the buckets; of these, the ones that it changes nothing in are not written either.
        """
        names = self.schema.names
        source = materialize(source.select(*names, self._bucket(F.col(self.key)).alias(BUCKET)), "merge_source")
        named = self._touched(source)
        stored = self._rows().filter(F.col(BUCKET).isin(named))
        inserted = self._touched(anti_join(source, stored, self.key))
        updating = source if source_cond is None else source.filter(source_cond)
        updated = self._touched(semi_join(stored if target_cond is None else stored.filter(target_cond), updating, self.key))
        hit = sorted({*inserted, *updated})
        batch = source.filter(F.col(BUCKET).isin(hit)).select(*names)
        return self._rewrite(hit, lambda rows: X.merge_upsert(rows, batch, self.key, set_cols=set_cols, target_cond=target_cond, source_cond=source_cond))

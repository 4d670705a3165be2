"""Join operators: membership, null-aware anti join, FK validation, interval (band) join.

Every join here is an equi-join on a key that Spark can hash-partition; AQE decides at run
time whether a side is small enough to broadcast (its measured size against
``spark.sql.autoBroadcastJoinThreshold``) and splits skewed partitions of the streamed side.
In the interval join, rows whose key or time is NULL can never match and are routed around
the shuffle instead of being hashed into one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

DAY_US = 86_400_000_000


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch, exact and time-zone free for the column's type."""
    t = df.schema[col].dataType
    if isinstance(t, TimestampNTZType):
        # wall-clock fields only: no conversion through the session time zone
        return F.expr(f"unix_date(to_date(`{col}`)) * {DAY_US} + hour(`{col}`) * 3600000000L"
                      f" + minute(`{col}`) * 60000000L"
                      f" + cast(extract(SECOND FROM `{col}`) * 1000000 as bigint)")
    if isinstance(t, TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(t, DateType):
        return F.unix_date(F.col(col)).cast("bigint") * F.lit(DAY_US)
    raise TypeError(f"{col}: expected a timestamp or date column, got {t.simpleString()}")


def day_of(micros: Column, unit: int = DAY_US) -> Column:
    """UTC day number (or number of the ``unit``) of epoch micros: exact integer floor division."""
    # (m - pmod(m, D)) is an exact multiple of D, so the quotient is exact
    return ((micros - F.pmod(micros, F.lit(unit))) / F.lit(unit)).cast("bigint")


def window_end(df: DataFrame, col: str, days: int) -> Column:
    """Epoch micros of ``col + INTERVAL days DAY``. On TIMESTAMP these are calendar days of the
    session time zone, as in SQL (a day with a clock change has 23 or 25 hours); on the other
    types a day has 24 hours."""
    if isinstance(df.schema[col].dataType, TimestampType):
        return F.unix_micros(F.col(col) + F.make_dt_interval(days=F.lit(days)))
    return epoch_micros(df, col) + F.lit(days * DAY_US)


def _pad(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with every column of ``other`` appended as a typed NULL."""
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema])


def semi_join(left: DataFrame, right: DataFrame, left_col: str,
              right_col: str | None = None) -> DataFrame:
    """``left where left_col in (select right_col from right)``."""
    r = right.select(F.col(right_col or left_col).alias("__rk"))
    return left.join(r, F.col(left_col) == F.col("__rk"), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, left_col: str,
              right_col: str | None = None) -> DataFrame:
    """Rows of ``left`` with no equal key in ``right``; NULL keys are kept (they match nothing)."""
    r = right.select(F.col(right_col or left_col).alias("__rk"))
    return left.join(r, F.col(left_col) == F.col("__rk"), "left_anti")


def not_in(left: DataFrame, col: str, right: DataFrame, right_col: str | None = None,
           null_aware: bool = True) -> DataFrame:
    """``left where col NOT IN (select right_col from right)`` with SQL three-valued logic.

    * right side empty: every left row is kept, NULL keys included;
    * right side holds a NULL: no row is kept (every comparison is NULL or FALSE);
    * otherwise: rows with a NULL key are dropped, the rest is a left anti join.

    SQL ``NOT IN`` is planned by Spark as a *broadcast* null-aware anti join whatever the
    size of the subquery. Here the non-NULL keys go through an ordinary anti join (shuffle or
    AQE broadcast by measured size) and the two global facts "is empty" / "has a NULL" are
    one scalar subquery: a single-row aggregate, evaluated once. ``null_aware=False`` gives
    the plain anti join (NULL keys kept).
    """
    right_col = right_col or col
    if not null_aware:
        return anti_join(left, right, col, right_col)
    r = right.select(F.col(right_col).alias("__rk"))
    facts = r.agg(F.struct(F.count(F.lit(1)).alias("n"),
                           F.count_if(F.col("__rk").isNull()).alias("nulls"))).scalar()
    # one pass over ``left``: a NULL key matches nothing in the anti join and is then
    # decided by the facts (kept only when the right side is empty)
    survivors = left.join(r.filter(F.col("__rk").isNotNull()), F.col(col) == F.col("__rk"),
                          "left_anti")
    return survivors.filter((facts.getField("nulls") == 0)
                            & (F.col(col).isNotNull() | (facts.getField("n") == 0)))


def membership_flag(df: DataFrame, col: str, keys: DataFrame, key_col: str | None = None,
                    name: str = "customerid_is_valid", yes: str = "Y", no: str = "N") -> DataFrame:
    """Append ``name`` = 'Y' when ``col`` is in the key set, else 'N' (an existence join).

    The key set is reduced to distinct keys (partial aggregation) and left-joined, so no row
    is multiplied and nothing is collected or shipped inside a closure.
    """
    k = keys.select(F.col(key_col or col).alias("__mk")).filter(F.col("__mk").isNotNull()) \
        .distinct().withColumn("__hit", F.lit(True))
    j = df.join(k, F.col(col) == F.col("__mk"), "left")
    return (j.withColumn(name, F.when(F.col("__hit"), F.lit(yes)).otherwise(F.lit(no)))
            .drop("__mk", "__hit"))


def valid_members(df: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose non-NULL ``fk`` exists in ``parent.pk`` (flag = 'Y')."""
    return semi_join(df.filter(F.col(fk).isNotNull()), parent, fk, pk)


def orphans(df: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows whose non-NULL ``fk`` is missing from ``parent.pk`` (flag = 'N')."""
    return anti_join(df.filter(F.col(fk).isNotNull()), parent, fk, pk)


def band_join_left(left: DataFrame, right: DataFrame, **kw) -> DataFrame:
    return band_join(left, right, how="left", **kw)


def band_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
              left_ts: str, right_ts: str, days: int, how: str = "left",
              bucket_days: int | None = None) -> DataFrame:
    """``left [LEFT] JOIN right ON left_key = right_key AND
    left_ts BETWEEN right_ts AND right_ts + INTERVAL days DAY`` (both ends closed).

    Spark would run this as a sort-merge join on the key alone with the interval as a
    residual predicate, i.e. all pairs of a key are compared. Here time is cut into buckets
    of ``bucket_days`` (default: the window length, at least one day); each right row is
    copied into the buckets its interval touches (two when the bucket is as wide as the
    window) and the join is on (key, bucket): a busy key is split by time, and only pairs
    that share a bucket are compared. Buckets are UTC-aligned in epoch micros; the end of the
    interval is ``window_end``, so a TIMESTAMP gets calendar days of the session time zone.
    Filter the right side before calling (a predicate on the right side in ON keeps every left
    row).
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    matchable = F.col(left_key).isNotNull() & F.col(left_ts).isNotNull()
    lb, rb = band_sides(left.filter(matchable), right, left_key=left_key, right_key=right_key, left_ts=left_ts,
                        right_ts=right_ts, days=days, bucket_days=bucket_days)
    joined = band_pairs(lb, rb, left.columns, right.columns, left_key, right_key, how)
    if how == "inner":
        return joined
    return joined.unionByName(_pad(left.filter(~matchable), right))


def band_sides(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str, left_ts: str, right_ts: str,
               days: int, bucket_days: int | None = None, busy_rows: int | None = None,
               spread_unmatched: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two sides of ``band_join``: rows with their bucket ``__bk`` and their times in epoch micros.

    With ``busy_rows``, keys with that many left rows or more get buckets of one day: more copies
    of their right rows, but more tasks to share their pairs and fewer pairs compared. With
    ``spread_unmatched``, left rows without key or time, which match nothing, get a bucket by their content.
    """
    if days < 0:
        raise ValueError("days must be >= 0")
    bucket = max(1, bucket_days if bucket_days is not None else days) * DAY_US
    l_us, r_us = epoch_micros(left, left_ts), epoch_micros(right, right_ts)
    r_end = window_end(right, right_ts, days)
    ls, rs = left, right.filter(F.col(right_key).isNotNull() & F.col(right_ts).isNotNull())
    width = F.lit(bucket)
    if busy_rows and bucket > DAY_US:
        # at most rows / busy_rows keys
        busy = F.broadcast(left.filter(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("__busy"))
                           .agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= busy_rows).select("__busy"))
        ls = ls.join(busy, F.col(left_key) == F.col("__busy"), "left")
        rs = rs.join(busy, F.col(right_key) == F.col("__busy"), "left")
        width = F.when(F.col("__busy").isNotNull(), F.lit(DAY_US)).otherwise(F.lit(bucket))

    def bk(us: Column) -> Column:
        return ((us - F.pmod(us, width)) / width).cast("bigint")

    rb = rs.select(*[F.col(f"`{c}`") for c in right.columns], r_us.alias("__rus"), r_end.alias("__rend"),
                   F.explode(F.sequence(bk(r_us), bk(r_end))).alias("__bk"))
    l_bk = bk(l_us)
    if spread_unmatched:
        l_bk = F.when(F.col(left_key).isNotNull() & F.col(left_ts).isNotNull(), l_bk) \
            .otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]))
    return ls.select(*[F.col(f"`{c}`") for c in left.columns], l_us.alias("__lus"), l_bk.alias("__bk")), rb


def band_pairs(lb: DataFrame, rb: DataFrame, left_cols: list[str], right_cols: list[str], left_key: str,
               right_key: str, how: str) -> DataFrame:
    """The pairs of two ``band_sides``."""
    cond = [F.col(f"l.{left_key}") == F.col(f"r.{right_key}"),
            F.col("l.__bk") == F.col("r.__bk"),
            F.col("l.__lus").between(F.col("r.__rus"), F.col("r.__rend"))]
    return (lb.alias("l").join(rb.alias("r"), cond, how)
            .select(*[F.col(f"l.`{c}`") for c in left_cols],
                    *[F.col(f"r.`{c}`") for c in right_cols]))

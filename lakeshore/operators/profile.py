"""Table profiles from mergeable sketches: one pass per partition of the data, merged without reading it again.

``sketches`` reads a table once and gives, per column (and per value of ``by``, such as the landing file), counts, bounds,
moments, a distinct-count sketch, a quantile sketch and a sketch of the most frequent values. All of them merge: ``merged`` combines
the rows of several partitions, loads or days into the profile of the whole. ``summary`` reads the figures off;
``frequent_values`` takes the candidates of the frequency sketch and counts them exactly in one further scan.

Bounds (documented by the sketches, tested here): a quantile's rank is off by about 1 % at ``QUANTILE_K`` = 200 per merged
sketch, the distinct count by about 1.6 % at ``DISTINCT_LG_K`` = 12; an estimate of a value's rows is off by at most 3.5 / ``TRACKED`` of all
rows, so a value that holds ``least_share`` of the rows cannot be missed while that is greater.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

QUANTILE_K, DISTINCT_LG_K, TRACKED = 200, 12, 2048
QUANTILES = (0.25, 0.5, 0.75)


def _number(c: Column, kind: DataType) -> Column:
    """The column on a number line: numbers as they are, times as seconds since the epoch, others null."""
    if isinstance(kind, NumericType):
        return c.cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(c).cast("double") / 1e6
    if isinstance(kind, TimestampNTZType):  # from the fields: no time zone plays a part
        return (F.unix_date(c.cast("date")).cast("double") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
                + F.extract(F.lit("SECOND"), c).cast("double"))
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double") * 86400
    return F.lit(None).cast("double")


def sketches(df: DataFrame, by: str | None = None, k: int = QUANTILE_K, tracked: int = TRACKED) -> DataFrame:
    """One row per column (per value of ``by``): ``[by], column, data_type, rows, nulls, min, max, number
    (n, mean, m2), quantiles, distinct, frequent``; one aggregate over the table, merged map-side."""
    fields = [f for f in df.schema.fields if f.name != by]
    aggs = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        x, text = _number(c, f.dataType), c.cast("string")
        aggs.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("rows"), F.count_if(c.isNull()).alias("nulls"),
            F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"),
            F.struct(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2")).alias("number"),
            F.min(x).alias("least"), F.max(x).alias("most"),
            F.kll_sketch_agg_double(x, k).alias("quantiles"), F.hll_sketch_agg(text, DISTINCT_LG_K).alias("distinct"),
            F.call_function("approx_top_k_accumulate", text, F.lit(tracked)).alias("frequent")).alias(f"s{i}"))
    keys = [F.col(f"`{by}`")] if by else []
    wide = df.groupBy(*keys).agg(*aggs)
    return wide.select(*keys, F.inline(F.array(*[F.col(f"s{i}") for i in range(len(fields))])))


def merged(parts: DataFrame) -> DataFrame:
    """The profile rows of the whole from those of its partitions: one row per column, no data read."""
    p = F.col("number")
    n, total = F.sum(p["n"]), F.sum(p["n"] * F.coalesce(p["mean"], F.lit(0.0)))
    mean = total / F.nullif(n, F.lit(0))
    # moments around the parts' own means, moved to the common one (parallel variance)
    around = F.sum(F.coalesce(p["m2"], F.lit(0.0))) + F.sum(p["n"] * p["mean"] * p["mean"]) - n * mean * mean
    numbers = F.col("data_type").rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    # bounds are compared as numbers where the column has a place on the number line, else as text
    low = F.coalesce(F.min_by("min", "least"), F.min("min"))
    high = F.coalesce(F.max_by("max", "most"), F.max("max"))
    return parts.groupBy("column", "data_type").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), low.alias("min"), high.alias("max"),
        F.struct(n.alias("n"), F.when(F.first(numbers), mean).alias("mean"),
                 F.when(F.first(numbers) & (n > 1), F.sqrt(F.greatest(around, F.lit(0.0)) / (n - 1))).alias("stddev")).alias("number"),
        F.call_function("kll_merge_agg_double", F.col("quantiles")).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent")).alias("frequent"))


def summary(profile: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Figures of a :func:`merged` profile: ``column, data_type, rows, nulls, distinct_approx, min, max, mean,
    stddev, quantiles`` (number-line values at ``quantiles``; null for columns that are not on it)."""
    at = F.array(*[F.lit(q) for q in quantiles])
    found = F.call_function("kll_sketch_get_quantile_double", F.col("quantiles"), at)
    return profile.select("column", "data_type", "rows", "nulls", F.hll_sketch_estimate("distinct").alias("distinct_approx"),
                          "min", "max", F.col("number.mean").alias("mean"), F.col("number.stddev").alias("stddev"),
                          F.when(F.col("number.n") > 0, found).alias("quantiles"))


def frequent_values(df: DataFrame, profile: DataFrame, least_share: float = 0.01, tracked: int = TRACKED) -> DataFrame:
    """``column, value, n``: every value (as text) that at least ``least_share`` of a column's rows hold, with its exact count.

    The sketch names at most 2 / ``least_share`` candidates a column, among them all that qualify; a scan counts them. The
    candidates are joined as a table whose size is bounded by that number times the columns.
    """
    if least_share <= 3.5 / tracked:
        raise ValueError("least_share must exceed the sketch's error; raise tracked")
    most = min(tracked, int(2 / least_share) + 1)
    candidates = profile.select("column", "rows", F.explode(F.call_function(
        "approx_top_k_estimate", F.col("frequent"), F.lit(most))).alias("c")).select(
        "column", "rows", F.col("c.item").alias("value")).filter("value is not null")
    names = [f.name for f in df.schema.fields]
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names])).alias("x"))
    counted = (cells.select("x.*").join(F.broadcast(candidates), ["column", "value"])
               .groupBy("column", "value", "rows").agg(F.count(F.lit(1)).alias("n")))
    return counted.filter(F.col("n") >= F.col("rows") * F.lit(least_share)).select("column", "value", "n")


def rank_errors(df: DataFrame, profile: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """``column, quantile, error``: how far the sketch's quantile is from that rank, counted exactly (0 within ties)."""
    asked = summary(profile, quantiles).filter("quantiles is not null").select(  # as many rows as columns times quantiles
        "column", F.inline(F.arrays_zip(F.array(*[F.lit(q) for q in quantiles]).alias("quantile"), F.col("quantiles").alias("v"))))
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"), _number(F.col(f"`{f.name}`"), f.dataType).alias("x"))
                                          for f in df.schema.fields])).alias("c")).select("c.*").filter("x is not null")
    ranks = (cells.join(F.broadcast(asked), "column").groupBy("column", "quantile")
             .agg(F.count_if(F.col("x") < F.col("v")).alias("below"), F.count_if(F.col("x") <= F.col("v")).alias("upto"), F.count(F.lit(1)).alias("n")))
    return ranks.select("column", "quantile", F.greatest(F.col("below") / F.col("n") - F.col("quantile"),
                                                         F.col("quantile") - F.col("upto") / F.col("n"), F.lit(0.0)).alias("error"))

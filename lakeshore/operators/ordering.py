"""Ordering, top-k, dropping the last rows in key order, and planted repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """The first ``k`` rows in ascending key order (NULLs last): TakeOrderedAndProject, a
    per-partition top-k merged on the driver, bounded by k."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(k)


def _content(df: DataFrame) -> list[Column]:
    """128 bits of a row's content (two 64-bit hashes)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def drop_last_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows but the last ``n`` in ascending key order (NULLs last), like ``iloc[:-n]``
    on a sorted frame. Rows with one key go by their content's hash, so a rerun drops the same ones.

    ``OFFSET`` would funnel every row through one task. Instead a bounded top-n over (key, hash) gives
    the first row that goes, as a scalar; rows before it stay, by a plain filter. Exact copies of that row
    may go in part: they are counted (map-side) and as many as stay are written out again, spread over
    tasks. Nothing is copied or shuffled but those.
    """
    if n <= 0:
        return df
    k, (h1, h2) = F.col(f"`{key}`"), _content(df)
    place = F.struct(k.isNull().alias("none"), k.alias("k"), h1.alias("h1"), h2.alias("h2"))
    last = (df.select(place.alias("p")).orderBy(F.col("p.none").desc(), F.col("p.k").desc(), F.col("p.h1").desc(), F.col("p.h2").desc())
            .limit(n))
    bound = (last.groupBy("p").agg(F.count(F.lit(1)).alias("n")).agg(F.min(F.struct("p", "n")).alias("b"))
             .select("b")).scalar()
    first_gone = bound.getField("p")
    kept = df.filter(place < first_gone)
    copies = (df.filter(k.eqNullSafe(first_gone.getField("k")) & (h1 == first_gone.getField("h1")) & (h2 == first_gone.getField("h2")))
              .groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__n", F.col("__n") - bound.getField("n")).filter("__n > 0"))
    return kept.unionByName(repeat_rows(copies, "__n"))


def repeat_rows(df: DataFrame, times: str, chunk: int = 10_000) -> DataFrame:
    """Every row as often as ``times`` says (1 or more); a row with very many copies is written by many tasks."""
    columns = [c for c in df.columns if c != times]
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / chunk))
    parts = df.select(*columns, times, F.explode(chunks).alias("__chunk")).repartition(F.xxhash64("__chunk", *columns))
    size = F.least(F.lit(chunk).cast("long"), F.col(times) - F.col("__chunk") * chunk)
    return parts.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("__copy")).drop("__copy")


def draw_with_replacement(df: DataFrame, k: int, seed: int, identity: Column | None = None) -> DataFrame:
    """Exactly ``k`` rows drawn uniformly with replacement; the same ones for any partitioning and rerun.

    Rows are ordered by the md5 of their ``identity`` (default: all columns as JSON; equal rows are one entry
    with a count), draw i takes the row of rank floor(u_i * rows) where u_i comes from the md5 of ``seed:i``.
    No global sort: the first hex digits cut the rows into at most 65,536 blocks, whose sizes give each
    draw its block (a join on coarse cells of ranks, which bounds the candidates) and its rank inside;
    in a block the draws meet the entries in one running window. The draws, like the rows, are a
    distributed table.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    named = df.select(F.md5(F.to_json(F.struct(*columns)) if identity is None else identity).alias("__h"), F.struct(*columns).alias("__row"))
    entries = named.groupBy("__h").agg(F.count(F.lit(1)).alias("m"))
    total = df.count()
    if not total or k <= 0:
        return df.limit(0)
    digits = next((d for d in range(4) if total <= 4096 * 16 ** d), 4)
    block = F.substring("__h", 1, digits) if digits else F.lit("")
    entries = entries.withColumn("block", block)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # at most 65,536 blocks
    blocks = (entries.groupBy("block").agg(F.sum("m").alias("size"))
              .withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))))
    cells = 16 ** digits
    cell = lambda rank: F.floor(rank * F.lit(float(cells) / total)).cast("long")
    blocks = blocks.select("block", "base", "size", F.explode(F.sequence(
        cell(F.col("base")), cell(F.col("base") + F.col("size") - 1))).alias("cell"))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 13), 16, 10).cast("double") / float(16 ** 13)
    draws = (df.sparkSession.range(k).select(F.floor(u * F.lit(float(total))).cast("long").alias("r"))
             .withColumn("cell", cell(F.col("r"))))
    placed = (draws.join(F.broadcast(blocks), "cell")  # at most twice 65,536 rows
              .filter((F.col("r") >= F.col("base")) & (F.col("r") < F.col("base") + F.col("size")))
              .select("block", (F.col("r") - F.col("base")).alias("at"), F.lit(None).cast("string").alias("__h"), F.lit(1).alias("tag")))
    ahead = Window.partitionBy("block").orderBy("__h").rowsBetween(Window.unboundedPreceding, -1)
    starts = entries.select("block", F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("at"), "__h", F.lit(0).alias("tag"))
    upto = Window.partitionBy("block").orderBy("at", "tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = (starts.unionByName(placed).withColumn("__h", F.last("__h", ignorenulls=True).over(upto)).filter("tag = 1")
             .groupBy("__h").agg(F.count(F.lit(1)).alias("__n")))
    rows = (named.join(drawn, "__h").groupBy("__h", "__n").agg(F.first("__row").alias("__row"))
            .select("__n", "__row.*"))
    return repeat_rows(rows, "__n").select(*columns)


def append_drawn_repeats(df: DataFrame, fraction: float, seed: int, identity: Column | None = None) -> DataFrame:
    """``df UNION ALL`` exactly round(fraction * rows) of its rows, drawn with replacement."""
    return df.unionByName(draw_with_replacement(df, round(df.count() * fraction), seed, identity))


def append_repeats(df: DataFrame, pick: Column) -> DataFrame:
    """``df UNION ALL (df WHERE pick)``: plant exact repeats chosen by a rule."""
    return df.unionByName(df.filter(pick))


def append_sampled_repeats(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """``df UNION ALL sample(df, with replacement)``: random repeats (Poisson per row)."""
    return df.unionByName(df.sample(withReplacement=True, fraction=fraction, seed=seed))

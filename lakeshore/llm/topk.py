"""Exact inner-product top-k by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets of ``bucket_rows``, so a bucket holds
vectors of similar length. A query's results in the longest vectors give it a first threshold.
In every further bucket the threshold over the product of the query's and the bucket's greatest
length is a bound on the cosine: above 1 the bucket is skipped; a high bound prunes by
coordinates (a vector whose share of a strong query coordinate lies outside the range that the
bound allows cannot reach it), a low one by length. Whatever is left is verified by its product.

Queries and buckets are tiled: a task holds one bucket and one tile of queries, whatever the
table's size. Pairs are never rows; a task returns at most ``k`` results per query.

Defined results: vectors that are null or hold null or non-finite components take no part;
vectors are compared with those of as many components; repeated rows are rows of their own, and
a row is only left out of its own query's results; fewer than ``k`` others: all of them. A row
without an id is a candidate like any other and comes last among equal scores.
Products are exact while they stay below 2^53.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import global_rank, table

#: Bounds on the cosine from which coordinates prune better than lengths.
COORDINATE_FROM = 0.5
FOCUS = 4
#: Stands for a null id where numbers are compared; the greatest, and told apart from a real one by a flag.
NO_ID = (1 << 63) - 1


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def scaled(v: Column, factor: float = 256.0) -> Column:
    """floor(factor * x) of every component, as whole numbers in doubles."""
    return F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("double"))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, 0))


def _search(c: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, q_rows: np.ndarray,
            bound: np.ndarray, k: int):
    """Best ``k`` of one bucket for each query: (query position, places in the bucket, scores)."""
    places = np.arange(len(c))
    lengths = np.sqrt((c * c).sum(1))
    order = np.argsort(-lengths, kind="stable")
    c, ids, rows, lengths, places = c[order], ids[order], rows[order], lengths[order], places[order]
    unit = np.divide(c, lengths[:, None], out=np.zeros_like(c), where=lengths[:, None] > 0)
    longest = lengths[0] if len(lengths) else 0.0
    q_len = np.sqrt((q * q).sum(1))
    for i in range(len(q)):
        reach = q_len[i] * longest
        live = None
        if bound[i] > 0:
            if reach * (1 + 1e-9) < bound[i]:
                continue
            cosine = bound[i] / reach
            if cosine >= COORDINATE_FROM:  # |unit_f - cos q_f| <= sqrt((1 - cos^2)(1 - q_f^2))
                share = q[i] / q_len[i]
                focus = np.argsort(-np.abs(share))[:FOCUS]
                spread = np.sqrt(max(0.0, 1 - cosine * cosine) * np.maximum(0.0, 1 - share[focus] ** 2))
                # a share beyond the bound itself: the coordinate's own axis reaches the bound
                low = np.where(share[focus] <= -cosine, -1.0, cosine * share[focus] - spread) - 1e-9
                high = np.where(share[focus] >= cosine, 1.0, cosine * share[focus] + spread) + 1e-9
                part = unit[:, focus]
                live = np.nonzero(((part >= low) & (part <= high)).all(1))[0]
            else:
                live = np.arange(np.searchsorted(-lengths, -(bound[i] / q_len[i]) * (1 - 1e-9), "right"))
        scores = (c if live is None else c[live]) @ q[i]
        at = np.arange(len(c)) if live is None else live
        keep = (rows[at] != q_rows[i]) & (scores >= bound[i])
        at, scores = at[keep], scores[keep]
        if len(at) > k:
            worst = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = scores >= worst
            at, scores = at[near], scores[near]
        best = np.lexsort((ids[at], -scores))[:k]
        yield i, places[at[best]], scores[best]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, bucket_rows: int = 8192,
          tile_rows: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` (vec_id, v) that are queries."""
    kept = vectors.filter(F.col("v").isNotNull()).select(
        "vec_id", "v", is_query.alias("is_query"), F.size("v").alias("dim"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x).alias("n2"))
    ranked = materialize(global_rank(kept, [F.col("dim").asc(), F.col("n2").desc(), F.col("vec_id").asc()],
                                     "topk_vectors", "row")
                         # a null among integers would make pandas turn them into floats
                         .withColumns({"no_id": F.col("vec_id").isNull(), "vec_id": F.coalesce("vec_id", F.lit(NO_ID))})
                         .withColumn("bucket", F.floor(F.col("row") / bucket_rows)), "topk_rows")
    queries = ranked.filter("is_query")
    heads = ranked.groupBy("dim", "bucket").agg(F.max("n2").alias("most"))  # a row per bucket
    first = heads.groupBy("dim").agg(F.min("bucket").alias("bucket"))
    queries = materialize(queries.select("vec_id", "no_id", "v", "n2", "dim", "row").withColumn(
        "tile", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-queries.count() // tile_rows))))), "topk_queries")

    def results(c_side: DataFrame, q_side: DataFrame) -> DataFrame:
        def search(both: pd.DataFrame) -> pd.DataFrame:
            c, q = both[both["bound"].isna()], both[both["bound"].notna()]
            parts = [(np.full(len(s), i), at, s)
                     for i, at, s in _search(_matrix(c["v"]), c["vec_id"].to_numpy(), c["row"].to_numpy(),
                                             _matrix(q["v"]), q["row"].to_numpy(), q["bound"].to_numpy(float), k)
                     ] if len(c) and len(q) else []
            if not parts:
                return pd.DataFrame({n: [] for n in ("row", "query_id", "no_query_id", "vec_id", "no_id", "score")})
            ours, theirs = (np.concatenate([p[n] for p in parts]) for n in (0, 1))
            return pd.DataFrame({"row": q["row"].to_numpy()[ours], "query_id": q["vec_id"].to_numpy()[ours],
                                 "no_query_id": q["no_id"].to_numpy()[ours], "vec_id": c["vec_id"].to_numpy()[theirs],
                                 "no_id": c["no_id"].to_numpy()[theirs], "score": np.concatenate([p[2] for p in parts])})
        keys = ["dim", "bucket", "tile"]
        columns = [*keys, "vec_id", "no_id", "row", "v", "bound"]  # a candidate has no bound
        rows = (c_side.withColumn("bound", F.lit(None).cast("double")).select(*columns)
                .unionByName(q_side.select(*columns)))
        return rows.groupBy(*keys).applyInPandas(
            search, "row long, query_id long, no_query_id boolean, vec_id long, no_id boolean, score double")

    def ranks(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc(), F.col("no_id").asc())
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    tiles = queries.select("dim", "tile").distinct()
    seeds = results(ranked.join(F.broadcast(first), ["dim", "bucket"])
                    .join(tiles, "dim").select("dim", "bucket", "tile", "vec_id", "no_id", "row", "v"),
                    queries.join(F.broadcast(first), "dim").withColumn("bound", F.lit(float("-inf"))))
    seeds = materialize(ranks(seeds), "topk_seeds")
    bounds = (seeds.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
              .select("row", F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf")).alias("bound")))
    # a query visits the buckets whose longest vector can still reach its threshold
    visits = materialize(
        queries.join(bounds, "row", "left").fillna(float("-inf"), ["bound"])
        .join(heads.join(first.withColumnRenamed("bucket", "first"), "dim").filter("bucket > first"), "dim")
        .filter((F.col("bound") <= 0) | (F.sqrt(F.col("n2")) * F.sqrt("most") * (1 + 1e-9) >= F.col("bound")))
        .select("dim", "bucket", "tile", "vec_id", "no_id", "row", "v", "bound"), "topk_visits")
    visited = visits.select("dim", "bucket", "tile").distinct()
    rest = results(ranked.join(visited, ["dim", "bucket"])
                   .select("dim", "bucket", "tile", "vec_id", "no_id", "row", "v"), visits)
    both = seeds.drop("rank").unionByName(rest)
    return ranks(both).select(F.when(~F.col("no_query_id"), F.col("query_id")).alias("query_id"), "rank",
                              F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"),
                              F.col("score").cast("long").alias("score"))


def op9_topk(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("v"))
    return top_k(rows, F.coalesce(F.pmod("vec_id", F.lit(50)) == 0, F.lit(False)))


QUERIES = {"op9_topk": op9_topk}
ORACLES = {"op9_topk": """
with v as (
  select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as c
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, q.r, c.vec_id, cast(list_inner_product(q.c, c.c) as bigint) as score
  from v q join v c on q.r <> c.r and len(q.c) = len(c.c)
  where q.vec_id % 50 = 0),
k as (
  select *, row_number() over (partition by r order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from k where rank <= 5"""}

"""Row-level changes as pure DataFrame -> DataFrame functions (merge, update, delete).

Parquet tables have no MERGE / UPDATE / DELETE, so each statement is a function from the
old rows to the new ones; ``lakeshore.sources.bucketed`` applies them to the touched part of a stored
table. NULL keys never match, as in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import anti_join, semi_join

MULTI_MATCH_MSG = "MERGE: several source rows match and update the same target row"


def merge_insert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``MERGE INTO target USING source ON key WHEN NOT MATCHED THEN INSERT *``.

    Source rows whose key is absent from the target are appended (an anti join); every
    such row is inserted, even several with one key, and a NULL key never matches.
    """
    return target.unionByName(anti_join(source.select(*target.columns), target, key))


def merge_upsert(target: DataFrame, source: DataFrame, key: str, *,
                 set_cols: Mapping[str, str],
                 target_cond: Column | None = None, source_cond: Column | None = None,
                 insert: bool = True) -> DataFrame:
    """``MERGE INTO target t USING source s ON t.key = s.key
    WHEN MATCHED AND <target_cond> AND <source_cond> THEN UPDATE SET col = s.<src>, ...
    WHEN NOT MATCHED THEN INSERT *``.

    ``set_cols`` maps a target column to the source column whose value it takes.
    ``target_cond`` is written over target columns, ``source_cond`` over source columns.

    Plan: the applicable source rows are reduced to one row per key (count + values, partial
    aggregation) and left-joined to the target, so every target row meets at most one row
    and nothing is multiplied or collapsed again. A target row that meets more than one
    applicable source row makes the merge ambiguous and raises when evaluated. Unmatched
    source rows come from an anti join on the key.
    """
    cols = target.columns
    src = source.select(*cols)
    app = src.filter(source_cond) if source_cond is not None else src
    agg = (app.filter(F.col(key).isNotNull()).groupBy(key)
           .agg(F.count(F.lit(1)).alias("__n"),
                *[F.first(F.col(s)).alias(f"__v_{t}") for t, s in set_cols.items()])
           .withColumnRenamed(key, "__k"))
    j = target.join(agg, F.col(key) == F.col("__k"), "left")
    hit = F.col("__n").isNotNull()
    if target_cond is not None:
        hit = hit & F.coalesce(target_cond, F.lit(False))
    # evaluated on every row that is kept, so column pruning cannot drop the check
    j = j.filter(F.when(hit & (F.col("__n") > 1), F.raise_error(F.lit(MULTI_MATCH_MSG)))
                 .isNull())
    out = [(F.when(hit, F.col(f"__v_{c}")).otherwise(F.col(c)) if c in set_cols else F.col(c))
           .alias(c) for c in cols]
    updated = j.select(*out)
    if not insert:
        return updated
    return updated.unionByName(anti_join(src, target, key))


def merge_fill_null(target: DataFrame, source: DataFrame, key: str, col: str) -> DataFrame:
    """Fill ``col`` where the target's is NULL and the source's is not; insert new keys."""
    return merge_upsert(target, source, key, set_cols={col: col},
                        target_cond=F.col(col).isNull(), source_cond=F.col(col).isNotNull())


def update_where(df: DataFrame, cond: Column, set_cols: Mapping[str, Column]) -> DataFrame:
    """``UPDATE df SET col = expr, ... WHERE cond``: only rows where cond is TRUE change."""
    hit = F.coalesce(cond, F.lit(False))
    return df.select(*[(F.when(hit, set_cols[c]).otherwise(F.col(c)) if c in set_cols
                        else F.col(c)).alias(c) for c in df.columns])


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """``DELETE FROM df WHERE cond``: rows where cond is TRUE go; FALSE or NULL stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def delete_in(df: DataFrame, col: str, keys: DataFrame, key_col: str | None = None) -> DataFrame:
    """``DELETE FROM df WHERE col IN (select key_col from keys)``: a left anti join, so a
    row with a NULL ``col`` is never deleted (even if the key set holds a NULL)."""
    return anti_join(df, keys, col, key_col or col)


def keep_in(df: DataFrame, col: str, keys: DataFrame, key_col: str | None = None) -> DataFrame:
    return semi_join(df, keys, col, key_col or col)

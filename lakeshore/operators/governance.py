"""Governed views: column masks and row filters applied by group membership.

The caller's groups are passed in (there is no identity service); inside the plan they are
literals, so masks and filters stay ordinary projections / predicates that Catalyst pushes
down and codegens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MaskFn = Callable[[Column, frozenset], Column]
FilterFn = Callable[[frozenset], Column]


def is_member(group: str, groups: Iterable[str]) -> Column:
    """The caller's membership as a literal boolean column."""
    return F.lit(group in set(groups))


def prefix_mask(keep: int = 2, fill: str = "*", group: str = "pii_readers") -> MaskFn:
    """Members of ``group`` see the first ``keep`` characters and ``fill`` for the rest.

    NULL stays NULL; values no longer than ``keep`` are shown as they are.
    """
    def fn(c: Column, groups: frozenset) -> Column:
        masked = F.concat(F.left(c, F.lit(keep)), F.repeat(F.lit(fill), F.length(c) - keep))
        return F.when(is_member(group, groups), masked).otherwise(c)
    return fn


def exclude_values(column: str, values: Iterable[str], admin_group: str = "ultra-admin") -> FilterFn:
    """Row filter ``IF(is_member(admin), true, column NOT IN values)``.

    A NULL ``column`` gives NULL for non-admins, so the row is hidden.
    """
    vals = list(values)

    def fn(groups: frozenset) -> Column:
        return F.when(is_member(admin_group, groups), F.lit(True)) \
            .otherwise(~F.col(column).isin(vals))
    return fn


def secured_view(df: DataFrame, groups: Iterable[str] = (), *,
                 masks: Mapping[str, MaskFn] | None = None,
                 row_filters: Iterable[FilterFn] = ()) -> DataFrame:
    """``df`` as seen by a caller in ``groups``: masks replace columns, filters drop rows
    whose predicate is not TRUE. Detaching a mask or filter means not passing it."""
    g = frozenset(groups)
    out = df
    for f in row_filters:
        out = out.filter(f(g))
    for col, m in (masks or {}).items():
        out = out.withColumn(col, m(F.col(col), g))
    return out

"""Bronze -> silver: whole-row dedup, shared-value removal, FK validation, insert-only merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import changes
from ..operators.joins import not_in, semi_join
from ..operators.quality import dedup_rows, shared_values


def customers_clean(bronze: DataFrame, key: str = "clientid", value: str = "email") -> DataFrame:
    """Distinct rows minus every holder of a value shared by more than one key.

    ``value NOT IN (shared values)`` keeps its SQL meaning: a NULL value is dropped when any
    value is shared, and a shared NULL (two keys without email) empties the result.
    """
    d0 = dedup_rows(bronze)
    # count(distinct key) per value is the same over the distinct rows and over all rows,
    # so the groups come straight from the landing rows (no second pass over d0)
    shared = shared_values(bronze, value, key)
    return not_in(d0, value, shared, value)


def customers_silver(bronze: DataFrame, target: DataFrame | None = None,
                     key: str = "clientid", value: str = "email") -> DataFrame:
    src = customers_clean(bronze, key, value)
    return src if target is None else changes.merge_insert(target, src, key)


def validated(bronze: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Distinct rows whose non-NULL foreign key exists in the parent.

    Dedup runs first (partial aggregation collapses copies on the map side), then the
    semi join on the key, where AQE may split a busy key.
    """
    return semi_join(dedup_rows(bronze.filter(F.col(fk).isNotNull())), parent, fk, pk)


def orders_silver(bronze: DataFrame, customers: DataFrame, target: DataFrame | None = None,
                  fk: str = "customerid", pk: str = "clientid", key: str = "orderid") -> DataFrame:
    src = validated(bronze, fk, customers, pk)
    return src if target is None else changes.merge_insert(target, src, key)


def marketing_silver(bronze: DataFrame, customers: DataFrame, target: DataFrame | None = None,
                     fk: str = "targetedcustomerid", pk: str = "clientid",
                     key: str = "marketingid") -> DataFrame:
    src = validated(bronze, fk, customers, pk)
    return src if target is None else changes.merge_insert(target, src, key)

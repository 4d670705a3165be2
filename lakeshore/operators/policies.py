"""Column masks and row filters that are attached to a name and detached again, in SQL.

``SET MASK`` / ``SET ROW FILTER`` and ``is_member`` are not in open-source Spark. Here a governed name is a view over
the table: its masks and filters are SQL expressions over the columns and the session variable
``caller_groups``, which holds the groups of whoever is asking. The view's text is analysed when it is queried, so
the same query gives masked, plain or filtered rows as the variable and the attached policies say. Masks and
filters are ordinary projections and predicates to the optimizer: filters on unmasked columns reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

VARIABLE = "caller_groups"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def declare_caller(spark: SparkSession) -> None:
    """Declare the session variable, without groups, unless it is there."""
    try:
        spark.sql(f"SELECT {VARIABLE}").schema
    except Exception:
        spark.sql(f"DECLARE VARIABLE {VARIABLE} ARRAY<STRING> DEFAULT CAST(array() AS ARRAY<STRING>)")


def set_caller(spark: SparkSession, groups: Iterable[str] = ()) -> None:
    """The groups of the caller of all later queries of this session."""
    declare_caller(spark)
    spark.sql(f"SET VARIABLE {VARIABLE} = CAST(array({', '.join(_text(g) for g in groups)}) AS ARRAY<STRING>)")


def is_member(group: str) -> str:
    """``is_member('group')`` as SQL."""
    return f"array_contains({VARIABLE}, {_text(group)})"


def prefix_mask(column: str, group: str, keep: int = 2, fill: str = "*") -> str:
    """``IF(is_member(group), <first characters, then fill>, column)`` as SQL; NULL stays NULL."""
    c = _name(column)
    return f"IF({is_member(group)}, CONCAT(LEFT({c}, {keep}), REPEAT({_text(fill)}, LENGTH({c}) - {keep})), {c})"


def exclude_values(column: str, values: Iterable[str], admin_group: str) -> str:
    """``IF(is_member(admin), true, column NOT IN (values))`` as SQL; a NULL column is hidden from others."""
    return f"IF({is_member(admin_group)}, true, {_name(column)} NOT IN ({', '.join(_text(v) for v in values)}))"


class GovernedView:
    """The view ``name`` over ``table`` (a table or view of the session) with its attached policies."""

    def __init__(self, spark: SparkSession, name: str, table: str):
        self.spark, self.name, self.table = spark, name, table
        self.columns = spark.table(table).columns
        self.masks: dict[str, str] = {}
        self.filters: dict[str, str] = {}
        declare_caller(spark)
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {_name(name)} AS {self._select()}")

    def _select(self) -> str:
        shown = [f"{self.masks[c]} AS {_name(c)}" if c in self.masks else _name(c) for c in self.columns]
        # filters see the stored values, not the masked ones
        where = " WHERE " + " AND ".join(f"({f})" for f in self.filters.values()) if self.filters else ""
        return f"SELECT {', '.join(shown)} FROM {_name(self.table)}{where}"

    def _alter(self) -> "GovernedView":
        self.spark.sql(f"ALTER VIEW {_name(self.name)} AS {self._select()}")
        return self

    def _known(self, column: str) -> str:
        if column not in self.columns:
            raise ValueError(f"{self.table} has no column {column}")
        return column

    def set_mask(self, column: str, expression: str) -> "GovernedView":
        """``ALTER TABLE .. ALTER COLUMN column SET MASK``; replaces a mask that is there."""
        self.masks[self._known(column)] = expression
        return self._alter()

    def drop_mask(self, column: str) -> "GovernedView":
        """``ALTER TABLE .. ALTER COLUMN column DROP MASK``."""
        self.masks.pop(self._known(column), None)
        return self._alter()

    def set_row_filter(self, column: str, expression: str) -> "GovernedView":
        """``ALTER TABLE .. SET ROW FILTER .. ON (column)``; replaces the column's filter."""
        self.filters[self._known(column)] = expression
        return self._alter()

    def drop_row_filter(self, column: str) -> "GovernedView":
        """``ALTER TABLE .. DROP ROW FILTER``."""
        self.filters.pop(self._known(column), None)
        return self._alter()

    def drop(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {_name(self.name)}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

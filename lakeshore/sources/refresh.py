"""Full refresh of a catalog table without a gap: a new copy first, then one switch of the name.

``DROP TABLE`` + ``CREATE TABLE AS`` leaves readers without a table while the new one is computed, and an overwrite in place
lets them see half of it. Here every refresh writes a location of its own; the table's location is changed when that is
complete. Queries that were planned before go on reading the old files, later ones read the new.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0].data_type


def full_refresh(df: DataFrame, table: str, comment: str | None = None, column_comments: Mapping[str, str] | None = None) -> str:
    """Make ``table`` hold exactly the rows of ``df``; returns the location that it had before ('' at first).

    Columns and types must stay (a change of them is a new table). The superseded location is the caller's to
    remove, once no reader that began before the switch is left.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "refresh")
    if not spark.catalog.tableExists(table):
        notes = column_comments or {}
        # CREATE TABLE AS: the data are written before the name exists
        df.write.parquet(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_text(notes[f.name])}" if f.name in notes else "")
                            for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'"
                  + (f" COMMENT {_text(comment)}" if comment else ""))
        return ""
    stored = spark.table(table).schema
    if [(f.name, f.dataType) for f in stored] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{table} has other columns: {stored.simpleString()}")
    before = _location(spark, table)
    df.write.parquet(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")  # the switch
    spark.catalog.refreshTable(table)
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_text(comment)}")
    for c, note in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{c}` COMMENT {_text(note)}")
    return before


def column_profile(spark: SparkSession, table: str) -> DataFrame:
    """``col_name, data_type, comment, filled``: the declaration of a table next to how many rows have a value."""
    fields = spark.table(table).schema.fields
    counts = spark.table(table).agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(f.name).alias("col_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.lit(f.metadata.get("comment")).cast("string").alias("comment"), F.col(f"c{i}").alias("filled")) for i, f in enumerate(fields)])))


def table_comment(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Comment'").collect()
    return rows[0].data_type if rows else None

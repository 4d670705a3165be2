"""Pipe-separated landing files: scan, SQL view, multi-file ingest, typed load, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from ..functions.text import TEXT_TS_FORMAT, text_to_ts, ts_to_text

# Fixed values of the landing format.
SEP = "|"
FILE_PATTERN = "{entity}_{seq:03d}.csv"


def string_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_pipe_csv(spark: SparkSession, path, columns=None, mode: str = "FAILFAST") -> DataFrame:
    """Scan '|'-separated files with a header into an all-STRING frame.

    With ``columns`` the schema is given up front (no extra pass over the file to read the
    header); FAILFAST stops on malformed lines instead of silently nulling them.
    """
    r = spark.read.option("sep", SEP).option("header", True).option("mode", mode)
    if columns is not None:
        r = r.schema(string_schema(columns))
    return r.csv(path)


def register_csv_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """``CREATE OR REPLACE TEMP VIEW name USING CSV OPTIONS (path, header, sep)``."""
    spark.sql(f"CREATE OR REPLACE TEMP VIEW `{name}` USING CSV "
              f"OPTIONS (path '{path}', header 'true', sep '{SEP}')")
    return spark.table(name)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Append the file each row was read from (lineage for multi-file loads)."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def file_sequence(path_col: str, entity: str) -> F.Column:
    """The N of ``<entity>_00N.csv`` in a file path."""
    return F.regexp_extract(F.col(path_col), rf"{entity}_(\d+)\.csv", 1).cast("int")


def to_typed(df: DataFrame, schema: StructType, lenient: bool = False,
             carry: tuple = ()) -> DataFrame:
    """Positional load into a typed table: column i of ``df`` becomes field i of ``schema``.

    Casts are explicit (OSS Spark refuses implicit STRING -> INT store casts); under ANSI a
    bad value raises, ``lenient`` turns it into NULL instead.
    """
    source_cols = [c for c in df.columns if c not in carry]
    if len(source_cols) != len(schema.fields):
        raise ValueError(f"{len(source_cols)} columns for a {len(schema.fields)}-column table")
    out = []
    for src, f in zip(source_cols, schema.fields):
        c = F.col(f"`{src}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)) and \
                isinstance(df.schema[src].dataType, StringType):
            t = text_to_ts(c, ntz=isinstance(f.dataType, TimestampNTZType), lenient=lenient)
            out.append(t.alias(f.name))
        else:
            out.append((c.try_cast(f.dataType) if lenient else c.cast(f.dataType)).alias(f.name))
    return df.select(*out, *carry)


def as_landing_text(df: DataFrame) -> DataFrame:
    """Timestamps rendered in the landing text format, other columns unchanged."""
    return df.select(*[ts_to_text(f.name, ntz=isinstance(f.dataType, TimestampNTZType))
                       .alias(f.name)
                       if isinstance(f.dataType, (TimestampType, TimestampNTZType))
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_pipe_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Export with header, '|' separator; timestamps as landing text. Written by the
    executors in parallel (a directory of part files), never through the driver."""
    as_landing_text(df).write.mode(mode).option("sep", SEP).option("header", True).csv(path)
    return path

"""Landing files into bronze: one partition per file, replaceable, bad lines set aside.

``INSERT INTO bronze SELECT * FROM file`` doubles a file that is loaded twice and cannot take a
corrected one. Here bronze is partitioned by the file's sequence number and a load overwrites the
partitions of the files it reads, dynamically: loading a file again changes nothing, loading a corrected
file replaces that file's rows, and the other partitions' files are not touched.

Files are parsed with the table's types. A line with the wrong number of fields or a value that is not of its
column's type neither stops the load nor turns into NULLs: it goes to a quarantine table, as it stands, with its
file, the reason and what could be parsed. The file's header must name the table's columns in order; else the load fails before anything is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.text import TEXT_TS_FORMAT
from .csv import SEP, file_sequence

LINE = "__line"
FILE_SEQ = "file_seq"


def parse_files(spark: SparkSession, paths, entity: str, schema: StructType) -> DataFrame:
    """All lines of the files, typed, with ``file_seq`` and ``__line``: the raw text of a bad line, else null."""
    parsed = StructType([*(StructField(f.name, f.dataType, True) for f in schema.fields), StructField(LINE, StringType())])
    rows = (spark.read.schema(parsed).option("sep", SEP).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
            .option("timestampFormat", TEXT_TS_FORMAT).option("timestampNTZFormat", TEXT_TS_FORMAT).csv(paths))
    return rows.withColumn("__path", F.col("_metadata.file_path")).withColumn(FILE_SEQ, file_sequence("__path", entity))


def _bad(rows: DataFrame, schema: StructType) -> DataFrame:
    fields = F.size(F.split(LINE, f"\\{SEP}"))
    reason = F.when(fields != len(schema.fields), F.lit("fields")).otherwise(F.lit("value"))
    return rows.filter(F.col(LINE).isNotNull()).select(
        F.element_at(F.split("__path", "/"), -1).alias("source_file"), F.col(LINE).alias("line"), reason.alias("reason"),
        F.to_json(F.struct(*schema.names)).alias("parsed"), FILE_SEQ)


def replace_partitions(df: DataFrame, path: str) -> None:
    """Overwrite the partitions that ``df`` has rows for (by ``file_seq``); the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FILE_SEQ).parquet(path)


def drop_partition(spark: SparkSession, path: str, column: str, value) -> None:
    """Delete one partition's files, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(place):
        fs.delete(place, True)


@dataclass(frozen=True)
class Loaded:
    """What a load did: rows by file sequence number."""
    good: dict[int, int]
    bad: dict[int, int]


def load_files(spark: SparkSession, files: dict[int, str], entity: str, schema: StructType, bronze: str,
               quarantine: str) -> Loaded:
    """Load ``files`` (sequence number -> path) into the bronze table, replacing what they gave before.

    One pass parses and writes the good rows and counts both kinds per file; a second one, over the files that
    have bad lines alone, writes the quarantine. A load that fails midway is repeated as it is.
    """
    seqs = sorted(files)
    rows = parse_files(spark, [files[n] for n in seqs], entity, schema)
    seen = Observation()
    count = lambda n, bad: F.count_if((F.col(FILE_SEQ) == n) & (F.col(LINE).isNotNull() == F.lit(bad)))
    # an aggregate per file of this load, merged with the tasks' results; no pass of its own
    counted = rows.observe(seen, *(count(n, bad).alias(f"{'bad' if bad else 'good'}_{n}") for n in seqs for bad in (False, True)))
    replace_partitions(counted.filter(F.col(LINE).isNull()).select(*schema.names, FILE_SEQ), bronze)
    found = Loaded(*({n: seen.get[f"{kind}_{n}"] for n in seqs} for kind in ("good", "bad")))
    if wrong := [n for n in seqs if found.bad[n]]:
        replace_partitions(_bad(parse_files(spark, [files[n] for n in wrong], entity, schema), schema), quarantine)
    # a file without rows leaves nothing for the overwrite to replace
    for n in seqs:
        if not found.good[n]:
            drop_partition(spark, bronze, FILE_SEQ, n)
        if not found.bad[n]:
            drop_partition(spark, quarantine, FILE_SEQ, n)
    return found


def read_bronze(spark: SparkSession, path: str, schema: StructType, with_file: bool = False) -> DataFrame:
    """The bronze table's rows, with the file's sequence number on request."""
    whole = StructType([*schema.fields, StructField(FILE_SEQ, IntegerType())])
    rows = spark.read.schema(whole).parquet(path)
    return rows if with_file else rows.drop(FILE_SEQ)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, line, reason, parsed, file_seq`` of the lines set aside; empty if there never was one."""
    schema = "source_file string, line string, reason string, parsed string, file_seq int"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_lines(lines: DataFrame, columns: list[str], path: str) -> str:
    """Write a column ``line`` as it is under the header of ``columns`` (a landing file that need not be well formed)."""
    header = SEP.join(columns)
    (lines.select(F.col("line").alias(header)).write.mode("overwrite").option("header", True).option("sep", "\x01")
     .option("quote", "").option("escapeQuotes", False).option("emptyValue", "").csv(path))
    return path

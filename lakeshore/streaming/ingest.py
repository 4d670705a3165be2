"""Incremental bronze load: new landing files only, each exactly once.

The batch job appends every landing file on every run (running it twice doubles bronze).
Here the landing folder is a streaming file source and bronze is the Parquet file sink:
the source remembers which files it has read and the sink commits each micro-batch
atomically through its metadata log, so a restart or a re-run after new files arrived
appends only the new files. ``trigger(availableNow=True)`` processes what is there in
bounded micro-batches and stops, so it runs as a scheduled batch task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.csv import SEP, file_sequence, string_schema, to_typed, with_source_file
from ..sources.landing import FILE_SEQ, read_bronze, replace_partitions


def landing_stream(spark: SparkSession, landing_glob: str, schema: StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Typed stream of the '|' CSV files matching ``landing_glob``."""
    r = (spark.readStream.schema(string_schema([f.name for f in schema.fields]))
         .option("sep", SEP).option("header", True).option("mode", "FAILFAST"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return to_typed(r.csv(landing_glob), schema)


def ingest_available(spark: SparkSession, landing_glob: str, schema: StructType,
                     bronze_path: str, checkpoint: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Append every not-yet-loaded landing file to bronze; returns the bronze table."""
    q = (landing_stream(spark, landing_glob, schema, max_files_per_trigger)
         .writeStream.format("parquet").option("path", bronze_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(bronze_path)


def ingest_each_batch(spark: SparkSession, landing_glob: str, schema: StructType,
                      checkpoint: str, apply: Callable[[DataFrame, int], None],
                      max_files_per_trigger: int | None = None) -> None:
    """Run ``apply(batch, batch_id)`` on each micro-batch of new files (``foreachBatch``).

    ``apply`` must be idempotent per batch id (a batch is replayed after a failure); an
    insert-only merge into a versioned table is.
    """
    q = (landing_stream(spark, landing_glob, schema, max_files_per_trigger)
         .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def ingest_replacing(spark: SparkSession, landing_glob: str, entity: str, schema: StructType, bronze_path: str,
                     checkpoint: str) -> DataFrame:
    """Load every new landing file in place of what an earlier file of the same sequence number gave.

    The source hands over files it has not seen; a corrected file, written anew under its sequence number, is such a
    file. A micro-batch holds all that is new (no limit per trigger), so the part files of one landing
    file come together, and its partition of bronze is overwritten as a whole. A batch that is replayed after a
    failure overwrites the same partitions with the same rows.
    """
    reader = (spark.readStream.schema(string_schema([f.name for f in schema.fields]))
              .option("sep", SEP).option("header", True).option("mode", "FAILFAST"))
    rows = with_source_file(reader.csv(landing_glob), "__path")
    typed = to_typed(rows, schema, carry=("__path",)).withColumn(FILE_SEQ, file_sequence("__path", entity)).drop("__path")

    def replace(batch: DataFrame, _batch_id: int) -> None:
        replace_partitions(batch, bronze_path)

    q = (typed.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_bronze(spark, bronze_path, schema, with_file=True)

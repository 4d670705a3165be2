"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Application id -> the folders of its written intermediate tables.
_WRITTEN: dict[str, list[str]] = {}


def build_session(master: str | None = None, app: str = "lakeshore",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library's plans are written for.

    AQE re-plans joins (broadcast only when the measured side is small), coalesces small
    shuffle partitions and splits skewed ones. The UI is off: no port is opened.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def sizing(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
           split_bytes: int = 1 << 30, least_block_bytes: int = 32 << 10) -> dict:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions of about ``target_partition_bytes`` before AQE coalesces (at least two
    waves of tasks), but never so many that a map task of ``split_bytes`` would write blocks
    under ``least_block_bytes``: the number of blocks is map tasks times partitions, and small
    ones make the fetch, not the data, the cost. Larger partitions spill instead.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    parts = min(parts, max(2 * total_cores, split_bytes // least_block_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (or the directory set on the context). Only a
    local master may go without: it gets a private directory. Elsewhere a machine-local folder
    would leave each executor's files on its own disk, so the call fails instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="lakeshore-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location under the shared root."""
    return os.path.join(shared_root(spark), "lakeshore", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared root and return the scan of it.

    Cuts the lineage of a result that several later steps read (every step then scans
    files instead of recomputing joins and aggregates), survives the loss of executors
    (unlike ``cache`` or a local checkpoint), and keeps Parquet column pruning and filter
    push-down for the readers. The files stay until ``release_intermediates``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no footer pass to infer it
    return spark.read.schema(df.schema).parquet(path)


def release_intermediates(spark: SparkSession, mark: int = 0) -> int:
    """Delete what ``materialize`` has written in this application since ``intermediates_mark`` gave ``mark``.

    For long sessions, once the results that read these files have been written or collected; returns how
    many tables went.
    """
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    gone = written[mark:]
    del written[mark:]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(gone)


def intermediates_mark(spark: SparkSession) -> int:
    """How many intermediate tables this application has written so far."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """At most ``rows`` rows in a batch read from Parquet or sent to a Python worker, in this session from now on.

    Spark's own bounds (4,096 and 10,000) are for short rows. A batch of long texts is held several times by a
    task: as vectors of the reader, as rows that wait for the worker's answer, as Arrow vectors outside the
    heap, as the bytes on their way and in the worker. Smaller settings of the caller's stay.
    """
    for key in ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        if not 0 < int(spark.conf.get(key)) <= rows:
            spark.conf.set(key, str(rows))


def ship_package(spark: SparkSession) -> None:
    """Make ``lakeshore`` importable in the executors' Python workers (once per context).

    Functions sent to workers (``mapInPandas``, pandas UDFs) may refer to library code; the
    package is zipped on the driver and added with ``addPyFile``, so Spark distributes it to
    every executor, as ``--py-files`` would.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_lakeshore_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="lakeshore-pkg-"), "lakeshore.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    sc._lakeshore_shipped = True

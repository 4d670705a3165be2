"""The scheduled job in dependency order: landing files -> bronze -> silver -> gold.

Every layer is written to storage (nothing is handed over in memory between steps, as
between the job's tasks), under one root in the shared folder:

    <root>/landing/<entity>_00N.csv/   '|'-separated export, one directory per file
    <root>/bronze/<entity>/            Parquet, appended per landing file (or a replaceable partition per file)
    <root>/quarantine/<entity>/        lines of the landing files that are not rows (replaceable files only)
    <root>/silver/<entity>/            Parquet, new rows appended (insert-only merges, idempotent)
    <root>/gold/order_attribution/     overwritten on each run (drop + CTAS)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import anti_join
from ..session import fresh_path
from ..sources import csv as C
from ..sources import fixtures, landing
from . import gold as G
from . import silver as S

ENTITIES = ("customers", "orders", "marketing")
KEYS = {"customers": "clientid", "orders": "orderid", "marketing": "marketingid"}
FILES = (1, 2, 3)


def fixture_schemas(spark: SparkSession, sf_dir: str) -> dict[str, StructType]:
    b = fixtures.bronze(spark, sf_dir)
    return {"customers": b.customers.schema, "orders": b.orders.schema,
            "marketing": b.marketing.schema}


def land_files(spark: SparkSession, sf_dir: str, root: str,
               entities: tuple = ENTITIES) -> dict[str, list[str]]:
    """Stand-in for the generator: split each mapped entity by key into three landing files
    (key % 3 = N - 1 goes to file N) and export them as '|' CSV with header."""
    b = fixtures.bronze(spark, sf_dir)
    out = {}
    for ent, df in zip(ENTITIES, (b.customers, b.orders, b.marketing)):
        if ent not in entities:
            continue
        key = KEYS[ent]
        out[ent] = [C.write_pipe_csv(df.filter(F.col(key) % 3 == n - 1),
                                     f"{root}/landing/" + C.FILE_PATTERN.format(entity=ent, seq=n))
                    for n in FILES]
    return out


def load_bronze(spark: SparkSession, files: list[str], schema: StructType,
                bronze_path: str) -> DataFrame:
    """``INSERT INTO bronze SELECT * FROM file_view`` for each file in order (append): a file that is
    loaded twice is there twice. ``sources.landing`` replaces a file's rows instead."""
    for path in files:
        raw = C.read_pipe_csv(spark, path, [f.name for f in schema.fields])
        C.to_typed(raw, schema).write.mode("append").parquet(bronze_path)
    return spark.read.parquet(bronze_path)


@dataclass
class PipelineRun:
    root: str
    bronze: dict
    silver: dict
    gold: DataFrame

    def counts(self) -> DataFrame:
        parts = [df.agg(F.lit(f"{layer}_{ent}").alias("layer"), F.count(F.lit(1)).alias("rows"))
                 for layer, tables in (("bronze", self.bronze), ("silver", self.silver))
                 for ent, df in tables.items()]
        parts.append(self.gold.agg(F.lit("gold_order_attribution").alias("layer"),
                                   F.count(F.lit(1)).alias("rows")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def create_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """``CREATE TABLE IF NOT EXISTS``: an empty Parquet table, unless something is there."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def merge_silver(spark: SparkSession, path: str, source: DataFrame, key: str,
                 schema: StructType) -> DataFrame:
    """Insert-only merge of ``source`` into the Parquet table at ``path``: rows whose key is not
    there are appended, and no stored row is written again. One writer per table; a merge that
    is repeated after a failure finds its rows there. A NULL key matches nothing, so such a row, which silver
    declares impossible, would be appended by every run (``sources.bucketed.merge_insert`` refuses it).

    The stored keys are never broadcast: a table that is merged into batch by batch would go through
    the driver once per batch, as often as there are files."""
    create_table(spark, path, schema)
    stored = spark.read.schema(schema).parquet(path).hint("merge")
    new = anti_join(source.select(*schema.names), stored, key)
    new.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def parse_flag(value) -> bool:
    """Job parameters arrive as text: 'False', '0', 'no' and '' mean False."""
    if isinstance(value, bool):
        return value
    return str(value).strip().lower() not in ("", "0", "false", "no", "off")


def drop_tables(spark: SparkSession, root: str) -> None:
    """``DROP TABLE IF EXISTS`` for every bronze / silver / gold table under ``root``."""
    jvm = spark.sparkContext._jvm
    for layer in ("bronze", "silver", "gold"):
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/{layer}")
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            fs.delete(p, True)


def run_pipeline(spark: SparkSession, sf_dir: str, root: str | None = None, days: int = 7,
                 runs: int = 1, recreate_tables="False", replace_files: bool = False) -> PipelineRun:
    """Land, load bronze, merge silver (``runs`` times: merges are idempotent), write gold.

    With ``recreate_tables`` set, existing tables under ``root`` are dropped first (bronze is
    appended to, so a re-run without dropping doubles it, as in the scheduled job). With ``replace_files``
    bronze has a partition per landing file, a re-run replaces what its files gave before, and lines that
    are no rows go to the quarantine instead of stopping the job."""
    root = root or fresh_path(spark, "pipeline")
    if parse_flag(recreate_tables):
        drop_tables(spark, root)
    schemas = fixture_schemas(spark, sf_dir)
    files = land_files(spark, sf_dir, root)
    bronze = {}
    for e in ENTITIES:
        path = f"{root}/bronze/{e}"
        if replace_files:
            landing.load_files(spark, dict(zip(FILES, files[e])), e, schemas[e], path, f"{root}/quarantine/{e}")
            bronze[e] = landing.read_bronze(spark, path, schemas[e])
        else:
            bronze[e] = load_bronze(spark, files[e], schemas[e], path)
    tables = {e: f"{root}/silver/{e}" for e in ENTITIES}
    silver = {}
    for _ in range(runs):
        cs = merge_silver(spark, tables["customers"], S.customers_clean(bronze["customers"]),
                          "clientid", schemas["customers"])
        silver = {"customers": cs}
        silver["orders"] = merge_silver(
            spark, tables["orders"], S.validated(bronze["orders"], "customerid", cs, "clientid"),
            "orderid", schemas["orders"])
        silver["marketing"] = merge_silver(
            spark, tables["marketing"],
            S.validated(bronze["marketing"], "targetedcustomerid", cs, "clientid"),
            "marketingid", schemas["marketing"])
    gold_path = f"{root}/gold/order_attribution"
    g = G.gold_attribution(G.Silver(silver["customers"], silver["orders"], silver["marketing"]),
                           days)
    g.write.mode("overwrite").parquet(gold_path)
    return PipelineRun(root, bronze, silver, spark.read.parquet(gold_path))


def register_catalog(spark: SparkSession, run: PipelineRun, database: str) -> list[str]:
    """``CREATE SCHEMA IF NOT EXISTS`` and one external Parquet table per written layer of the
    run. The caller's current database stays as it is."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{run.root}/{database}.db'")
    tables = {f"{ent}_{layer}": (df, f"{run.root}/{layer}/{ent}")
              for layer, found in (("bronze", run.bronze), ("silver", run.silver))
              for ent, df in found.items()}
    tables["gold_order_attribution"] = (run.gold, f"{run.root}/gold/order_attribution")
    for name, (df, path) in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet", schema=df.schema)
    return sorted(tables)

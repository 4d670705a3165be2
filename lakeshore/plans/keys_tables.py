"""Sources, sinks, row changes and their versions over the mapped test tables.

Sink keys write into a fresh directory of the shared folder and return what they read
back, so the result proves the round trip. The DML script runs on the mapped customers:

    file1 = customers where clientid % 3 <> 2        file2 = customers where clientid % 3 <> 0
    v0 create   v1 insert distinct file1   v2 set email NULL for six keys
    v3 merge distinct file2 (fill NULL email, insert new keys)
    v4 delete holders of shared emails     v5 delete clientid 2     v6 restore v3
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import changes as X
from ..operators.joins import valid_members
from ..session import fresh_path
from ..sources import csv as C
from ..sources.landing import drop_partition
from . import gold as G
from . import pipeline as P
from . import silver as S
from .fixture_sql import bronze_ctes, with_flow
from .registry import bronze, register, silver_layer

# Fixed values of the DML script.
NULLED_KEYS = (1, 3, 4, 6, 7, 10)
DELETED_KEY = 2
T0 = dt.datetime(2024, 12, 1, 0, 0, 0)
AS_OF = dt.datetime(2024, 12, 1, 3, 30, 0)

DML_CTES = f"""
file1 as (select * from customers_bronze where clientid % 3 <> 2),
file2 as (select * from customers_bronze where clientid % 3 <> 0),
v1 as (select distinct * from file1),
v2 as (select clientid, case when clientid in {NULLED_KEYS} then null else email end as email,
         country, channel, creation_date from v1),
src as (select distinct * from file2),
upd as (select clientid, min(email) as email from src where email is not null group by clientid),
v3 as (
  select t.clientid, case when t.email is null and u.email is not null then u.email else t.email end
         as email, t.country, t.channel, t.creation_date
  from v2 t left join upd u on t.clientid = u.clientid
  union all
  select * from src s where not exists (select 1 from v2 t where t.clientid = s.clientid)),
v4 as (select * from v3 where not coalesce(email in (
         select email from v3 group by email having count(*) > 1), false)),
v5 as (select * from v4 where not coalesce(clientid = {DELETED_KEY}, false))"""


def dml_sql(select: str) -> str:
    return "with " + bronze_ctes() + "," + DML_CTES + "\n" + select


def dml_files(spark, d):
    """The two input files of the row-change script."""
    c = bronze(spark, d).customers
    return c.filter(F.col("clientid") % 3 != 2), c.filter(F.col("clientid") % 3 != 0)


def _v1(spark, d):
    return dml_files(spark, d)[0].distinct()


def _v2(spark, d):
    return X.update_where(_v1(spark, d), F.col("clientid").isin(*NULLED_KEYS),
                          {"email": F.lit(None).cast("string")})


def _v3(spark, d):
    return X.merge_fill_null(_v2(spark, d), dml_files(spark, d)[1].distinct(), "clientid", "email")


def _v4(spark, d):
    v3 = _v3(spark, d)
    shared = v3.groupBy("email").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return X.delete_in(v3, "email", shared)


def _v5(spark, d):
    return X.delete_where(_v4(spark, d), F.col("clientid") == DELETED_KEY)


#: What each statement of the script is; the rows of a version are the table's partition of that number.
OPERATIONS = ("CREATE TABLE", "WRITE", "UPDATE", "MERGE", "DELETE", "DELETE", "RESTORE")
CURRENT = len(OPERATIONS) - 1


def _versions(spark, d) -> tuple[str, DataFrame]:
    """The script's versions as one Parquet table partitioned by version: every statement is an ordinary job
    that reads what it needs and appends its result as the next partition (0 is empty, 6 is 3 again)."""
    path = fresh_path(spark, "customers_versions")
    schema = bronze(spark, d).customers.schema
    for n, rows in enumerate((_v1, _v2, _v3, _v4, _v5, _v3), start=1):
        rows(spark, d).withColumn("version", F.lit(n)).write.mode("append").partitionBy("version").parquet(path)
    return path, spark.read.schema(StructType([*schema.fields, StructField("version", IntegerType())])).parquet(path)


def _commits(spark) -> DataFrame:
    """Version, operation and time of every statement: statement i ran at T0 + i hours."""
    rows = [(n, op, T0 + dt.timedelta(hours=n)) for n, op in enumerate(OPERATIONS)]
    return spark.createDataFrame(rows, "version long, operation string, committed_at timestamp_ntz")


def _history(spark, rows: DataFrame) -> DataFrame:
    """The commits with the rows that their version holds."""
    counts = rows.groupBy(F.col("version").cast("long").alias("version")).agg(F.count(F.lit(1)).alias("n"))
    return _commits(spark).join(counts, "version", "left").withColumn("num_rows", F.coalesce("n", F.lit(0).cast("long"))).drop("n")


# ---- O4 - O8: row changes as operators ---------------------------------------------------

@register("update_set_null", with_flow(f"""select distinct clientid,
    case when clientid in {NULLED_KEYS} then null else email end as email, country, channel, creation_date
    from customers_bronze""", silver=False))
def update_set_null(spark, d):
    """Email set to NULL for six keys, over all distinct customers."""
    return X.update_where(bronze(spark, d).customers.distinct(), F.col("clientid").isin(*NULLED_KEYS),
                          {"email": F.lit(None).cast("string")})


@register("merge_upsert_fill_null", dml_sql("select * from v3"))
def merge_upsert_fill_null(spark, d):
    return _v3(spark, d)


@register("delete_shared_values", dml_sql("select * from v4"))
def delete_shared_values(spark, d):
    return _v4(spark, d)


@register("delete_by_key", dml_sql("select * from v5"))
def delete_by_key(spark, d):
    return _v5(spark, d)


@register("insert_distinct", with_flow("select distinct * from customers_bronze", silver=False))
def insert_distinct(spark, d):
    """``CREATE TABLE`` + ``INSERT INTO t SELECT DISTINCT * FROM file``, read back."""
    rows, path = bronze(spark, d).customers, fresh_path(spark, "insert_distinct")
    P.create_table(spark, path, rows.schema)
    rows.distinct().write.mode("append").parquet(path)
    return spark.read.parquet(path)


# ---- S6, S7, O9 - O14: versions as partitions of a plain table ------------------------------

@register("version_as_of", dml_sql("select * from v2"))
def version_as_of(spark, d):
    return _versions(spark, d)[1].filter("version = 2").drop("version")


@register("timestamp_as_of", dml_sql("select * from v3"))
def timestamp_as_of(spark, d):
    """The version that was the latest at AS_OF: a scalar subquery that prunes the partitions."""
    at = _commits(spark).filter(F.col("committed_at") <= F.lit(AS_OF).cast("timestamp_ntz")).agg(F.max("version").cast("int").alias("v"))
    return _versions(spark, d)[1].filter(F.col("version") == at.scalar()).drop("version")


@register("restore_version", dml_sql("select * from v3"))
def restore_version(spark, d):
    """The current version after version 3 was written again."""
    return _versions(spark, d)[1].filter(F.col("version") == CURRENT).drop("version")


_HISTORY_SQL = dml_sql("""
select * from (values (0, 'CREATE TABLE'), (1, 'WRITE'), (2, 'UPDATE'), (3, 'MERGE'),
  (4, 'DELETE'), (5, 'DELETE'), (6, 'RESTORE')) h(version, operation)
join (select 0 as v, 0 as num_rows union all select 1, count(*) from v1
  union all select 2, count(*) from v2 union all select 3, count(*) from v3
  union all select 4, count(*) from v4 union all select 5, count(*) from v5
  union all select 6, count(*) from v3) c on h.version = c.v""")


@register("table_history", _HISTORY_SQL.replace("select * from (values",
                                                "select cast(version as bigint) as version, operation, "
                                                "cast(num_rows as bigint) as num_rows from (values", 1))
def table_history(spark, d):
    """Rows per version, counted by partition, next to what made them."""
    return _history(spark, _versions(spark, d)[1]).select("version", "operation", "num_rows")


@register("vacuum_dry_run", _HISTORY_SQL.replace(
    "select * from (values",
    "select cast(version as bigint) as version, cast(num_rows as bigint) as num_rows from (values", 1)
    + " where h.version < 6")
def vacuum_dry_run(spark, d):
    """The versions whose partitions would go, with their rows; nothing is deleted."""
    return _history(spark, _versions(spark, d)[1]).filter(F.col("version") < CURRENT).select("version", "num_rows")


@register("vacuum_apply", _HISTORY_SQL.replace(
    "select * from (values",
    "select cast(version as bigint) as version, operation, version < 6 as vacuumed, "
    "version = 6 as readable from (values", 1))
def vacuum_apply(spark, d):
    """After the older partitions are dropped every version is still listed; only the current one has rows."""
    path, rows = _versions(spark, d)
    for n in range(CURRENT):
        drop_partition(spark, path, "version", n)
    left = _history(spark, spark.read.schema(rows.schema).parquet(path))
    return left.select("version", "operation", (F.col("version") < CURRENT).alias("vacuumed"), (F.col("num_rows") > 0).alias("readable"))


@register("describe_table", dml_sql("\nunion all ".join(
    f"select '{c}' as col_name, '{t}' as data_type, count({c}) as filled from v3"
    for c, t in (("clientid", "bigint"), ("email", "string"), ("country", "string"), ("channel", "string"), ("creation_date", "timestamp_ntz")))))
def describe_table(spark, d):
    """Names and types as stored, with how many rows of the current version have a value."""
    rows = _versions(spark, d)[1].filter(F.col("version") == CURRENT).drop("version")
    counts = rows.agg(*[F.count(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rows.schema.fields)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("col_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                                                     F.col(f"c{i}").alias("filled")) for i, f in enumerate(rows.schema.fields)])))


@register("table_detail")
def table_detail(spark, d):
    """Files and bytes of the current version, from the metadata of the files its rows are in."""
    rows = _versions(spark, d)[1].filter(F.col("version") == CURRENT)
    files = rows.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.lit("parquet").alias("format"), F.count(F.lit(1)).alias("num_files"), F.sum("file_size").alias("size_in_bytes"),
                     F.sum("n").alias("num_rows"))


# ---- S1 - S3, K1 - K8: files and tables --------------------------------------------------

_TEXT_SQL = with_flow("""select cast(clientid as varchar) as clientid, email, country, channel,
    strftime(creation_date, '%Y-%m-%d %H:%M:%S') as creation_date from customers_bronze""",
                      silver=False)


def _landed_customers(spark, d):
    path = fresh_path(spark, "landing") + "/customers_001.csv"
    return C.write_pipe_csv(bronze(spark, d).customers, path)


@register("csv_scan_pipe", _TEXT_SQL)
def csv_scan_pipe(spark, d):
    """'|' CSV with header read back as an all-STRING frame."""
    return C.read_pipe_csv(spark, _landed_customers(spark, d))


@register("csv_sql_view", _TEXT_SQL)
def csv_sql_view(spark, d):
    C.register_csv_view(spark, "customers_tv", _landed_customers(spark, d))
    return spark.sql("SELECT * FROM customers_tv")


@register("multi_file_ingest", with_flow(
    "select *, cast(clientid % 3 + 1 as int) as file_seq from customers_bronze", silver=False))
def multi_file_ingest(spark, d):
    """Three landing files read in one scan (glob), typed, with the file sequence number."""
    root = fresh_path(spark, "ingest")
    P.land_files(spark, d, root, entities=("customers",))
    schema = bronze(spark, d).customers.schema
    raw = C.read_pipe_csv(spark, f"{root}/landing/customers_00*.csv",
                          [f.name for f in schema.fields])
    typed = C.to_typed(C.with_source_file(raw, "__path"), schema, carry=("__path",))
    return typed.withColumn("file_seq", C.file_sequence("__path", "customers")).drop("__path")


@register("bronze_append", with_flow("select * from customers_bronze", silver=False))
def bronze_append(spark, d):
    """Three landing files appended one by one into a typed bronze table, read back."""
    root = fresh_path(spark, "bronze")
    files = P.land_files(spark, d, root, entities=("customers",))["customers"]
    schema = bronze(spark, d).customers.schema
    return P.load_bronze(spark, files, schema, f"{root}/bronze/customers")


@register("csv_export_roundtrip", with_flow(
    """select orderid, date_trunc('second', transactiondate) as transactiondate, items, amount,
              customerid from orders_bronze""", silver=False))
def csv_export_roundtrip(spark, d):
    """Export with header and '|' (timestamps as landing text, whole seconds), load back."""
    o = bronze(spark, d).orders
    path = C.write_pipe_csv(o, fresh_path(spark, "export") + "/orders_001.csv")
    return C.to_typed(C.read_pipe_csv(spark, path, o.columns), o.schema)


@register("gold_ctas_roundtrip", with_flow("select * from gold", gold=True))
def gold_ctas_roundtrip(spark, d):
    """Drop + ``CREATE TABLE AS`` of gold (overwrite), read back."""
    path = fresh_path(spark, "gold")
    G.gold_attribution(silver_layer(spark, d), 7).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SCHEMA_ROWS = ", ".join(
    f"('{t}', '{c}', '{ty}', {str(n).lower()})"
    for t, cols in (
        ("customers_bronze", [(c, "string", True) for c in
                              ("clientid", "firstname", "lastname", "email", "address", "country",
                               "phone", "channel")] + [("creation_date", "timestamp", True)]),
        ("customers_silver", [("clientid", "string", False)] +
         [(c, "string", True) for c in ("firstname", "lastname", "email", "address", "country",
                                        "phone", "channel")] + [("creation_date", "timestamp", True)]),
        ("orders_bronze", [("orderid", "string", True), ("transactiondate", "timestamp", True),
                           ("items", "int", True), ("amount", "int", True),
                           ("customerid", "string", True)]),
        ("orders_silver", [("orderid", "string", False), ("transactiondate", "timestamp", True),
                           ("items", "int", True), ("amount", "int", True),
                           ("customerid", "string", True)]),
        ("marketing_bronze", [("marketingid", "string", True), ("marketingdate", "timestamp", True),
                              ("discount", "float", True), ("clicked", "int", True),
                              ("targetedcustomerid", "string", True)]),
        ("marketing_silver", [("marketingid", "string", False), ("marketingdate", "timestamp", True),
                              ("discount", "float", True), ("clicked", "int", True),
                              ("targetedcustomerid", "string", True)]))
    for c, ty, n in cols)


@register("typed_table_schema", with_flow(f"""
select s.table_name, s.col_name, s.data_type, s.nullable, r.num_rows from (values {_SCHEMA_ROWS})
  s(table_name, col_name, data_type, nullable)
join (select 'customers_bronze' as t, count(*) as num_rows from customers_bronze
      union all select 'customers_silver', count(*) from customers_silver
      union all select 'orders_bronze', count(*) from orders_bronze
      union all select 'orders_silver', count(*) from orders_silver
      union all select 'marketing_bronze', count(*) from marketing_bronze
      union all select 'marketing_silver', count(*) from marketing_silver) r
  on s.table_name = r.t"""))
def typed_table_schema(spark, d):
    """The typed tables of the DDL, created and loaded (missing columns are NULL): (table, column,
    type, nullable, rows). Columns, types and rows are what the stored files hold; whether a
    column may be NULL is the declaration, since a Parquet read makes every column nullable."""
    from ..schemas import TABLES
    b = bronze(spark, d)
    s = silver_layer(spark, d)
    data = {"customers_bronze": b.customers, "orders_bronze": b.orders,
            "marketing_bronze": b.marketing, "customers_silver": s.customers,
            "orders_silver": s.orders, "marketing_silver": s.marketing}
    root = fresh_path(spark, "typed")
    parts = []
    for name, (schema, _pk, _fk) in TABLES.items():
        df = data[name]
        cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
                .alias(f.name) for f in schema.fields]
        # CREATE TABLE IF NOT EXISTS (typed, empty), then INSERT
        P.create_table(spark, f"{root}/{name}", schema)
        df.select(*cols).write.mode("append").parquet(f"{root}/{name}")
        back = spark.read.parquet(f"{root}/{name}")
        meta = spark.createDataFrame(
            [(name, f.name, f.dataType.simpleString(), schema[f.name].nullable) for f in back.schema.fields],
            "table_name string, col_name string, data_type string, nullable boolean")
        cnt = back.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("num_rows"))
        parts.append(meta.join(cnt, "table_name"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


# ---- O1 - O3, O5: insert-only merges -------------------------------------------------------

def _merged(spark, name, target, source, key):
    """``target`` written as a table, ``source`` merged into it by appending the new rows."""
    path = fresh_path(spark, name)
    target.write.parquet(path)
    return P.merge_silver(spark, path, source, key, target.schema)


@register("merge_insert_customers", with_flow("""select clientid, email, country,
    case when clientid % 3 = 0 then 'kept' else channel end as channel, creation_date from customers_silver"""))
def merge_insert_customers(spark, d):
    """Merge the cleaned customers into a silver table that already holds a third of them, with
    another channel: rows that are there must stay as they are."""
    clean = S.customers_clean(bronze(spark, d).customers)
    target = clean.filter(F.col("clientid") % 3 == 0).withColumn("channel", F.lit("kept"))
    return _merged(spark, "merge_customers", target, clean, "clientid")


@register("merge_insert_orders", with_flow("""select orderid, transactiondate, items,
    case when orderid % 2 = 0 then -1 else amount end as amount, customerid from orders_silver"""))
def merge_insert_orders(spark, d):
    s = silver_layer(spark, d)
    src = S.validated(bronze(spark, d).orders, "customerid", s.customers, "clientid")
    target = src.filter(F.col("orderid") % 2 == 0).withColumn("amount", F.lit(-1))
    return _merged(spark, "merge_orders", target, src, "orderid")


@register("merge_insert_marketing", with_flow("""select marketingid, marketingdate,
    case when marketingid % 2 = 0 then cast(-1 as double) else discount end as discount, clicked,
    targetedcustomerid from marketing_silver"""))
def merge_insert_marketing(spark, d):
    s = silver_layer(spark, d)
    src = S.validated(bronze(spark, d).marketing, "targetedcustomerid", s.customers, "clientid")
    target = src.filter(F.col("marketingid") % 2 == 0).withColumn("discount", F.lit(-1.0))
    return _merged(spark, "merge_marketing", target, src, "marketingid")


@register("merge_idempotent", with_flow("select * from customers_silver"))
def merge_idempotent(spark, d):
    """The silver merge run twice against the stored table leaves it as after one run."""
    run = P.run_pipeline(spark, d, runs=2)
    return run.silver["customers"]


@register("pipeline_end_to_end", with_flow("""
select 'bronze_customers' as layer, count(*) as "rows" from customers_bronze
union all select 'bronze_orders', count(*) from orders_bronze
union all select 'bronze_marketing', count(*) from marketing_bronze
union all select 'silver_customers', count(*) from customers_silver
union all select 'silver_orders', count(*) from orders_silver
union all select 'silver_marketing', count(*) from marketing_silver
union all select 'gold_order_attribution', count(*) from gold""", gold=True))
def pipeline_end_to_end(spark, d):
    """The whole job in dependency order; row counts per written layer."""
    return P.run_pipeline(spark, d).counts()


# ---- incremental load (Structured Streaming) ----------------------------------------------

@register("incremental_ingest", with_flow("select * from customers_bronze", silver=False))
def incremental_ingest(spark, d):
    """Three landing files streamed into bronze (availableNow), then the same landing folder
    streamed again: the second run finds no new file, so bronze is not doubled."""
    from ..streaming.ingest import ingest_available
    root = fresh_path(spark, "stream")
    P.land_files(spark, d, root, entities=("customers",))
    schema = bronze(spark, d).customers.schema
    glob = f"{root}/landing/customers_00*.csv/*.csv"
    for _ in range(2):
        out = ingest_available(spark, glob, schema, f"{root}/bronze/customers", f"{root}/_ckpt",
                               max_files_per_trigger=1)
    return out


@register("incremental_silver_merge", with_flow(
    """select orderid, date_trunc('second', transactiondate) as transactiondate, items, amount,
              customerid from orders_silver"""))
def incremental_silver_merge(spark, d):
    """Orders landing files streamed batch by batch into silver: the insert-only merge appends
    the new orders only (FK-validated against silver customers). A batch that is replayed finds
    its orders there and appends nothing. Each batch meets the same customers, so their keys are
    shuffled between executors and not broadcast through the driver by every batch."""
    from ..streaming.ingest import ingest_each_batch
    root = fresh_path(spark, "stream_silver")
    P.land_files(spark, d, root, entities=("orders",))
    schema = bronze(spark, d).orders.schema
    customers = silver_layer(spark, d).customers.hint("merge")
    path = f"{root}/silver/orders"

    def apply(batch, batch_id):
        P.merge_silver(spark, path, S.validated(batch, "customerid", customers, "clientid"), "orderid", schema)

    glob = f"{root}/landing/orders_00*.csv/*.csv"
    ingest_each_batch(spark, glob, schema, f"{root}/_ckpt", apply, max_files_per_trigger=1)
    return spark.read.schema(schema).parquet(path)


@register("catalog_tables", with_flow("""
select 'customers_bronze' as table_name, count(*) as num_rows from customers_bronze
union all select 'orders_bronze', count(*) from orders_bronze
union all select 'marketing_bronze', count(*) from marketing_bronze
union all select 'customers_silver', count(*) from customers_silver
union all select 'orders_silver', count(*) from orders_silver
union all select 'marketing_silver', count(*) from marketing_silver
union all select 'gold_order_attribution', count(*) from gold""", gold=True))
def catalog_tables(spark, d):
    """The job's layers registered in a database of the session catalog (K7) and read back
    by table name."""
    import uuid
    run = P.run_pipeline(spark, d)
    db = f"lakeshore_{uuid.uuid4().hex[:8]}"
    names = P.register_catalog(spark, run, db)
    parts = [spark.table(f"{db}.{n}").agg(F.lit(n).alias("table_name"),
                                          F.count(F.lit(1)).alias("num_rows")) for n in names]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@register("table_detail_exact", dml_sql(
    "select 'parquet' as format, (select count(*) from v3) as num_rows, "
    "cast(6 as integer) as version"))
def table_detail_exact(spark, d):
    """Format, rows and number of the current version (3 written again)."""
    rows = _versions(spark, d)[1]
    return (rows.filter(F.col("version") == rows.agg(F.max("version")).scalar())
            .agg(F.lit("parquet").alias("format"), F.count(F.lit(1)).alias("num_rows"), F.max("version").alias("version")))

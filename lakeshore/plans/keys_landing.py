"""Landing files that are loaded again, corrected or partly unreadable (mapped customers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ts_to_text
from ..session import fresh_path
from ..sources import landing as L
from ..sources.csv import FILE_PATTERN, SEP, write_pipe_csv
from .fixture_sql import with_flow
from .pipeline import FILES
from .registry import bronze, register

TEXT_TS = "strftime(creation_date, '%Y-%m-%d %H:%M:%S')"


class _Landing:
    """A landing folder, a bronze and a quarantine table of the mapped customers."""

    def __init__(self, spark, d: str):
        self.spark, self.rows, self.root = spark, bronze(spark, d).customers, fresh_path(spark, "landing")
        self.schema, self.bronze, self.quarantine = self.rows.schema, f"{self.root}/bronze", f"{self.root}/quarantine"

    def _path(self, n: int) -> str:
        return f"{self.root}/files/" + FILE_PATTERN.format(entity="customers", seq=n)

    def _part(self, rows: DataFrame, n: int) -> DataFrame:
        return rows.filter(F.col("clientid") % 3 == n - 1)

    def land(self, rows: DataFrame, seqs=FILES) -> dict[int, str]:
        return {n: write_pipe_csv(self._part(rows, n), self._path(n)) for n in seqs}

    def land_lines(self, line: Column, seqs=FILES) -> dict[int, str]:
        return {n: L.write_lines(self._part(self.rows, n).select(line.alias("line")), self.schema.names, self._path(n)) for n in seqs}

    def load(self, files: dict[int, str]) -> L.Loaded:
        return L.load_files(self.spark, files, "customers", self.schema, self.bronze, self.quarantine)

    def read(self) -> DataFrame:
        return L.read_bronze(self.spark, self.bronze, self.schema, with_file=True)


@register("bronze_reload", with_flow(
    "select *, cast(clientid % 3 + 1 as int) as file_seq from customers_bronze", silver=False))
def bronze_reload(spark, d):
    """Three landing files loaded twice: bronze holds each once."""
    t = _Landing(spark, d)
    files = t.land(t.rows)
    for _ in range(2):
        t.load(files)
    return t.read()


def _corrected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("clientid") % 15 != 1).withColumn("channel", F.upper("channel"))


@register("bronze_replace_file", with_flow("""
select clientid, email, country, case when clientid % 3 = 1 then upper(channel) else channel end as channel, creation_date,
       cast(clientid % 3 + 1 as int) as file_seq
from customers_bronze where clientid % 15 <> 1""", silver=False))
def bronze_replace_file(spark, d):
    """File 2 arrives again with other channels and without some customers: it replaces what it gave before."""
    t = _Landing(spark, d)
    t.load(t.land(t.rows))
    t.load(t.land(_corrected(t.rows), seqs=(2,)))
    return t.read()


@register("bronze_replace_file_counts", with_flow("""
select cast(clientid % 3 + 1 as int) as file_seq, count(*) as num_rows, count(distinct clientid) as customers
from customers_bronze where clientid % 15 <> 1 group by 1""", silver=False))
def bronze_replace_file_counts(spark, d):
    """Rows and customers per landing file after file 2 was replaced, read by partition."""
    return bronze_replace_file(spark, d).groupBy("file_seq").agg(
        F.count(F.lit(1)).alias("num_rows"), F.count_distinct("clientid").alias("customers"))


@register("incremental_replace_file", with_flow("""
select clientid, email, country, case when clientid % 3 = 1 then upper(channel) else channel end as channel, creation_date,
       cast(clientid % 3 + 1 as int) as file_seq
from customers_bronze where clientid % 15 <> 1""", silver=False))
def incremental_replace_file(spark, d):
    """The landing folder as a stream: file 2 arrives, then again corrected, and replaces itself."""
    from ..streaming.ingest import ingest_replacing
    t = _Landing(spark, d)
    run = lambda: ingest_replacing(spark, f"{t.root}/files/customers_00*.csv/*.csv", "customers", t.schema,
                                   t.bronze, f"{t.root}/_ckpt")
    t.land(t.rows)
    run()
    t.land(_corrected(t.rows), seqs=(2,))
    return run()


#: Customers whose landing line lacks its last field, has a date that is none, has a field too many.
SHORT, NO_DATE, LONG = 7, 11, 13
_BAD_SQL = f"""lines as (
  select *, cast(clientid % 3 + 1 as int) as file_seq, clientid % 40 as kind,
         concat_ws('{SEP}', clientid, email, country, channel) as head, {TEXT_TS} as stamp from customers_bronze)"""


def _partly_unreadable(spark, d) -> _Landing:
    t = _Landing(spark, d)
    head = F.concat_ws(SEP, "clientid", "email", "country", "channel")
    kind, stamp = F.col("clientid") % 40, ts_to_text("creation_date")
    t.load(t.land_lines(F.when(kind == SHORT, head).when(kind == NO_DATE, F.concat_ws(SEP, head, F.lit("soon")))
                        .when(kind == LONG, F.concat_ws(SEP, head, stamp, F.lit("x"))).otherwise(F.concat_ws(SEP, head, stamp))))
    return t


@register("landing_good_rows", with_flow(
    f"""select * exclude (kind, head, stamp) from lines where kind not in ({SHORT}, {NO_DATE}, {LONG})""",
    silver=False, extra=_BAD_SQL))
def landing_good_rows(spark, d):
    """Bronze after landing files with bad lines: the good rows, each once."""
    return _partly_unreadable(spark, d).read()


@register("landing_quarantine", with_flow(f"""
select file_seq, case kind when {NO_DATE} then 'value' else 'fields' end as reason,
       case kind when {SHORT} then head when {NO_DATE} then head || '{SEP}soon' else head || '{SEP}' || stamp || '{SEP}x' end as line
from lines where kind in ({SHORT}, {NO_DATE}, {LONG})""", silver=False, extra=_BAD_SQL))
def landing_quarantine(spark, d):
    """The lines set aside, as they stood, with their file and the reason."""
    t = _partly_unreadable(spark, d)
    return L.read_quarantine(spark, t.quarantine).select("file_seq", "reason", "line")


@register("landing_quarantine_by_file", with_flow(f"""
select file_seq, count(*) filter (kind in ({SHORT}, {NO_DATE}, {LONG})) as bad_rows,
       count(*) filter (kind not in ({SHORT}, {NO_DATE}, {LONG})) as good_rows from lines group by 1""",
    silver=False, extra=_BAD_SQL))
def landing_quarantine_by_file(spark, d):
    """Good and bad lines per landing file, from the two tables."""
    t = _partly_unreadable(spark, d)
    bad = L.read_quarantine(spark, t.quarantine).select("file_seq", F.lit(1).alias("bad"), F.lit(0).alias("good"))
    good = t.read().select("file_seq", F.lit(0).alias("bad"), F.lit(1).alias("good"))
    return bad.unionByName(good).groupBy("file_seq").agg(F.sum("bad").alias("bad_rows"), F.sum("good").alias("good_rows"))

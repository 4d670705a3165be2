"""Merges and changes that read and write no more of a stored table than they touch."""

import glob
import os
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import changes as X
from lakeshore.session import fresh_path
from lakeshore.sources import bucketed as B

SCHEMA = "clientid long, email string, channel string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def database(spark):
    name = f"t_bucketed_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_path(spark, name)}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _stored(spark, database, n=2000):
    rows = spark.range(n).select(F.col("id").alias("clientid"), F.lit("a").alias("email"), F.lit("kept").alias("channel"))
    B.create_bucketed(rows, f"{database}.customers", "clientid", 8, fresh_path(spark, "customers"))
    return f"{database}.customers"


def test_merge_has_no_exchange_on_the_stored_side(spark, database):
    table = _stored(spark, database)
    batch = spark.createDataFrame([(k, "b", "new") for k in range(1990, 2010)], SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table of any real size
    try:
        plan = _plan(B.new_rows(spark, table, batch, "clientid"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [clientid" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning(clientid") == 1              # the batch, to the table's buckets
    assert "Exchange hashpartitioning(__rk" not in plan and "BroadcastExchange" not in plan
    assert re.search(r"FileScan parquet \S+\[clientid#\d+L\] Batched: true, Bucketed: true", plan)   # the key alone, as it lies


def test_merge_inserts_what_is_not_there(spark, database):
    table = _stored(spark, database)
    files = set(spark.table(table).inputFiles())
    batch = spark.createDataFrame([(k, "b", "new") for k in range(1990, 2010)] + [(2005, "c", "new")], SCHEMA)
    for _ in range(2):
        out = B.merge_insert(spark, table, batch, "clientid", 8)
    assert out.count() == 2011 and out.filter("channel = 'kept'").count() == 2000
    assert files <= set(out.inputFiles())                                    # no stored file was written again
    assert out.groupBy("clientid").count().filter("count > 1").count() == 1  # both rows of the new key 2005
    with pytest.raises(Exception, match="NULL in key"):
        B.merge_insert(spark, table, spark.createDataFrame([(None, "x", "y")], SCHEMA), "clientid", 8)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_bloom_filter_misses_no_key_and_drops_most_others(spark, kind):
    keys = spark.range(0, 50_000, 5).select(F.col("id").cast(kind).alias("k"))
    might = B.bloom_filter(keys.union(spark.sql(f"select cast(null as {kind})")), "k")
    rows = spark.range(100_000).select(F.col("id").cast(kind).alias("k")).filter(might(F.col("k")))
    got = rows.count()
    assert rows.join(keys, "k", "left_semi").count() == 10_000 and got < 10_000 + 0.01 * 100_000
    none = B.bloom_filter(keys.limit(0), "k")
    assert keys.filter(none(F.col("k"))).count() == 0


class Keyed:
    def __init__(self, spark, rows, buckets=16):
        self.spark, self.path = spark, fresh_path(spark, "t_keyed").replace("file:", "")
        df = spark.createDataFrame(rows, SCHEMA)
        self.table = B.KeyedTable(spark, self.path, df.schema, "clientid", buckets).create(df)

    def rows(self):
        return sorted(map(tuple, self.table.read().collect()), key=repr)

    def written(self):
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{self.path}/*=*/*.parquet")}

    def change(self, run):
        before = self.written()
        touched = run(self.table)
        after = self.written()
        bucket = lambda f: int(re.search(r"key_bucket=(\d+)", f)[1])
        assert {f: t for f, t in before.items() if bucket(f) not in touched} == \
            {f: t for f, t in after.items() if bucket(f) not in touched}     # the others kept their files and times
        assert not set(touched) & {bucket(f) for f in before.keys() & after.keys()}
        return touched


ROWS = [(k, f"e{k // 2 if k % 10 < 2 else k}", "Web") for k in range(200)] + [(5, "e5", "Web"), (None, "e1", "App"), (None, None, "App")]


def test_update_and_delete_rewrite_touched_buckets(spark):
    t, df = Keyed(spark, ROWS), spark.createDataFrame(ROWS, SCHEMA)
    want = lambda d: sorted(map(tuple, d.collect()), key=repr)
    hit = F.col("clientid").isin(5, 7)
    assert 1 <= len(t.change(lambda x: x.update(hit, {"email": F.lit(None).cast("string")}))) <= 2
    df = X.update_where(df, hit, {"email": F.lit(None).cast("string")})
    assert t.rows() == want(df)
    assert t.change(lambda x: x.update(F.col("clientid") == 10**6, {"email": F.lit("x")})) == []
    assert len(t.change(lambda x: x.delete(F.col("clientid") == 2))) == 1
    df = X.delete_where(df, F.col("clientid") == 2)
    assert t.rows() == want(df)
    shared = df.groupBy("email").count().filter("count > 1")
    t.change(lambda x: x.delete_in("email", x.read().groupBy("email").count().filter("count > 1")))
    df = X.delete_in(df, "email", shared)
    assert t.rows() == want(df) and any(r[0] is None for r in t.rows())
    with pytest.raises(ValueError):
        t.table.update(hit, {"clientid": F.lit(1)})


def test_a_bucket_may_lose_all_rows(spark):
    t = Keyed(spark, [(k, "e", "Web") for k in range(40)], buckets=8)
    t.change(lambda x: x.delete(F.col("clientid") != 3))
    assert t.rows() == [(3, "e", "Web")]
    t.change(lambda x: x.delete(F.lit(True)))
    assert t.rows() == []


def test_merge_rewrites_touched_buckets(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, f"e{k}"]), "Web") for k in range(300)] + [(None, "n", "Web")]
    batch = [(k, rng.choice([None, f"new{k}"]), "App") for k in rng.sample(range(310), 12)] + [(305, "twice", "App")] * 2
    batch = [b for b in batch if b[0] != 305 or b[1] == "twice"]
    t, src, df = Keyed(spark, rows, buckets=64), spark.createDataFrame(batch, SCHEMA), spark.createDataFrame(rows, SCHEMA)
    touched = t.change(lambda x: x.merge(src, {"email": "email"}, F.col("email").isNull(), F.col("email").isNotNull()))
    assert t.rows() == sorted(map(tuple, X.merge_fill_null(df, src, "clientid", "email").collect()), key=repr)
    assert 0 < len(touched) <= 13
    # nothing to fill and nothing to insert: nothing is written
    same = spark.createDataFrame([(k, e, c) for k, e, c in t.rows() if k is not None and e is not None][:50], SCHEMA)
    assert t.change(lambda x: x.merge(same, {"email": "email"}, F.col("email").isNull(), F.col("email").isNotNull())) == []


def test_an_ambiguous_merge_changes_nothing(spark):
    t = Keyed(spark, [(1, None, "Web"), (2, "b", "Web")])
    before = t.rows()
    src = spark.createDataFrame([(1, "x", "App"), (1, "y", "App")], SCHEMA)
    with pytest.raises(Exception, match="several source rows"):
        t.table.merge(src, {"email": "email"})
    assert t.rows() == before

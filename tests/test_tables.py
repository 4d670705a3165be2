"""Landing files and the pipeline runner."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeshore.session import fresh_path
from lakeshore.sources import csv as C
from tests.conftest import SF_SMALL

def test_csv_roundtrip_and_bad_values(spark, tmp_path):
    p = str(tmp_path / "t_csv")
    lines = ["a|n|ts", '1|5|2024-01-02 03:04:05', '2|x|2024-01-02 03:04:05',
             '3||not a time', '"4|quoted"|7|2024-02-03 00:00:00']
    (tmp_path / "t_csv").mkdir()
    (tmp_path / "t_csv" / "f.csv").write_text("\n".join(lines) + "\n")
    raw = C.read_pipe_csv(spark, p)
    assert raw.columns == ["a", "n", "ts"] and raw.count() == 4
    assert raw.filter(F.col("a") == "4|quoted").count() == 1     # separator inside quotes
    schema = spark.createDataFrame([], "a string, n int, ts timestamp_ntz").schema
    with pytest.raises(Exception):
        C.to_typed(raw, schema).collect()                        # 'x' is not an INT
    lenient = {r.a: (r.n, r.ts) for r in C.to_typed(raw, schema, lenient=True).collect()}
    assert lenient["2"][0] is None and lenient["3"] == (None, None)
    assert lenient["1"] == (5, dt.datetime(2024, 1, 2, 3, 4, 5))


def test_bronze_append_twice_doubles_silver_merge_does_not(spark):
    from lakeshore.plans import pipeline as P
    root = fresh_path(spark, "t_pipeline")
    files = P.land_files(spark, SF_SMALL, root, entities=("customers",))["customers"]
    schema = P.fixture_schemas(spark, SF_SMALL)["customers"]
    once = P.load_bronze(spark, files, schema, f"{root}/bronze/c").count()
    twice = P.load_bronze(spark, files, schema, f"{root}/bronze/c").count()
    assert twice == 2 * once
    run = P.run_pipeline(spark, SF_SMALL, runs=2)
    counts = dict((r.layer, r.rows) for r in run.counts().collect())
    assert counts["silver_customers"] == 144 and counts["gold_order_attribution"] == 132


def test_recreate_flag_drops_tables_first(spark):
    from lakeshore.plans import pipeline as P
    assert [P.parse_flag(v) for v in ("True", "1", True, "False", "0", "", " no ", False)] == \
        [True] * 3 + [False] * 5
    root = fresh_path(spark, "t_recreate")

    def bronze(flag):
        run = P.run_pipeline(spark, SF_SMALL, root=root, recreate_tables=flag)
        return dict((r.layer, r.rows) for r in run.counts().collect())

    first, again, recreated = bronze("True"), bronze("False"), bronze("True")    # nothing to drop at first
    assert again["bronze_orders"] == 2 * first["bronze_orders"]
    assert again["silver_orders"] == first["silver_orders"] and recreated == first


def test_insert_only_merge_appends(spark):
    from lakeshore.plans import pipeline as P
    path = fresh_path(spark, "t_append")
    old = spark.createDataFrame([(1, "old"), (2, "old")], "key int, value string")
    old.write.parquet(path)
    files = {f for f in spark.read.parquet(path).inputFiles()}
    src = spark.createDataFrame([(2, "new"), (3, "new"), (None, "new")], "key int, value string")
    out = P.merge_silver(spark, path, src, "key", old.schema)
    assert sorted(out.collect(), key=repr) == sorted(
        [(1, "old"), (2, "old"), (3, "new"), (None, "new")], key=repr)
    assert files <= set(out.inputFiles())                  # stored rows were not written again


def test_stream_merge_broadcasts_nothing_per_batch(spark, monkeypatch):
    """Neither the stored orders nor the customers go through the driver with every landing file."""
    from lakeshore.plans import catalog
    from lakeshore.plans import pipeline as P
    plain, plans = P.anti_join, []

    def seen(*args, **kw):
        df = plain(*args, **kw)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(P, "anti_join", seen)
    assert catalog.queries()["incremental_silver_merge"](spark, SF_SMALL).count() > 0
    assert len(plans) >= 3                                  # a batch per landing file at least
    assert all("Broadcast" not in p and "SortMergeJoin" in p for p in plans)

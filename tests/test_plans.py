"""Plan shapes that the scale design relies on."""

import pytest

from lakeshore.plans import gold as G
from lakeshore.plans.registry import silver_layer
from lakeshore.session import sizing
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    return silver_layer(spark, SF_SMALL)


def test_gold_forms_no_pairs_and_splits_customers_by_day_and_hour(silver):
    plan = _plan(G.gold_attribution(silver, 7))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    # the raw-row window is partitioned by customer, day and hour
    assert "hashpartitioning(__c" in plan and "__h" in plan
    assert "WindowGroupLimit" in plan


def test_silver_reads_are_pruned_and_pushed(spark, silver):
    g = G.gold_attribution(silver, 7).select("country", "amount")
    plan = _plan(g)
    assert "PushedFilters: [IsNotNull(clicked), EqualTo(clicked,1)" in plan


def test_sizing():
    size = 100 * 2**40
    conf = sizing(size, 8000)
    maps, parts = size // int(conf["spark.sql.files.maxPartitionBytes"]), int(conf["spark.sql.shuffle.partitions"])
    assert parts >= 2 * 8000 and size / (maps * parts) >= 32 << 10      # bytes per shuffle block
    assert sizing(10 * 2**40, 400)["spark.sql.shuffle.partitions"] == "32768"
    assert sizing(1, 8)["spark.sql.shuffle.partitions"] == "16"


def test_incremental_ingest_loads_each_file_once(spark):
    from lakeshore.plans import pipeline as P
    from lakeshore.session import fresh_path
    from lakeshore.streaming.ingest import ingest_available
    root = fresh_path(spark, "t_stream")
    P.land_files(spark, SF_SMALL, root, entities=("customers",))
    schema = P.fixture_schemas(spark, SF_SMALL)["customers"]
    glob = f"{root}/landing/customers_00*.csv/*.csv"
    first = ingest_available(spark, glob, schema, f"{root}/b", f"{root}/ck").count()
    second = ingest_available(spark, glob, schema, f"{root}/b", f"{root}/ck").count()
    assert first == second == 156

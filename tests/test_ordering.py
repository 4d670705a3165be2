"""All but the last n rows by a bound, and draws of a fixed size."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import ordering as O

SCHEMA = "k long, v string, d double"


def _tuples(df):
    return Counter(map(tuple, df.collect()))


def _rows(seed, n, keys, nulls=.1):
    rng = random.Random(seed)
    return [(None if rng.random() < nulls else rng.randint(0, keys), rng.choice("abc"), rng.choice([0.5, None])) for _ in range(n)]


@pytest.mark.parametrize("seed,n,keys", [(1, 300, 1000), (2, 300, 20), (3, 200, 1), (4, 50, 0)])
def test_drop_last_n_keeps_the_rest(spark, seed, n, keys):
    rows = _rows(seed, n, keys)
    df = spark.createDataFrame(rows, SCHEMA)
    order = lambda r: (r[0] is None, r[0] or 0)
    for drop in (0, 1, 7, n - 1, n, n + 5):
        got = O.drop_last_n(df.repartition(1 + drop % 5), "k", drop)
        assert got.columns == df.columns
        kept = _tuples(got)
        assert sum(kept.values()) == max(0, n - drop) and not kept - Counter(rows)
        gone = sorted((Counter(rows) - kept).elements(), key=order)
        assert [order(r) for r in gone] == [order(r) for r in sorted(rows, key=order)[max(0, n - drop):]]
        assert kept == _tuples(O.drop_last_n(df.repartition(3), "k", drop))       # the same rows at every run


def test_drop_last_n_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "same", 0.5)] * 25_000 + [(0, "x", None)], SCHEMA)
    assert _tuples(O.drop_last_n(df, "k", 22)) == Counter({(1, "same", 0.5): 24_978, (0, "x", None): 1})
    assert _tuples(O.drop_last_n(df, "k", 25_000)) == Counter({(0, "x", None): 1})


def test_drop_last_n_plan(spark):
    df = spark.range(10_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"), F.lit(1.0).alias("d"))
    plan = O.drop_last_n(df, "k", 22)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=22" in plan and "Join" not in plan and "checkpoint" not in plan.lower()
    kept = plan[:plan.index("Subquery")]
    assert "Exchange" not in kept.split("\n")[2]                                   # the rows that stay are filtered where they are


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert O.drop_last_n(none, "k", 3).count() == 0
    assert O.draw_with_replacement(none, 5, 1).count() == 0 and O.append_drawn_repeats(none, .5, 1).count() == 0


@pytest.mark.parametrize("n,k", [(1, 10), (100, 7), (9000, 360), (70_000, 2800)])
def test_draw_has_its_size_and_does_not_depend_on_partitions(spark, n, k):
    df = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), (F.col("id") % 1000).cast("string")).alias("v"))
    a, b = (O.draw_with_replacement(df.repartition(p), k, 310) for p in (1, 7))
    assert a.columns == df.columns
    a, b = _tuples(a), _tuples(b)
    assert sum(a.values()) == k and a == b and not set(a) - {(i, f"v{i % 1000}") for i in range(n)}
    assert n == 1 or _tuples(O.draw_with_replacement(df, k, 311)) != a


def test_draw_is_uniform_over_rows_and_repeats(spark):
    rows = [(1, "often", None)] * 3000 + [(k, "once", None) for k in range(2, 1002)]
    drawn = _tuples(O.draw_with_replacement(spark.createDataFrame(rows, SCHEMA), 8000, 5))
    assert sum(drawn.values()) == 8000
    assert abs(drawn[(1, "often", None)] - 6000) < 200                             # 3 of 4 rows; standard deviation 39
    once = [c for r, c in drawn.items() if r[1] == "once"]
    assert abs(len(once) - 1000 * (1 - (1 - 1 / 4000) ** 8000)) < 60 and max(once) < 15


def test_append(spark):
    df = spark.createDataFrame(_rows(6, 250, 10), SCHEMA)
    out = O.append_drawn_repeats(df, .04, 3)
    assert out.count() == 260 and not _tuples(df) - _tuples(out)

"""Sketch profiles: exact parts, error bounds, merging, frequent values."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import profile as P

SCHEMA = "part int, n long, d double, t string, at timestamp_ntz, day date, dec decimal(10,2), none string"


def _frame(spark, n=20_000, seed=1):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 4), int(rng.expovariate(1e-3)), rng.gauss(1e6, 5) if rng.random() < .9 else None,
             rng.choice(["hot"] * 30 + ["warm"] * 5 + [f"v{k}" for k in range(65)]) if rng.random() < .5 else f"u{i}", i % 86400, i % 400, i % 77)
            for i in range(n)]
    df = spark.createDataFrame(rows, "part int, n long, d double, t string, s int, g int, c int")
    return df.selectExpr("part", "n", "d", "t", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as at",
                         "date_add(date'2024-01-01', g) as day", "cast(c / 4 as decimal(10,2)) as dec", "cast(null as string) as none")


@pytest.fixture(scope="module")
def frame(spark):
    return _frame(spark).cache()


@pytest.fixture(scope="module")
def by_part(frame):
    return P.merged(P.sketches(frame, by="part")).cache()


def test_exact_parts_are_the_same_whole_or_merged(frame, by_part):
    data = frame.toPandas()
    whole = {r["column"]: r for r in P.summary(P.merged(P.sketches(frame.drop("part")))).collect()}
    parts = {r["column"]: r for r in P.summary(by_part).collect()}
    assert whole.keys() == parts.keys() == set(frame.columns) - {"part"}
    for c in whole:
        for got in (whole[c], parts[c]):
            known = data[c].dropna()
            assert (got.rows, got.nulls) == (len(data), len(data) - len(known))
            if c == "none":
                assert got.min is got.max is got["mean"] is got.quantiles is None
                continue
            low, high = frame.agg(F.min(c).cast("string"), F.max(c).cast("string")).first()
            assert (got.min, got.max) == (low, high)
            distinct = len(set(known))
            assert abs(got.distinct_approx - distinct) <= 0.06 * distinct + 1
            if c in ("n", "d", "dec"):
                x = [float(v) for v in known]
                assert got["mean"] == pytest.approx(statistics.fmean(x), rel=1e-12)
                assert got["stddev"] == pytest.approx(statistics.stdev(x), rel=1e-6)
            else:
                assert got["mean"] is None and got["stddev"] is None


def test_quantile_ranks_are_within_the_bound(frame, by_part):
    for profile in (P.merged(P.sketches(frame.drop("part"))), by_part):
        errors = P.rank_errors(frame, profile, (0.01, 0.25, 0.5, 0.75, 0.99)).collect()
        assert {r["column"] for r in errors} == {"n", "d", "at", "day", "dec"} and len(errors) == 25
        assert max(r.error for r in errors) < 0.02


def test_frequent_values_are_exact_and_complete(frame, by_part):
    got = {}
    for r in P.frequent_values(frame.drop("part"), by_part, 0.01).collect():
        got.setdefault(r["column"], {})[r["value"]] = r["n"]
    rows = frame.count()
    for c in ("t", "dec", "day", "n", "at"):
        counts = Counter(r[0] for r in frame.select(F.col(c).cast("string")).collect())
        assert got.get(c, {}) == {v: n for v, n in counts.items() if n >= 0.01 * rows}, c
    assert {"hot", "warm"} <= got["t"].keys() and "none" not in got
    with pytest.raises(ValueError):
        P.frequent_values(frame, by_part, 0.001)


def test_one_pass_without_python(frame):
    plan = P.sketches(frame.drop("part"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and plan.count("partial_count(1)") >= 1
    assert plan.count("Exchange") == 1


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    rows = P.summary(P.merged(P.sketches(none.drop("part")))).collect()
    assert len(rows) == 7 and all(r.rows == 0 and r.distinct_approx == 0 and r.quantiles is None for r in rows)
    assert P.frequent_values(none.drop("part"), P.merged(P.sketches(none.drop("part")))).count() == 0

"""Policies by session state, model calls on distinct prompts, refresh without a gap."""

import glob
import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeshore.functions.predict import predict_distinct
from lakeshore.operators import policies as Po
from lakeshore.session import fresh_path
from lakeshore.sources import refresh as R

PEOPLE = [(1, "ann@x.com", "Web"), (2, None, "App"), (3, "c", "Call Center"), (4, "dora@x.com", None)]


@pytest.fixture
def view(spark):
    spark.createDataFrame(PEOPLE, "id int, email string, channel string").createOrReplaceTempView("people_")
    Po.set_caller(spark, [])
    v = Po.GovernedView(spark, "people", "people_")
    yield v
    v.drop()
    Po.set_caller(spark, [])


def _ids_and_mails(spark):
    return {r.id: r.email for r in spark.sql("select id, email from people").collect()}      # the same text every time


def test_the_same_query_by_session_state(spark, view):
    plain = {r[0]: r[1] for r in PEOPLE}
    assert _ids_and_mails(spark) == plain
    view.set_mask("email", Po.prefix_mask("email", "readers")).set_row_filter("channel", Po.exclude_values("channel", ["Call Center"], "admins"))
    assert _ids_and_mails(spark) == {1: "ann@x.com", 2: None}                                # no groups: filtered, not masked
    Po.set_caller(spark, ["readers"])
    assert _ids_and_mails(spark) == {1: "an*******", 2: None}
    Po.set_caller(spark, ["readers", "admins"])
    assert _ids_and_mails(spark) == {1: "an*******", 2: None, 3: "c", 4: "do********"}
    view.drop_mask("email")
    assert _ids_and_mails(spark) == plain
    Po.set_caller(spark, ["o'neill\\"])
    view.drop_row_filter("channel").set_mask("email", Po.prefix_mask("email", "o'neill\\", 1, "'"))
    assert _ids_and_mails(spark)[1] == "a" + "'" * 8
    view.drop_mask("email")
    assert _ids_and_mails(spark) == plain
    with pytest.raises(ValueError):
        view.set_mask("nothing", "1")


def test_a_filter_reads_the_stored_value_and_reaches_the_scan(spark, view):
    path = fresh_path(spark, "t_policies")
    spark.createDataFrame(PEOPLE, "id int, email string, channel string").write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("people_stored")
    v = Po.GovernedView(spark, "people2", "people_stored").set_mask("channel", "'hidden'").set_row_filter(
        "channel", Po.exclude_values("channel", ["Call Center"], "admins"))
    assert {(r.id, r.channel) for r in v.read().collect()} == {(1, "hidden"), (2, "hidden")}
    plan = v.read().filter("id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,1)" in plan and "Python" not in plan
    v.drop()


class Counting:
    """Writes a file per call; fails on some prompts, and the first time on others."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self):
        def model(prompts: pd.Series) -> pd.Series:
            for p in prompts:
                open(os.path.join(self.folder, f"{p}-{uuid.uuid4().hex}"), "w").close()
            if any(p.startswith("bad") for p in prompts):
                raise RuntimeError("no answer")
            if any(p.startswith("flaky") for p in prompts) and len(glob.glob(f"{self.folder}/flaky-*")) < 2:
                raise TimeoutError("later")
            return prompts.str.upper()
        return model


def _calls(folder):
    out = {}
    for f in os.listdir(folder):
        out[f.rsplit("-", 1)[0]] = out.get(f.rsplit("-", 1)[0], 0) + 1
    return out


def test_the_model_is_called_once_per_distinct_prompt(spark, tmp_path):
    rows = [(i, [None, "de", "fr", "en"][i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, prompt string").repartition(5)
    out = predict_distinct(df, "prompt", Counting(str(tmp_path)), out_col="answer")
    for _ in range(2):                                                                      # two actions, no second call
        got = out.orderBy("id").collect()
    assert [(r.id, r.prompt) for r in got] == rows and out.columns == ["id", "prompt", "answer", "error"]
    assert all(r.answer == (r.prompt and r.prompt.upper()) and r.error is None for r in got)
    assert _calls(tmp_path) == {"de": 1, "fr": 1, "en": 1}


def test_a_failing_prompt_takes_no_other_row_with_it(spark, tmp_path):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "bad1", "b", "bad2", "a", None])], "id int, prompt string").coalesce(1)
    got = {r.id: (r.response, r.error) for r in predict_distinct(df, "prompt", Counting(str(tmp_path)), retries=1).collect()}
    bad = (None, "RuntimeError: no answer")
    assert got == {0: ("A", None), 1: bad, 2: ("B", None), 3: bad, 4: ("A", None), 5: (None, None)}
    assert max(_calls(tmp_path).values()) <= 4                                              # two as a batch, two alone


def test_a_flaky_prompt_is_tried_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "flaky")], "id int, prompt string")
    assert predict_distinct(df, "prompt", Counting(str(tmp_path))).first().response == "FLAKY"
    assert _calls(tmp_path) == {"flaky": 2}
    none = df.limit(0)
    assert predict_distinct(none, "prompt", Counting(str(tmp_path))).count() == 0


def test_refresh_switches_when_the_new_copy_is_complete(spark):
    db = f"t_refresh_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{fresh_path(spark, db)}'")
    table, first = f"{db}.t", spark.range(10).selectExpr("id", "'old' as v")
    assert R.full_refresh(first, table, "it's a table", {"id": "the key", "v": "a 'word'"}) == ""
    early = spark.table(table)                                                              # planned before the refresh
    before = early.agg(F.count(F.lit(1)))
    old = R.full_refresh(spark.range(3).selectExpr("id", "if(id = 0, null, 'new') as v"), table, column_comments={"v": "another"})
    assert old and {r.v for r in early.collect()} == {"old"} and before.first()[0] == 10
    assert sorted((r.id, r.v) for r in spark.table(table).collect()) == [(0, None), (1, "new"), (2, "new")]
    assert [tuple(r) for r in R.column_profile(spark, table).collect()] == [("id", "bigint", "the key", 3), ("v", "string", "another", 2)]
    assert R.table_comment(spark, table) == "it's a table"
    failing = spark.range(5).selectExpr("id", "raise_error('midway') as v").selectExpr("id", "cast(v as string) as v")
    with pytest.raises(Exception, match="midway"):
        R.full_refresh(failing, table)
    assert spark.table(table).count() == 3                                                  # a refresh that fails changes nothing
    with pytest.raises(ValueError, match="other columns"):
        R.full_refresh(spark.range(2), table)
    spark.sql(f"DROP DATABASE {db} CASCADE")

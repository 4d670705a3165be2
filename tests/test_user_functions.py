"""User functions on nullable and very large ids; time of the window pick; the shared folder."""

import time

import pytest
from pyspark.sql import functions as F

from lakeshore.functions.predict import batch_predict, echo_upper_model
from lakeshore.functions.udfs import pandas_membership_flag
from lakeshore.session import shared_root

BIG = 9007199254740992


def test_membership_flag_keeps_large_ids_apart(spark):
    df = spark.createDataFrame([(BIG + 1,), (BIG,), (None,)], "id bigint")
    keys = spark.createDataFrame([(BIG,), (BIG,), (None,)], "k bigint")
    got = {r.id: r.flag for r in pandas_membership_flag(df, "id", keys, "k", "flag").collect()}
    assert got == {BIG + 1: "N", BIG: "Y", None: "N"}


def test_predict_keeps_other_columns(spark):
    df = spark.createDataFrame([(BIG + 1, "a"), (None, None)], "id bigint, prompt string")
    got = {(r.id, r.prompt, r.response) for r in batch_predict(df, "prompt", echo_upper_model).collect()}
    assert got == {(BIG + 1, "a", "A"), (None, None, None)}


def test_shared_root_needs_a_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_root(Session())


def test_written_intermediates_can_be_released(spark):
    import os
    from lakeshore.session import intermediates_mark, materialize, release_intermediates
    mark = intermediates_mark(spark)
    kept = [materialize(spark.range(3), "t_release") for _ in range(2)]
    folders = [os.path.dirname(df.inputFiles()[0].replace("file://", "")) for df in kept]
    assert all(df.count() == 3 for df in kept) and all(map(os.path.isdir, folders))
    assert release_intermediates(spark, mark) == 2 and not any(map(os.path.isdir, folders))
    assert release_intermediates(spark, mark) == 0

"""Replaceable landing files: what is rewritten, what is set aside, what stays untouched."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from lakeshore.plans import pipeline as P
from lakeshore.session import fresh_path
from lakeshore.sources import landing as L
from tests.conftest import SF_SMALL

COLUMNS = ["clientid", "email", "creation_date"]
AT = "2024-01-01 00:00:00"


class Table:
    def __init__(self, spark):
        self.spark = spark
        root = fresh_path(spark, "t_landing").replace("file:", "")
        self.files, self.bronze, self.quarantine = f"{root}/files", f"{root}/bronze", f"{root}/quarantine"
        self.schema = spark.createDataFrame([], "clientid long, email string, creation_date timestamp_ntz").schema

    def land(self, n, lines, columns=COLUMNS):
        df = self.spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1)
        return {n: L.write_lines(df, columns, f"{self.files}/customers_{n:03d}.csv")}

    def load(self, files):
        return L.load_files(self.spark, files, "customers", self.schema, self.bronze, self.quarantine)

    def rows(self):
        return sorted((r.file_seq, r.clientid, r.email) for r in L.read_bronze(self.spark, self.bronze, self.schema, True).collect())

    def bad(self):
        return sorted((r.file_seq, r.reason, r.line) for r in L.read_quarantine(self.spark, self.quarantine).collect())

    def written(self):
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{self.bronze}/file_seq=*/*.parquet")}


@pytest.fixture
def table(spark):
    return Table(spark)


def test_a_corrected_file_replaces_its_own_rows_only(table):
    files = table.land(1, [f"1|a|{AT}", f"2|b|{AT}"]) | table.land(2, [f"3|c|{AT}", f"4|d|{AT}"]) | table.land(12, [f"5|e|{AT}"])
    assert table.load(files) == L.Loaded({1: 2, 2: 2, 12: 1}, {1: 0, 2: 0, 12: 0})
    first = table.written()
    table.load(table.land(2, [f"3|corrected|{AT}"]))
    assert table.rows() == [(1, 1, "a"), (1, 2, "b"), (2, 3, "corrected"), (12, 5, "e")]
    second = table.written()
    untouched = [f for f in first if "file_seq=2/" not in f]
    assert len(untouched) == 2 and all(second[f] == first[f] for f in untouched)
    assert not {f for f in first if "file_seq=2/" in f} & second.keys()
    for _ in range(2):
        table.load(files | table.land(2, [f"3|corrected|{AT}"]))
    assert table.rows() == [(1, 1, "a"), (1, 2, "b"), (2, 3, "corrected"), (12, 5, "e")]


def test_bad_lines_are_set_aside_and_leave_when_corrected(table):
    lines = ["3|c|not a date", "4|d", f"5|e|{AT}|x", f"6||{AT}", f"x|f|{AT}", f'7|"q|r"|{AT}', "", f"|null id|{AT}", "8|g|2024-02-30 00:00:00"]
    done = table.load(table.land(1, [f"1|a|{AT}"]) | table.land(2, lines))
    assert done == L.Loaded({1: 1, 2: 3}, {1: 0, 2: 5})
    got = L.read_bronze(table.spark, table.bronze, table.schema, True).collect()
    assert {(r.file_seq, r.clientid, r.email) for r in got} == {(1, 1, "a"), (2, 6, None), (2, 7, "q|r"), (2, None, "null id")}
    assert table.bad() == sorted([(2, "value", "3|c|not a date"), (2, "fields", "4|d"), (2, "fields", f"5|e|{AT}|x"),
                                  (2, "value", f"x|f|{AT}"), (2, "value", "8|g|2024-02-30 00:00:00")])
    table.load(table.land(2, [f"3|c|{AT}"]))
    assert table.bad() == [] and table.rows() == [(1, 1, "a"), (2, 3, "c")]


def test_files_without_rows_empty_their_partition(table):
    table.load(table.land(1, [f"1|a|{AT}"]) | table.land(2, [f"2|b|{AT}"]))
    assert table.load(table.land(2, [])).good == {2: 0} and table.rows() == [(1, 1, "a")]
    assert table.load(table.land(1, ["nothing of use"])) == L.Loaded({1: 0}, {1: 1})
    assert table.rows() == [] and table.bad() == [(1, "fields", "nothing of use")]


def test_a_header_that_does_not_name_the_columns_stops_the_load(table):
    table.load(table.land(1, [f"1|a|{AT}"]))
    before = table.written()
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        table.load(table.land(1, [f"9|{AT}|z"], ["clientid", "creation_date", "email"]))
    assert table.written() == before and table.rows() == [(1, 1, "a")]


def test_job_with_replaceable_files_runs_twice(spark):
    root = fresh_path(spark, "t_job")
    counts = [dict((r.layer, r.rows) for r in P.run_pipeline(spark, SF_SMALL, root=root, replace_files=True).counts().collect())
              for _ in range(2)]
    assert counts[0] == counts[1] and counts[0]["bronze_customers"] == 156 and counts[0]["gold_order_attribution"] == 132
    assert L.read_quarantine(spark, f"{root}/quarantine/customers").count() == 0


def test_good_rows_are_parsed_in_one_pass(table):
    """The good rows' write is one scan of the files; files without a bad line are not read again."""
    files = table.land(1, [f"{k}|a|{AT}" for k in range(50)]) | table.land(2, ["bad"] * 3)
    plan = L.parse_files(table.spark, list(files.values()), "customers", table.schema).filter(F.col(L.LINE).isNull())
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert table.load(files) == L.Loaded({1: 50, 2: 0}, {1: 0, 2: 3})

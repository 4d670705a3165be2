"""Every registered query against its SQL oracle (DuckDB) on the test tables."""

import pytest

from lakeshore.plans import catalog
from tests.conftest import SF_ORACLE
from tests.oracle import compare, duck

import __spark_entry__ as E

ORACLES = E.oracle_sql()
KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_key_has_an_oracle_or_is_listed():
    rows_only = {"table_detail", "bootstrap_duplicates_sampled"}
    assert {k for k in catalog.queries() if k not in ORACLES} == rows_only


@pytest.mark.parametrize("key", [k for k in KEYS if k in ORACLES])
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_ORACLE)
    problems, _ = compare(df, con, ORACLES[key])
    assert not problems, problems


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 132


@pytest.mark.parametrize("key,by", [
    ("order_by_ordinal", lambda r: (r.country, r.channel)),
    ("order_by_mixed", lambda r: (r.country, -r.creation_date.timestamp())),
    ("preview_limit", lambda r: r.orderid),
    ("duplicate_records", lambda r: r.clientid),
    ("shared_email_records", lambda r: (r.email, -r.creation_date.timestamp()))])
def test_rows_come_in_order(spark, key, by):
    rows = E.queries()[key](spark, SF_ORACLE).collect()
    assert len(rows) > 1 and [by(r) for r in rows] == sorted(by(r) for r in rows)

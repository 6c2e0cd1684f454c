"""Every registered key against its DuckDB oracle on the smallest data set
(the driver repeats this at sf0.01; ``tests/run_oracle_check.py`` does too)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from dq_mart.plans.registry import load_all
from oracle_harness import compare, duck

from conftest import SF_SMALL

KEYS = sorted(load_all())
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    r = compare(df, con, ORACLES[key])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["diagnosis", "frequency", "pct"]

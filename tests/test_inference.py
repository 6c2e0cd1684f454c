"""The type lattice over raw text."""

from __future__ import annotations

import pytest

from dq_mart.operators.inference import infer_types

CASES = [
    (["1", "-2", None], "int"), (["1", "3000000000"], "bigint"), (["1", "9223372036854775808"], "decimal(19,0)"),
    (["1", "2.50"], "decimal(3,2)"), (["1", ".5", "12."], "decimal(3,1)"), (["1", "1e3"], "double"),
    (["9" * 39], "double"), (["9" * 30, "0.123456789"], "double"), (["true", "FALSE"], "boolean"),
    (["true", "1"], "string"), (["2024-02-29"], "date"), (["2024-02-30"], "string"), (["2024-01-01", "5"], "string"),
    ([None, None], "void"), (["007", " 8 "], "int"), (["", "1"], "string"), (["0", "0.0"], "decimal(1,1)"),
    (["12d"], "string"), (["NaN"], "string"), (["+"], "string"), (["x" * 5000], "string"),
]


@pytest.mark.parametrize("values,dtype", CASES)
def test_join_of_classes(spark, values, dtype):
    df = spark.createDataFrame(list(enumerate(values)), "o int, v string")
    r = infer_types(df, "t", "o").first()
    there = [v for v in values if v is not None]
    assert r.dtype == dtype and r.non_null == len(there) and r.sample == values[0]
    assert r.widest == (min(there, key=lambda v: (-len(v), v)) if there else None)


def test_empty_table_and_odd_names(spark):
    df = spark.createDataFrame([], "o int, `a.b` string, dtype string, n bigint")
    assert {r.column_name: (r.dtype, r.non_null) for r in infer_types(df, "t", "o").collect()} == {
        "a.b": ("void", 0), "dtype": ("void", 0), "n": ("bigint", 0)}


def test_one_scan(spark):
    df = spark.createDataFrame([(1, "a", "2")], "o int, v string, w string")
    plan = infer_types(df, "t", "o")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1

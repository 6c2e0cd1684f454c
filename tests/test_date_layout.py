"""Date layouts by vote."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dq_mart.operators.conform import ColumnSpec, TableSpec, transform
from dq_mart.operators.date_layout import LAYOUTS, guess_layouts, parse_layout

# values: (layout, ambiguous, disputed, parsed)
CASES = [
    (["2024-02-03", "2024-12-31", "x", None], ("yyyy-MM-dd", False, 0, 2)),
    (["03/04/2024", "25/04/2024"], ("dd/MM/yyyy", False, 1, 2)),
    (["03/04/2024", "04/25/2024"], ("MM/dd/yyyy", False, 1, 2)),
    (["03/04/2024", "05/06/2024"], ("dd/MM/yyyy", True, 2, 2)),
    (["04/04/2024"], ("dd/MM/yyyy", False, 0, 1)),
    (["03-Apr-2024", "03-Xyz-2024"], ("dd-MMM-yyyy", False, 0, 1)),
    (["20240203", "20241303"], ("yyyyMMdd", False, 0, 1)),
    ([" 01.02.2024 ", "31.02.2024"], ("dd.MM.yyyy", False, 0, 1)),
    (["2024-01-02 10:11:12"], ("yyyy-MM-dd HH:mm:ss", False, 0, 1)),
    (["13/13/2024", "abc", ""], (None, False, 0, 0)), ([None], (None, False, 0, 0)), ([], (None, False, 0, 0)),
]


@pytest.mark.parametrize("values,want", CASES)
def test_votes(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "`a.d` string")
    r = guess_layouts(df, ["a.d"]).first()
    assert (r.layout, r.ambiguous, r.disputed, r.parsed) == want
    assert r.parsed + r.unparsed == sum(v is not None for v in values)


def test_each_layout_reads_only_its_own_shape(spark):
    day = dt.date(2024, 11, 25)
    df = spark.createDataFrame([(day,)], "d date")
    for layout in LAYOUTS:
        text = df.select(F.date_format("d", layout).alias("t"))
        got = text.select(*[parse_layout(F.col("t"), o).alias(f"p{i}") for i, o in enumerate(LAYOUTS)]).first()
        assert [o for o, v in zip(LAYOUTS, got) if v is not None] == [layout] and day in tuple(got)


def test_a_table_without_configured_layouts(spark):
    raw = spark.createDataFrame([("25/04/2024", "2024-01-02", "1"), ("03/04/2024", "bad", "2")],
                                "`Date In` string, `Date Out` string, Id string")
    spec = TableSpec("t", (ColumnSpec("date_in", "date"), ColumnSpec("date_out", "date"), ColumnSpec("id", "int")),
                     match_lower=True, dates=("date_in", "date_out", "absent"), date_formats=())
    got = [tuple(r) for r in transform(raw, spec).orderBy("id").collect()]
    assert got == [(dt.date(2024, 4, 25), dt.date(2024, 1, 2), "1"), (dt.date(2024, 4, 3), None, "2")]


def test_one_scan_for_all_columns(spark):
    df = spark.createDataFrame([("2024-01-01", "x")], "a string, b string")
    plan = guess_layouts(df, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1

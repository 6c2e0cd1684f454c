"""Edges: empty tables, absent columns, odd numbers, keys of different kinds,
short and long CSV rows, publishing and wide sums."""

from __future__ import annotations

import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from dq_mart.functions import casts
from dq_mart.operators import analytics as A
from dq_mart.operators import profiling as P
from dq_mart.operators.conform import ColumnSpec, TableSpec, conform, good_rows, rejected_rows
from dq_mart.operators.integrity import ForeignKey, fk_integrity, fk_orphans
from dq_mart.operators.table_profile import TableProfile
from dq_mart.session import local_fs_path, shared_path
from dq_mart.sources import sinks
from dq_mart.sources.catalog import row_counts
from dq_mart.sources.csv import read_raw_csv


def test_empty_tables_are_counted(spark):
    a, e = spark.range(3), spark.range(0)
    got = {r.table_name: r.row_count for r in row_counts({"a": a, "e": e}).collect()}
    assert got == {"a": 3, "e": 0, "TOTAL": 3}
    assert {r.row_count for r in row_counts({"e": e}).collect()} == {0}


def test_keys_of_different_kinds(spark):
    parent = spark.createDataFrame([(1,), (2,), (5,)], "k bigint")
    text = spark.createDataFrame([("zz",), ("5",), ("2.0",), ("1.5",), (None,)], "k string")
    part = spark.createDataFrame([(1.5,), (1.0,), (2.0,)], "k double")
    none = parent.where("k < 0")
    checks = [ForeignKey("text", text, "k", parent, "k"), ForeignKey("part", part, "k", parent, "k"),
              ForeignKey("none", none, "k", parent, "k")]
    orphans = {(r.label, r.orphan) for r in fk_orphans(checks).collect()}
    assert orphans == {("text", "zz"), ("text", "1.5"), ("text", None), ("part", "1.5")}
    rows = {r.label: (r.child_ids, r.orphans, r.examples) for r in fk_integrity(checks).collect()}
    assert rows["none"] == (0, 0, None) and rows["part"][:2] == (3, 1) and rows["text"][:2] == (5, 3)


def test_absent_columns(spark):
    df = spark.createDataFrame([("x",)], "a string")
    rows = TableProfile(df, "t").categorical(["B", "C"]).long().collect()
    assert {(r.column_name, r.value) for r in rows if r.metric == "status"} == {
        ("B", "missing"), ("C", "missing")}
    assert P.profile_dates(df, "t", ["D"]).collect() == []
    assert P.profile_yes_no(df, "t", ["D"]).collect() == []
    assert P.profile_yes_no_unexpected(df, "t", ["D"]).collect() == []
    assert TableProfile(df, "t").dates(["D"]).yes_no(["D"]).long().collect() == []


def test_only_numbers_are_numbers(spark):
    texts = ["12d", "77F", "0x1p3", "Infinity", "NaN", "12", " 7 ", "5.9", "-5.9", "1e3", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(casts.bigint_or_zero("v")).collect()]
    assert got == [0, 0, 0, 0, 0, 12, 7, 5, -5, 1000, 0, 0]
    ranges = TableProfile(df.where("v like '%d' or v like '0x%'"), "t").int_range().long()
    assert ranges.collect() == []                   # no numeric column


def test_integer_columns_take_numbers_rounded(spark):
    spec = TableSpec(name="t", columns=(ColumnSpec("v", "int"),))
    df = spark.createDataFrame([("5.0",), ("12.7",), ("-2.5",), ("1e3",), ("12d",), ("9999999999",)], "v string")
    out = conform(df, spec)
    assert [r.v for r in good_rows(out).collect()] == [5, 13, -3, 1000]
    assert [r.v for r in rejected_rows(out).collect()] == ["12d", "9999999999"]
    real = conform(spark.createDataFrame([(12.7,), (5.0,)], "v double"), spec)
    assert [r.v for r in good_rows(real).collect()] == [13, 5]


def test_a_tuple_needs_a_comma(spark):
    df = spark.createDataFrame([("('AB')",), ("('AB',)",), ("('A,B')",), ("('A', 'B')",), ("()",)], "v string")
    got = [r[0] for r in df.select(casts.parse_list_string("v")).collect()]
    assert got == [None, ["AB"], None, ["A", "B"], []]


def test_sums_stay_exact(spark):
    bill = "987654321098765.43"
    df = spark.createDataFrame([("b", D(bill))] * 1000, "branch_id string, total_bill decimal(18,2)")
    (r,) = A.revenue_by_branch(df).collect()
    assert r.total_revenue == D(bill) * 1000 and r.avg_bill == D(bill)
    neg = spark.createDataFrame([("b", D("-0.01")), ("b", D("0.00"))], "branch_id string, total_bill decimal(18,2)")
    assert A.revenue_by_branch(neg).collect()[0].avg_bill == D("-0.01")


def _csv(spark, text, name="t.csv"):
    folder = local_fs_path(shared_path(spark, "tests", "csv"))
    os.makedirs(folder)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return f"{folder}/{name}"


def test_short_rows_are_filled_and_long_rows_fail(spark):
    short = read_raw_csv(spark, _csv(spark, "a,b\n1\n2,3\n"))
    assert [(r.a, r.b) for r in short.collect()] == [("1", None), ("2", "3")]
    long = read_raw_csv(spark, _csv(spark, "a,b\n1,2\n3,4,5\n"))
    for df in (long, long.select("a"), long.agg(F.count(F.lit(1)))):
        with pytest.raises(Exception, match="more fields than the header"):
            df.collect()


def test_quoted_newlines(spark):
    path = _csv(spark, 'a,b\n"x\ny",2\n')
    assert [r.a for r in read_raw_csv(spark, path, multiline=True).collect()] == ["x\ny"]


def test_a_table_without_rows_is_readable(spark):
    root = shared_path(spark, "tests", "empty")
    df = spark.createDataFrame([], "a int, load_status string")
    w = sinks.write_table(spark, df, root, "t", partition_by=["load_status"])
    assert spark.read.parquet(w.path).columns == ["a", "load_status"]
    (r,) = sinks.load_count_audit(spark, [w], loaded="load_status = 'ok'").collect()
    assert (r.rows_written, r.rows_read, r.rows_loaded, r.rows_rejected, r.ok) == (0, 0, 0, 0, True)


def test_publishing_switches_a_pointer(spark):
    root = shared_path(spark, "tests", "publish")
    paths = [sinks.write_table(spark, spark.range(n), root, "t").path for n in (1, 2, 3)]
    assert sinks.table_path(spark, root, "t") == paths[2]
    assert spark.read.parquet(paths[2]).count() == 3
    # the version before stays for readers that have begun, older ones go
    assert [sinks.path_exists(spark, p) for p in paths] == [False, True, True]
    # a version that was written but not published changes nothing
    sinks.write_counted(spark.range(9), f"{root}/t/v_unpublished")
    assert sinks.table_path(spark, root, "t") == paths[2]
    assert sinks.table_path(spark, root, "absent") is None
    broken = sinks.Written("gone", f"{root}/gone", 4)
    (r,) = sinks.load_count_audit(spark, [broken]).collect()
    assert (r.rows_read, r.ok) == (None, False)


def test_numbers_out_of_range_are_no_ids(spark):
    texts = ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
             "9223372036854775807.9", "9223372036854775808.1", "1.99999999999999", "-0.5", ".5", "1e30", "5.", "+3"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    top, low = 2**63 - 1, -2**63
    got = [r[0] for r in df.select(casts.bigint_from_text("v")).collect()]
    assert got == [top, None, low, None, top, None, 1, 0, 0, None, 5, 3]


def test_large_maxima_keep_every_digit(spark):
    df = spark.createDataFrame([(2**53 + 1, str(2**53 + 1)), (3, "7")], "a bigint, b string")
    got = {r.column_name: r.max_value for r in P.profile_int_range(df, "t").collect()}
    assert got == {"a": "9007199254740993"}
    rows = TableProfile(df, "t").int_range().long().collect()
    assert {r.column_name: r.value for r in rows if r.metric == "max_value"} == {
        "a": "9007199254740993", "b": "9007199254740993"}
    far = spark.createDataFrame([("1e40",), ("5",)], "b string")
    rows = TableProfile(far, "t").int_range().long().collect()
    assert {r.metric: r.value for r in rows} == {"max_value": "1.0E40", "needs_bigint": "true"}


def test_text_keys_keep_digits_and_leading_zeros(spark):
    parent = spark.createDataFrame([(5,), (7,), (10000000,)], "k bigint")
    text = spark.createDataFrame([("5.00000000001",), ("007",), ("7.00",), ("-0",), ("+5",)], "k string")
    real = spark.createDataFrame([(1e7,), (5.00000000001,)], "k double")
    got = {(r.label, r.orphan) for r in fk_orphans([ForeignKey("t", text, "k", parent, "k"),
                                                     ForeignKey("r", real, "k", parent, "k")]).collect()}
    assert got == {("t", "5.00000000001"), ("t", "007"), ("t", "0"), ("t", "+5"), ("r", "5.00000000001")}

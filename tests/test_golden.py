"""Hand-computed expectations for the dirty cases of FIXTURES.md section 2."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dq_mart.functions import (bigint_or_zero, normalize_header, null_tokens,
                               parse_list_string, pct_half_up, report_number,
                               to_date_safe, yes_no)
from dq_mart.operators import analytics as A
from dq_mart.operators import cleaning as C
from dq_mart.operators import integrity as I
from dq_mart.operators import profiling as P
from dq_mart.operators.conform import (ColumnSpec, TableSpec, conform, good_rows,
                                       rejected_rows)


def col1(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def run(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_header_normalisation():
    assert normalize_header("Sl. No.") == "Sl_No"
    assert normalize_header("No. of OTs") == "No_of_OTs"
    assert normalize_header("Surgery Duration (hours)") == "Surgery_Duration_hours"
    assert normalize_header("Out-of-Pocket Expenses") == "Out_of_Pocket_Expenses"
    assert normalize_header(" A  b ") == "A_b"


def test_header_collision_fails(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(C.ColumnCollision):
        C.clean_headers(df)


def test_null_tokens(spark):
    df = col1(spark, ["None", "NA", "null", "", "none", "  ", "x"])
    assert run(df, null_tokens("v")) == [None, None, None, None, "none", "  ", "x"]


def test_yes_no(spark):
    vals = ["Yes ", " no ", "TRUE", "1", None, "NO", "\tyes", "maybe", "on", "y"]
    df = col1(spark, vals)
    assert run(df, yes_no("v")) == [True, False, True, True, False, False, True, False,
                                    False, False]


def test_dates(spark):
    df = col1(spark, ["2024-01-02", "not-a-date", "2024-13-45", None])
    assert run(df, to_date_safe("v")) == [dt.date(2024, 1, 2), None, None, None]
    prof = P.profile_dates(df, "t", ["v"]).collect()[0]
    assert prof.bad_count == 3 and prof.min_date is None


def test_bigint_default0(spark):
    df = col1(spark, ["12", "12.7", "x", None, " 5 ", "9007199254740993", "3000000000"])
    assert run(df, bigint_or_zero("v")) == [12, 12, 0, 0, 5, 9007199254740993, 3000000000]


def test_money_and_length_rejects(spark):
    spec = TableSpec("t", (ColumnSpec("amount", "decimal(10,2)"), ColumnSpec("code", "string", 10)))
    df = spark.createDataFrame([("2.345", "short"), ("99999999.99", "x"),
                                ("123456789.00", "y"), ("1.00", "elevenchars")],
                               "amount string, code string")
    c = conform(df, spec)
    good = sorted((r.amount, r.code) for r in good_rows(c).collect())
    assert good == [(Decimal("2.35"), "short"), (Decimal("99999999.99"), "x")]
    rej = sorted(r.reasons for r in rejected_rows(c).collect())
    assert rej == ["amount: not a valid decimal(10,2)", "code: longer than 10"]


LIST_CASES = [
    ("['A', 'B ']", ["A", "B"]), ("[]", []), ("['A',]", ["A"]), ('["A"]', ["A"]),
    ("('A','B')", ["A", "B"]), ("{'A'}", ["A"]), ("['O\\'x']", ["O'x"]),
    ("[A]", None), ("oops", None), ("", None), (None, None), ("'AB'", None),
]


def test_list_strings(spark):
    df = col1(spark, [v for v, _ in LIST_CASES])
    got = run(df, parse_list_string("v"))
    for (raw, want), g in zip(LIST_CASES, got):
        assert (None if g is None else [x.strip() for x in g]) == want, raw


def test_bridge_explode_dedups_pairs(spark):
    df = spark.createDataFrame([("D1", "['A','A ']"), ("D2", "oops"), ("D3", None),
                                ("D4", "['B', 'C']")], "id string, l string")
    got = sorted(tuple(r) for r in C.explode_list_pairs(df, "id", "l").collect())
    assert got == [("D1", "A"), ("D4", "B"), ("D4", "C")]
    prof = P.profile_list_column(df, "l").collect()[0]
    assert (prof.total_rows, prof.parse_errors, prof.pairs, prof.distinct_items) == (4, 2, 4, 3)


def test_keep_first_in_file_order(spark):
    df = spark.createDataFrame([("K1", 3, "late"), ("K1", 1, "first"), (None, 5, "n2"),
                                (None, 2, "n1"), ("K2", 4, "only")], "k string, ord int, v string")
    got = sorted((r.k or "", r.v) for r in C.dedup_keep_first(df, ["k"], "ord").collect())
    assert got == [("", "n1"), ("K1", "first"), ("K2", "only")]


def test_fk_null_semantics(spark):
    child = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    parent_no_null = spark.createDataFrame([("a",)], "k string")
    parent_null = spark.createDataFrame([("a",), (None,)], "k string")
    o1 = sorted(str(r.k) for r in I.orphan_keys(child, "k", parent_no_null, "k").collect())
    o2 = sorted(str(r.k) for r in I.orphan_keys(child, "k", parent_null, "k").collect())
    assert o1 == ["None", "zz"] and o2 == ["zz"]
    row = I.fk_check(I.ForeignKey("c->p", child, "k", parent_no_null, "k")).collect()[0]
    assert (row.child_ids, row.orphans, row.examples) == (3, 2, "NULL, zz")


def test_mismatch_null_regimes(spark):
    df = spark.createDataFrame([("a", "a"), (None, None), (None, "b"), ("a", "b")],
                               "r string, c string")
    assert P.profile_mismatch(df, "r", "c").collect()[0].mismatches == 3
    sub = A.substitution_by_branch(df.withColumn("branch_id", F.lit("B")), "branch_id", "r", "c")
    assert sub.collect()[0].substitutions == 1


def test_yes_no_audit(spark):
    df = spark.createDataFrame([("yes", "Yes", "yes"), ("No", " no", None),
                                ("yes", "no", "true")], "a string, b string, c string")
    rows = {r.column_name: r for r in P.profile_yes_no(df, "t", ["a", "b", "c"]).collect()}
    assert (rows["a"].yes_count, rows["a"].no_count, rows["a"].unexpected_count) == (2, 1, 0)
    # ' no' passes the domain test but is not counted (no trim in the count)
    assert (rows["b"].yes_count, rows["b"].no_count) == (1, 1)
    assert rows["c"].yes_count is None and rows["c"].unexpected_count == 2


def test_claim_status_null_insurer(spark):
    bill = spark.createDataFrame([("I1", "Approved"), ("I1", "Rejected"), ("I2", None),
                                  ("I2", None)], "insurance_provider string, claim_status string")
    a = {r.insurance_provider: r for r in A.claim_status_rate(bill).collect()}
    b = {r.insurance_provider: r for r in A.claim_status(bill).collect()}
    assert a["I2"].total_claims == 0 and a["I2"].approved_rate_pct is None
    assert a["I1"].approved_rate_pct == 50.0
    assert b["I2"].total_claims == 2


def test_substitution_shared_location_and_orphan(spark):
    appts = spark.createDataFrame([(1, "B1", "d1", "d2"), (2, "B2", "d1", "d1"),
                                   (3, "B9", "d1", "d2")],
                                  "serial_no int, branch_id string, requested_doctor_id string, "
                                  "consulted_doctor_id string")
    branches = spark.createDataFrame([("B1", "Pune"), ("B2", "Pune")], "branch_id string, location string")
    rows = A.substitution_rate(appts, branches).collect()
    assert [(r.branch_name, r.total_appointments, r.substituted_appointments,
             r.substitution_rate_pct) for r in rows] == [("Pune", 2, 1, 50.0)]


def test_top_k_ties_break_by_key(spark):
    df = spark.createDataFrame([(d,) for d in ["b", "a", "c", "c"]], "diagnosis string")
    assert [r.diagnosis for r in A.top_diagnoses(df, k=2).collect()] == ["c", "a"]


def test_percent_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 5), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(pct_half_up("n", "d", 2)).collect()]
    assert got == [12.5, 33.33, 66.67, 0.0, None]
    got1 = [r[0] for r in spark.createDataFrame([(1, 16)], "n long, d long")
            .select(pct_half_up("n", "d", 1)).collect()]
    assert got1 == [6.3]  # 6.25 rounds half up


def test_report_number_format(spark):
    df = spark.createDataFrame([(757703674.73,), (12.5,), (12.0,), (0.05,), (100.1,)], "x double")
    assert [r[0] for r in df.select(report_number("x")).collect()] == \
        ["757703674.73", "12.5", "12.0", "0.05", "100.1"]


def test_categorical_missing_column(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    rows = P.profile_categorical(df, "t", ["v", "Anesthesia Type"]).collect()
    got = sorted((r.column_name, r.value, r.cnt, r.pct, r.status) for r in rows
                 if r.status == "ok")
    assert got == [("v", "a", 2, 66.7, "ok")]
    assert [r.column_name for r in rows if r.status == "missing"] == ["Anesthesia Type"]


def test_nulls_count_blanks(spark):
    df = spark.createDataFrame([(None, 1.0), ("  ", float("nan")), ("\t", 2.0), ("x", None)],
                               "s string, d double")
    rows = {r.column_name: (r.null_count, r.pct) for r in P.profile_nulls(df, "t").collect()}
    assert rows == {"s": (3, 75.0), "d": (2, 50.0)}


def test_csv_reader_dialect_and_ordinal(spark):
    import os

    from dq_mart.session import local_fs_path, shared_path
    from dq_mart.sources.csv import ORDINAL, read_raw_csv

    base = local_fs_path(shared_path(spark, "tests", "csv"))
    os.makedirs(base, exist_ok=True)
    with open(os.path.join(base, "a.csv"), "w", encoding="utf-8") as f:
        f.write('﻿Sl. No.,Name,Note\n1,"Doe, ""J""",None\n2,x,\n3,y,  \n')
    df = read_raw_csv(spark, os.path.join(base, "a.csv"))
    assert df.columns == ["Sl. No.", "Name", "Note", ORDINAL]
    rows = df.orderBy(ORDINAL).collect()
    assert [r["Sl. No."] for r in rows] == ["1", "2", "3"]
    assert rows[0]["Name"] == 'Doe, "J"' and rows[0]["Note"] is None
    assert rows[1]["Note"] is None and rows[2]["Note"] == "  "

    with open(os.path.join(base, "bad.csv"), "w", encoding="utf-8") as f:
        f.write("a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, os.path.join(base, "bad.csv")).collect()

"""The report's sections from kept monthly partials."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dq_mart.operators import analytics as A
from dq_mart.plans import monthly as M
from dq_mart.session import scratch_path

SCHEMA = "branch_id string, date_of_consultation date, diagnosis string, requested_doctor_id int, consulted_doctor_id int"


@pytest.fixture()
def fact(spark):
    return M.appointments_fact()


def some_rows(n, months, seed):
    r = random.Random(seed)
    return [(r.choice(["A", "B", None]), r.choice([dt.date(2024, r.choice(months), r.randint(1, 28)), None]),
             r.choice(["flu", "cold", None]), r.choice([1, 2, None]), r.choice([1, 2])) for _ in range(n)]


def sections(p):
    return [sorted(map(str, s.collect())) for s in (
        M.visits_by_branch(p).select("branch_id", "month", "visit_count"), M.top_diagnoses(p), M.substitutions(p))]


def direct(df):
    a = df.withColumnRenamed("date_of_consultation", "d")
    visits = a.groupBy("branch_id", A.month_of("d").alias("month")).agg(F.count("*").alias("visit_count"))
    subst = a.groupBy("branch_id").agg(F.count("*").alias("total_appointments"), A._cnt_when(
        A._substituted("requested_doctor_id", "consulted_doctor_id")).alias("substitutions"))
    return [sorted(map(str, s.collect())) for s in (visits, A.top_diagnoses(df), subst)]


def test_only_changed_months_are_computed(spark, fact):
    root = scratch_path(spark, "tests", "monthly")
    first = spark.createDataFrame(some_rows(300, [1, 2, 3], 1), SCHEMA)
    M.replace_months(first, root, fact)
    assert M.refresh(spark, root, fact) == ["2024-01", "2024-02", "2024-03", M.UNDATED]
    assert sections(M.partials(spark, root, fact)) == direct(first)
    assert M.refresh(spark, root, fact) == []
    # March comes again, April is new, January goes
    dated = [r for r in some_rows(200, [3, 4], 2) if r[1]]
    late = spark.createDataFrame(dated, SCHEMA)
    M.replace_months(late, root, fact)
    M.drop_month(spark, root, fact, "2024-01")
    assert M.refresh(spark, root, fact) == ["2024-03", "2024-04"]
    kept = first.where("date_of_consultation is null or month(date_of_consultation) = 2").unionByName(late)
    assert sections(M.partials(spark, root, fact)) == direct(kept)


def test_a_run_killed_between_months_is_made_good(spark, fact, monkeypatch):
    root = scratch_path(spark, "tests", "monthly")
    df = spark.createDataFrame([r for r in some_rows(100, [1, 2], 3) if r[1]], SCHEMA)
    M.replace_months(df, root, fact)
    real = M.fingerprints
    # as if only January had been written
    monkeypatch.setattr(M, "fingerprints", lambda *a: {k: v for k, v in real(*a).items() if k == "2024-01"})
    assert M.refresh(spark, root, fact) == ["2024-01"]
    monkeypatch.undo()
    assert M.refresh(spark, root, fact) == ["2024-02"]
    assert sections(M.partials(spark, root, fact)) == direct(df)


def test_nothing_stored(spark, fact):
    root = scratch_path(spark, "tests", "monthly")
    assert M.refresh(spark, root, fact) == []
    with pytest.raises(FileNotFoundError):
        M.partials(spark, root, fact)


def test_outcomes_by_doctor(spark):
    root = scratch_path(spark, "tests", "monthly")
    fact = M.surgeries_fact()
    r = random.Random(4)
    df = spark.createDataFrame([(r.randrange(30), r.choice([A.SUCCESSFUL, A.FAILED, "x", None]), dt.date(2024, r.randint(1, 5), 1))
                                for _ in range(400)], "doctor_id int, surgery_outcome string, surgery_date date")
    M.replace_months(df, root, fact)
    M.refresh(spark, root, fact)
    got = M.surgery_outcomes(M.partials(spark, root, fact)).collect()
    assert list(map(tuple, got)) == list(map(tuple, A.surgery_outcomes(df).collect()))

"""One commit for all tables of a refresh, gated by its audit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dq_mart.plans import jobs as J
from dq_mart.plans import schemas as S
from dq_mart.session import scratch_path
from dq_mart.sources import snapshots as N


@pytest.fixture()
def root(spark):
    return scratch_path(spark, "tests", "snapshots")


def stage(spark, root, n, tables=("a", "b")):
    return [N.stage_table(spark.range(n).withColumn("t", F.lit(t)), root, t) for t in tables]


def put(spark, root, base, staged):
    return N.commit(spark, root, base, {s.table: s.version for s in staged}, {s.table: s.rows for s in staged})


def test_staged_versions_are_invisible_until_committed(spark, root):
    empty = N.read_snapshot(spark, root)
    assert (empty.number, dict(empty.tables)) == (0, {})
    staged = stage(spark, root, 3)
    assert N.read_snapshot(spark, root) == empty
    with pytest.raises(FileNotFoundError):
        N.snapshot_table(spark, root, "a")
    first = put(spark, root, empty, staged)
    assert first == N.read_snapshot(spark, root) and first.number == 1 and first.rows == {"a": 3, "b": 3}
    held = N.snapshot_table(spark, root, "a", first)
    put(spark, root, first, stage(spark, root, 5))
    # a reader of the first snapshot keeps it, for all tables
    assert held.count() == 3 and N.snapshot_table(spark, root, "b", first).count() == 3
    assert N.snapshot_table(spark, root, "b").count() == 5
    assert N.read_snapshot(spark, root, 1) == first


def test_of_two_runs_from_one_snapshot_the_second_fails(spark, root):
    base = put(spark, root, N.read_snapshot(spark, root), stage(spark, root, 1))
    mine, other = stage(spark, root, 2), stage(spark, root, 4)
    put(spark, root, base, other)
    with pytest.raises(N.SnapshotConflict):
        put(spark, root, base, mine)
    assert N.snapshot_table(spark, root, "a").count() == 4


def test_vacuum_keeps_what_the_last_snapshots_name(spark, root):
    for n in (1, 2, 3):
        put(spark, root, N.read_snapshot(spark, root), stage(spark, root, n))
    assert N.vacuum(spark, root, keep=2) == 2
    assert N.snapshot_table(spark, root, "a").count() == 3
    assert N.snapshot_table(spark, root, "a", N.read_snapshot(spark, root, 2)).count() == 2


def test_metrics_are_counted_on_the_write(spark, root):
    df = spark.range(10).withColumn("odd", (F.col("id") % 2).cast("bigint"))
    got = N.stage_table(df, root, "t", metrics={"odds": F.sum("odd")}, drop=["odd"])
    assert (got.rows, got.metrics) == (10, {"odds": 5})
    assert spark.read.parquet(got.path).columns == ["id"]
    none = N.stage_table(df.where("id < 0"), root, "e", ["id"], {"odds": F.coalesce(F.sum("odd"), F.lit(0))})
    assert (none.rows, none.metrics) == (0, {"odds": 0}) and spark.read.parquet(none.path).count() == 0


def raw_tables(spark, n):
    branches = spark.createDataFrame(
        [(str(i), f"B{i}", "x", "Yes", i) for i in range(n)],
        "`Sl. No.` string, `Branch ID` string, Location string, `OT_Available` string, ingest_ord int")
    billing = spark.createDataFrame(
        [(str(i), "x" if i == 0 else str(i), "7", "1.50") for i in range(n)],
        "`Sl. No.` string, `Claim ID` string, `Case ID` string, `Total Bill` string")
    return {"branches": branches, "billing": billing}


def test_a_job_that_fails_between_tables_changes_none(spark, root, monkeypatch):
    audit = {r.table_name: r for r in J.etl_job(spark, raw_tables(spark, 2), root).collect()}
    assert audit["billing"].zero_ids == 1 and audit["branches"].zero_ids is None
    whole, real = N.read_snapshot(spark, root), J.stage_loaded

    def breaks(raw, spec, out):
        if spec.name == "billing":
            raise RuntimeError("executor lost")
        return real(raw, spec, out)
    monkeypatch.setattr(J, "stage_loaded", breaks)
    with pytest.raises(RuntimeError):
        J.etl_job(spark, raw_tables(spark, 5), root)
    assert N.read_snapshot(spark, root) == whole
    assert {n: J.read_loaded(spark, root, n).count() for n in whole.tables} == {"branches": 2, "billing": 2}


def test_a_false_audit_commits_nothing(spark, root, monkeypatch):
    J.etl_job(spark, raw_tables(spark, 2), root)
    real = J.stage_loaded

    def miscounts(raw, spec, out):
        s = real(raw, spec, out)
        return N.Staged(s.table, s.path, s.rows + (spec.name == "billing"), s.version, s.metrics)
    monkeypatch.setattr(J, "stage_loaded", miscounts)
    with pytest.raises(J.AuditFailed) as e:
        J.etl_job(spark, raw_tables(spark, 3), root)
    assert [r["table_name"] for r in e.value.audit if not r["ok"]] == ["billing"]
    assert N.read_snapshot(spark, root).number == 1 and J.read_loaded(spark, root, "billing").count() == 2


def test_a_raw_table_is_scanned_once(spark, root):
    """Counters ride on the one plan that is written."""
    spec = S.SPECS["billing"]
    raw = raw_tables(spark, 3)["billing"]
    raw.write.parquet(f"{root}/src")
    raw = spark.read.parquet(f"{root}/src")
    rows = J.etl_table(raw.withColumns({"etl_zero_ids": J.coercion_counters(raw, spec)["zero_ids"]}), spec,
                       ["etl_zero_ids"])
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert J.stage_loaded(raw, spec, root).metrics == {"zero_ids": 1}


def test_counters_include_rows_that_keep_first_drops(spark, root):
    doctors = spark.createDataFrame(
        [("1", "D1", "oops", 1), ("2", "D1", "nope", 2), ("3", "D2", "['B1']", 3)],
        f"`Sl. No.` string, `Doctor ID` string, `{S.DOCTOR_LIST_COLUMN}` string, ingest_ord int")
    got = J.stage_loaded(doctors, S.SPECS["doctors"], root)
    assert (got.rows, got.metrics) == (2, {"list_errors": 2})

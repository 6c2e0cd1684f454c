"""Referential checks from bucketed key tables."""

from __future__ import annotations

import pytest

from dq_mart.operators.integrity import ForeignKey, fk_integrity
from dq_mart.session import scratch_path
from dq_mart.sources.key_tables import (drop_key_tables, flagged_rows, key_integrity, kind_of, open_key_table,
                                        write_key_table, write_key_tables)


@pytest.fixture()
def checks(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    dims = spark.createDataFrame([("a",), ("b",)], "k string")
    fact = spark.createDataFrame([(1, "a", 1), (1, "x", 9), (3, None, 1), (None, "b", None), (3, "a", 2)],
                                 "p int, d string, q bigint")
    return [ForeignKey("p", fact, "p", parent, "k"), ForeignKey("d", fact, "d", dims, "k"),
            ForeignKey("q", fact, "q", parent, "k"), ForeignKey("none", fact.where("p > 99"), "p", parent, "k"),
            ForeignKey("mixed", fact, "p", dims, "k")]


def pairs_of(checks, tables):
    out = {}
    for fk in checks:
        kind = kind_of(fk.child.schema[fk.child_col].dataType, fk.parent.schema[fk.parent_col].dataType)
        out[fk.label] = (tables[(id(fk.child), fk.child_col, kind)], tables[(id(fk.parent), fk.parent_col, kind)])
    return out


def test_same_answer_as_the_plain_checks(spark, checks):
    tables = write_key_tables(checks, scratch_path(spark, "tests", "keys"), buckets=4)
    assert len(tables) == 7                      # the number keys of the parent once
    got = {r.label: r for r in key_integrity(spark, pairs_of(checks, tables)).collect()}
    plain = {r.label: tuple(r) for r in fk_integrity(checks).collect()}
    assert {k: tuple(r)[:4] for k, r in got.items()} == plain
    assert (got["p"].child_rows, got["p"].orphan_rows) == (5, 2)      # 3 twice; null has a parent
    assert (got["d"].orphan_rows, got["q"].orphan_rows, got["none"].child_rows) == (2, 1, 0)


def test_checks_exchange_no_child_rows(spark, checks):
    """Joined bucket by bucket: no exchange, and no sort, below the joins."""
    tables = write_key_tables(checks, scratch_path(spark, "tests", "keys"), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = flagged_rows(spark, pairs_of(checks, tables))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == len(checks) and "Exchange" not in plan, plan


def test_a_key_table_is_read_by_another_session(spark, checks):
    path = scratch_path(spark, "tests", "keys")
    fk = checks[0]
    written = write_key_table(fk.child, fk.child_col, "bigint", f"{path}/c", buckets=4)
    parent = write_key_table(fk.parent, fk.parent_col, "bigint", f"{path}/p", buckets=4)
    drop_key_tables(spark, [written, parent])
    again = [open_key_table(spark, f"{path}/{x}", "bigint", 4) for x in "cp"]
    got = key_integrity(spark, {"p": tuple(again)}).first()
    assert (got.child_ids, got.orphans, got.examples, got.orphan_rows) == (3, 1, "3", 2)


def test_kinds_must_agree(spark, checks):
    path = scratch_path(spark, "tests", "keys")
    a = write_key_table(checks[0].child, "p", "bigint", f"{path}/a", 2)
    b = write_key_table(checks[1].parent, "k", "string", f"{path}/b", 2)
    with pytest.raises(ValueError):
        flagged_rows(spark, {"x": (a, b)})

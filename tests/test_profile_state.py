"""Stored profile states: merging parts equals profiling the whole."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dq_mart.operators.inference import infer_types
from dq_mart.operators.profile_state import (SKETCH_BITS, finish, merge_states, merged_profile,
                                             profile_state)

VALUES = ["1", "2.50", "true", None, " ", "x", "2024-02-29", "9007199254740993", "1e3", "yes", " NO ", "007", "-4"]


def rows_of(df):
    return sorted((tuple(r) for r in df.drop("distinct_estimate").collect()), key=str)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(VALUES), rng.choice(VALUES[:2]), rng.randrange(50), None, rng.choice("abcde"))
            for i in range(400)]
    return spark.createDataFrame(rows, "o int, v string, n string, k bigint, none string, part string")


COLS = ["v", "n", "k", "none"]


def test_merged_parts_equal_the_whole(spark, table):
    whole = finish(merge_states(profile_state(table, "t", "o", COLS)))
    parts = profile_state(table, "t", "o", COLS, F.col("part"))
    assert parts.count() == 5 * len(COLS)
    assert rows_of(finish(merge_states(parts))) == rows_of(whole)
    # in two steps, in another order
    half = merge_states(parts.where("part < 'c'")).unionByName(merge_states(parts.where("part >= 'c'")))
    assert rows_of(finish(merge_states(half))) == rows_of(whole)
    by_part = finish(merge_states(parts, by=["part"]))
    assert by_part.count() == 5 * len(COLS)


def test_types_and_counts_as_the_single_checks(spark, table):
    got = {r.column_name: r for r in finish(merge_states(profile_state(table, "t", "o", COLS))).collect()}
    types = {r.column_name: r for r in infer_types(table.drop("part"), "t", "o").collect()}
    for c in COLS:
        assert (got[c].dtype, got[c].sample, got[c].widest) == (types[c].dtype, types[c].sample, types[c].widest)
    rows = table.collect()
    assert got["v"].rows == 400 and got["v"].missing == sum(r.v is None or not r.v.strip() for r in rows)
    assert got["n"].max_value == "2.500000" and got["k"].max_value == str(max(r.k for r in rows))
    assert got["v"].max_value is None and got["none"].dtype == "void" and got["none"].distinct_estimate == 0
    assert got["k"].needs_bigint is False


def test_a_new_part_is_profiled_alone_and_a_part_again_replaces_its_state(spark, table):
    stored = profile_state(table.where("part <> 'e'"), "t", "o", COLS, F.col("part"))
    new = profile_state(table.where("part = 'e'"), "t", "o", COLS, F.col("part"))
    whole = rows_of(finish(merge_states(profile_state(table, "t", "o", COLS))))
    assert rows_of(finish(merge_states(merged_profile(stored, new)))) == whole
    assert rows_of(finish(merge_states(merged_profile(merged_profile(None, stored), new)))) == whole
    # profiled twice, counted once
    again = merged_profile(merged_profile(stored, new), new)
    assert rows_of(finish(merge_states(again))) == whole


def test_error_of_merged_distinct_counts(spark):
    """Within four standard deviations, merged or not, at every size."""
    bound = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)
    for n in (1, 100, 3000, 60000):
        df = spark.range(3 * n).select(F.col("id").cast("int").alias("o"),
                                       F.concat(F.lit("v"), F.col("id") % n).alias("v"),
                                       (F.col("id") % 7).cast("string").alias("part"))
        states = profile_state(df, "t", "o", ["v"], F.col("part"))
        one = finish(merge_states(profile_state(df, "t", "o", ["v"]))).first().distinct_estimate
        many = finish(merge_states(states)).first().distinct_estimate
        assert abs(one - n) <= bound * n + 0.5 and abs(many - n) <= bound * n + 0.5, (n, one, many)


def test_states_survive_storage_and_empty_tables(spark, table, tmp_path):
    states = profile_state(table, "t", "o", COLS, F.col("part"))
    states.write.parquet(f"{tmp_path}/s")
    assert rows_of(finish(merge_states(spark.read.parquet(f"{tmp_path}/s")))) == rows_of(finish(merge_states(states)))
    none = profile_state(table.where("false"), "t", "o", COLS, F.col("part"))
    assert none.count() == 0 and finish(merge_states(none)).count() == 0

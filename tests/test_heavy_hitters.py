"""Exact top-k against plain counting, on easy and hard distributions."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dq_mart.operators.heavy_hitters import candidates_of, exact_top_k, top_k_state


def brute(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "o int, `a.v` string").repartition(3)


RNG = random.Random(7)
CASES = {
    "skewed": [f"v{int(RNG.paretovariate(0.7)) % 3000}" for _ in range(6000)],
    "flat": [f"v{RNG.randrange(2000)}" for _ in range(4000)],
    "all distinct": [f"v{i:05d}" for i in range(3000)],
    "one value": ["x"] * 500, "ties": [f"v{i % 40}" for i in range(400)],
    "few": ["b", "a", None, "a"], "none": [None, None], "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_top_values(spark, name):
    df = frame(spark, CASES[name])
    # a sketch far too small, and few buckets, still give the exact answer
    for tracked, buckets in ((10_000, 1 << 16), (16, 8)):
        got = [tuple(r) for r in exact_top_k(df, "a.v", 5, tracked=tracked, buckets=buckets).collect()]
        assert got == brute(CASES[name], 5), (tracked, buckets)


def test_states_of_parts_combine(spark):
    values = CASES["skewed"]
    df = frame(spark, values)
    states = top_k_state(df, "a.v", F.col("o") % 4)
    assert states.count() == 4
    found = candidates_of(states, 30)
    assert {v for v, _ in brute(values, 3)} <= {r.value for r in found.collect()}
    assert [tuple(r) for r in exact_top_k(df, "a.v", 8, found).collect()] == brute(values, 8)
    # useless candidates cost work, not results
    wrong = spark.createDataFrame([("nothing",), (None,)], "value string")
    assert [tuple(r) for r in exact_top_k(df, "a.v", 8, wrong).collect()] == brute(values, 8)


def test_proven_without_counting_all_values(spark):
    """Where the candidates win clearly, no exchange by value follows."""
    values = ["hot"] * 2000 + ["warm"] * 1500 + [f"v{i}" for i in range(3000)]
    out = exact_top_k(frame(spark, values), "a.v", 2)
    assert [tuple(r) for r in out.collect()] == [("hot", 2000), ("warm", 1500)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Aggregate" not in plan

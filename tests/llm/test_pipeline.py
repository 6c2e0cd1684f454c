"""The pipeline against brute force, stage by stage, and its defined results."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dq_mart.llm import pii, toxicity
from dq_mart.llm.common import fold_of
from conftest import SF_CHECK
from test_operators import CLASH, EDGE, _components, docs_of


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF_CHECK)
        path = corpus_pipeline.shared_path(spark, "test", name)
        rows.write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_return_the_columns_of_documents(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.count() <= before.count()


def test_toxicity_stage(spark, stages):
    before, after = map(_texts, stages[0])
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    index = toxicity.fit(stages[0][0], labels.where(fold_of("doc_id") != 0))
    assert set(after) == {i for i, t in before.items() if index.score(t)[0] < 0.5}
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()} & set(before)
    assert len(clean & set(after)) >= 0.98 * len(clean)


def test_near_duplicate_stage(stages):
    before, after = map(_texts, stages[1])
    want = _components(sorted(before.items()), 5, 80)
    assert set(after) == {i for i, (_, c) in want.items() if c == i}


def test_decontamination_stage(spark, stages):
    before, after = map(_texts, stages[2])
    items = [r["text"] for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    holds = {i for i, t in before.items() if any(x in t for x in items)}
    assert holds and not holds & set(after)
    words = lambda t: re.findall(r"\w+", t.lower())
    quads = [{tuple(w[i:i + 4]) for i in range(len(w) - 3)} for w in map(words, items)]
    for i in set(before) - set(after) - holds:        # the others hold most of an item
        w = words(before[i])
        own = {tuple(w[j:j + 4]) for j in range(len(w) - 3)}
        assert max(len(own & q) / len(q) for q in quads) > 0.3


def test_pii_stage(stages):
    before, after = map(_texts, stages[3])
    assert set(before) == set(after)
    assert all(not pii.base_spans(t) for t in after.values())
    assert any("[EMAIL]" in t for t in after.values())
    for i, t in before.items():
        if not re.search(r"[0-9@]| at |\(at", t):
            assert after[i] == t
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3][1].collect())


def test_packing_stage(stages):
    docs, rows = stages[4]
    total = {r["doc_id"]: r["doc_tokens"] for r in rows.collect()}
    got = {r["doc_id"]: r["n"] for r in rows.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == total and set(total) == set(_texts(docs))


def test_defined_results(spark):
    docs = docs_of(spark, [*EDGE, (7, "x y z"), (7, "x y z")])
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, SF_CHECK)
        assert out.columns == docs.columns
        rows = out.collect()
        assert sum(r["doc_id"] is None for r in rows) == 2
        assert sum(r["doc_id"] == 4 for r in rows) == (1 if n == 1 else 2)
        assert sum(r["doc_id"] == 1 and r["text"] is None for r in rows) == 1
        assert all(r[c] == "x" for r in rows for c in CLASH)
        assert stage(spark, docs.limit(0), SF_CHECK).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_CHECK).count() >= len(EDGE)

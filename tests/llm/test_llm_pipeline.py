"""The registered queries of the subpackage against their SQL, and the pipeline stage by stage."""

import os
import re

import oracle
import pytest
from llm_cases import UP, near_components

import corpus_pipeline
from foliograph.llm.queries import ORACLES, QUERIES

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    problems, n = oracle.compare(QUERIES[name](spark, DIRECTORY), oracle.connect(DIRECTORY), ORACLES[name])
    assert not problems, problems
    assert n > 0


def test_all_queries():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    columns, seen = docs.columns, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, DIRECTORY).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        seen.append((before, docs))
    text = [{r.doc_id: r.text for r in b.collect()} for b, _ in seen]
    assert all(a.columns == columns for _, a in seen[:4])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIRECTORY}/labels.parquet").collect()}
    low = [i for i in text[0] if i not in text[1] and i in labels]
    assert sum(labels[i] == 0 for i in low) >= 0.9 * len(low)
    assert len([i for i in text[1] if labels.get(i) == 1]) >= 0.97 * len([i for i in text[0] if labels.get(i) == 1])
    last = {}
    for i, t in text[1].items():
        last[(t or "").translate(UP)] = max(i, last.get((t or "").translate(UP), -1))
    assert set(text[2]) == set(last.values())
    want = near_components([(i, t) for i, t in text[2].items()], shingle=corpus_pipeline.STAGE_SHINGLE)
    assert set(text[3]) == {c for _, c in want.values()}
    assert set(text[4]) == set(text[3])
    for r in seen[3][1].collect():
        assert r.n_chars == len(r.text)
        for m in re.findall(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}", text[3][r.doc_id]):
            assert m not in r.text
    assert {r.doc_id for r in seen[4][1].collect()} == set(text[4])


def test_run_and_empty(spark, tmp_path):
    columns = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    columns.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{DIRECTORY}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

"""The pipeline: each stage against its operator, on the smallest tables and on awkward rows."""

from __future__ import annotations

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = corpus_pipeline.load(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}


def test_result(spark, stages):
    last, ids = stages[-1].collect(), {r[0] for r in stages[-2].select("doc_id").collect()}
    assert {r["doc_id"] for r in last} == ids and len(ids) > 100
    run = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, last))


def test_awkward_rows_pass_every_stage(spark):
    rows = [(None, None, "x", 1), (1, None, "x", 1), (2, "", "x", 1), (3, "word " * 30_000, "x", 1), (4, "a b c d e f g", "x", 1), (4, "a b c d e f g", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, label int")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 4, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name

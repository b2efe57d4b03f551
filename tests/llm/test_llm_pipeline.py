"""Every stage of the pipeline on its own input, against brute force or its operator's exact parts."""

import importlib.util
import os

import pytest
from llm_cases import documents, tables
from test_llm_near_dedup import brute as brute_groups
from test_llm_substring import brute as brute_cut

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline():
    spec = importlib.util.spec_from_file_location("corpus_pipeline", f"{ROOT}/corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_stages_and_their_columns(spark, pipeline, tmp_path):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "substring_dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        if name == "near_dedup":
            groups = brute_groups(list(before.items()), 5, 80)
            assert set(after) == {i for i, g in groups.items() if g[2]}
        elif name == "substring_dedup":
            ids = list(before)
            want = {i: (before[i] if not cut[1] else cut[2]) for i, cut in zip(ids, brute_cut([before[i] for i in ids], 35))}
            assert after == want
        else:
            assert all(after[i] == before[i] for i in after)
        before = after
    packed = pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(before)


def test_odd_rows_pass_every_stage(spark, pipeline, tmp_path):
    folder = tables(spark, tmp_path, labels=[(1, 1, 0), (6, 1, 0), (5, 1, 0)])
    docs = documents(spark)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        docs = pipeline.store(out, "stage")
    assert docs.count() >= 1
    assert pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()


def test_no_rows(spark, pipeline, tmp_path):
    folder = tables(spark, tmp_path, rows=[])
    assert pipeline.run(spark, folder).count() == 0

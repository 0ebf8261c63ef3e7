"""The pipeline and the registered queries on small tables."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from candlewick.llm import registry
from tests.llm.tables import SCHEMA, documents
from tests.parity import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    documents(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_awkward_rows_pass_all_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")], name
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count() > 0


def test_last_stage_encodes_and_decodes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert Counter((r.doc_id, r.decoded) for r in rows) == Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert all(bool(r.ids) == bool(r.decoded) for r in rows)


def test_empty_tables_pass_all_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_queries_are_registered():
    assert {name.split("_")[0] for name in registry.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(registry.queries()) | {"pipeline"} <= set(contract.queries())


def test_top_k_against_its_statement(spark):
    count, problem = differences(registry.queries()["op9_nearest"](spark, SF_DIR), duck(SF_DIR), registry.statements()["op9_nearest"])
    assert not problem and count > 0

"""The stages one after the other against their plain versions, and the queries with SQL."""

import os

import pytest
from tests.llm.test_texts import brute_components, brute_contamination
from tests.llm.test_tokens import check_packing

import corpus_pipeline
from ledgerloom.llm import packing, quality_rules
from ledgerloom.llm.queries import BYTE_TOKENIZER, ORACLE_SQL, QUERIES
from verification.compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    ok, message = compare(spark, connect(SF_DIR), SF_DIR, name, QUERIES[name], ORACLE_SQL[name])
    assert ok, message


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "packing"]
    good = stages["quality"](spark, docs, SF_DIR)
    model = quality_rules.fit(docs, labels)
    keep = {r.doc_id for r in quality_rules.scored(docs, model).where("score >= 0.5").collect()}
    rows = [r for r in rows if r[0] in keep]
    assert good.columns == docs.columns and sorted((r.doc_id, r.text) for r in good.collect()) == sorted(rows)
    single = stages["near_duplicates"](spark, good, SF_DIR)
    keep = {i for i, _, _, stays in brute_components(rows, 5, 80) if stays}
    rows = [r for r in rows if r[0] in keep]
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(r[0] for r in rows)
    clean = stages["decontamination"](spark, single, SF_DIR)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    keep = {i for i, _, _, _, bad in brute_contamination(rows, items) if not bad}
    rows = [r for r in rows if r[0] in keep]
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in rows)
    check_packing(rows, packing.pack(clean, BYTE_TOKENIZER).collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {r[0] for r in rows}

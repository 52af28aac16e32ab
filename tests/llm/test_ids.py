"""Ids beyond 2**53 stay what they are, also beside a null id."""

import public_tokenizers
from pyspark.sql import functions as F

from ledgerloom.llm import binary_output, html_extraction, packing, token_counts

IDS = [None, 2**53 + 1, 2**53 + 3, 2**60 + 1, 2**60 + 7, -(2**60) - 1, 5, None]
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def sorted_ids(values):
    return sorted(values, key=str)


def test_ids_of_token_counts_packing_and_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {k} of some words") for k, i in enumerate(IDS)], "doc_id long, text string").coalesce(1)
    docs = docs.withColumn("other", F.col("doc_id"))
    trees = token_counts.with_trees(docs, BYTES)
    assert sorted_ids(r.other for r in trees.collect()) == sorted_ids(IDS)
    edited = trees.withColumn("edits", token_counts.redactions(F.col("text")))
    assert sorted_ids(r.doc_id for r in token_counts.count_after_edits(edited, BYTES).collect()) == sorted_ids(IDS)
    assert sorted_ids({r.doc_id for r in packing.pack(docs, BYTES).collect()}) == sorted_ids(set(IDS))
    frames = binary_output.write_token_files(docs, str(tmp_path / "files"), public_tokenizers.path("word_bpe_49k.json"))
    assert {r.last_doc_id for r in frames.collect()} <= set(IDS)
    assert sorted_ids(r.doc_id for r in binary_output.read_token_files(spark, str(tmp_path / "files")).collect()) == sorted_ids(IDS)


def test_ids_of_pages(spark):
    rows = [(i, "http://a.b/c", f"<article><p>Page {k} has a text of its own.</p></article>") for k, i in enumerate(IDS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert sorted_ids(r.page_id for r in html_extraction.extract(pages).collect()) == sorted_ids(IDS)

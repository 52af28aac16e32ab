"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    binary_output,
    decontamination,
    html_extraction,
    lexical_search,
    license_scan,
    near_duplicates,
    oracle_sql,
    packing,
    periodic_runs,
    prefix_tree_join,
    quality_rules,
    token_counts,
    url_filter,
    vector_search,
)
from ledgerloom.llm.common import fresh_path, table

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents before and after personal data is replaced by placeholders."""
    trees = token_counts.with_trees(table(spark, folder, "documents").select("doc_id", "text"), BYTE_TOKENIZER)
    edited = trees.withColumn("edits", token_counts.redactions(F.col("text")))
    return token_counts.count_after_edits(edited, BYTE_TOKENIZER).select(
        "doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_chars", "n_chars_encoded"
    )


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    found = html_extraction.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    return license_scan.scan(table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    return packing.pack(table(spark, folder, "documents"), BYTE_TOKENIZER).drop("ids")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in all documents."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents whose sets of three-word shingles are at least 85 % alike."""
    found = near_duplicates.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)
    return found.drop("text_hash")


def op7_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other vectors for each vector whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings").select("vec_id", vector_search.quantised(F.col("embedding")).alias("vector"))
    return vector_search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return url_filter.judge(table(spark, folder, "pages"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents by a model fit on labelled ones."""
    docs = table(spark, folder, "documents")
    model = quality_rules.fit(docs, table(spark, folder, "labels"))
    scores = quality_rules.scored(docs.select("doc_id", "text"), model)
    return scores.select("doc_id", quality_rules.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_binary_output(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    place = fresh_path(spark, "token-files")
    binary_output.write_token_files(table(spark, folder, "documents"), place, WORD_TOKENIZER)
    return binary_output.read_token_files(spark, place).drop("ids")


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents whose sets of four-word shingles are at least 85 % alike."""
    return prefix_tree_join.similar_sets(table(spark, folder, "documents"), words=4, percent=85)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which are made to repeat a part of themselves."""
    docs = periodic_runs.with_planted_repeats(table(spark, folder, "documents"))
    rows = periodic_runs.periodic_runs(docs)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.array_max(order).alias("longest"), lines.alias("lines"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All documents through the stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_html_extraction": op2_html_extraction,
    "op3_license_scan": op3_license_scan,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_vector_search": op7_vector_search,
    "op8_url_filter": op8_url_filter,
    "op9_quality_rules": op9_quality_rules,
    "op10_binary_output": op10_binary_output,
    "op11_lexical_search": op11_lexical_search,
    "op12_ngram_join": op12_ngram_join,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op5_decontamination": oracle_sql.OP5,
    "op6_near_duplicates": oracle_sql.OP6,
    "op7_vector_search": oracle_sql.OP7,
    "op8_url_filter": oracle_sql.OP8,
    "op11_lexical_search": oracle_sql.OP11,
    "op12_ngram_join": oracle_sql.OP12,
}

"""Passages of a benchmark in training documents, found by word windows; built-in functions only.

1. Every benchmark item is cut into windows of 13 consecutive normalised words; a shorter item is one
   window. Equal windows are kept once, with the items they come from in a table beside them.
2. The hash of the window at each word of every document is looked up in the broadcast hashes of the
   benchmark's windows; a hit counts if its words are equal, not only its hash. A benchmark of more
   than ``WINDOWS_AT_ONCE`` distinct windows is taken in blocks of about that many, each broadcast on
   its own; so what is broadcast has a bound, and no window is left out.
3. Hits of a document are merged to covered words; documents or spans can be removed.

Texts are split into words once, in the scan that looks for windows. Grouping is by document, so a
passage in a third of all documents makes no large group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace, alnum_words
from ledgerloom.llm.grams import find_grams

WINDOW = 13
WINDOWS_AT_ONCE = 200_000

# Words, and what stands between them, in a text that still has its capitals.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item (its id as text) and gram (the words) of each distinct window of each item.

    Items without words have none. Windows of rows with a null id are of no item, but they hit words.
    """
    words = items.select(F.col("item_id").cast("string").alias("item"), alnum_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("gram")).distinct()


def window_hits(docs: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``find_grams`` for the distinct windows of ``benchmark_windows``, stored."""
    space = Workspace(docs.sparkSession, "decontamination")
    grams = space.store(windows.select("gram").distinct(), "grams")
    lengths = sorted(r.n for r in grams.select(F.size("gram").alias("n")).distinct().collect()) or [window]  # at most `window` rows
    blocks = max(1, -(-grams.count() // WINDOWS_AT_ONCE))
    found = None
    for block in range(blocks):
        part = grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == block)
        rows = find_grams(docs, part, lengths)
        if block:
            rows = rows.withColumn("first", F.lit(False))
        found = rows if found is None else found.unionByName(rows)
    return space.store(found, "hits")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items (ids as sorted text), contaminated per row of ``docs``.

    A document is contaminated if words are hit and they are at least one in twenty. Null text has no
    words. Rows with equal or null ids are judged by their own texts. An empty benchmark hits nothing.
    Items with a null id count for n_hit, but not as items.
    """
    windows = Workspace(docs.sparkSession, "benchmark").store(benchmark_windows(items, window), "windows")
    found = window_hits(docs, windows, window)
    key = ["doc_id", "text_hash"]
    totals = found.where("first").select(*key, "n_words")  # one for each row of docs
    hits = found.select(*key, F.explode("hits").alias("hit")).select(*key, "hit.at", "hit.gram")
    spans = F.sort_array(F.collect_set(F.struct("at", (F.col("at") + F.size("gram")).alias("end"))))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("until")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["at"], acc["until"]))).alias("n"),
            F.greatest(acc["until"], s["end"]).alias("until"),
        ),
        lambda acc: acc["n"],
    )
    n_hit = hits.groupBy(*key).agg(spans.alias("spans")).select(*key, covered.cast("long").alias("n_hit"))
    of_item = hits.select(*key, "gram").distinct().join(windows, "gram").groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
        same = left["doc_id"].eqNullSafe(right["__id"]) & (left["text_hash"] == right["__hash"])
        return left.join(right, same, "left").drop("__id", "__hash")

    both = beside(beside(totals, n_hit), of_item)
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_hit = F.coalesce("items", F.array().cast("array<string>"))
    return both.select(
        *key,
        "n_words",
        hit.alias("n_hit"),
        F.size(items_hit).cast("long").alias("n_items"),
        items_hit.alias("items"),
        ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    bad = contamination(docs, items, window).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    own_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("__id")) & (own_hash == F.col("__hash")), "left_anti")


def without_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows of ``docs``; in ``text`` every hit word is gone with what stands between it and the next word."""
    found = window_hits(docs, benchmark_windows(items, window), window).select("doc_id", "text_hash", F.explode("hits").alias("hit"))
    length = F.size("hit.gram").alias("length")
    spans = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("hit.at", length)).alias("__spans"))
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__spans")
    own_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    both = docs.join(spans, docs["doc_id"].eqNullSafe(F.col("__id")) & (own_hash == F.col("__hash")), "left")
    words = F.filter(F.split("text", _BETWEEN), lambda w: w != "")
    between = F.split("text", _WORD)
    hit = lambda i: F.exists("__spans", lambda s: (s["at"] <= i) & (i < s["at"] + s["length"]))
    kept = F.transform("__words", lambda w, i: F.when(hit(i), "").otherwise(F.concat(w, F.get("__between", i + 1))))
    rebuilt = F.concat(F.get("__between", F.lit(0)), F.array_join(kept, ""))
    both = both.withColumns({"__words": words, "__between": between})
    both = both.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(rebuilt))
    return both.select(*docs.columns)

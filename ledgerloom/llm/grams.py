"""Word n-grams of whole texts looked up in a broadcast table, with built-in functions only.

Every word is put beside the ones that follow it by zipping the array of words with itself moved by
one, two, ... places, and the zipped array is exploded; all of it, the hashes and the join run in one
generated loop. No higher-order function sees a word, and the array of words itself is not copied to
the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import alnum_words


def gram_hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def text_hash() -> Column:
    """Tells rows of equal id and different text apart; null counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def find_grams(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """Places of grams in documents: doc_id, text_hash, n_words, first, hits.

    grams: gram (array of words), distinct, few enough to be broadcast; lengths: the lengths that occur.
    There is a row for each word at which a gram begins, with the grams in ``hits`` (structs at, gram),
    and one row with ``first`` true for each row of ``docs``, whether it has hits or not. A hit is one
    whose words are equal, not only the hash.
    """
    width = max(lengths)
    rows = docs.select("doc_id", text_hash().alias("text_hash"), alnum_words(F.col("text")).alias("words"))
    size = F.size("words")
    moved = [F.col("words"), *(F.slice("words", k + 1, size) for k in range(1, width))]
    rows = rows.select("doc_id", "text_hash", size.cast("long").alias("n_words"), F.arrays_zip(*moved).alias("zipped"))
    rows = rows.select("doc_id", "text_hash", "n_words", F.posexplode_outer("zipped").alias("at", "here"))
    names = rows.schema["here"].dataType.names
    words = [F.col("here")[name] for name in names]
    first = F.col("at").isNull() | (F.col("at") == 0)
    hits = []
    for n in lengths:
        own = grams.where(F.size("gram") == n).select(F.col("gram").alias(f"gram_{n}"))
        own = own.withColumn(f"hash_{n}", gram_hash([F.col(f"gram_{n}")[k] for k in range(n)]))
        rows = rows.withColumn(f"hash_{n}", gram_hash(words[:n])).join(F.broadcast(own), f"hash_{n}", "left").drop(f"hash_{n}")
        same = F.array(*words[:n]) == F.col(f"gram_{n}")
        hits.append(F.when(same, F.struct("at", F.col(f"gram_{n}").alias("gram"))))
    any_hit = first
    for n in lengths:
        any_hit = any_hit | F.col(f"gram_{n}").isNotNull()
    rows = rows.where(any_hit)
    found = F.array_compact(F.array(*hits))
    return rows.select("doc_id", "text_hash", "n_words", F.coalesce(first, F.lit(False)).alias("first"), found.alias("hits"))

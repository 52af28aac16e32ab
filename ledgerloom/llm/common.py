"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.tables import run_dir

# Runs of characters that are no word: control characters, ASCII punctuation and white space.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def alnum_words(text: Column) -> Column:
    """Words of ASCII letters and digits and of every character beyond ASCII, lower-cased; null has none."""
    text = F.coalesce(text, F.lit(""))
    # A text of as many bytes as characters is ASCII, for which lower() is the same and much faster.
    lower = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.array_remove(F.split(lower, NOT_ALNUM), "")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


class Workspace:
    """Tables written between the steps of one operator; ``drop`` deletes those no later step reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = fresh_path(spark, label)
        self._n = 0

    def store(self, df: DataFrame, label: str) -> DataFrame:
        self._n += 1
        path = f"{self.folder}/{self._n:03d}-{label}"
        df.write.mode("overwrite").parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        read._stored_path = path
        return read

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = getattr(df, "_stored_path", None)
            if path and path.startswith(self.folder):
                delete_folder(self.spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate from file sizes, 0 if it has none; reads nothing."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 57 else 0  # rows that are in no file count as the largest long each


def partitions_for(df: DataFrame, mb_each: int = 64) -> int:
    """Partitions for a shuffle of ``df``: the session's number, or more if the input is larger."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-estimated_bytes(df) // (mb_each << 20)))


def bounded_chunks[T: (bytes, str)](texts: Iterable[T], most: int = 1 << 19) -> Iterable[tuple[int, list[T]]]:
    """Consecutive texts in chunks of about ``most`` bytes (of str: characters), with the place of the first; a longer text is alone."""
    chunk: list[T] = []
    size = first = place = 0
    for place, text in enumerate(texts):
        if chunk and size + len(text) > most:
            yield first, chunk
            chunk, size, first = [], 0, place
        chunk.append(text)
        size += len(text)
    if chunk:
        yield first, chunk


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2**64 and their inverses, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 19)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers


def word_hashes(chunk: list[bytes], separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, one after the other, and each text's first word in them.

    ``separators`` tells for each byte whether it ends words; A-Z count as a-z. The texts are joined
    by a separator, a running sum of byte times power gives each word's polynomial hash at once.
    """
    glue = bytes([int(np.flatnonzero(separators)[0])])
    lengths = np.fromiter(map(len, chunk), np.int64, len(chunk))
    data = np.frombuffer(glue.join(chunk) + glue, np.uint8)
    starts_of_texts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if chunk else np.zeros(0, np.int64)
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90)).astype(np.uint8)
    outside = separators[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], outside)).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    up, down = _powers_to(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])))
        hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, starts_of_texts)

"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``LEAST_PERIODS`` periods and
``LEAST_WORDS`` words long, that no neighbouring word extends. Texts are taken a chunk at a time, each
with an alphabet of its own, so that nothing matches across texts:

1. Prefix doubling gives the suffix array of the chunk and, for each power of two m, the class of the m
   words from every place on: a class is a range of the suffix array.
2. A run of period q, m <= q < 2 m, holds an aligned block of m words whose copy q words later lies in
   the run too. So each aligned (dyadic) block is asked for its occurrences that begin in the window
   from m to 2 m words after it: range successors in its part of the suffix array, answered for all
   blocks at once by a wavelet matrix.
3. Occurrences in such a window form an arithmetic progression. One or two of them are candidate
   periods themselves. Three or more have the block's own period p as difference; then block and
   occurrences lie in stretches of period p, and as a run carries the end of the one to the end of the
   other, the distance of these ends is the only candidate.
4. A candidate is extended to both sides with the classes (longest common extensions by halving
   steps); stretches that are long enough are runs, of equal ones the smallest period counts.

Each text is handled whole, in time n log n; a worker holds one chunk, which is one text if that is
long (about 250 bytes a word at worst).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_PERIODS = 4
WORDS_AT_ONCE = 1 << 16

RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixClasses:
    """Suffix array of numbers, and for each level k the class of the 2**k numbers from each place on.

    A class is named by the first slot of the suffix array that its members take, and they take
    adjacent ones. Levels end where every class has one member.
    """

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.slots = np.argsort(ids, kind="stable").astype(np.int64)  # the suffix array
        ordered = ids[self.slots]
        fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        names = np.empty(n, np.int64)
        names[self.slots] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        self.levels = [names.astype(np.int32)]
        width = 1
        while True:
            sizes = np.bincount(names, minlength=n)
            # Members of classes of several, by class; the other places are settled.
            open_slots = np.flatnonzero(sizes[names[self.slots]] > 1)
            if not len(open_slots):
                break
            places = self.slots[open_slots]
            after = places + width
            next_name = np.where(after < n, names[np.minimum(after, n - 1)], -1)
            order = np.argsort(names[places] * (n + 1) + next_name + 1, kind="stable")
            places, next_name = places[order], next_name[order]
            self.slots[open_slots] = places
            own = names[places]
            fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (next_name[1:] != next_name[:-1])))
            names = names.copy()
            names[places] = open_slots[fresh][np.cumsum(fresh) - 1]
            self.levels.append(names.astype(np.int32))
            width *= 2

    def common_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from ``a`` on equal those from ``b`` on (a and b differ)."""
        n, common = len(self.slots), np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            x, y = a + common, b + common
            inside = np.maximum(x, y) + (1 << k) <= n
            same = inside & (names[np.minimum(x, n - 1)] == names[np.minimum(y, n - 1)])
            common += same.astype(np.int64) << k
        return common

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers before ``a`` equal those before ``b``."""
        common = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            x, y = a - common - (1 << k), b - common - (1 << k)
            same = (np.minimum(x, y) >= 0) & (names[np.maximum(x, 0)] == names[np.maximum(y, 0)])
            common += same.astype(np.int64) << k
        return common


class WaveletMatrix:
    """Numbers below 2**bits, arranged bit by bit, to ask many ranges at once for the next greater value."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        current = values
        for bit in range(max(int(values.max()).bit_length(), 1) - 1, -1, -1):
            is_zero = (current >> bit) & 1 == 0
            zeros = np.zeros(len(current) + 1, np.int32)
            np.cumsum(is_zero, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            current = np.concatenate((current[is_zero], current[~is_zero]))

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value of at least ``least`` (within the numbers' bits) among values[low:high]; -1 if there is none."""
        below = np.zeros(len(low), np.int64)
        a, b = low, high
        for bit, zeros, n_zeros in self.levels:
            za, zb = zeros[a], zeros[b]
            one = (least >> bit) & 1 == 1
            below += np.where(one, zb - za, 0)
            a, b = np.where(one, n_zeros + a - za, za), np.where(one, n_zeros + b - zb, zb)
        found = np.full(len(low), -1, np.int64)
        some = np.flatnonzero(below < high - low)
        a, b, rank = low[some], high[some], below[some]
        value = np.zeros(len(some), np.int64)
        for bit, zeros, n_zeros in self.levels:
            za, zb = zeros[a], zeros[b]
            one = rank >= zb - za
            rank = np.where(one, rank - (zb - za), rank)
            value |= one.astype(np.int64) << bit
            a, b = np.where(one, n_zeros + a - za, za), np.where(one, n_zeros + b - zb, zb)
        found[some] = value
        return found


def _candidates(classes: SuffixClasses) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances at which a run's period may stand."""
    n = len(classes.slots)
    matrix = WaveletMatrix(classes.slots)
    places, periods = [], []
    for k, names in enumerate(classes.levels):
        m = 1 << k
        blocks = np.arange(0, n - m, m)
        low = names[blocks].astype(np.int64)
        high = low + np.bincount(names, minlength=n)[low]
        several = high - low > 1
        blocks, low, high = blocks[several], low[several], high[several]
        end = np.minimum(blocks + 2 * m, n)
        found = []
        least = blocks + m
        for _ in range(3):
            here = matrix.successor(low, high, least)
            there = (here >= 0) & (here < end)
            found = [f[there] for f in found]
            blocks, low, high, end, here = blocks[there], low[there], high[there], end[there], here[there]
            found.append(here)
            if len(found) < 3:
                places.append(blocks)
                periods.append(here - blocks)
                more = here + 1 < end
                found = [f[more] for f in found]
                blocks, low, high, end, least = blocks[more], low[more], high[more], end[more], here[more] + 1
            if not len(blocks):
                break
        else:  # progressions of three and more
            first, own = found[0], found[1] - found[0]
            end_here = blocks + own + classes.common_after(blocks, blocks + own)
            end_there = first + own + classes.common_after(first, first + own)
            apart = end_there > end_here
            places.append(blocks[apart])
            periods.append((end_there - end_here)[apart])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, period = np.concatenate(places), np.concatenate(periods)
    inside = at + period < n
    return at[inside], period[inside]


def runs_of(ids: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (start, length, period) of all runs of numbers, by start, then period; ``least_periods`` is 4 at least."""
    if least_periods < 4:
        raise ValueError("blocks find runs of at least four periods")
    none = np.zeros((0, 3), np.int64)
    if len(ids) < max(least_words, least_periods):
        return none
    classes = SuffixClasses(ids)
    if len(classes.levels) == 1:  # no number occurs twice
        return none
    at, period = _candidates(classes)
    start = at - classes.common_before(at, at + period)
    length = at + period + classes.common_after(at, at + period) - start
    long = length >= np.maximum(least_words, least_periods * period)
    rows = np.unique(np.stack((start, length, period), 1)[long], axis=0)
    if not len(rows):
        return none
    same = np.concatenate(([False], (rows[1:, :2] == rows[:-1, :2]).all(1)))
    rows = rows[~same]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _chunk_rows(texts: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
    """Runs of each text's words, and the words that stay joined by a space."""
    ids: list[int] = []
    firsts = [0]
    for words in texts:
        own: dict[bytes, int] = {}
        base = len(ids)
        ids += [base + own.setdefault(word, len(own)) for word in words]
        firsts.append(len(ids))
    found = runs_of(np.array(ids, np.int64))
    covers = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covers, found[:, 0] + found[:, 2], 1)
    np.add.at(covers, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(covers) > 0
    bounds = np.searchsorted(found[:, 0], firsts)
    runs, kept = [], []
    for k, words in enumerate(texts):
        rows = found[bounds[k] : bounds[k + 1]]
        first = firsts[k]
        runs.append([{"start": s - first, "length": n, "period": p} for s, n, p in rows.tolist()])
        if len(rows):
            words = [word for word, gone in zip(words, dropped[first : firsts[k + 1]].tolist(), strict=True) if not gone]
        kept.append(b" ".join(words))
    return runs, kept


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period, by start, then period), collapsed.

    docs: doc_id (of any type), text; other columns are ignored. Words are what the white space of ASCII
    separates. collapsed: the text without the words that any run contains after its first period,
    joined by one space. Null, empty and blank texts have no words, no runs and an empty collapsed
    text. Rows of equal or null id are rows of their own; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            low = 0
            while low < batch.num_rows:
                chunk: list[list[bytes]] = []
                size = 0
                for k in range(low, batch.num_rows):
                    words = (texts[k].as_py() or b"").split()
                    if chunk and size + len(words) > WORDS_AT_ONCE:
                        break
                    chunk.append(words)
                    size += len(words)
                runs, kept = _chunk_rows(chunk)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(low, len(chunk)),
                        "n_words": pa.array(map(len, chunk), pa.int64()),
                        "runs": pa.array(runs, pa.list_(pa.struct({"start": pa.int64(), "length": pa.int64(), "period": pa.int64()}))),
                        "collapsed": pa.array(kept, pa.binary()).view(pa.string()),
                    }
                )
                low += len(chunk)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_words long, runs {RUNS_TYPE}, collapsed string")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which a tenth of the texts end in repeats of a part of them.

    With h the crc32 of the decimal doc_id and g = floor(h / 10): if h is divisible by 10, each word
    i >= a of the n words becomes the word a + (i - a) % p, with a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). Texts without words, and rows without an id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.array_remove(F.split(F.when(chosen, F.col("text")), r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).cast("long").alias("g"))
    n = F.size("words")
    rows = rows.withColumn("a", (F.col("g") % F.greatest(n, F.lit(1))).cast("long"))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.transform("words", lambda _, i: F.get("words", place(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(planted, " ")).alias("text"))

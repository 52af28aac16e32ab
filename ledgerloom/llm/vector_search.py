"""Exact inner-product top-k, pruned by bounds from segment means and deviations.

A vector is cut into segments of equal length; per segment its mean and the norm of what deviates
from the mean are kept. The inner product of two vectors is, segment by segment, length times the
product of the means plus the inner product of the deviations, and the latter is at most the product
of their norms. That bounds a score from above (a distance from below) with a few numbers. The bound
is taken with 4 segments, then 16 for what is left; only survivors of both get their exact score. A
pair is left out only if its bound is below the k-th best score found so far, so the result is exact.

Queries are taken in blocks of a fixed size, each broadcast to all candidates; a task keeps k rows a
query. Nothing else than a block goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace

SEGMENTS = (4, 16)
QUERIES_AT_ONCE = 1024
_ROWS_AT_ONCE = 2048
_LARGEST = float(1 << 63)


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * component) as integers; null for null vectors and ones with a null, non-finite or huge component.

    Huge means not below 2**63 in size after scaling; such a component is no long.
    """
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    whole = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < _LARGEST))
    return F.when(whole, F.transform(scaled, lambda x: F.floor(x)))


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector and segment the mean times the root of the length, then the deviations' norms.

    The inner product of two such rows is the upper bound of the vectors' inner product. The last
    segments may be shorter by one component.
    """
    parts = np.array_split(np.arange(vectors.shape[1]), min(segments, max(vectors.shape[1], 1)))
    means, norms = [], []
    for part in parts:
        own = vectors[:, part]
        mean = own.mean(axis=1) if len(part) else np.zeros(len(vectors))
        means.append(mean * np.sqrt(len(part)))
        norms.append(np.sqrt(np.square(own - mean[:, None]).sum(axis=1)))
    return np.stack([*means, *norms], axis=1)


def _largest(vectors: np.ndarray) -> np.ndarray:
    return np.abs(vectors).max(axis=1, initial=0.0)


def _scores(a: np.ndarray, b: np.ndarray, most: np.ndarray | None) -> np.ndarray:
    """Exact inner products of integer rows, in wider integers where 64 bits might not do; an error if a result doesn't fit them.

    most: what the sizes can be at most, or None if none of them needs more than 64 bits.
    """
    scores = np.einsum("ij,ij->i", a, b)
    wide = np.flatnonzero(most >= 2.0**62) if most is not None else np.zeros(0, np.int64)
    for k in wide.tolist():
        score = sum(x * y for x, y in zip(a[k].tolist(), b[k].tolist(), strict=True))
        if abs(score) >= 1 << 63:
            raise OverflowError(f"vector search: a score of {score} does not fit 64 bits")
        scores[k] = score
    return scores


class _Best:
    """The k best scores so far of some queries of one dimension, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.exact, self.vectors, self.k = ids, vectors, vectors.astype(np.float64), k
        self.most = vectors.shape[1] * _largest(self.vectors)
        self.statistics = [segment_statistics(self.vectors, s) for s in SEGMENTS]
        self.slack = 1e-6 + 1e-9 * np.sqrt(np.square(self.vectors).sum(axis=1))
        self.least = np.full(len(ids), -np.inf)
        self.found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))  # query, id, score

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        wide = vectors.astype(np.float64)
        norms = np.sqrt(np.square(wide).sum(axis=1))
        least = self.least[:, None] - self.slack[:, None] * (1 + norms)
        q, c = np.nonzero((self.statistics[0] @ segment_statistics(wide, SEGMENTS[0]).T >= least) & (self.ids[:, None] != ids))
        fine = segment_statistics(wide, SEGMENTS[1])
        kept = []
        largest = _largest(wide)
        is_wide = self.most.max(initial=0.0) * largest.max(initial=0.0) >= 2.0**62
        for low in range(0, len(q), 1 << 16):
            a, b = q[low : low + (1 << 16)], c[low : low + (1 << 16)]
            bound = np.einsum("ij,ij->i", self.statistics[1][a], fine[b])
            keep = bound >= least[a, b]
            a, b = a[keep], b[keep]
            score = _scores(self.exact[a], vectors[b], self.most[a] * largest[b] if is_wide else None)
            good = score >= self.least[a]
            kept.append((a[good], ids[b[good]], score[good]))
        q, c, score = (np.concatenate(x) for x in zip(self.found, *kept, strict=True))
        order = np.lexsort((c, -score, q))
        q, c, score = q[order], c[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        self.found = tuple(x[rank < self.k] for x in (q, c, score))
        full = self.found[0][np.arange(len(self.found[0])) - np.searchsorted(self.found[0], self.found[0]) == self.k - 1]
        self.least[full] = self.found[2][np.arange(len(self.found[0])) - np.searchsorted(self.found[0], self.found[0]) == self.k - 1]


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, queries_at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k candidates of highest inner product for each query.

    Both tables: vec_id, vector (integers; null takes no part; others of another length than the
    query's are no candidates of it). Rows with a null id take no part. A query's own id is never its
    candidate. Of several queries with one id the one with the smallest vector is asked; candidates
    of one id are candidates each. Ties go to the smaller id. Other columns are ignored. A score that
    does not fit 64 bits is an error.
    """
    spark = candidates.sparkSession
    space = Workspace(spark, "vector-search")
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    rows = space.store(candidates.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<long>").alias("vector")), "candidates")
    asked = queries.where(usable).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.col("vector").cast("array<long>")).alias("vector"))
    asked = space.store(asked, "queries")
    blocks = max(1, -(-asked.count() // queries_at_once))
    found = None
    for block in range(blocks):
        one = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        own: dict[int, list] = {}
        for row in one.collect():  # about `queries_at_once` rows
            own.setdefault(len(row.vector), []).append((row.vec_id, row.vector))
        shared = spark.sparkContext.broadcast(
            {n: (np.array([i for i, _ in some], np.int64), np.array([v for _, v in some], np.int64).reshape(len(some), n)) for n, some in own.items()}
        )

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            best = {n: _Best(ids, vectors, k) for n, (ids, vectors) in shared.value.items()}
            step = 64  # few rows at first, to have something to prune by
            for batch in batches:
                sizes = batch["vector"].map(len).to_numpy()
                for n in np.unique(sizes):
                    if n not in best:
                        continue
                    part = batch[sizes == n]
                    ids = part["vec_id"].to_numpy(np.int64)
                    vectors = np.stack(part["vector"].to_list()).astype(np.int64).reshape(len(part), n)
                    low = 0
                    while low < len(part):
                        best[n].add(ids[low : low + step], vectors[low : low + step])
                        low += step
                        step = min(2 * step, _ROWS_AT_ONCE)
            for b in best.values():
                query, vec_id, score = b.found
                yield pd.DataFrame({"query_id": b.ids[query], "vec_id": vec_id, "score": score})

        part = rows.mapInPandas(search, "query_id long, vec_id long, score long")
        part = space.store(part, f"block-{block}")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

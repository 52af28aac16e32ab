"""Ranked lexical search: exact best documents of each item from a sparse ball tree.

1. The items' distinct terms are the vocabulary. One scan of the documents counts each one's terms and
   how often it holds those of the vocabulary; document frequencies are sums over that.
2. A document's vector holds, for each of its vocabulary terms, the whole-number score that the term
   adds; an item's score of a document is the sum over the item's terms, an inner product with a
   vector of ones.
3. Vectors are projected to four dimensions and range-sorted by their place on a Hilbert curve. Each
   partition cuts its rows into subtrees: balls of a centroid and a radius, split at the median of the
   line between two far members down to leaves of ``LEAF_ROWS`` documents.
4. An item's score in a ball is at most (centroid, item) + radius * sqrt(common terms). Items search a
   subtree together, best ball first; an item leaves a ball whose bound lies below its ``k``-th best
   score so far. Leaves are scored exactly. A first round, which looks at few leaves of each subtree,
   gives every item the score it starts from; the second one prunes with it.

All floating-point bounds are rounded up by more than their summation error, and scores are sums of
whole numbers below 2**53, or 64-bit integers beyond it: the result is exact. Terms are compared as
64-bit hashes. A task holds one subtree and the best rows of one block of items; blocks hold at most
``BLOCK_TERMS`` terms, and the vocabulary about ``VOCABULARY`` ones (more items are taken in turns).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import Workspace, bounded_chunks, partitions_for, word_hashes
from ledgerloom.llm.packing import DIMENSIONS, curve_key

BEST = 50
VOCABULARY = 1_000_000
BLOCK_TERMS = 200_000
ITEMS_TOGETHER = 256
SUBTREE_ROWS = 4096
SUBTREE_ENTRIES = 1_000_000
LEAF_ROWS = 64
FIRST_LEAVES = 4

# Score formula (fixed values): whole-number BM25 with k1 = 1, b = 1/2.
LENGTH_SHARE = 50

#: Bytes that are no part of a term.
_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_EXACT = float(1 << 53)


def _term_rows(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of few texts with the hashes of all their terms and the number of terms of each text."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            for first, chunk in bounded_chunks(texts):
                hashes, starts = word_hashes(chunk, _OUTSIDE)
                yield part.slice(first, len(chunk)), hashes, np.diff(np.append(starts, len(hashes)))


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values, kind))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (hashes of the distinct terms) of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, hashes, counts in _term_rows(batches):
            ends = np.cumsum(counts)
            own = [np.unique(hashes[end - n : end]).view(np.int64) for n, end in zip(counts, ends, strict=True)]
            yield pa.RecordBatch.from_pydict({"item_id": part.column("item_id"), "terms": pa.array(own, pa.list_(pa.int64()))})

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(rows, f"item_id {kind}, terms array<long>")


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (terms with repeats), terms (places in the sorted vocabulary), tfs of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary)
        for part, hashes, counts in _term_rows(batches):
            place = np.searchsorted(vocabulary, hashes)
            known = vocabulary[np.minimum(place, size - 1)] == hashes
            row = np.repeat(np.arange(len(counts)), counts)
            keys, tfs = np.unique(row[known] * size + place[known], return_counts=True)
            of_row = np.bincount(keys // size, minlength=len(counts))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n": pa.array(counts, pa.int64()),
                    "terms": _lists(keys % size, of_row, pa.int32()),
                    "tfs": _lists(tfs, of_row, pa.int32()),
                }
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(rows, "doc_id long, n long, terms array<int>, tfs array<int>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a list column, and its row bounds in them."""
    bounds = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def document_vectors(counted: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, curve_key, terms, parts (per term the score before its weight) of rows with a vocabulary term.

    counted: rows of ``term_counts`` with ``m``, the length part of the formula.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection = np.random.default_rng(11).standard_normal((len(weights), DIMENSIONS))
        for batch in (whole.slice(low, 500) for whole in batches for low in range(0, whole.num_rows, 500)):
            terms, bounds = _flat(batch.column("terms"))
            tfs = _flat(batch.column("tfs"))[0].astype(np.int64)
            sizes = np.diff(bounds)
            m = np.repeat(batch.column("m").to_numpy(), sizes)
            parts = 1_000_000_000 * tfs // (1000 * tfs + 20 * m)
            adds = (weights[terms] * parts).astype(np.float64)
            norms = np.sqrt(np.add.reduceat(adds * adds, bounds[:-1]))
            points = np.add.reduceat(adds[:, None] * projection[terms], bounds[:-1]) / np.maximum(norms, 1)[:, None]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "curve_key": pa.array(curve_key(points), pa.int64()),
                    "terms": batch.column("terms"),
                    "parts": _lists(parts, sizes, pa.int32()),
                }
            )

    some = counted.where(F.size("terms") > 0).select("doc_id", "m", "terms", "tfs")
    return some.mapInArrow(rows, "doc_id long, curve_key long, terms array<int>, parts array<int>")


class Rows:
    """Sparse rows: the entries of row i are those from bounds[i] to bounds[i + 1]."""

    def __init__(self, terms: np.ndarray, values: np.ndarray, bounds: np.ndarray):
        self.terms, self.values, self.bounds = terms, values, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = (self.bounds[1:] - self.bounds[:-1])[rows]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1][rows] - bounds[:-1], sizes)
        return Rows(self.terms[at], self.values[at], bounds)

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * dense[self.terms], self.bounds[:-1])


def ball_tree(rows: Rows, n_terms: int, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, list[tuple]]:
    """Order of the rows in the tree, and its balls: first row, row after the last, right child (0: leaf), radius, terms, centroid.

    A ball's left child is the next ball. rows: none of them empty, values of at least 0. Radii are
    rounded up, centroids are 32-bit numbers (any point may be the centre).
    """
    order = np.arange(len(rows))
    squares = np.add.reduceat(rows.values * rows.values, rows.bounds[:-1])
    balls: list[list] = []
    todo = [(0, len(rows), -1)]
    while todo:
        low, high, parent = todo.pop()
        if parent >= 0:
            balls[parent][2] = len(balls)
        own = rows.take(order[low:high])
        total = np.bincount(own.terms, weights=own.values, minlength=n_terms)
        support = np.flatnonzero(total)
        centroid = (total / (high - low)).astype(np.float32)
        center = centroid.astype(np.float64)
        square, own_squares = float(center @ center), squares[order[low:high]]
        apart = own_squares - 2 * own.dot(center) + square
        slack = (n_terms + 16) * 2.0**-51 * (math.sqrt(own_squares.max()) + math.sqrt(square)) ** 2
        radius = math.sqrt(max(apart.max(), 0.0) + slack) * (1 + 2.0**-40)
        balls.append([low, high, 0, radius, support, centroid[support]])
        if high - low <= leaf_rows:
            continue

        def dense(row: int, own: Rows = own) -> np.ndarray:
            return np.bincount(own.terms[own.bounds[row] : own.bounds[row + 1]], weights=own.values[own.bounds[row] : own.bounds[row + 1]], minlength=n_terms)

        one = dense(int(apart.argmax()))
        other = dense(int((own_squares - 2 * own.dot(one)).argmax()))
        order[low:high] = order[low:high][np.argsort(own.dot(one - other), kind="stable")]
        middle = (low + high) // 2
        todo += [(middle, high, len(balls) - 1), (low, middle, -1)]
    return order, [tuple(ball) for ball in balls]


_TREE = "ids array<long>, terms array<int>, parts array<int>, bounds array<int>, firsts array<int>, lasts array<int>, rights array<int>, radii array<double>, center_terms array<int>, centers array<float>, center_bounds array<int>"


def subtrees(vectors: DataFrame, weights: np.ndarray) -> DataFrame:
    """One row a subtree: its documents in tree order and its balls. A partition holds one subtree at a time."""

    def subtree(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        terms, bounds = _flat(table.column("terms").combine_chunks())
        parts = _flat(table.column("parts").combine_chunks())[0]
        known, local = np.unique(terms, return_inverse=True)
        adds = (weights[terms] * parts.astype(np.int64)).astype(np.float64)
        order, balls = ball_tree(Rows(local, adds, bounds), len(known))
        placed = Rows(terms, parts, bounds).take(order)
        firsts, lasts, rights, radii, supports, centers = zip(*balls, strict=True)
        row = {
            "ids": ids.take(pa.array(order)),
            "terms": placed.terms,
            "parts": placed.values,
            "bounds": placed.bounds,
            "firsts": firsts,
            "lasts": lasts,
            "rights": rights,
            "radii": radii,
            "center_terms": known[np.concatenate(supports)],
            "centers": np.concatenate(centers),
            "center_bounds": np.concatenate(([0], np.cumsum([len(s) for s in supports]))),
        }
        kinds = {"ids": pa.int64(), "radii": pa.float64(), "centers": pa.float32()}
        columns = {}
        for name, values in row.items():
            values = values if isinstance(values, pa.Array) else pa.array(values, kinds.get(name, pa.int32()))
            columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_pydict(columns)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n_rows = n_entries = 0
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                sizes = np.diff(batch.column("terms").offsets.to_numpy())[low : low + SUBTREE_ROWS - n_rows]
                n = max(int(np.searchsorted(np.cumsum(sizes) + n_entries, SUBTREE_ENTRIES, "right")), 0 if held else 1)
                if n:
                    held.append(batch.slice(low, n))
                    n_rows, n_entries, low = n_rows + n, n_entries + int(sizes[:n].sum()), low + n
                if n < len(sizes) or n_rows >= SUBTREE_ROWS:
                    yield subtree(held)
                    held, n_rows, n_entries = [], 0, 0
        if held:
            yield subtree(held)

    return vectors.select("doc_id", "terms", "parts").mapInArrow(build, _TREE)


class _Best:
    """The best rows of some items so far, and the score below which a row doesn't count."""

    def __init__(self, least: np.ndarray, k: int):
        n = len(least)
        self.k, self.least = k, least
        self.scores = np.zeros((n, k), np.int64)
        self.ids = np.zeros((n, k), np.int64)
        self.no_id = np.zeros((n, k), bool)

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """scores: a row an item, a column a document."""
        some = (scores >= self.least[items, None]).any(1)
        items, scores = items[some], scores[some]
        if not len(items):
            return
        shape = scores.shape
        scores = np.concatenate((self.scores[items], scores), 1)
        ids = np.concatenate((self.ids[items], np.broadcast_to(ids, shape)), 1)
        no_id = np.concatenate((self.no_id[items], np.broadcast_to(no_id, shape)), 1)
        order = np.lexsort((ids, no_id, -scores))[:, : self.k]
        self.scores[items] = np.take_along_axis(scores, order, 1)
        self.ids[items] = np.take_along_axis(ids, order, 1)
        self.no_id[items] = np.take_along_axis(no_id, order, 1)
        self.least[items] = np.maximum(self.least[items], self.scores[items, -1])


def _search(tree: dict[str, np.ndarray], no_id: np.ndarray, weights: np.ndarray, asks: np.ndarray, known: np.ndarray, best: _Best, leaves: int | None) -> None:
    """Best-first search of one subtree by several items.

    asks: a row for each term of the subtree (``known``), a column for each item, 1 if the item has the term.
    """
    centers, center_bounds = tree["centers"].astype(np.float64), tree["center_bounds"]
    center_terms = np.searchsorted(known, tree["center_terms"])
    round_up = 1 + (len(known) + 16) * 2.0**-50

    def bounds(ball: int, items: np.ndarray) -> np.ndarray:
        own = slice(center_bounds[ball], center_bounds[ball + 1])
        common = asks[center_terms[own]][:, items].astype(np.float64)
        return (centers[own] @ common + tree["radii"][ball] * np.sqrt(common.sum(0))) * round_up + 1

    def push(ball: int, items: np.ndarray) -> None:
        upper = bounds(ball, items)
        open_ = upper >= best.least[items]
        if open_.any():
            items, upper = items[open_], upper[open_]
            heapq.heappush(heap, (-float((upper / best.least[items]).max()), ball, items, upper))

    heap: list[tuple] = []
    push(0, np.arange(asks.shape[1]))
    while heap and (leaves is None or leaves > 0):
        _, ball, items, upper = heapq.heappop(heap)
        items = items[upper >= best.least[items]]
        if not len(items):
            continue
        right = int(tree["rights"][ball])
        if right:
            push(ball + 1, items)
            push(right, items)
            continue
        low, high = int(tree["firsts"][ball]), int(tree["lasts"][ball])
        entries = slice(tree["bounds"][low], tree["bounds"][high])
        adds = weights[tree["terms"][entries]] * tree["parts"][entries].astype(np.int64)
        rows = np.repeat(np.arange(high - low), np.diff(tree["bounds"][low : high + 1]))
        terms, adds, rows = tree["terms"][entries][adds > 0], adds[adds > 0], rows[adds > 0]
        own, column = np.unique(terms, return_inverse=True)
        kind = np.float64 if np.bincount(rows, weights=adds, minlength=1).max() < _EXACT / 2 else np.int64
        dense = np.zeros((high - low, len(own)), kind)
        dense[rows, column] = adds
        common = asks[np.searchsorted(known, own)][:, items].astype(kind)
        scores = (dense @ common).astype(np.int64).T
        best.add(items, scores, tree["ids"][low:high], no_id[low:high])
        leaves = None if leaves is None else leaves - 1


def _searched(trees: DataFrame, weights: np.ndarray, asked: list[np.ndarray], least: np.ndarray, k: int, leaves: int | None) -> DataFrame:
    """item (number in ``asked``), doc_id, score: the best rows of each partition of subtrees.

    asked: sorted places of each item's terms in the vocabulary; least: lowest score that counts.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(least[low : low + ITEMS_TOGETHER].copy(), k) for low in range(0, len(asked), ITEMS_TOGETHER)]
        for batch in batches:
            for place in range(batch.num_rows):
                cells = {name: batch.column(name)[place].values for name in batch.schema.names}
                no_id = cells["ids"].is_null().to_numpy(zero_copy_only=False)
                cells["ids"] = cells["ids"].fill_null(0)
                tree = {name: cell.to_numpy() for name, cell in cells.items()}
                known = np.unique(tree["center_terms"])
                if not len(known):
                    continue  # no term adds anything
                for number, one in enumerate(best):
                    group = asked[number * ITEMS_TOGETHER : (number + 1) * ITEMS_TOGETHER]
                    terms = np.concatenate(group)
                    items = np.repeat(np.arange(len(group)), [len(g) for g in group])
                    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                    there = known[at] == terms
                    asks = np.zeros((len(known), len(group)), bool)
                    asks[at[there], items[there]] = True
                    _search(tree, no_id, weights, asks, known, one, leaves)
        for number, one in enumerate(best):
            item, slot = np.nonzero(one.scores > 0)
            ids = pa.array(one.ids[item, slot], pa.int64(), mask=one.no_id[item, slot])
            yield pa.RecordBatch.from_pydict({"item": pa.array(item + number * ITEMS_TOGETHER, pa.int64()), "doc_id": ids, "score": pa.array(one.scores[item, slot])})

    return trees.mapInArrow(search, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _in_turns(space: Workspace, asked: DataFrame, size: str, most: int) -> list[DataFrame]:
    """The rows in as many parts as keep the sum of ``size`` at about ``most`` in each."""
    total = asked.agg(F.sum(size)).first()[0] or 0
    parts = -(-total // most)
    return [asked.where(F.pmod(F.xxhash64("number"), F.lit(parts)) == part) for part in range(parts)]


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    docs: doc_id (integer), text; items: item_id, text; other columns are ignored. Terms are runs of
    ASCII letters and digits and of characters beyond ASCII, A-Z as a-z. With N documents that hold a
    term, L terms in all of them, n and tf the document's terms and those equal to the item's term, df
    the documents holding it, and integer division, the score sums over the item's distinct terms
    floor(1000 * ln((2 N + 2) / (2 df + 1))) * (10**9 tf / (1000 tf + 20 m)), m = 50 + 50 n N / L.
    Only scores above 0 count; equal ones rank by ascending doc_id, null last. Null and empty texts
    hold no term and find nothing. Rows of equal or null id, in either table, are rows of their own.
    Without items or documents there are no rows. An n N beyond 64 bits is an error.
    """
    space = Workspace(docs.sparkSession, "lexical-search")
    asked = item_terms(items).where(F.size("terms") > 0).withColumn("number", F.monotonically_increasing_id())
    asked = space.store(asked.withColumn("size", F.size("terms").cast("long")), "items")
    found = []
    for turn in _in_turns(space, asked, "size", VOCABULARY):
        # Bounded by VOCABULARY; equal terms of several items are one row.
        words = turn.select(F.explode("terms").alias("term")).distinct().toPandas()["term"]
        vocabulary = np.sort(words.to_numpy(np.int64).view(np.uint64))
        if not len(vocabulary):
            continue
        counted = space.store(term_counts(docs, vocabulary), "counted")
        n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_docs:
            return _no_rows(docs, asked)
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas()  # at most the vocabulary
        df = np.zeros(len(vocabulary), np.int64)
        df[held["term"].to_numpy()] = held["count"].to_numpy()
        weights = np.array([term_weight(n_docs, int(one)) for one in df], np.int64)
        m = F.lit(LENGTH_SHARE) + F.expr(f"({LENGTH_SHARE}L * n * {n_docs}L) div {n_terms}L")
        vectors = document_vectors(counted.withColumn("m", m), weights)
        ordered = vectors.repartitionByRange(partitions_for(counted), "curve_key", "doc_id").sortWithinPartitions("curve_key")
        trees = space.store(subtrees(ordered, weights), "trees")
        space.drop(counted)
        for block in _in_turns(space, turn, "size", BLOCK_TERMS):
            rows = block.select("number", "terms").collect()  # at most BLOCK_TERMS terms
            if not rows:
                continue
            places = [np.searchsorted(vocabulary, np.sort(np.array(r.terms, np.int64).view(np.uint64))) for r in rows]
            least = np.ones(len(rows), np.int64)
            first = _ranked(_searched(trees, weights, places, least, k, FIRST_LEAVES), k).where(F.col("rank") == k)
            for one in first.select("item", "score").collect():  # a row an item
                least[one.item] = one.score
            best = space.store(_ranked(_searched(trees, weights, places, least, k, None), k), "best")
            numbers = docs.sparkSession.createDataFrame([(i, r.number) for i, r in enumerate(rows)], "item long, number long")
            found.append(best.join(numbers, "item").select("number", "rank", "doc_id", "score"))
    if not found:
        return _no_rows(docs, asked)
    return reduce(DataFrame.union, found).join(asked.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


def _no_rows(docs: DataFrame, asked: DataFrame) -> DataFrame:
    return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))

"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tests.llm.helpers import AWKWARD, ascii_lower, prose, with_clashing_columns

from ledgerloom.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(ascii_lower(text))


def brute_force(docs, items, k):
    counted = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_terms = sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counted:
            score = 0
            for term in set(terms_of(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 100 - 50 + (50 * c.total() * n_docs) // n_terms
                score += w * ((10**9 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return sorted(out, key=str)


ITEMS = [
    (1, "The stone of the seven Winds, the café"),
    (2, None),
    (3, " ;;; "),
    (None, "x1 bétà"),
    (5, "words nobody wrote"),
    (5, "blue tree"),
    (5, "blue tree"),
    (2**60 + 1, "one two row twice " + prose(9, 300)),
]


@pytest.mark.parametrize("k", [1, 7, 50])
def test_best_documents_equal_brute_force(spark, k):
    rng = random.Random(k)
    docs = [*AWKWARD, *((100 + i, prose(i % 90, rng.choice([3, 20, 80]))) for i in range(400))]
    docs += [(i, "one blue stone") for i in range(2000, 2300)]  # ties of more rows than are returned
    docs += [(2**60 + 3, prose(3, 20_000)), (2**60 + 1, "the stone"), (None, "the stone")]
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, terms string")
    got = lexical_search.search(with_clashing_columns(spark, docs).repartition(5), items, k)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, ITEMS, k)


def test_blocks_and_turns_change_nothing(spark, monkeypatch):
    docs = [(i, prose(i, 30)) for i in range(200)]
    items = [(i, prose(1000 + i, 5)) for i in range(40)]
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 20)
    monkeypatch.setattr(lexical_search, "VOCABULARY", 90)
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string"), frame, 3)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, items, 3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a stone")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "stone")], "item_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    nothing = lexical_search.search(docs.limit(0), items)
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.search(docs, items.limit(0)).collect() == []
    assert lexical_search.search(blank, items).collect() == []


def test_balls_hold_their_rows_and_bound_every_query():
    rng = np.random.default_rng(2)
    n_terms = 40
    sizes = rng.integers(1, 12, 500)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    terms = np.concatenate([rng.choice(n_terms, n, replace=False) for n in sizes])
    values = rng.integers(0, 10**10, len(terms)).astype(np.float64)
    order, balls = lexical_search.ball_tree(lexical_search.Rows(terms, values, bounds), n_terms, leaf_rows=16)
    assert sorted(order.tolist()) == list(range(500))
    dense = np.zeros((500, n_terms))
    for row in range(500):
        dense[row, terms[bounds[row] : bounds[row + 1]]] = values[bounds[row] : bounds[row + 1]]
    for first, last, right, radius, support, centroid in balls:
        center = np.zeros(n_terms)
        center[support] = centroid
        inside = dense[order[first:last]]
        assert (np.sqrt(((inside - center) ** 2).sum(1)) <= radius).all()
        query = rng.integers(0, 2, n_terms).astype(float)
        upper = center @ query + radius * math.sqrt(query[support].sum())
        assert (inside @ query <= upper * (1 + 1e-12) + 1).all()
        assert (right == 0) == (last - first <= 16)
    # Rows that are all alike make balls of hardly any radius.
    alike = lexical_search.Rows(np.tile([1, 4], 100), np.tile([7e9, 3e9], 100), np.arange(0, 201, 2))
    assert max(ball[3] for ball in lexical_search.ball_tree(alike, 5)[1]) < 1e4


def test_hot_copies_prune(spark):
    """A tree over very many equal rows is left at its first ball below the best score."""
    rows = lexical_search.Rows(np.tile([0, 1], 1000), np.tile([5.0, 6.0], 1000), np.arange(0, 2001, 2))
    order, balls = lexical_search.ball_tree(rows, 2)
    firsts, lasts, rights, radii, supports, centers = zip(*balls, strict=True)
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in supports])))
    tree = {
        "ids": np.arange(1000)[order], "terms": np.tile([0, 1], 1000), "parts": np.tile([5, 6], 1000), "bounds": np.arange(0, 2001, 2),
        "firsts": np.array(firsts), "lasts": np.array(lasts), "rights": np.array(rights), "radii": np.array(radii),
        "center_terms": np.concatenate(supports), "centers": np.concatenate(centers).astype(np.float32), "center_bounds": bounds,
    }
    best = lexical_search._Best(np.array([1, 1000]), 3)
    calls = []
    add = best.add
    best.add = lambda items, *rest: (calls.append(items.tolist()), add(items, *rest))
    lexical_search._search(tree, np.zeros(1000, bool), np.ones(2, np.int64), np.ones((2, 2), bool), np.array([0, 1]), best, None)
    assert all(items == [0] for items in calls)
    assert best.scores[0].tolist() == [11, 11, 11] and best.ids[0].tolist() == [0, 1, 2]
    assert best.scores[1].tolist() == [0, 0, 0]

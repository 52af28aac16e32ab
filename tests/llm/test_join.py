"""N-gram Jaccard join against brute force."""

import random

import numpy as np
import pytest
from tests.llm.helpers import AWKWARD, prose, spaced_words, with_clashing_columns

from ledgerloom.llm import prefix_tree_join
from ledgerloom.llm.prefix_tree_join import PrefixTree, similar_sets


def shingles(text, words):
    own = spaced_words(text)
    if len(own) < words:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + words]) for i in range(len(own) - words + 1)}


def connected(sets, percent):
    """Smallest number reachable from each set over links."""
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [root(i) for i in range(len(sets))]


def brute_force(rows, words, percent):
    sets = [shingles(text, words) for _, text in rows]
    label = connected(sets, percent)
    members = {}
    for i, k in enumerate(label):
        members.setdefault(k, []).append(rows[i][0])
    out = []
    for (doc_id, _), own, k in zip(rows, sets, label, strict=True):
        ids = [i for i in members[k] if i is not None]
        out.append((doc_id, len(own), (min(ids) if ids else None) if own else doc_id))
    return sorted(out, key=str)


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[at : at + (kind != 0)] = [f"new{rng.randrange(10**6)}"] if kind != 1 else []
    return words


def corpus(rng):
    """Clusters of near copies around the threshold, passages and a line that many share, and copies."""
    line = "this very common line stands in a third of all documents".split()
    passages = [[f"p{k}w{i}" for i in range(60)] for k in range(3)]
    rows = []
    for cluster in range(25):
        base = [f"c{cluster}w{rng.randrange(300)}" for _ in range(rng.choice([5, 12, 40, 150]))]
        for _ in range(rng.randrange(1, 12)):
            words = edited(base, rng, rng.choice([0, 0, 1, 1, 2, 3]) * max(1, len(base) // 60))
            if rng.random() < 0.3:
                words = words + line
            if rng.random() < 0.2:
                words = rng.choice(passages) + words
            rows.append(" ".join(words))
    return [(i * 7 % 1009, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (1, 60), (3, 100)])
def test_components_equal_brute_force(spark, words, percent):
    rows = [*AWKWARD, *corpus(random.Random(words)), (None, "a text without an id, of some words"), (3000, prose(2, 20_000))]
    got = similar_sets(with_clashing_columns(spark, rows).repartition(4), words, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows, words, percent)


@pytest.mark.parametrize("rounds", [0, 2])
def test_long_lists_are_dealt_into_groups(spark, monkeypatch, rounds):
    """A large group of near copies, and lists of texts that are alike but for the threshold, in small groups."""
    monkeypatch.setattr(prefix_tree_join, "GROUP_SETS", 6)
    monkeypatch.setattr(prefix_tree_join, "LEAST_ROUNDS", rounds)
    rng = random.Random(rounds)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(base, rng, 1))) for i in range(60)]
    rows += [(500 + i, " ".join([*base[:50], *(f"own{i}x{k}" for k in range(30))])) for i in range(30)]
    rows += [(900, " ".join(base[:115])), (901, " ".join(base[:60])), (902, " ".join(base[2:60]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, similar_sets(docs, 4, 85).collect()), key=str) == brute_force(rows, 4, 85)


def test_empty_tables_and_other_ids(spark):
    docs = spark.createDataFrame([("b", "one two three"), ("a", "one two three"), (None, None)], "doc_id string, text string")
    assert sorted(map(tuple, similar_sets(docs).collect()), key=str) == [("a", 1, "a"), ("b", 1, "a"), (None, 0, None)]
    assert similar_sets(docs.limit(0)).collect() == []
    assert similar_sets(docs.where("text IS NULL")).count() == 1


def test_tree_finds_all_components():
    rng = random.Random(1)
    for percent in (50, 80, 85, 95):
        for _ in range(60):
            base = sorted(rng.sample(range(300), rng.randint(1, 80)))
            sets = {tuple(base)}
            for _ in range(25):
                own = set(base) - set(rng.sample(base, rng.randint(0, len(base) // 3)))
                own |= set(rng.sample(range(300), rng.randint(0, len(base) // 4)))
                if own:
                    sets.add(tuple(sorted(own)))
            sets = [np.array(s) for s in sets]
            groups = np.array([rng.choice([k, 0]) if rng.random() < 0.2 else k for k in range(len(sets))])
            links = PrefixTree(sets).links(percent, groups)
            label = connected([set(s.tolist()) for s in sets], percent)
            joined = list(range(len(sets)))
            pairs = [*links, *((k, int(g)) for k, g in enumerate(groups))]
            known = [(k, x) for k, x in enumerate(label)] + [(k, int(g)) for k, g in enumerate(groups)]

            def least(joined, pairs):
                changed = True
                while changed:
                    changed = False
                    for x, y in pairs:
                        low = min(joined[x], joined[y])
                        changed |= joined[x] != low or joined[y] != low
                        joined[x] = joined[y] = low
                return joined

            assert least(joined, pairs) == least(list(range(len(sets))), known)
            for x, y in links:  # nothing but links
                a, b = set(sets[x].tolist()), set(sets[y].tolist())
                assert 100 * len(a & b) >= percent * len(a | b)

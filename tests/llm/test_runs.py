"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from tests.llm.helpers import AWKWARD, prose, with_clashing_columns

from ledgerloom.llm import periodic_runs, queries
from ledgerloom.llm.periodic_runs import SuffixClasses, WaveletMatrix, runs_of

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every stretch that a period covers, of equal ones the smallest period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_words(rng):
    words = [rng.randint(0, 3) for _ in range(rng.randint(0, 5))]
    for _ in range(rng.randint(1, 5)):
        part = [rng.randint(0, rng.choice([1, 2, 9])) for _ in range(rng.randint(1, 18))]
        if rng.random() < 0.5:  # a long power of one word inside the period
            part = [0] * rng.randint(1, 15) + part[: rng.randint(1, 3)]
        words += part * rng.randint(1, 7) + part[: rng.randint(0, len(part))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        words = periodic_words(rng)
        assert [tuple(r) for r in runs_of(np.array(words, np.int64)).tolist()] == brute_runs(words), words


def test_long_powers_and_short_texts():
    assert runs_of(np.zeros(50_000, np.int64)).tolist() == [[0, 50_000, 1]]
    assert runs_of(np.tile(np.arange(700), 60)).tolist() == [[0, 42_000, 700]]
    assert runs_of(np.zeros(5, np.int64)).tolist() == [] and runs_of(np.zeros(6, np.int64)).tolist() == [[0, 6, 1]]
    assert runs_of(np.arange(100)).tolist() == [] and runs_of(np.zeros(0, np.int64)).tolist() == []


def test_classes_and_successors_equal_brute_force():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 3, 200)
    classes, text = SuffixClasses(ids), ids.tolist()
    assert classes.slots.tolist() == sorted(range(200), key=lambda i: text[i:])
    a, b = rng.integers(0, 200, 300), rng.integers(0, 200, 300)
    a, b = a[a != b], b[a != b]
    for x, y, after, before in zip(a, b, classes.common_after(a, b), classes.common_before(a, b), strict=True):
        same = [text[i] == text[j] for i, j in zip(range(x, 200), range(y, 200), strict=False)]
        assert after == (same.index(False) if False in same else len(same))
        same = [text[x - 1 - i] == text[y - 1 - i] for i in range(min(x, y))]
        assert before == (same.index(False) if False in same else len(same))
    values = rng.permutation(150)
    low = rng.integers(0, 150, 400)
    high, least = np.minimum(low + rng.integers(0, 60, 400), 150), rng.integers(0, 150, 400)
    expected = [min((v for v in values[p:q].tolist() if v >= x), default=-1) for p, q, x in zip(low, high, least, strict=True)]
    assert WaveletMatrix(values).successor(low, high, least).tolist() == expected


def planted(doc_id, text):
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if longest[0] is None else 1000 * longest[1] // longest[2]
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *longest, milli, *digests)


def test_query_equals_brute_force_on_awkward_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = [*AWKWARD, (30, "la " * 500), (31, prose(4, 3000)), (32, "a b\tc\x0b" * 9 + "\x1c a \x85 a"), (30, "x " * 7)]
    rows += [(1000 + k, " ".join(map(str, periodic_words(rng)))) for k in range(150)]
    rows += [(2000 + k, prose(k, rng.randint(1, 60))) for k in range(150)]
    rows.append((2**60 + 1, "ab ab ab ab ab ab"))
    with_clashing_columns(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    key = str
    assert sorted(map(tuple, got.collect()), key=key) == sorted((brute_row(*row) for row in rows), key=key)


def test_empty_table_and_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "x x x x x x x y"), (None, None)], "doc_id string, text string")
    got = periodic_runs.periodic_runs(docs)
    assert {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()} == {
        "a": (8, [(0, 7, 1)], "x y"),
        None: (0, [], ""),
    }
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0

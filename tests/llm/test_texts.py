"""Licence scan, decontamination, near duplicates and quality against brute force."""

import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tests.llm.helpers import AWKWARD, alnum_words, prose, spaced_words, with_clashing_columns

from ledgerloom.llm import decontamination, license_scan, near_duplicates, quality_rules
from pyspark.sql import functions as F

LONG = prose(1, 40_000)


# Licence scan


def places(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


def test_licence_phrases_equal_brute_force(spark):
    rows = [
        *AWKWARD,
        (20, "Released under the MIT License. mit license, MIT-license!"),
        (21, "cc by cc by cc by"),
        (22, LONG + " GNU General\nPublic  License " + LONG),
        (23, "Apache. License; apachelicense"),
        (24, "CC BY-NC 4.0"),
    ]
    got = license_scan.scan(with_clashing_columns(spark, rows)).collect()
    expected = []
    for doc_id, text in rows:
        words = alnum_words(text)
        found = {p: places(words, p.split()) for p in license_scan.PHRASES}
        every = sorted(i for at in found.values() for i in at)
        labels = ",".join(sorted({license_scan.PHRASES[p] for p, at in found.items() if at}))
        expected.append((doc_id or 0, len(words), len(every), every[0] if every else -1, every[-1] if every else -1, labels))
    mine = [(r.doc_id or 0, r.n_words, r.n_base, -1 if r.first_word is None else r.first_word, -1 if r.last_word is None else r.last_word, r.base_labels) for r in got]
    assert sorted(mine) == sorted(expected)
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert bool(r.labels) == (r.score > 0)
    assert license_scan.scan(with_clashing_columns(spark, rows).limit(0)).count() == 0


def test_notices_with_words_put_in_are_one_span(spark):
    notice = license_scan.NOTICES["mit-notice"].split()
    changed = [*notice[:12], "truly", "and", *notice[12:]]
    rows = [(1, "x y z " + " ".join(changed) + " tail"), (2, " ".join(notice[:6])), (3, LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, grams = license_scan.places(docs, license_scan.PHRASES, license_scan.NOTICES)
    spans = [r for r in license_scan.spans(found, grams).collect() if r.label == "mit-notice"]
    words = alnum_words(rows[0][1])
    assert [(r.doc_id, r.first, words[r.last]) for r in spans] == [(1, 3, words[-2])]
    assert {r.doc_id: r.labels for r in license_scan.scan(docs).collect()} == {1: "mit-notice", 2: "", 3: ""}


# Decontamination


def brute_contamination(rows, items):
    windows = {}
    for item, text in items:
        words = alnum_words(text)
        for i in range(max(len(words) - 12, 1)) if words else ():
            windows.setdefault(tuple(words[i : i + 13]), set()).update([] if item is None else [str(item)])
    out = []
    for doc_id, text in rows:
        words = alnum_words(text)
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                own = windows.get(tuple(words[i : i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc_id or 0, len(words), len(hit), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out)


def contaminated_rows():
    items = [(k, prose(100 + k, 15 + k)) for k in range(6)] + [(6, prose(100, 15)), (7, "Short item here"), (8, ""), (9, None), (None, prose(9, 20)), (10, "cc")]
    texts = [t for _, t in items if t]
    rows = [
        *AWKWARD,
        (30, prose(3, 60) + " " + "".join(c.upper() if c.isascii() else c for c in texts[0]) + " " + prose(4, 60)),
        (31, texts[1] + " " + texts[1]),
        (32, LONG + " " + texts[2]),
        (33, "a short ITEM here; short item here"),
        (34, " ".join(texts[3].split()[2:14])),
        (35, "cc"),
        (36, "before " + texts[-2] + " after"),
        *((40 + k, texts[4]) for k in range(5)),
    ]
    return rows, items


@pytest.mark.parametrize("at_once", [200_000, 7])
def test_contamination_equals_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(decontamination, "WINDOWS_AT_ONCE", at_once)
    rows, items = contaminated_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(with_clashing_columns(spark, rows), bench).collect()
    mine = sorted((r.doc_id or 0, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in got)
    assert mine == brute_contamination(rows, items)


def test_contaminated_documents_and_spans_are_removed(spark):
    rows, items = contaminated_rows()
    docs, bench = with_clashing_columns(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    clean = decontamination.without_contaminated(docs, bench)
    bad = [(i, n) for i, n, _, _, flag in brute_contamination(rows, items) if flag]
    assert clean.columns == docs.columns and clean.count() == len(rows) - len(bad)
    cut = {r.doc_id: r.text for r in decontamination.without_spans(docs, bench).where("doc_id in (2, 30, 33)").collect()}
    assert alnum_words(cut[30]) == alnum_words(prose(3, 60)) + alnum_words(prose(4, 60))
    assert (cut[2], cut[33]) == ("", "a ")
    assert decontamination.without_spans(docs, bench).count() == len(rows)


def test_empty_benchmark_and_empty_documents(spark):
    docs, none = with_clashing_columns(spark, AWKWARD), spark.createDataFrame([], "item_id long, text string")
    got = decontamination.contamination(docs, none).collect()
    assert len(got) == len(AWKWARD) and not any(r.contaminated or r.n_hit or r["items"] for r in got)
    assert decontamination.contamination(docs.limit(0), spark.createDataFrame([(1, LONG)], "item_id long, text string")).count() == 0


def test_equal_rows_are_no_hot_key(spark):
    same = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    docs = same.union(spark.createDataFrame([(k % 2, "mit license, short item here") for k in range(4)], "doc_id long, text string"))
    bench = spark.createDataFrame([(None, "short item here")], "item_id long, text string")
    got = decontamination.contamination(docs, bench).groupBy("doc_id", "n_words", "n_hit", "n_items").count().collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got) == [(-1, 0, 0, 0, 200_000), (0, 5, 3, 0, 2), (1, 5, 3, 0, 2)]
    got = license_scan.scan(docs).groupBy("doc_id", "n_words", "n_base").count().collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got) == [(-1, 0, 0, 200_000), (0, 5, 1, 2), (1, 5, 1, 2)]


# Near duplicates


def brute_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = spaced_words(text)
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                group[top(a)] = top(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = least.setdefault(top(i), [])
        ids.append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        known = [d for d in least[top(i)] if d is not None]
        component = doc_id if not sets[i] else (min(known) if known else None)
        out.append((doc_id or 0, len(sets[i]), component or 0, doc_id == component))
    return sorted(out)


def edited(seed, text, changes):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def near_rows():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(2_000)]
    fresh = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, other, passage = fresh(200), fresh(300), fresh(60)
    chain = [fresh(150)]
    for k in range(6):
        chain.append(edited(k, chain[-1], 4))
    rows = [
        *AWKWARD,
        *((100 + k, edited(k, base, k % 9)) for k in range(60)),
        *((200 + k, other) for k in range(25)),
        *((300 + k, t) for k, t in enumerate(chain)),
        *((400 + k, passage + " " + fresh(40 + k)) for k in range(40)),
        *((500 + k, "in in in of of of " * (k % 3 + 1) + f"tail{k % 11}") for k in range(40)),
        (600, LONG),
        (601, LONG + " end"),
    ]
    rng.shuffle(rows)
    return rows


def test_least_overlap_is_the_exact_binomial_tail():
    rng = np.random.default_rng(1)
    for percent, sketch in ((85, 64), (80, 64), (90, 64), (50, 32), (85, 256)):
        least = near_duplicates.least_overlap(percent, sketch)
        chances = [Fraction(percent, 100) ** k * Fraction(100 - percent, 100) ** (sketch - k) * math.comb(sketch, k) for k in range(sketch)]
        assert sum(chances[:least]) <= near_duplicates.MISS_CHANCE < sum(chances[: least + 1])
        assert rng.binomial(sketch, percent / 100, 100_000).min() >= least
    assert near_duplicates.least_overlap(100, 64) == 64


@pytest.mark.parametrize(("percent", "apart", "n"), [(85, 26, 200), (80, 30, 180)])
def test_a_pair_with_little_sketch_overlap_is_found(spark, percent, apart, n):
    # Of the 64 smallest hashes of both texts' words, ``apart`` are in one text alone, and no others are.
    words = sorted((f"w{k}" for k in range(n)), key=lambda w: next(near_duplicates.shingle_sets([w], 1))[0])
    alone, common = words[:apart], words[apart:]
    rows = [(1, " ".join(alone[::2] + common)), (2, " ".join(alone[1::2] + common)), (3, " ".join(f"z{k}" for k in range(n)))]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize(("words", "percent", "small", "fine"), [(3, 85, 64, 1024), (5, 80, 2, 4)])
def test_components_equal_brute_force(spark, monkeypatch, words, percent, small, fine):
    monkeypatch.setattr(near_duplicates, "SMALL_LIST", small)
    monkeypatch.setattr(near_duplicates, "SMALL_FINE_LIST", fine)
    rows = near_rows()
    if small < 64:  # every list is large, so the last rounds run as well
        rows = [r for r in rows if (r[0] or 0) < 120 or 300 <= r[0] < 400]
    got = near_duplicates.near_duplicates(with_clashing_columns(spark, rows), words, percent).collect()
    mine = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got)
    assert mine == brute_components(rows, words, percent)


def rows_around_one_text():
    """Most of them just not linked with it, and a few alike, but not like it."""
    rng = random.Random(8)
    base = " ".join(f"w{rng.randrange(900)}" for _ in range(200))
    rows = [(k, edited(k, base, 6 + k % 3 if k % 4 else 2 + k % 5)) for k in range(60)]
    return rows + [(100 + k, edited(k, edited(7, base, 7), k % 4)) for k in range(8)]


def large_lists(monkeypatch, a_member, most):
    """Every list is large; more rounds than ``most`` are an error."""
    monkeypatch.setattr(near_duplicates, "SMALL_LIST", 2)
    monkeypatch.setattr(near_duplicates, "SMALL_FINE_LIST", 4)
    monkeypatch.setattr(near_duplicates, "PAIRS_A_MEMBER", a_member, raising=False)
    monkeypatch.setattr(near_duplicates, "PAIRS_AT_ONCE", 1, raising=False)
    rounds, confirm = [], near_duplicates._Links.confirm

    def counted(links, pairs, *more):
        rounds.append(1)
        assert len(rounds) <= most, "a round for each member"
        return confirm(links, pairs, *more)

    monkeypatch.setattr(near_duplicates._Links, "confirm", counted)


@pytest.mark.parametrize(("words", "percent", "a_member", "most"), [(3, 85, 32, 4), (5, 80, 1, 40)])
def test_many_texts_just_too_far_apart_take_few_rounds(spark, monkeypatch, words, percent, a_member, most):
    large_lists(monkeypatch, a_member, most)
    rows = rows_around_one_text()
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect()
    mine = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)
    assert mine == brute_components(rows, words, percent)
    assert len({c for _, _, c, _ in mine}) > 20


def test_the_stage_keeps_one_of_each_group_in_few_rounds(spark, monkeypatch):
    large_lists(monkeypatch, 32, 4)
    rows = rows_around_one_text()
    kept = near_duplicates.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [i for i, _, _, stays in brute_components(rows, 5, 80) if stays]


def test_one_document_of_each_group_stays(spark):
    rows = near_rows()
    docs = with_clashing_columns(spark, rows)
    kept = near_duplicates.without_near_duplicates(docs, 3, 85)
    assert kept.columns == docs.columns
    truth = brute_components(rows, 3, 85)
    assert sorted(r.doc_id or 0 for r in kept.where("doc_id >= 100").collect()) == sorted({i for i, _, _, stays in truth if stays and i >= 100})
    small = sorted((r.doc_id or 0, r.text or "") for r in kept.where("doc_id < 100 OR doc_id IS NULL").collect())
    assert small == sorted({(i or 0, t or "") for i, t in AWKWARD})
    assert near_duplicates.without_near_duplicates(docs.limit(0)).count() == 0


# Quality


def test_rules_score_like_their_compiled_form_and_hold_out(spark):
    rng = random.Random(3)
    good = [prose(1000 + k, 20 + rng.randrange(200)) for k in range(400)]
    bad = [" ".join([rng.choice(["As", "du", "éai"])] * (30 + rng.randrange(100))) for _ in range(200)]
    rows = [(k, t) for k, t in enumerate(good + bad)]
    docs = spark.createDataFrame([*rows, *((None if i is None else i + 10_000, t) for i, t in AWKWARD)], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("x")).withColumn("predicted", F.lit("y")).withColumn("lang", F.lit("en"))
    known = [(k, int(k < 400), 0) for k, _ in rows] + [(None, 1, 0), (3, None, 0), (5, 7, 0)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    x, y = quality_rules.training_sample(docs, labels)
    assert len(y) == sum(zlib_crc(k) % 3 != 1 for k, _ in rows)
    model = quality_rules.fit_rules(x, y)
    assert 0 < len(model.rules) and quality_rules.fit(docs, labels) == model
    got = {r.doc_id: r for r in quality_rules.scored(docs, model).where("doc_id < 10000").collect()}
    held = [k for k, _ in rows if zlib_crc(k) % 3 == 1]
    assert np.mean([got[k].predicted == int(k < 400) for k in held]) > 0.97
    total = sum(np.array([w * quality_rules._fires(rule, x) for rule, w in model.rules])) + model.intercept
    by_hand = sorted(1 / (1 + np.exp(-total)))
    trained = [k for k, _ in rows if zlib_crc(k) % 3 != 1]
    assert by_hand == pytest.approx(sorted(got[k].score for k in trained), abs=1e-9)
    every = quality_rules.scored(docs, model)
    assert every.count() == docs.count() and every.where("score IS NULL OR NOT score BETWEEN 0 AND 1").isEmpty()
    assert every.columns == ["doc_id", "text", "lang", "score", "predicted"]
    assert quality_rules.scored(docs.limit(0), model).count() == 0


def zlib_crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_a_filter_on_the_prediction_does_not_repeat_the_statistics(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, len(quality_rules.STATISTICS)))
    model = quality_rules.fit_rules(x, (x[:, 0] + x[:, 1] > 0).astype(float))
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").repartition(2)
    rows = quality_rules.scored(docs, model)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (rows, rows.where("predicted = 1"))]
    assert plans[1].count("regexp_replace") == plans[0].count("regexp_replace") > 0


def test_without_labels_the_score_is_constant(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = quality_rules.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {(r.score, r.predicted) for r in quality_rules.scored(docs, model).collect()} == {(0.5, 1)}

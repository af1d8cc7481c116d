"""Operators on pairs, vectors, models and benchmark items."""

import math
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from seriesmart.llm import decontaminate as D
from seriesmart.llm.components import components
from seriesmart.llm.jaccard import Measure, jaccard_join, light_boundary, subset_keys
from seriesmart.llm.licenses import TEMPLATES, scan
from seriesmart.llm.quality import FEATURES, features, fit, score, train
from seriesmart.llm.vector_search import build_graph, nearest, robust_prune


# --- components ---------------------------------------------------------------

def brute_components(edges):
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    df = spark.createDataFrame([*edges, (None, 5), (7, 7)], "u long, v long")
    want = {k: v for k, v in brute_components([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


# --- n-gram Jaccard join --------------------------------------------------------

def brute_sets(rows, k):
    out = {}
    for i, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        out[i] = {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute_jaccard(rows, k, num, den):
    sets = brute_sets(rows, k)
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    comp = brute_components(links)
    return {i: (len(sets[i]), comp.get(i, i)) for i in ids}


def near_copies(rng, n, length, edits, vocabulary=200):
    words = [f"w{i}" for i in range(vocabulary)]
    base = [rng.choice(words) for _ in range(length)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        if rng.random() < .3:
            copy = copy[:-rng.randint(1, 3)]
        yield " ".join(copy)


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (2, 60, 100), (1, 1, 1)])
def test_jaccard_join_equals_brute_force(docs_of, k, num, den):
    rng = random.Random(k)
    texts = []
    for length, edits in ((6, 1), (9, 1), (14, 1), (22, 1), (40, 2), (120, 5), (300, 9)):
        texts += list(near_copies(rng, 14, length, edits))
    texts += ["Same Text here now", "same text HERE now", "same", "same", "", None, " \n ", "a b", "a b c", "word " * 60, "word " * 61]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(docs_of(rows), k, num, den).collect()}
    assert got == brute_jaccard(rows, k, num, den)


def test_jaccard_blocks_and_rounds(docs_of, monkeypatch):
    import seriesmart.llm.jaccard as module
    monkeypatch.setattr(module, "BLOCK", 3)
    rng = random.Random(11)
    rows = list(enumerate([*near_copies(rng, 40, 60, 4), *near_copies(rng, 20, 12, 1)]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(docs_of(rows), 3, 70, 100, rounds=0).collect()}
    assert got == brute_jaccard(rows, 3, 70, 100)


def test_jaccard_nulls_and_repeated_ids(docs_of):
    rows = [(5, "one two three four"), (3, "one two three four"), (3, "nothing like it at all"), (None, "one two three four"),
            (None, None), (9, None)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in jaccard_join(docs_of(rows)).collect())
    assert got == [(-1, 0, -1), (-1, 1, 3), (3, 1, 3), (3, 2, 3), (5, 1, 3), (9, 0, 9)]
    assert jaccard_join(docs_of(rows).limit(0)).count() == 0


def test_light_sets_share_a_subset():
    m, rng = Measure(85, 100), random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 16)
        a = sorted(rng.sample(range(1000), n))
        b = sorted(set(a[:-1] if rng.random() < .5 and n > 1 else a) | set(rng.sample(range(1000), rng.randint(0, 1))))
        s, t = np.array(a, np.uint64), np.array(b, np.uint64)
        if m.links(s, t):
            assert len(np.intersect1d(subset_keys(s, 0, m, 18), subset_keys(t, 0, m, 18)))
    assert light_boundary([], 1.0, m) >= 0
    assert light_boundary([(a, 10) for a in range(1, 25)], 0.0, m) < light_boundary([(a, 10) for a in range(1, 25)], 500.0, m)


# --- vectors --------------------------------------------------------------------

def test_nearest_recall_and_exact_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    x = (centres[rng.integers(0, 12, 1200)] + 0.5 * rng.normal(size=(1200, 24))).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in nearest(df, df.where("vec_id % 25 = 0"), k=10, shard_rows=400).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = 0
    for q in range(0, 1200, 25):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(1200), d))[:10]
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(math.isclose(f[2], d[f[1]], rel_tol=1e-12) for f in found)
        hit += len(set(want) & {f[1] for f in found})
    assert hit / 480 >= 0.9


def test_nearest_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [2.0, 0.0]), (9, [1.5, 0.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id, r.score) for r in nearest(df, df.where("vec_id = 0"), k=3).collect())
    assert got == [(1, 1, 0.0), (2, 2, 0.0), (3, 9, 0.5)]  # ties to the smaller id, a repeated id once
    assert nearest(df, df.where("vec_id in (3, 4, 5)")).count() == 0
    assert nearest(df.limit(0), df.where("vec_id = 0")).count() == 0
    # Many copies of one vector: all are found through their node.
    same = spark.createDataFrame([(i, [3.0, 4.0]) for i in range(300)], "vec_id long, embedding array<double>")
    ids = [r.vec_id for r in nearest(same, same.where("vec_id = 100"), k=5).orderBy("rank").collect()]
    assert ids == [0, 1, 2, 3, 4]


def test_nearest_repeated_rows_hide_nothing(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 6))
    x[20:28] = x[20]  # eight ids share a vector
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x) for _ in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, df.where("vec_id in (3, 20)"), k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    for q in (3, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        assert [i for _, i in sorted(got[q])] == np.lexsort((np.arange(40), d))[:10].tolist()
    # One id with more near vectors than a beam holds.
    near = [(1, [1.0 + i * 1e-4, 0.0]) for i in range(300)] + [(i, [5.0 + i, 1.0]) for i in range(2, 14)]
    many = spark.createDataFrame([(0, [1.0, 0.0]), *near], "vec_id long, embedding array<double>")
    ids = [r.vec_id for r in nearest(many, many.where("vec_id = 0"), k=10).orderBy("rank").collect()]
    assert ids == list(range(1, 11))


def test_robust_prune_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [5, 5]], np.float32)
    assert robust_prune(x, 0, np.arange(5), 1.2, 4).tolist() == [1, 3]
    graph, entry = build_graph(x)
    assert graph.shape[0] == 6 and 0 <= entry < 5


# --- quality ----------------------------------------------------------------------

GOOD = ["The weather was fine and we walked along the river until evening.",
        "Several studies describe the method, and its results agree with theory.",
        "She opened the window, looked at the garden and went back to work."]


def test_quality_on_held_out_rows(spark, docs_of):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(240):
        base = " ".join(rng.sample(" ".join(GOOD).split(), 20)) + "."
        bad = i % 4 == 0
        junk = rng.choice([base.upper().replace(" ", "!! "), " ".join(w + "%%%" for w in base.split()), "spam " * 30])
        rows.append((i, junk if bad else base))
        marks.append((i, int(not bad)))
    docs = docs_of(rows)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    ranking = train(docs, labels.where("doc_id % 5 <> 0"), max_labelled=100)
    out = {r.doc_id: r for r in score(docs, ranking).collect()}
    held = [i for i in range(240) if i % 5 == 0]
    right = sum(out[i].predicted == marks[i][1] for i in held) / len(held)
    assert right >= 0.95 and all(0 <= r.score <= 1 for r in out.values())
    assert set(docs.columns) < set(score(docs, ranking).columns)


def test_quality_edges(spark, docs_of):
    assert len(features("")) == len(features("x " * 9)) == len(FEATURES)
    docs = docs_of([(1, None), (2, ""), (2, ""), (3, "word " * 30000)])
    none = spark.createDataFrame([(None, 1), (1, None), (7, 0)], "doc_id long, quality int")
    ranking = train(docs, none)  # no labelled document: everything stays
    assert [r.predicted for r in score(docs, ranking).collect()] == [1] * 4
    torn = spark.createDataFrame([(3, 1), (3, 0), (2, 1)], "doc_id long, quality int")
    assert train(docs, torn).weights == (0.0,) * len(FEATURES)  # conflicting labels count for nothing
    x = np.array([[0.0] * len(FEATURES), [1.0] * len(FEATURES)])
    assert list(fit(x, np.array([0, 1])).scores(x) >= 0.3) == [False, True]
    assert score(docs.limit(0), ranking).count() == 0


# --- licences -----------------------------------------------------------------------

def test_quality_repeated_labelled_id_counts_once(docs_of, spark):
    """An id of many rows comes back as one, with the mean of its rows' features."""
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    rows = [(2, "bad !!! $$$"), (3, "more ### bad")]
    once = train(docs_of([(1, "a good text of some words"), *rows]), labels)
    many = train(docs_of([(1, "a good text of some words")] * 500 + rows), labels)
    assert np.allclose(once.weights, many.weights) and np.allclose(once.mean, many.mean)
    two = train(docs_of([(1, "a good text of some words"), (1, "another"), *rows]), labels)
    x = [features(t) for t in ("a good text of some words", "another")]
    assert np.allclose(np.array(two.mean) * 3, np.mean(x, axis=0) + features(rows[0][1]) + features(rows[1][1]))


def test_quality_fit_solves_the_pairwise_loss():
    """Weights against plain gradient descent on the loss of all preference pairs."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, len(FEATURES)))
    y = (x[:, 0] + 0.5 * x[:, 3] + rng.normal(size=60) > 0).astype(int)
    got = np.array(fit(x, y).weights)
    z = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-3), -8, 8)
    good, bad = z[y == 1], z[y == 0]
    few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
    rounds = max(16, -(-len(many) // len(few)))
    i, j = np.tile(few, (rounds, 1)), many[np.arange(len(few) * rounds) % len(many)]
    diff = j - i if few is bad else i - j
    w = np.zeros(len(FEATURES))
    for _ in range(20000):
        w -= 0.5 * (-(diff / (1 + np.exp(diff @ w))[:, None]).mean(0) + 1e-2 * w)
    assert np.allclose(got, w, atol=1e-5)


def test_license_scan(docs_of):
    prose = "\n".join(GOOD)
    rows = [(1, prose + "\nReleased under the MIT License."), (2, "Licensed under the Apache License, Version 2.0.\n" + prose),
            (3, prose), (4, None), (5, ""), (6, "\n\n  \n"), (7, "All rights reserved."), (7, "All rights reserved."),
            (8, "This work is licensed under the terms of the Frobnicate Licence Agreement."),
            (None, "Licensed under CC BY-NC 4.0."), (9, "word " * 30000)]
    got = sorted(((r.doc_id or 0, r.paragraph, r.family, r.confirmed) for r in scan(docs_of(rows)).collect()))
    assert [g for g in got if g[0] != 8] == [
        (0, 0, "cc-by-nc", True), (1, 3, "mit", True), (2, 0, "apache-2.0", True),
        (7, 0, "all-rights-reserved", True), (7, 0, "all-rights-reserved", True)]
    assert not any(g[3] for g in got if g[0] == 8)
    assert scan(docs_of(rows).limit(0)).count() == 0


def test_license_scan_equals_a_plain_version(docs_of):
    """Similarity and confirmation of every reported paragraph, worked out by sets of word pairs."""
    def pairs(t):
        w = [x for x in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if x]
        return set(" ".join(p) for p in zip(w, w[1:])) if len(w) > 1 else set(w)

    notices = [t for f, ts in sorted(TEMPLATES.items()) for t in ts]
    text = {i: t + "\n" + GOOD[i % len(GOOD)] for i, t in enumerate(notices)}
    got = scan(docs_of(list(text.items()))).collect()
    assert len({r.doc_id for r in got}) >= len(notices) - 1
    for r in got:
        mine = pairs(text[r.doc_id].split("\n")[r.paragraph])
        near = max(len(pairs(t) & mine) / len(pairs(t)) for t in TEMPLATES[r.family])
        assert abs(near - r.similarity) < 1e-12 and r.confirmed == (near >= 0.6 and r.family != "unknown")


def test_license_scan_keeps_frequent_notices_without_a_template(docs_of):
    rng = random.Random(8)
    words = " ".join(GOOD).split()
    prose = lambda: "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(4))
    notice = "Distributed under the Boost Software License"
    rows = [(i, prose() + ("\n" + notice if i % 3 == 0 else "")) for i in range(90)]
    rows.append((90, "Released under the MIT License."))
    got = {r.doc_id: r for r in scan(docs_of(rows)).collect()}
    assert set(got) == {*range(0, 90, 3), 90}
    assert got[90].family == "mit" and got[90].confirmed
    assert not any(got[i].confirmed for i in range(0, 90, 3)) and {got[i].paragraph for i in range(0, 90, 3)} == {4}


# --- benchmark decontamination --------------------------------------------------------

def brute_template(text):
    """Template words and slot values, by the same rules in another engine."""
    t = regex.sub(r"(\p{Lu}(?<=[\p{Ll}\p{N},;:] .)\p{Ll}+)", "\ue001\\1", text or "")
    t = regex.sub(r"[.,](?<=[0-9].)(?=[0-9])", "", t)
    t = regex.sub(r"([0-9]) ?(?i:(" + "|".join(sorted(D.UNITS, key=len, reverse=True)) + r"))(?!\p{L})", "\\1 \ue002\\2", t)
    t = regex.sub(r"([0-9](?<![\p{L}\p{N}][0-9])[0-9]*)(?!\p{L})", "\ue000\\1", t)
    words = [w for w in regex.split(r"[^\p{L}\p{N}\ue000-\ue002]+", t.lower()) if w]
    return [w[0] if "\ue000" <= w[0] <= "\ue002" else w for w in words], words


def brute_leaks(rows, items, window, coverage):
    def windows(text):
        plain, full = brute_template(text)
        n = max(len(plain) - window + 1, 1) if plain else 0
        return {a: (tuple(plain[a:a + window]), [w for w in full[a:a + window] if w[0] != "" and "\ue000" <= w[0] <= "\ue002"])
                for a in range(n)}

    out = set()
    for item, text in items:
        mine = {a: w for a, w in windows(text).items() if len(w[0]) >= 2 * len(w[1])}
        for d, t in rows:
            theirs, by_shift = windows(t), {}
            for a, (key, slots) in mine.items():
                for b, (other, values) in theirs.items():
                    if key == other:
                        by_shift.setdefault(b - a, []).append((a, list(zip(slots, values))))
            found = set()
            for matches in by_shift.values():
                pairs = {p for _, ps in matches for p in ps}
                if len(pairs) == len({p[0] for p in pairs}):
                    found |= {a for a, _ in matches}
            if mine and len(found) / len(mine) >= coverage:
                out.add((d, item))
    return out


def brute_verbatim(rows, items, window, coverage):
    """The same for plain words; an item under a window's length is one window."""
    plain = lambda t: [w[1:] if "\ue000" <= w[0] <= "\ue002" else w for w in brute_template(t)[1]]
    out = set()
    for item, text in items:
        words = plain(text)
        n = min(window, len(words))
        mine = {a: tuple(words[a:a + n]) for a in range(len(words) - n + 1)} if words else {}
        for d, t in rows:
            theirs = plain(t)
            held = {tuple(theirs[a:a + n]) for a in range(len(theirs) - n + 1)} if n else set()
            if mine and sum(w in held for w in mine.values()) / len(mine) >= coverage:
                out.add((d, item))
    return out


def test_verbatim_leaks_equal_brute_force_on_the_tables(spark, docs_of):
    """The registered setting, over whole tables and over texts made from items' words."""
    d = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    rng = random.Random(9)
    made = []
    for k in range(60):  # parts of items of every length, in other texts
        words = rng.choice(items)[1].split()
        a, b = sorted(rng.sample(range(len(words) + 1), 2))
        made.append((10_000 + k, "Before. " + " ".join(words[a:b]) + " After it, more."))
    rows = [(r.doc_id, r.text) for r in docs.collect()] + made
    more = [*items, (900, "5 7 9"), (901, items[0][1].upper()), (900, "After it, more")]
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs_of(rows), spark.createDataFrame(more, "item_id long, text string"),
                                                  verbatim=True).collect()}
    unique = [i for i in more if i[0] != 900]
    want = brute_leaks(rows, unique, D.WINDOW, D.COVERAGE) | brute_verbatim(rows, unique, D.WINDOW, D.COVERAGE)
    assert {g for g in got if g[1] != 900} == want
    assert {g[0] for g in got if g[1] == 900} >= {10_000 + k for k in range(60)}  # one of the two texts of its id


@pytest.mark.parametrize("window,coverage", [(3, 0.3), (4, 1.0), (8, 0.7)])
def test_leaks_other_windows_and_shares(spark, docs_of, window, coverage):
    rng = random.Random(window)
    vocabulary = ["alpha", "beta", "gamma", "Delta", "7", "12", "km", "the", "of", "run"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(1, 14))) for i in range(25)]
    rows = [(i, text(8) + " " + rng.choice(items)[1] + " " + text(rng.randint(0, 6))) for i in range(60)]
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"),
                                                  window, coverage, verbatim=True).collect()}
    assert got == brute_leaks(rows, items, window, coverage) | brute_verbatim(rows, items, window, coverage)


ITEMS = [(1, "A train travels 120 km in 2 hours, then Maria drives 60 km more; how far did Maria and the train go in total?"),
         (2, "What is the capital of the old kingdom that lies beyond the seven hills near the long river?"),
         (3, "Three words only"), (4, None), (5, "5 7 9 11 13 15 17 19 21 23")]


def test_leaks_catch_new_parameters_and_check_slots(spark, docs_of):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(10, "Intro text. A train travels 345 km in 7 hours, then Peter drives 88 km more; how far did Peter and the train go in total? End."),
            # One name of the item stands for two names here: the slots disagree.
            (11, "A train travels 345 km in 7 hours, then Peter drives 88 km more; how far did Carol and the train go in total?"),
            (12, ITEMS[1][1]), (13, "Three words only"), (14, "There are three words only in this text, and some more besides."),
            (15, None), (16, ""), (17, "plain " * 20000), (12, ITEMS[1][1]), (None, ITEMS[1][1]), (18, ITEMS[4][1])]
    got = {(r.doc_id, r.item_id): r for r in D.leaks(docs_of(rows), bench).collect()}
    assert set(got) == brute_leaks([r for r in rows if r[0] is not None], ITEMS, D.WINDOW, D.COVERAGE)
    assert {(10, 1), (12, 2), (13, 3)} <= set(got) and (18, 5) not in got
    assert not got[10, 1].exact and got[12, 2].exact
    assert ("maria", "peter") in {(s.item, s.doc) for s in got[10, 1].slots}
    assert D.leaks(docs_of(rows).limit(0), bench).count() == 0
    assert D.leaks(docs_of(rows), bench.limit(0)).count() == 0


def test_leaks_equal_brute_force_on_the_tables(spark):
    d = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}
    want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()],
                       D.WINDOW, D.COVERAGE)
    assert got == want and got
    # The way beyond the broadcast bound gives the same.
    old, D.BROADCAST_ROWS = D.BROADCAST_ROWS, 0
    try:
        assert {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()} == want
    finally:
        D.BROADCAST_ROWS = old
    assert docs.where(F.col("doc_id") < 0).count() == 0


def test_leaks_find_placeholders_with_attached_characters(spark, docs_of):
    items = [(1, "How many videos do users upload to YouTube every day worldwide"),
             (2, "in which 20th century decade, the 1990s or later, was a 64bit chip sold by McDonald on 5 km2 of land")]
    rows = [(i, f"Some words stand before. {text} and others come after it.") for i, text in items]
    got = {(r.doc_id, r.item_id): r for r in D.leaks(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == {(1, 1), (2, 2)} == brute_leaks(rows, items, D.WINDOW, D.COVERAGE)
    assert all(r.exact and r.coverage == 1 for r in got.values())


def test_verbatim_leaks_leave_no_item_unfindable(spark, docs_of):
    names = "Was it Anna Smith, Peter Jones, Mary Brown, John White or Lucy Green who met Carl Black in Paris?"
    items = [*ITEMS, (6, names), (7, "Why?"), (8, "!!")]
    rows = [(1, "There are three words only in this text, and some more besides."), (2, f"Count on: {ITEMS[4][1]} and so on."),
            (3, names.lower()), (4, "He asked:\n" + names.replace(" ", "\n") + "\nNobody knew."), (5, "And WHY not, he said."),
            (6, "5 7 9 11 and nothing else of it"), (7, "words only three"), (8, None), (9, "!!"),
            (10, ITEMS[0][1].replace("120", "345").replace("Maria", "Peter")), (4, "why")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.leaks(docs_of(rows), bench, verbatim=True).collect()}
    assert set(got) == {(1, 3), (2, 5), (3, 6), (4, 6), (5, 7), (4, 7), (10, 1)}
    assert (got[2, 5].item_windows, got[2, 5].matched_windows, got[2, 5].start_word) == (3, 3, 2)
    assert got[3, 6].exact and not got[10, 1].exact and got[10, 1].slots and not got[1, 3].slots
    assert D.leaks(docs_of(rows).limit(0), bench, verbatim=True).count() == 0
    old, D.BROADCAST_ROWS = D.BROADCAST_ROWS, 0
    try:
        assert {(r.doc_id, r.item_id) for r in D.leaks(docs_of(rows), bench, verbatim=True).collect()} == set(got)
    finally:
        D.BROADCAST_ROWS = old

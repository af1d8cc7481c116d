"""Operators over whole corpora: tokenizer alignment, collocations, fingerprints."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesmart.llm import collocations as col
from seriesmart.llm.alignment import Aligner, align
from seriesmart.llm.bpe import byte_symbols
from seriesmart.llm.collocations import collocations, phrase_counts
from seriesmart.llm.fingerprints import Sketch, edited, fingerprints, shingles

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = ["", None, " ", "a", "Hello, world!  It's 12:30.\n\tTabs \x00 and <|endoftext|> <s> </s>", "naïve café — ½ ﬁ 日本語 🙂🙂",
         "x▁y holds the blank sign", "word " * 300, "a" * 1000, "\n\n  \n", "é" * 50, "trailing   ", "Hello, world!",
         "don't can't we'll I've", "...!!??--==", "ab" * 700 + " end", "𝔘𝔫𝔦 code", "﻿bom ​ zero width"]


# --- 11: alignment -----------------------------------------------------------

def brute_align(texts):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {s: b for b, s in byte_symbols().items()}
    a_raw = {i: bytes(back.get(c, 0) for c in s) for s, i in t.get_vocab().items()}

    def b_raw(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def spans(ids, raw):
        out, p = [], 0
        for i in ids:
            out.append((p, p + len(raw(i)), i))
            p = out[-1][1]
        return out

    rows, links, counts = [], [], Counter()
    for text in texts:
        text = text or ""
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        whole = (" " + text).encode()
        if not text or any(b"".join(map(raw, ids)) != whole for ids, raw in ((a, a_raw.get), (b, b_raw))):
            rows.append((0, 0, 0, 0, ""))
            links.append([])
            continue
        sa, sb = spans(a, a_raw.get), spans(b, b_raw)
        cuts = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        groups = ["|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in (sa, sb))
                  for lo, hi in zip([0, *cuts], cuts)]
        pairs = [(x, y) for s, e, x in sa for s2, e2, y in sb if s < e2 and s2 < e]
        links.append(pairs)
        counts.update(pairs)
        rows.append((len(a), len(b), len(cuts), len(pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(*r, sum(counts[p] == best[p[1]] for p in l), sum(counts[p] for p in l)) for r, l in zip(rows, links)]


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("heavy", [200_000, 3])
def test_alignment_against_brute_force(docs_of, heavy):
    """With a small bound most groups take the way over the shuffle."""
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in align(docs_of(list(enumerate(TEXTS))), A, B, heavy=heavy).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute_align(TEXTS)


def test_alignment_edges(spark, docs_of):
    empty = align(docs_of([]), A, B)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                    "groups_sha256"]
    rows = [(1, "some words"), (1, "some words"), (None, "some words"), (2, None)]
    clash = docs_of(rows).withColumns({c: F.lit("x") for c in ("n_a", "row", "plain", "odd", "g", "c", "best", "id")})
    got = sorted(align(clash, A, B).collect(), key=lambda r: (r.doc_id or 0, r.n_a))
    assert [r.doc_id for r in got] == [None, 1, 1, 2]
    one = brute_align(["some words"] * 3)[0]
    assert {tuple(r[f] for f in FIELDS) for r in got[:3]} == {one}
    assert tuple(got[3][f] for f in FIELDS) == (0, 0, 0, 0, "", 0, 0)


def test_links_of_a_group_of_many_tokens():
    """More tokens on a side than an id's width can count."""
    al = Aligner(open(A).read(), open(B, "rb").read())
    byte, seven = int(al.a.encode("!")[0]), next(i for i, raw in al.b.bytes.items() if len(raw) == 7)
    packed = np.array([*divmod(70_000, 1 << 16), *[byte] * 70_000, *[seven] * 10_000], al.width).tobytes()
    left, right = al.links(packed)
    assert left.tolist() == [byte] * 70_000 and right.tolist() == [seven] * 70_000


# --- 12: collocations --------------------------------------------------------

def brute_phrases(rows, min_count, top, max_words=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, max_words + 1):
                counts[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p in f if 1 < len(p) and f[p] >= min_count]
        rows = []
        for p in found:
            a, n = f[p], total[lang]
            score, _, l, r = min((int(Fraction(1000 * a * n, f[p[:k]] * f[p[k:]])), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * f[q] >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                       for q in found):
                rows.append((lang, " ".join(p), a, l, r, n, score))
        rows.sort(key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(x[0], i, *x[1:]) for i, x in enumerate(rows[:top], 1)]
    return sorted(out)


PHRASES = [("en", "The quick fox. The quick fox, the quick dog! New York City is big; new york city\nis old"),
           ("en", "the quick fox the quick fox the quick fox"), (None, "ja ja ja ja ja"), ("und", "ja ja"), ("fr", None), ("fr", ""),
           ("en", "\tnew\t york  city \x0bof New York City: ÀB àb ÀB àb"), ("de", "für immer für immer für immer 😀 a 😀 a é a"),
           ("en", "New York City is big. new york city is big")]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


@pytest.mark.parametrize("bits", [64, 6])
@pytest.mark.parametrize("min_count,top", [(1, 50), (2, 2000), (3, 2)])
def test_collocations_against_brute_force(spark, bits, min_count, top):
    """With few bits many phrases share a fingerprint and are counted by their texts."""
    got = collocations(_docs(spark, PHRASES * 2), min_count=min_count, top=top, fingerprint_bits=bits).collect()
    assert sorted(tuple(r) for r in got) == brute_phrases(PHRASES * 2, min_count, top)


def test_collocations_edges(spark):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for rows in ([], [("en", None), (None, "")], [("en", "no phrase is frequent")]):
        out = collocations(_docs(spark, rows))
        assert out.columns == names and out.count() == 0
    clash = _docs(spark, PHRASES).withColumns({c: F.lit(1) for c in ("n", "k", "phrase", "block", "words", "ids", "own", "f")})
    assert sorted(tuple(r) for r in collocations(clash, min_count=2).collect()) == brute_phrases(PHRASES, 2, 2000)


def test_counts_of_long_texts_cut_into_blocks(spark, monkeypatch):
    """Blocks of a few bytes, texts without any punctuation, one word longer than a block."""
    words = ["ab", "c", "déf", "ghijklmnopqrstuvw" * 9]
    rng = np.random.default_rng(5)
    text = " ".join(rng.choice(words, 400)) + ". " + " ".join(rng.choice(words, 100)) + ",c c c"
    raw = text.encode()
    for size in (40, 97, 1000):
        whole = Counter()
        for part, own in col.cuts(raw, 5, size):
            row = col.coded("en", part, own)
            if row is None:
                continue
            block = col.Block("en", row["words"], row["ids"], row["own"], (1 << 64) - 1)
            for k in range(1, 6):
                at = np.flatnonzero(block.room >= k)
                whole.update(block.phrase(i, k) for i in at[at < block.own].tolist())
        expected = Counter()
        for piece in re.split(r"[.,]", text):
            w = piece.split()
            expected.update(" ".join(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
        assert whole == expected


def test_block_of_many_distinct_words():
    """More distinct words than two bytes can number."""
    text = " ".join(f"w{i}" for i in range(70_000)) + ". w1 w2"
    row = col.coded("en", text.encode(), len(text))
    block = col.Block("en", row["words"], row["ids"], row["own"], (1 << 64) - 1)
    assert block.phrase(0, 5) == "w0 w1 w2 w3 w4" and block.room[69_999] == 1 and block.room[70_000] == 0
    assert block.prints(np.array([1, 70_001]), 2)[0] == block.prints(np.array([70_001]), 2)[0]


def test_word_totals(spark):
    _, totals = phrase_counts(_docs(spark, PHRASES), min_count=2)
    words = Counter()
    for lang, text in PHRASES:
        words[lang or "und"] += len(re.findall(r"[^\x20\x09-\x0D.,;:!?]+", text or ""))
    assert {r.lang: r.n for r in totals.collect()} == {k: n for k, n in words.items() if n}


# --- 13: fingerprints --------------------------------------------------------

def _texts(n, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "日本", "Zürich."]
    return [" ".join(rng.choice(words, rng.integers(1, 900))) for _ in range(n)]


def brute_rows(rows):
    """(id, n_chars, sha of the edited text) of (id, text) rows by plain sorting."""
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        first.setdefault(i, t or "")
    order = sorted((i for i in first if i is not None), reverse=True) + [None] * (None in first)
    after = {i: first[order[(k + 1) % len(order)]] for k, i in enumerate(order)}
    return Counter((i, len(t or ""), hashlib.sha256(edited(t or "", after[i]).encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("range_rows", [10_000, 7, 1])
def test_fingerprints_against_brute_force(docs_of, range_rows):
    texts = [*_texts(40), "", None, "a", "ab", "abc", "日本語テキスト", "   "]
    rows = [(3 * i - 20, t) for i, t in enumerate(texts)]
    got = fingerprints(docs_of(rows), range_rows=range_rows).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute_rows(rows)
    text = dict(rows)
    for r in got:
        assert r.fingerprint == Sketch.of((text[r.doc_id] or "").encode()).hex()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.n_chars < 3:
            assert r.near_edited == 1 and r.edited_fingerprint == r.fingerprint


@pytest.mark.parametrize("range_rows", [10_000, 3])
def test_repeated_and_null_ids(docs_of, range_rows):
    """An id of half of the rows and null ids are dealt over several ranges."""
    t = _texts(30, 1)
    rows = [(5, x) for x in t[:15]] + [(None, x) for x in t[15:22]] + [(i, x) for i, x in enumerate(t[22:], 2)]
    got = fingerprints(docs_of(rows), range_rows=range_rows).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute_rows(rows)


def test_fingerprint_edges(docs_of):
    assert fingerprints(docs_of([])).count() == 0
    for rows in ([(1, "one two three four five six")], [(None, "only a null id here"), (None, "and another one")], [(1, None)]):
        got = fingerprints(docs_of(rows).withColumns({c: F.lit(0) for c in ("range", "own", "place", "id", "near_next")})).collect()
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute_rows(rows)
    one = fingerprints(docs_of([(1, "same text"), (2, "same text"), (3, "")])).collect()
    by_id = {r.doc_id: r for r in one}
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[2].near_next == 1.0 and by_id[1].near_next == 0.0


def test_sketches_estimate_containment_and_merge():
    long, part = [" ".join(f"u{i}" for i in range(n)) for n in (20_000, 6_000)]
    a, b = Sketch.of(long.encode()), Sketch.of(part.encode())
    assert abs(b.containment(a) - 1) < 1e-9 and abs(a.containment(b) - 0.3) < 0.04 and abs(a.jaccard(b) - 0.3) < 0.04
    assert len(a.hashes) < 20_000 / 16 * 1.2
    other = Sketch.of(" ".join(f"v{i}" for i in range(3_000)).encode())
    both = Sketch.of((long + " " + " ".join(f"v{i}" for i in range(3_000))).encode())
    merged = a.merge(other)
    assert len(np.setxor1d(merged.hashes, both.hashes)) <= 4  # the shingles across the seam
    assert a.merge(b).hex() == a.hex() and b.merge(a).hex() == a.hex()
    assert Sketch.from_hex(a.hex()).containment(b) == a.containment(b)
    short = Sketch.of(b"a few words are kept whole in a sketch of their own")
    assert short.whole and len(short.hashes) == len(shingles(b"a few words are kept whole in a sketch of their own"))

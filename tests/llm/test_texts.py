"""Operators on texts against the libraries, brute force and exact round trips."""

import hashlib
import random
import struct
from collections import Counter

import pytest

from seriesmart.llm.bpe import WordEncoder, encode
from seriesmart.llm.line_dedup import apply_bitmaps, keep_bitmaps
from seriesmart.llm.queries import BYTE_BPE, WORD_BPE, tokenizer
from seriesmart.llm import substring_dedup
from seriesmart.llm.common import materialize
from seriesmart.llm.substring_dedup import COVERS, cover_for, dedup_substrings
from seriesmart.llm.suffix_dedup import remove_repeats
from seriesmart.llm.token_counts import Counter as TokenCounter
from seriesmart.llm.token_counts import token_counts

tokenizers = pytest.importorskip("tokenizers")

SPECIALS = ("<|endoftext|>", "<|startoftext|>", "<|endoftext|")
ALPHABET = ("abcXYZ's't're'll 0123  \n\t\x0b\x1c\x85\xa0 　éÉÀñßΣσςİıǅﬁ漢字かな☃€½²Ⅷ"
            "٣́ि한글각😀﻿​'DŽ'S'T\x00'' rvel----====")
ODD = ["", None, " ", "\n\n", "a" * 3000, "-" * 2000, "0" * 500, " " * 900, "x\x00y", "<|endoftext|><|endoftext|> a",
       "don't I'll 'tis we've", "Ab́c ΣΑΣ", "word " * 5000]


def random_text(rng, n=14):
    s = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, n)))
    return s + rng.choice(SPECIALS) + s if rng.random() < .2 else s


def test_word_bpe_equals_the_library():
    lib = tokenizers.Tokenizer.from_file(tokenizer(WORD_BPE))
    own = WordEncoder(open(tokenizer(WORD_BPE), encoding="utf-8").read())
    rng = random.Random(1)
    for text in [*filter(None, ODD), *(random_text(rng) for _ in range(3000))]:
        want = lib.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        decoded = own.decode(ids)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, repr(text)
        assert decoded == lib.decode(want, skip_special_tokens=False), repr(text)


def test_merge_order_and_stale_entries():
    own = WordEncoder(open(tokenizer(WORD_BPE), encoding="utf-8").read())
    # Every vocabulary word that merges reach comes back as itself.
    for word in ("the", "ing", "running", "aaaaaaa", "banana"):
        assert own.decode(own.word(word)).replace(" ", "") == word + "</w>"


def test_encode_frame(spark, docs_of):
    docs = docs_of([*enumerate(ODD), (0, ""), (None, "null id")]).withColumnRenamed("lang", "n_tokens")
    got = encode(docs, tokenizer(WORD_BPE)).collect()
    assert len(got) == len(ODD) + 2
    empty = [r for r in got if r.doc_id == 0]
    assert [(r.n_tokens, r.ids_sha256) for r in empty] == [(0, hashlib.sha256(b"").hexdigest())] * 2
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert encode(docs.limit(0), tokenizer(WORD_BPE)).count() == 0


@pytest.mark.parametrize("chunk", [1 << 14, 1, 2, 5])
def test_token_counts_equal_the_library(chunk):
    lib = tokenizers.Tokenizer.from_file(tokenizer(BYTE_BPE))
    own = TokenCounter(open(tokenizer(BYTE_BPE), encoding="utf-8").read())
    rng = random.Random(chunk)
    texts = [*filter(None, ODD), *(random_text(rng) for _ in range(1500))]
    for text in texts if chunk > 100 else [t for t in texts if len(t) < 100]:
        assert own.count(text, chunk) == len(lib.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_counts_when_few_states_are_kept(monkeypatch):
    import seriesmart.llm.token_counts as module
    monkeypatch.setattr(module, "MAX_STATES", 20)
    monkeypatch.setattr(module, "MEMO_RUNS", 3)
    lib = tokenizers.Tokenizer.from_file(tokenizer(BYTE_BPE))
    own = TokenCounter(open(tokenizer(BYTE_BPE), encoding="utf-8").read())
    rng = random.Random(9)
    for text in (random_text(rng, 30) for _ in range(300)):
        assert own.count(text) == len(lib.encode(text, add_special_tokens=False).ids), repr(text)


def test_chunk_maps_compose_in_any_bracketing():
    own = TokenCounter(open(tokenizer(BYTE_BPE), encoding="utf-8").read())
    text = "We've 12 apples,  and\n\nthey're  ripe -- aren't they?"
    maps = [own.chunk_map(text[i:i + 7]) for i in range(0, len(text), 7)]
    left = maps[0]
    for m in maps[1:]:
        left = own.compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = own.compose(m, right)
    total = lambda m: own.span(m[0]) + (m[1] or 0) + own.span(m[2])
    assert total(left) == total(right) == total(own.scan(maps)) == own.count(text)


@pytest.mark.parametrize("long,chunk", [(0, 3), (40, 7), (200, 16)])
def test_token_counts_by_parallel_scan(docs_of, long, chunk):
    """Texts whose chunks are rows of their own: special strings cut by a chunk's end,
    chunks in which nothing synchronises, several levels of the scan."""
    texts = [*ODD, "word and <|endoftext|> word " * 40, "x" * 500, "a1" * 300 + " <|endoftext|>", "<|endoftext|>" * 3, None, ""]
    lib = tokenizers.Tokenizer.from_file(tokenizer(BYTE_BPE))
    got = token_counts(docs_of([*enumerate(texts), (None, texts[0]), (0, texts[0])]), tokenizer(BYTE_BPE), long=long, chunk=chunk)
    want = [(i, t or "") for i, t in [*enumerate(texts), (None, texts[0]), (0, texts[0])]]
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == Counter(
        (i, len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids)) for i, t in want)


def test_token_counts_frame(docs_of):
    got = token_counts(docs_of([*enumerate(ODD), (0, "")]), tokenizer(BYTE_BPE), limit=1024).collect()
    assert len(got) == len(ODD) + 1
    by = {r.doc_id: r for r in got}
    assert (by[1].n_bytes, by[1].n_tokens, by[1].over_limit) == (0, 0, False)
    assert by[12].over_limit and by[12].n_tokens > 1024


# --- line deduplication -------------------------------------------------------

def brute_lines(rows, min_docs):
    strip = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(strip))
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(i)
    common = {k for k, v in holders.items() if len(k) >= 1 and len(v) >= min_docs}
    return {i: ((len(t.split("\n")) if t else 1), "\n".join(x for x in (t or "").split("\n") if key(x) not in common))
            for i, t in rows}


def test_line_dedup_equals_brute_force(spark, docs_of):
    rng = random.Random(4)
    pool = ["Shared LINE", " shared line\t", "ÉTÉ", "été", "", "  ", "x\x0b", "rare"] + [f"own {i}" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(30)]
    rows += [(100, None), (101, ""), (102, "Shared LINE"), (103, "\n".join(["rare"] * 5000))]
    docs = docs_of(rows)
    got = {r.doc_id: (r.n_lines, r.text or "") for r in apply_bitmaps(docs, keep_bitmaps(docs, min_docs=5)).collect()}
    assert got == brute_lines(rows, 5)


def test_line_dedup_edges(spark, docs_of):
    docs = docs_of([(1, "a\nb"), (1, "a\nc"), (2, "a"), (None, "a"), (3, None)])
    marks = keep_bitmaps(docs, min_docs=2)
    assert {(r.doc_id, tuple(map(tuple, r.drops))) for r in marks.collect()} == {(1, ((0, 1),)), (2, ((0, 1),))}
    out = {(r.doc_id, r.text) for r in apply_bitmaps(docs, marks).collect()}
    assert out == {(1, "b"), (1, "c"), (2, ""), (None, "a"), (3, None)}
    assert apply_bitmaps(docs.limit(0), keep_bitmaps(docs.limit(0))).count() == 0


# --- repeated byte strings ----------------------------------------------------

def brute_bytes(rows, length):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("length,alphabet,max_pieces", [(8, "ab", 10 ** 6), (13, "abcd ", 10 ** 6), (40, "abcdefg ", 10 ** 6),
                                                         (13, "ab", 2), (40, "abcd", 1)])
def test_suffix_dedup_equals_brute_force(docs_of, length, alphabet, max_pieces):
    rng = random.Random(length)
    base = "".join(rng.choice(alphabet) for _ in range(400))
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 350)
            parts.append(base[a:a + rng.randint(1, 3 * length)] if rng.random() < .5 else
                         "".join(rng.choice(alphabet + "é") for _ in range(rng.randint(0, 2 * length))))
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "a" * 3 * length), (103, base), (104, base)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in remove_repeats(docs_of(rows), length, max_pieces=max_pieces).collect()}
    assert got == brute_bytes(rows, length)


def test_suffix_dedup_repeated_ids_and_nulls(docs_of):
    same = "the same text, over and over"
    rows = [(1, same), (1, "other words entirely here"), (None, same), (None, None), (2, "short")]
    got = sorted((r.doc_id or 0, r.n_removed) for r in remove_repeats(docs_of(rows), 20).collect())
    assert got == [(0, 0), (0, len(same)), (1, 0), (1, len(same)), (2, 0)]
    assert remove_repeats(docs_of(rows).limit(0), 20).count() == 0


# --- repeated word windows ----------------------------------------------------

def brute_words(rows, window):
    docs = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i, w in docs.items():
        for a in range(len(w) - window + 1):
            k = tuple(w[a:a + window])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, w in docs.items():
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < i:
                gone[a:a + window] = [True] * window
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_covers_hold_every_difference():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert cover_for(50) == (31, COVERS[31], 20) and cover_for(1)[2] == 1


@pytest.mark.parametrize("window,vocabulary", [(50, 400), (9, 3), (4, 12), (1, 30)])
def test_substring_dedup_equals_brute_force(docs_of, window, vocabulary):
    rng = random.Random(window)
    words = [f"w{i}" for i in range(vocabulary)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 280)
            parts += (base[a:a + rng.randint(1, 2 * window)] if rng.random() < .5
                      else [rng.choice(words) for _ in range(rng.randint(0, window))])
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(100, None), (101, ""), (102, " \n"), (103, " ".join(base)), (104, " ".join(base))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in dedup_substrings(docs_of(rows), window).collect()}
    assert got == brute_words(rows, window)


def test_substring_dedup_leaves_exact_copies_out_of_the_comparison(docs_of, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    base, other = ([rng.choice(words) for _ in range(300)] for _ in range(2))
    part = " ".join(base[100:180])
    rows = [(i, " ".join(base)) for i in range(40)] + [(50, part), (50, "b " + part), (60, part)]
    rows += [(-1, "x " + part)] + [(i, " ".join(other)) for i in range(100, 140)] + [(200, "short"), (201, "short")]
    rows.remove((7, " ".join(base)))
    rows += [(7, " ".join(base)), (7, " ".join(other))]  # an id with two texts
    written = {}

    def recorded(df, name, *args):
        out = materialize(df, name, *args)
        written[name] = out.collect()
        return out
    monkeypatch.setattr(substring_dedup, "materialize", recorded)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in dedup_substrings(docs_of(rows), 50).collect())
    expected = sorted((i, len(t.split()), *plain_removal(rows, i, t, 50)) for i, t in rows)
    assert got == expected
    # One row for each different text that shares anchors, however many copies it has.
    assert len(written["substring-anchors"]) <= len({t for _, t in rows})
    assert max(len(r.hs) for r in written["substring-anchors"]) < 80


def plain_removal(rows, doc_id, text, window):
    ws = text.split()
    before = {tuple(v[i:i + window]) for d, t in rows if d < doc_id for v in [t.split()] for i in range(len(v) - window + 1)}
    gone = {p for i in range(len(ws) - window + 1) if tuple(ws[i:i + window]) in before for p in range(i, i + window)}
    return len(gone), " ".join(w for p, w in enumerate(ws) if p not in gone)


def test_substring_dedup_repeated_ids_and_nulls(docs_of):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "x a b c"), (None, None)]
    got = sorted((r.doc_id or 0, r.n_removed, r.kept) for r in dedup_substrings(docs_of(rows), 3).collect())
    assert got == [(0, 0, ""), (0, 0, "a b c"), (1, 0, "a b c"), (1, 0, "a b c"), (2, 3, "x")]
    assert dedup_substrings(docs_of(rows).limit(0), 3).count() == 0

"""Operator 12: phrase collocation mining.

Texts are coded once into blocks of one language: the block's distinct words and
an array of word numbers, cut where a phrase may not run on. Level by level (one
word to ``max_words``), Rabin-Karp prefix polynomials over the block's word hashes
give the 64-bit fingerprint of every n-gram at once. Each block counts its own
fingerprints and the shuffle adds them up. The frequent ones are then aggregated
with a pointer to their first occurrence (block and position) and the range of a
second, independent fingerprint.

* Only n-grams whose two parts of one word less passed the level before are
  counted: a phrase is never more frequent than its parts. The test is a filter of
  at most 32 MB; a filter that is too full lets more n-grams into the shuffle, and
  the counts stay exact.
* The text of a frequent phrase is read at its pointer. A fingerprint whose second
  one varies stands for several phrases: those are counted anew by their texts.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .common import (LOWER, WORD_POWERS, Powers, materialize, mix64, pick, prefix_hash, slices, span_hash,
                     word_hashes)

BLOCK_BITS = 20                 # a block holds less than 2**20 bytes of text (but for a longer word)
ROW_BITS = 18                   # and a task fewer than 2**18 blocks
BLOCK_BYTES = (1 << BLOCK_BITS) - (1 << 16)
GROUP_BLOCKS = 8                # blocks that are read at a time
STRETCH = 1 << 17               # bytes of a block that are hashed at a time

# Second, independent polynomials (any fixed odd multipliers would do).
CHECK_BYTES, CHECK_WORDS = Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB)
CHECK_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))

# Bytes that end a piece, and bytes between words.
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _STOP.copy()
_GAP[[0x20, 0x09]] = True
_GAPS = re.compile(rb"[.,;:!?\x0a-\x0d\x20\x09]")


def cuts(text: bytes, words: int, size: int = BLOCK_BYTES):
    """(text, bytes of it that are the block's own): blocks of a text. A cut inside
    a piece is followed by the words that a phrase begun before it may need."""
    ahead = re.compile(rb"(?:[\x20\x09]*[^.,;:!?\x0a-\x0d\x20\x09]+){0,%d}" % (words - 1))
    at = 0
    while len(text) - at > size:
        tail = np.frombuffer(text, np.uint8, size, at)
        stops = np.flatnonzero(_STOP[tail])
        gaps = stops if len(stops) else np.flatnonzero(_GAP[tail])
        if len(gaps):
            end = at + int(gaps[-1]) + 1
        else:  # one word to the end of the window: up to where it ends
            m = _GAPS.search(text, at + size)
            end = m.end() if m else len(text)
        yield text[at:end if _STOP[text[end - 1]] else ahead.match(text, end).end()], end - at
        at = end
    if at < len(text):
        yield text[at:], len(text) - at


def coded(lang: str, text: bytes, own: int) -> dict | None:
    """The block of a lower-cased text: ``words`` (distinct, blank between), ``ids``
    (numbers of words, the largest number of their width where a piece ends), ``own``
    (ids that begin in the own part of the text) and the number of its own words."""
    buf = np.frombuffer(text, np.uint8)
    word = np.zeros(len(buf) + 2, np.int8)
    word[1:-1] = ~_GAP[buf]
    step = np.diff(word)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return None
    stops = np.cumsum(_STOP[buf], dtype=np.int32)[starts]
    breaks = np.diff(stops, prepend=stops[:1]) > 0
    hashes, checks = hashed(buf, starts, ends)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    if (checks != checks[first][number]).any():  # two words of one hash: by their bytes
        table: dict[bytes, int] = {}
        number = np.array([table.setdefault(text[s:e], len(table)) for s, e in zip(starts, ends)])
        distinct = list(table)
    else:
        distinct = [text[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
    at = np.arange(len(starts)) + np.cumsum(breaks)
    width = width_of(len(distinct))
    ids = np.full(at[-1] + 1, np.iinfo(width).max, width)
    ids[at] = number
    mine = int((starts < own).sum())
    return {"lang": lang, "words": b" ".join(distinct), "ids": ids.tobytes(), "own": int(at[mine - 1]) + 1 if mine else 0,
            "n_words": mine}


def width_of(words: int) -> type:
    return np.uint16 if words < np.iinfo(np.uint16).max else np.uint32


def hashed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of words, a stretch of the text at a time: the polynomials take
    eight bytes for each byte of it."""
    out, check = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    steps = np.searchsorted(starts, np.arange(0, len(buf) + STRETCH, STRETCH))
    for i, j in zip(steps[:-1].tolist(), steps[1:].tolist()):
        if i < j:
            low = starts[i]
            part, s, e = buf[low:ends[j - 1]], starts[i:j] - low, ends[i:j] - low
            out[i:j] = word_hashes(part, s, e)
            check[i:j] = span_hash(prefix_hash(CHECK_CODE[part], CHECK_BYTES), s, e, CHECK_BYTES)
    return out, check


class Block:
    """Fingerprints of a block's n-grams."""

    def __init__(self, lang: str, words: bytes, ids: bytes, own: int, mask: int):
        buf = np.frombuffer(words, np.uint8)
        gaps = np.flatnonzero(buf == 0x20)
        starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(buf)]
        self.text = words.split(b" ")
        raw = np.frombuffer(ids, width_of(len(self.text)))
        word = raw < len(self.text)
        self.ids = np.where(word, raw, len(self.text)).astype(np.int32)
        self.own, self.mask = own, np.uint64(mask)
        self.seed = np.uint64(xxhash.xxh64_intdigest(lang))
        words, checks = (np.append(h, np.uint64(0)) for h in hashed(buf, starts, ends))
        self.prefix, self.check = prefix_hash(words[self.ids], WORD_POWERS), prefix_hash(checks[self.ids], CHECK_WORDS)
        here = np.arange(len(self.ids), dtype=np.int32)
        stop = np.where(word, np.int32(len(self.ids)), here)
        self.room = np.minimum.accumulate(stop[::-1])[::-1] - here  # words up to the piece's end

    def prints(self, at: np.ndarray, k: int) -> np.ndarray:
        return mix64(span_hash(self.prefix, at, at + k, WORD_POWERS) ^ self.seed) & self.mask

    def checks(self, at: np.ndarray, k: int) -> np.ndarray:
        return (span_hash(self.check, at, at + k, CHECK_WORDS) >> np.uint64(32)).astype(np.int64)

    def candidates(self, k: int, filters: list[np.ndarray]) -> np.ndarray:
        """Positions of n-grams of k words whose parts all pass the filters. Parts that
        begin beyond the block's own positions are looked at too."""
        alive = None
        for j in range(1, k + 1):
            ok = self.room >= j
            if alive is not None:
                ok[:-1] &= alive[:-1] & alive[1:]
                ok[-1] = False
            at = np.flatnonzero(ok)
            if j == k:
                return at[at < self.own]
            alive = np.zeros(len(self.ids), bool)
            alive[at[bloom.contains(filters[j - 1], self.prints(at, j).view(np.int64))]] = True
        return np.zeros(0, np.int64)

    def phrase(self, at: int, k: int) -> str:
        return b" ".join([self.text[i] for i in self.ids[at:at + k]]).decode()


def _blocks(src: DataFrame, words: int) -> DataFrame:
    def build(batches):
        held, size = defaultdict(list), defaultdict(int)

        def flush(lang):
            text = b"\n".join(held.pop(lang))
            size.pop(lang)
            rows = [r for part, own in cuts(text, words) if (r := coded(lang, part, own))]
            for r in rows:
                yield pa.RecordBatch.from_pylist([r], schema)

        for batch in (part for whole in batches for part in slices(whole)):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                low = LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes()
                if size[lang] and size[lang] + len(low) > BLOCK_BYTES:
                    yield from flush(lang)
                held[lang].append(low)
                size[lang] += len(low) + 1
                if sum(size.values()) >= 16 * BLOCK_BYTES:  # many languages: nothing grows beyond this
                    for x in list(held):
                        yield from flush(x)
        for x in list(held):
            yield from flush(x)

    schema = pa.schema([("lang", pa.string()), ("words", pa.binary()), ("ids", pa.binary()), ("own", pa.int32()),
                        ("n_words", pa.int64())])
    got = src.mapInArrow(build, "lang string, words binary, ids binary, own int, n_words long")
    # The number is fixed once it is written.
    return materialize(got.withColumn("block", F.monotonically_increasing_id()), "phrase-blocks", GROUP_BLOCKS)


_BLOCK = ["lang", "words", "ids", "own"]


def _pointer(block: int) -> int:
    """Where a block's positions begin; partition and row of the block's number."""
    part, row = block >> 33, block & ((1 << 33) - 1)
    if row >= 1 << ROW_BITS or part >= 1 << (63 - ROW_BITS - BLOCK_BITS):
        raise ValueError("too many blocks in a task")
    return (part << ROW_BITS | row) << BLOCK_BITS


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the values (stable), where each distinct one begins in it, and how often it stands."""
    order = np.argsort(values, kind="stable")
    head = np.flatnonzero(np.diff(values[order], prepend=~values[order[:1]]))
    return order, head, np.diff(np.append(head, len(values)))


def _counted(blocks: DataFrame, k: int, filters: list[np.ndarray], mask: int, min_count: int) -> DataFrame:
    """(fp, n) of the fingerprints of k words that are frequent."""
    shared = blocks.sparkSession.sparkContext.broadcast(filters)

    def count(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            r = batch.to_pylist()[0]
            b = Block(*[r[c] for c in _BLOCK], mask)
            fp = b.prints(b.candidates(k, shared.value), k)
            order, head, n = _runs(fp)
            yield pa.RecordBatch.from_arrays([pa.array(fp[order[head]].view(np.int64)), pa.array(n)], ["fp", "n"])

    rows = blocks.select(*_BLOCK).mapInArrow(count, "fp long, n long")
    frequent = rows.groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return materialize(frequent.hint("rebalance"), f"phrases-{k}")  # few rows: files of a size, not one for each task


def _pointed(blocks: DataFrame, frequent: DataFrame, filters: list[np.ndarray], mask: int) -> DataFrame:
    """(k, fp, n, at, low, high): the frequent fingerprints with a pointer to their
    first occurrence and the range of the second fingerprint over all of them."""
    shared = blocks.sparkSession.sparkContext.broadcast(filters)

    def point(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            r = batch.to_pylist()[0]
            b = Block(*[r[c] for c in _BLOCK], mask)
            for k in range(1, len(shared.value) + 1):
                at = b.candidates(k, shared.value)
                fp = b.prints(at, k)
                hit = bloom.contains(shared.value[k - 1], fp.view(np.int64))
                at, fp = at[hit], fp[hit]
                order, head, n = _runs(fp)
                at, fp = at[order], fp[order]
                check = b.checks(at, k)
                # Occurrences with another second fingerprint than the first only widen the range.
                rows = np.concatenate([head, np.flatnonzero(check != np.repeat(check[head], n))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), k, np.int32)), pa.array(fp[rows].view(np.int64)),
                     pa.array(at[rows] + _pointer(r["block"])), pa.array(check[rows])], ["k", "fp", "at", "chk"])

    rows = blocks.select(*_BLOCK, "block").mapInArrow(point, "k int, fp long, at long, chk long")
    spots = rows.groupBy("k", "fp").agg(F.min("at").alias("at"), F.min("chk").alias("low"), F.max("chk").alias("high"))
    return materialize(frequent.join(spots, ["k", "fp"]).hint("rebalance"), "phrases-pointed")


def _texts(blocks: DataFrame, frequent: DataFrame, mask: int) -> DataFrame:
    """(lang, phrase, k, f) of the frequent fingerprints, read at their pointers."""
    block = F.shiftleft(F.shiftrightunsigned("at", BLOCK_BITS + ROW_BITS), 33) + F.shiftrightunsigned(
        "at", BLOCK_BITS).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    spots = frequent.groupBy(block.alias("block")).agg(F.collect_list(F.struct(
        "k", F.col("at").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("pos"), "n")).alias("spots"))

    def read(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            r = batch.to_pylist()[0]
            b = Block(*[r[c] for c in _BLOCK], mask)
            k, n = [s["k"] for s in r["spots"]], [s["n"] for s in r["spots"]]
            phrase = [b.phrase(s["pos"], s["k"]) for s in r["spots"]]
            yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(k)), pa.array(phrase), pa.array(k, pa.int32()),
                                              pa.array(n, pa.int64())], ["lang", "phrase", "k", "f"])

    return blocks.join(spots, "block").select(*_BLOCK, "spots").mapInArrow(
        read, "lang string, phrase string, k int, f long")


def _recounted(blocks: DataFrame, clash: DataFrame, filters: list[np.ndarray], mask: int, min_count: int) -> DataFrame:
    """(lang, phrase, k, f) behind fingerprints that stand for several phrases."""
    levels = sorted(r.k for r in clash.select("k").distinct().collect())
    wanted = {k: bloom.build(clash.where(F.col("k") == k), "fp", clash.where(F.col("k") == k).count()) for k in levels}
    shared = blocks.sparkSession.sparkContext.broadcast((filters, wanted))

    def spell(batches):
        filters, wanted = shared.value
        for batch in (part for whole in batches for part in slices(whole, 1)):
            r = batch.to_pylist()[0]
            b = Block(*[r[c] for c in _BLOCK], mask)
            for k, want in wanted.items():
                at = b.candidates(k, filters)
                fp = b.prints(at, k).view(np.int64)
                hit = bloom.contains(want, fp)
                at, fp = at[hit], fp[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp), pa.array([r["lang"]] * len(at), pa.string()),
                     pa.array([b.phrase(i, k) for i in at.tolist()], pa.string()), pa.array([k] * len(at), pa.int32())],
                    ["fp", "lang", "phrase", "k"])

    rows = blocks.select(*_BLOCK).mapInArrow(spell, "fp long, lang string, phrase string, k int")
    counts = rows.groupBy("fp", "k", "lang", "phrase").agg(F.count("*").alias("f")).where(F.col("f") >= min_count)
    return counts.join(clash.select("fp", "k"), ["fp", "k"], "left_semi").select("lang", "phrase", "k", "f")


def phrase_counts(docs: DataFrame, min_count: int = 100, max_words: int = 5, lang_col: str = "lang",
                  text_col: str = "text", fingerprint_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of 1 to ``max_words`` words: (lang, phrase, k, f) with at least
    ``min_count`` occurrences, and (lang, n), all word occurrences of each language.

    Texts are lower-cased (A-Z), cut at ``. , ; : ! ?`` and line ends, and split at
    blanks and tabs; phrases do not cross a cut. A null language is ``und``; null and
    empty texts have no words; repeated rows count each time; an empty table gives
    empty results; other columns are not read. Fewer ``fingerprint_bits`` only make
    more phrases share one (for tests).
    """
    src = pick(docs, {"lang": lang_col, "text": text_col}).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    mask = (1 << fingerprint_bits) - 1
    blocks = _blocks(src, max_words)
    filters, levels = [], []
    for k in range(1, max_words + 1):
        level = _counted(blocks, k, filters, mask, min_count)
        size = level.count()
        levels.append(level.withColumn("k", F.lit(k)))
        if not size:
            break
        filters.append(bloom.build(level, "fp", size))
    frequent = levels[0]
    for level in levels[1:]:
        frequent = frequent.unionByName(level)
    frequent = _pointed(blocks, frequent, filters, mask)
    clash = frequent.where("low < high")
    phrases = _texts(blocks, frequent.where("low = high"), mask)
    if not clash.isEmpty():
        phrases = phrases.unionByName(_recounted(blocks, clash, filters, mask, min_count))
    return materialize(phrases.hint("rebalance"), "phrases"), blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))


def collocations(docs: DataFrame, min_count: int = 100, max_words: int = 5, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text", fingerprint_bits: int = 64) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language.

    A phrase of a occurrences, cut into parts of l and r occurrences, scores
    ``floor(1000 * a * n / (l * r))`` with the language's n words; its lowest cut
    counts (ties: the first). Phrases contained in a longer frequent phrase that is
    as frequent are dropped. Ordered by score, then a (both descending), then phrase
    in UTF-8 byte order: lang, rank, phrase, a, l, r, n, score. For null, empty and
    repeated input see ``phrase_counts``; languages without a phrase have no rows.
    """
    counts, totals = phrase_counts(docs, min_count, max_words, lang_col, text_col, fingerprint_bits)
    longer = counts.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda i, n: F.array_join(F.slice("w", i, n), " ")
    cut = longer.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at")).select(
        "lang", "phrase", "k", "a", "at", part(F.lit(1), F.col("at")).alias("left"),
        part(F.col("at") + 1, F.col("k") - F.col("at")).alias("right"))
    count_of = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = (cut.join(count_of("left", "l"), ["lang", "left"]).join(count_of("right", "r"), ["lang", "right"])
              .join(F.broadcast(totals), "lang")  # a row for each language
              .withColumn("up", (wide("a") * 1000).cast("decimal(19,0)") * wide("n"))
              .withColumn("down", wide("l") * wide("r"))
              .withColumn("score", F.expr("up div down")))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "at", "l", "r")).alias("x"))
    spans = longer.where("k > 2").select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
    inner = (spans.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("i"))
             .select("lang", part(F.col("i"), F.col("m")).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("held")))
    kept = (lowest.join(inner, ["lang", "phrase"], "left").where(F.coalesce(F.col("held") < F.col("a"), F.lit(True)))
            .select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))

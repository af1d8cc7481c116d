"""Operator 4: token counts by a compiled finite-state tokenizer.

A byte-level BPE tokenizer is compiled, lazily, into one deterministic
transducer over characters. A state holds what the pre-token pattern must
remember plus the bytes whose tokens are still open; a transition carries the
number of tokens that become certain with that character, whatever follows.

* Bytes to tokens: the encoding of every prefix of a pre-token ends with one
  token, so the encodings form a tree over positions. After a byte, a later
  token can only begin at a position from which some vocabulary entry may still
  run on; tokens shared by the tree paths to all those positions are settled
  and emitted.
* Chunks: where a run of letters or of digits ends, and where white space
  follows another character, every state goes to the same one. A chunk's state map is therefore (head, count, tail): the
  text before its first such place, the tokens settled between the first and
  the last, and the text after the last. Maps compose associatively, so the
  chunks of a text are combined by a prefix scan in any bracketing.
* Long texts: their chunks are rows of their own, mapped wherever there is a
  task; the maps are then composed in a parallel scan, ``FAN`` neighbours at a
  time, level by level, until each text has one.
"""

from __future__ import annotations

import gc
from functools import lru_cache, reduce

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, byte_symbols
from .common import materialize, pick, slices

CHUNK = 1 << 14        # characters per chunk
LONG = 1 << 16         # characters beyond which a text's chunks are dealt over tasks
FAN = 16               # neighbouring maps that one step of the parallel scan composes
MAX_STATES = 60_000   # compiled states kept per task; others are stepped through without being kept
MEMO_RUNS = 400_000    # counted runs kept per task (speed only)

# Fixed values of the byte-level pre-token pattern: contraction endings.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class ByteTransducer:
    """Settles the BPE tokens of a byte string from left to right."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.alphabet = byte_symbols()
        back = {s: b for b, s in self.alphabet.items()}
        specials = set(vocabulary.special)
        self.tokens = {bytes(back[c] for c in s): i for s, i in vocabulary.ids.items() if s not in specials}
        self.content = {i: b for b, i in self.tokens.items()}
        # Every token and every proper prefix of one: (token or -1, whether longer tokens begin so).
        self.entries = {b[:k]: (-1, True) for b in self.tokens for k in range(1, len(b))}
        self.entries |= {b: (i, b in self.entries) for b, i in self.tokens.items()}
        self.longest = max(map(len, self.tokens))
        self.single = [bytes([b]) for b in range(256)]
        self.fits: dict[int, bool] = {}
        self.scans: dict[bytes, tuple[tuple, tuple]] = {}

    def adjacent(self, a: int, b: int) -> bool:
        """Whether token b can follow token a: their joint bytes encode to exactly these two."""
        left, right = self.content[a], self.content[b]
        merged = self.v.merge([self.alphabet[x] for x in left + right])
        got = len(merged) == 2 and self.v.ids[merged[0]] == a
        if len(self.fits) >= 2 * MEMO_RUNS:
            self.fits.clear()
        self.fits[a << 32 | b] = got
        return got

    def _scan(self, tail: bytes) -> tuple[tuple, tuple]:
        """Tokens that end with these bytes, longest first, as (begin, token), and
        the places from which a longer token may still run on."""
        ends_here, places = [], []
        for i in range(max(0, len(tail) - self.longest), len(tail)):
            own, runs_on = self.entries.get(tail[i:], (-1, False))
            if own >= 0:
                ends_here.append((i, own))
            if runs_on:
                places.append(i)
        if not ends_here or ends_here[-1][0] != len(tail) - 1:
            raise ValueError("the vocabulary lacks a byte")
        if len(self.scans) >= MEMO_RUNS:
            self.scans.clear()
        self.scans[tail] = tuple(ends_here), tuple(places)
        return self.scans[tail]

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """(next state, settled tokens). A state is (last settled token, open
        bytes, last token of the encoding of every open prefix, where it begins)."""
        before, tail, path, parent = state
        tail += self.single[byte]
        n, fits = len(tail), self.fits
        got = self.scans.get(tail)
        if got is None:
            got = self._scan(tail)
        ends_here, places = got
        for begin, token in ends_here:
            prev = path[begin - 1] if begin else before
            if prev is None:
                break
            ok = fits.get(prev << 32 | token)
            if ok or ok is None and self.adjacent(prev, token):
                break
        path += (token,)
        parent += (begin,)
        cut = n  # the last position that the paths to all candidate places share
        for other in places:
            while cut != other:
                if cut > other:
                    cut = parent[cut - 1]
                else:
                    other = parent[other - 1]
            if not cut:
                return (before, tail, path, parent), 0
        settled = self._tokens(parent, cut)
        if cut == n:
            return (token, b"", (), ()), settled
        return (path[cut - 1], tail[cut:], path[cut:], tuple([p - cut if p > cut else 0 for p in parent[cut:]])), settled

    @staticmethod
    def _tokens(parent: tuple, at: int) -> int:
        """Tokens on the tree path from the first open byte to position ``at``."""
        n = 0
        while at:
            at, n = parent[at - 1], n + 1
        return n

    def flush(self, state: tuple) -> int:
        """Tokens of the open bytes when the pre-token ends here."""
        return self._tokens(state[3], len(state[1]))


FRESH = (None, b"", (), ())


class TextTransducer:
    """Pre-token pattern and byte transducer as one lazily compiled machine.

    ``mode`` of a state: start; space (one pending blank); white (a white-space
    run whose last character is pending); L, N, O (letters, digits, others);
    quote (an apostrophe that begins a pre-token) and q-r, q-v, q-l after it.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = ByteTransducer(vocabulary)
        self.letter, self.digit = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
        self.space = regex.compile(r"\p{White_Space}")
        self.kinds: dict[str, str] = {}
        self.keys: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.arcs: list[dict[str, tuple]] = []
        self.start = self._state("start", "", FRESH)

    def _state(self, mode: str, pending: str, held: tuple):
        """The number of a compiled state, or the state itself when no more are kept."""
        # The last settled token and the open bytes determine the rest of the byte state.
        key = (mode, pending, held[0], held[1])
        at = self.number.get(key)
        if at is None:
            if len(self.keys) >= MAX_STATES:
                return mode, pending, held
            at = self.number[key] = len(self.keys)
            self.keys.append((mode, pending, held))
            self.arcs.append({})
        return at

    def _feed(self, state: tuple, text: str) -> tuple[tuple, int]:
        count = 0
        for b in text.encode():
            state, k = self.bytes.step(state, b)
            count += k
        return state, count

    def kind(self, c: str) -> str:
        got = self.kinds.get(c)
        if got is None:
            got = self.kinds[c] = ("S" if self.space.match(c) else "L" if self.letter.match(c)
                                   else "N" if self.digit.match(c) else "O")
        return got

    def arc(self, at, c: str) -> tuple:
        """The transition of a state on a character: next state and emitted tokens."""
        mode, pending, held = self.keys[at] if type(at) is int else at
        kind, count = self.kind(c), 0
        if mode == kind:  # the run goes on
            held, count = self._feed(held, c)
            return self._arc(at, c, mode, "", held, count)
        if mode in ("space", "white"):
            if kind == "S":
                held, count = self._feed(held, pending)
                return self._arc(at, c, "white", c, held, count)
            if mode == "white":
                count += self.bytes.flush(held)  # the run without its last character
                held = FRESH
            held, k = self._feed(held, pending)
            count += k
            if pending != " ":
                count += self.bytes.flush(held)
                held, mode = FRESH, "start"
            else:
                mode = kind  # a blank joins the run that follows, an apostrophe too
        if mode == "quote":
            if kind == "L" and c in "stmd":
                held, k = self._feed(held, c)
                return self._arc(at, c, "start", "", FRESH, count + k + self.bytes.flush(held))
            if kind == "L" and c in "rvl":
                return self._arc(at, c, "q-" + c, c, held, count)
            mode = "O"
        if mode.startswith("q-"):
            if c == {"q-r": "e", "q-v": "e", "q-l": "l"}[mode]:
                held, k = self._feed(held, pending + c)
                return self._arc(at, c, "start", "", FRESH, count + k + self.bytes.flush(held))
            count += self.bytes.flush(held)  # the apostrophe alone; the letter begins a new run
            held, k = self._feed(FRESH, pending)
            count, mode = count + k, "L"
        if mode != "start" and mode != kind:
            count += self.bytes.flush(held)
            held, mode = FRESH, "start"
        if mode == "start" and kind == "S":
            return self._arc(at, c, "space" if c == " " else "white", c, FRESH, count)
        fresh = mode == "start"
        held, k = self._feed(held, c)
        return self._arc(at, c, "quote" if fresh and c == "'" else kind, "", held, count + k)

    def _arc(self, at, c: str, mode: str, pending: str, held: tuple, count: int) -> tuple:
        arc = self._state(mode, pending, held), count
        if type(at) is int and type(arc[0]) is int:
            self.arcs[at][c] = arc
        return arc

    def end(self, at) -> int:
        """Tokens still owed when the text ends in this state."""
        mode, pending, held = self.keys[at] if type(at) is int else at
        if mode in ("space", "white"):
            held, k = self._feed(held, pending)
            return k + self.bytes.flush(held)
        if mode.startswith("q-"):
            rest, k = self._feed(FRESH, pending)
            return self.bytes.flush(held) + k + self.bytes.flush(rest)
        return self.bytes.flush(held)

    def run(self, text: str) -> int:
        """Tokens of a text that begins and ends at pre-token boundaries."""
        at, count, arcs = self.start, 0, self.arcs
        for c in text:
            at, k = (arcs[at].get(c) if type(at) is int else None) or self.arc(at, c)
            count += k
        return count + self.end(at)


class Counter:
    """Chunk maps and their composition."""

    # Every state goes to the same one where a letter or digit run ends, and where white space
    # follows another character. RUNS are the texts between such places.
    RUNS = regex.compile(r"\p{White_Space}*(?:[^\p{White_Space}\p{L}\p{N}]+(?:\p{L}+|\p{N}+)?|\p{L}+|\p{N}+)"
                         r"|\p{White_Space}+")
    PLACE = (r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})"
             r"|(?<=[^\p{White_Space}])(?=\p{White_Space})")
    FIRST, LAST = regex.compile(PLACE), regex.compile("(?r)" + PLACE)

    def __init__(self, spec: str):
        v = Vocabulary(spec)
        self.machine = TextTransducer(v)
        self.special = regex.compile("|".join(map(regex.escape, v.special))) if v.special else None
        self.memo: dict[str, int] = {}

    def span(self, text: str) -> int:
        """Tokens of a text that begins and ends at synchronising places (or at the text's ends)."""
        count, memo = 0, self.memo
        for run in self.RUNS.findall(text):
            k = memo.get(run)
            if k is None:
                k = self.machine.run(run)
                if len(memo) >= MEMO_RUNS:
                    memo.clear()
                memo[run] = k
            count += k
        return count

    def chunk_map(self, text: str) -> tuple[str, int | None, str]:
        """(head, tokens, tail); tokens is None when no place in the chunk synchronises."""
        first = self.FIRST.search(text)
        if first is None:
            return text, None, ""
        a, b = first.start(), self.LAST.search(text).start()
        return text[:a], self.span(text[a:b]), text[b:]

    def compose(self, left: tuple, right: tuple) -> tuple:
        """The map of the two chunks one after the other (associative)."""
        (h1, n1, t1), (h2, n2, t2) = left, right
        if n1 is None and n2 is None:
            return self.chunk_map(h1 + h2)
        if n1 is None:
            h, n, t = self.chunk_map(h1 + h2)
            return (h1 + h2, n2, t2) if n is None else (h, n + self.span(t) + n2, t2)
        h, n, t = self.chunk_map(t1 + h2)
        if n2 is None:
            return (h1, n1, t1 + h2) if n is None else (h1, n1 + self.span(h) + n, t)
        return h1, n1 + self.span(t1 + h2) + n2, t2

    def scan(self, maps: list[tuple]) -> tuple:
        """Combine neighbours pairwise, level by level."""
        while len(maps) > 1:
            maps = [reduce(self.compose, maps[i:i + 2]) for i in range(0, len(maps), 2)]
        return maps[0]

    def parts(self, text: str) -> list[str]:
        """The texts before, between and after special strings; each of these is one token."""
        return self.special.split(text) if self.special and "<" in text else [text]

    def total(self, mapped: tuple) -> int:
        """Tokens of a text with this map."""
        h, n, t = mapped
        return self.span(h) + (n or 0) + self.span(t)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        parts = self.parts(text)
        return len(parts) - 1 + sum(
            self.total(self.scan([self.chunk_map(part[i:i + chunk]) for i in range(0, len(part), chunk)]))
            for part in parts if part)


@lru_cache(maxsize=1)
def compiled(spec: str) -> Counter:
    """One machine per Python worker, shared by the tasks that it runs."""
    return Counter(spec)


_MAP = "row long, part int, idx long, head string, n long, tail string"


def _scan(long_texts: DataFrame, vocabulary, chunk: int) -> DataFrame:
    """(row, n_tokens) of texts numbered by ``row``, by a parallel scan over their chunks."""
    def cut(batches):
        counter = compiled(vocabulary.value)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, part in enumerate(counter.parts(text)):
                    starts = range(0, max(1, len(part)), chunk)
                    yield pa.RecordBatch.from_pydict({
                        "row": pa.array([row] * len(starts), pa.int64()), "part": pa.array([k] * len(starts), pa.int32()),
                        "idx": pa.array(range(len(starts)), pa.int64()), "text": [part[i:i + chunk] for i in starts]})

    def table_of(row, part, idx, maps):
        return pa.table({"row": pa.array(row, pa.int64()), "part": pa.array(part, pa.int32()), "idx": pa.array(idx, pa.int64()),
                         "head": pa.array([m[0] for m in maps], pa.string()), "n": pa.array([m[1] for m in maps], pa.int64()),
                         "tail": pa.array([m[2] for m in maps], pa.string())})

    def mapped(batches):
        counter = compiled(vocabulary.value)
        for batch in (part for whole in batches for part in slices(whole)):
            yield from table_of(*(batch.column(i).to_pylist() for i in range(3)),
                                [counter.chunk_map(t) for t in batch.column(3).to_pylist()]).to_batches()

    def composed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        counter = compiled(vocabulary.value)
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("idx", "head", "n", "tail"))))
        return table_of([key[0].as_py()], [key[1].as_py()], [key[2].as_py()], [reduce(counter.compose, [r[1:] for r in rows])])

    def totals(batches):
        counter = compiled(vocabulary.value)
        for batch in (part for whole in batches for part in slices(whole)):
            n = [counter.total(m) for m in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["row", "part", "n"])

    chunks = long_texts.select("row", "text").mapInArrow(cut, "row long, part int, idx long, text string")
    maps = materialize(chunks.repartition("row", "part", "idx").mapInArrow(mapped, _MAP), "token-maps")
    while (maps.agg(F.max("idx")).first()[0] or 0) > 0:
        maps = materialize(maps.groupBy("row", "part", F.expr(f"idx div {FAN}").alias("idx_up")).applyInArrow(composed, _MAP),
                           "token-maps")
    # The parts' tokens, and one for each special string between two parts.
    return maps.mapInArrow(totals, "row long, part int, n long").groupBy("row").agg(
        (F.sum("n") + F.max("part")).alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text", long: int = LONG, chunk: int = CHUNK) -> DataFrame:
    """Tokens of every whole text (null: empty) as the byte-level BPE file gives
    them: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    One row out per row in, repeated rows too; empty texts count 0; an empty
    table gives an empty result; other columns are not read. Special strings
    inside a text are single tokens, as the library's default has it. Texts of more
    than ``long`` characters are counted by many tasks, the others by one each.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # fixed size: the vocabulary
    src = pick(docs, {"id": id_col, "text": text_col})

    def run(batches):
        counter = compiled(shared.value)
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            gc.disable()  # the tables hold no cycles; spare the collector from walking them
            try:
                n = [counter.count(t) for t in texts]
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                                              pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = src.schema["id"].dataType.simpleString()
    is_long = F.coalesce(F.char_length("text") > long, F.lit(False))
    out = src.where(~is_long).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    # Their numbers are fixed once they are written.
    texts = materialize(src.where(is_long).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    if not texts.isEmpty():
        counted = texts.select("id", "row", F.octet_length("text").cast("long").alias("n_bytes")).join(
            _scan(texts, shared, chunk), "row")
        out = out.unionByName(counted.select("id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col)

"""Operator 11: alignment of two tokenizers over a corpus.

Every text is encoded by a byte-level BPE (A) and by a piece model (B). The byte
offsets where tokens of both end cut the tokens into groups; within a group every
pair of tokens whose byte ranges overlap is a link.

* Identity map: an array over A's ids holds the id of the B token with the same
  bytes. Groups of exactly such two tokens are the fast path: they are counted in
  vectors of the vocabulary's length, one for each task, and never enter a pair
  shuffle.
* All other groups are irregular. They are counted by content, so each distinct
  group is taken apart into pairs once, whatever its number of occurrences.
* Back to the documents: the identity vector is broadcast (as long as the
  vocabulary), and so are the irregular groups that make up at least a
  ``1 / HEAVY`` of all occurrences, of which there are at most ``HEAVY``. The rest
  is joined by a shuffle in which no group holds more than that share of rows.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .common import materialize, pick, slices

HEAVY = 200_000  # irregular groups that are broadcast, at most

# The pre-token pattern of a byte-level tokenizer, and the piece model's blank.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "▁"


class ByteSide:
    """Tokenizer A: ids and bytes of a ``tokenizers`` byte-level BPE file. Special
    strings inside texts are ordinary text."""

    def __init__(self, spec: str):
        model = json.loads(spec)["model"]
        alphabet = byte_symbols()
        back = {s: b for b, s in alphabet.items()}
        raw = lambda s: bytes(back[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        order = dict.fromkeys([bytes([b]) for b in range(256)] + [raw(a + b) for a, b in pairs])
        ranks = {b: i for i, b in enumerate(order)}
        self.encoding = tiktoken.Encoding("a", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.ids = np.array([model["vocab"]["".join(alphabet[x] for x in b)] for b in order], np.int32)
        self.bytes = dict(zip(self.ids.tolist(), order))
        self.size = max(model["vocab"].values()) + 1

    def encode(self, text: str) -> np.ndarray:
        return self.ids[self.encoding.encode_to_numpy(text, disallowed_special=())]


class PieceSide:
    """Tokenizer B: ids and bytes of a sentencepiece model."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        self.fallback = {i for i in range(self.size) if self.model.is_byte(i)}
        self.bytes = {i: bytes([int(p[1:-1], 16)]) if i in self.fallback else p.replace(BLANK, " ").encode()
                      for i, p in enumerate(pieces)}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int32)


def lengths(tokens: dict[int, bytes], size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    out[list(tokens)] = [len(b) for b in tokens.values()]
    return out


class Aligner:
    """Groups and links of single texts."""

    def __init__(self, a_spec: str, b_model: bytes):
        self.a, self.b = ByteSide(a_spec), PieceSide(b_model)
        same: dict[bytes, int] = {}
        for i in sorted(self.b.bytes, key=lambda i: (i not in self.b.fallback, -i)):
            same[self.b.bytes[i]] = i  # a plain piece before a byte, then the smallest id
        self.identity = np.full(self.a.size, -1, np.int64)
        for i, raw in self.a.bytes.items():
            self.identity[i] = same.get(raw, -1)
        self.length_a, self.length_b = lengths(self.a.bytes, self.a.size), lengths(self.b.bytes, self.b.size)
        self.width = np.dtype(np.uint16 if max(self.a.size, self.b.size) <= 1 << 16 else np.uint32)
        # A token's number and what follows it in a group string: even places inside a side, odd at its end.
        self.strings = [f"{i}{end}" for size, ends in ((self.a.size, ",|"), (self.b.size, ",;"))
                        for i in range(size) for end in ends]

    def text(self, text: str) -> tuple | None:
        """(tokens of A, of B, groups, group string, packed A ids of identity groups,
        packed irregular groups) of a text; None if it has no tokens by the rules."""
        if not text:
            return None
        a, b = self.a.encode(" " + text), self.b.encode(text)
        whole = (" " + text).encode()
        # A knows every byte, so only B can fail to give the text back.
        if b"".join(map(self.b.bytes.__getitem__, b.tolist())) != whole:
            return None
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        in_a, in_b = np.zeros((2, len(whole) + 1), bool)
        in_a[ends_a], in_b[ends_b] = True, True
        last_a, last_b = in_b[ends_a], in_a[ends_b]  # tokens that end a group's side
        cut_a, cut_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        n_a, n_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        # Both sides in the order of the groups, a group's A tokens first.
        at_a = np.arange(len(a)) + np.repeat(cut_b + 1 - n_b, n_a)
        at_b = np.arange(len(b)) + np.repeat(cut_a + 1, n_b)
        codes, ids = np.empty(len(a) + len(b), np.int32), np.empty(len(a) + len(b), self.width)
        codes[at_a], codes[at_b] = 2 * a + last_a, 2 * (self.a.size + b) + last_b
        ids[at_a], ids[at_b] = a, b
        spec = "".join(map(self.strings.__getitem__, codes.tolist()))[:-1]
        plain = (n_a == 1) & (n_b == 1)
        plain[plain] = self.identity[a[cut_a[plain]]] == b[cut_b[plain]]
        odd = np.flatnonzero(~plain)
        size = self.width.itemsize
        end = (cut_a + cut_b + 2)[odd]
        start = (end - (n_a + n_b)[odd]) * size
        packed = ids.tobytes()
        # The number of A tokens in two values: it may be larger than an id.
        heads = {k: np.array(divmod(k, 1 << 16), self.width).tobytes() for k in set(n_a[odd].tolist())}
        groups = [heads[k] + packed[i:j] for k, i, j in zip(n_a[odd].tolist(), start.tolist(), (end * size).tolist())]
        return len(a), len(b), len(cut_a), spec, a[cut_a[plain]].astype(self.width).tobytes(), groups

    def links(self, group: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A and B ids of the links of a packed irregular group."""
        high, low, *x = np.frombuffer(group, self.width).tolist()
        n = (high << 16) + low
        a, b = x[:n], x[n:]
        ends_a = np.cumsum([len(self.a.bytes[i]) for i in a])
        ends_b = np.cumsum([len(self.b.bytes[i]) for i in b])
        ends = np.union1d(ends_a, ends_b)  # one link ends at each place where a token of either ends
        return np.array(a)[np.searchsorted(ends_a, ends)], np.array(b)[np.searchsorted(ends_b, ends)]


@lru_cache(maxsize=1)
def aligner(a_spec: str, b_model: bytes) -> Aligner:
    """One aligner per Python worker, shared by the tasks that it runs."""
    return Aligner(a_spec, b_model)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          heavy: int = HEAVY) -> DataFrame:
    """Alignment of the two tokenizations of every whole text.

    Returns id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links
    whose id pair has its B id's highest count in the corpus, ties included),
    ``count_sum`` (corpus counts of the pairs, summed over links) and
    ``groups_sha256`` (of the ids, ``a1,a2|b1;a3|b2``).

    Null and empty texts, and texts that one of the tokenizers does not give back
    byte for byte, have no tokens: zeros and an empty string. One row out per row
    in: repeated rows stay and count each time, a null id stays null, an empty table
    gives an empty result, other columns are not read.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as fa, open(b_path, "rb") as fb:
        files = spark.sparkContext.broadcast((fa.read(), fb.read()))  # fixed size: the vocabularies
    src = pick(docs, {"id": id_col, "text": text_col})
    kind = src.schema["id"].dataType.simpleString()

    def encode(batches):
        al = aligner(*files.value)
        for batch in (part for whole in batches for part in slices(whole)):
            got = [al.text(t) or (0, 0, 0, "", b"", ()) for t in batch.column(1).to_pylist()]
            na, nb, n, spec, plain, odd = zip(*got)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0), "n_a": pa.array(na, pa.int64()), "n_b": pa.array(nb, pa.int64()),
                "n_groups": pa.array(n, pa.int64()),
                "groups_sha256": pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spec]),
                "plain": pa.array(plain, pa.binary()), "odd": pa.array(odd, pa.list_(pa.binary()))})

    coded = src.mapInArrow(encode, f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
                                   "plain binary, odd array<binary>")
    # The number is fixed once it is written.
    coded = materialize(coded.withColumn("row", F.monotonically_increasing_id()), "aligned")

    def vector(batches):
        al = aligner(*files.value)
        total = np.zeros(al.a.size, np.int64)
        for batch in batches:
            for plain in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(plain, al.width), minlength=al.a.size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"a": at, "b": al.identity[at], "n": total[at]})

    regular = materialize(coded.select("plain").mapInArrow(vector, "a long, b long, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n")), "aligned-vector")
    groups = materialize(coded.select(F.explode("odd").alias("g")).groupBy("g").agg(F.count("*").alias("n")),
                         "aligned-groups")

    def apart(batches):
        al = aligner(*files.value)
        for batch in (part for whole in batches for part in slices(whole, 4096)):
            links = [al.links(g) for g in batch.column(0).to_pylist()]
            size = [len(a) for a, _ in links]
            at = np.repeat(np.arange(len(links)), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                 pa.array(np.concatenate([a for a, _ in links]) if links else [], pa.int64()),
                 pa.array(np.concatenate([b for _, b in links]) if links else [], pa.int64())], ["g", "n", "a", "b"])

    links = groups.mapInArrow(apart, "g binary, n long, a long, b long")
    pairs = (regular.unionByName(links.select("a", "b", "n")).groupBy("a", "b").agg(F.sum("n").alias("c")))
    pairs = materialize(pairs, "aligned-pairs")
    best = pairs.groupBy("b").agg(F.max("c").alias("top"))  # at most as many rows as B has ids
    pairs = pairs.join(F.broadcast(best), "b").select("a", "b", "c", (F.col("c") == F.col("top")).cast("long").alias("is_best"))
    worth = (links.join(pairs, ["a", "b"]).groupBy("g").agg(
        F.first("n").alias("n"), F.sum("c").alias("c"), F.sum("is_best").alias("best")))
    worth = materialize(worth, "aligned-worth")
    occurrences = worth.agg(F.sum("n")).first()[0] or 0
    frequent = worth.where(F.col("n") * heavy >= occurrences)

    # Both bounded: A's ids, and `heavy` groups.
    ids = pairs.join(F.broadcast(regular.select("a", "b")), ["a", "b"]).select("a", "c", "is_best").toArrow()
    held = frequent.select("g", "c", "best").toArrow()
    known = spark.sparkContext.broadcast((
        [ids.column(i).to_numpy() for i in range(3)],
        dict(zip(held.column(0).to_pylist(), zip(held.column(1).to_pylist(), held.column(2).to_pylist())))))

    def settle(batches):
        al = aligner(*files.value)
        (at, c, is_best), group = known.value
        count, top = np.zeros(al.a.size, np.int64), np.zeros(al.a.size, np.int64)
        count[at], top[at] = c, is_best
        for batch in (part for whole in batches for part in slices(whole)):
            sums, bests, rest = [], [], []
            for plain, odd in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                x = np.frombuffer(plain, al.width)
                found = [group.get(g) for g in odd]
                sums.append(int(count[x].sum()) + sum(f[0] for f in found if f))
                bests.append(int(top[x].sum()) + sum(f[1] for f in found if f))
                rest.append([g for g, f in zip(odd, found) if f is None])
            yield pa.RecordBatch.from_pydict({
                "row": batch.column(0), "c": pa.array(sums, pa.int64()), "best": pa.array(bests, pa.int64()),
                "rest": pa.array(rest, pa.list_(pa.binary()))})

    settled = materialize(coded.select("row", "plain", "odd").mapInArrow(
        settle, "row long, c long, best long, rest array<binary>"), "aligned-settled")
    light = (settled.select("row", F.explode("rest").alias("g"))
             .join(worth.where(F.col("n") * heavy < occurrences).select("g", "c", "best"), "g"))
    per_row = settled.select("row", "c", "best").unionByName(light.select("row", "c", "best")).groupBy("row").agg(
        F.sum("c").alias("count_sum"), F.sum("best").alias("n_best"))
    return (coded.drop("plain", "odd").join(per_row, "row")
            .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups",
                    (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"), "n_best", "count_sum",
                    "groups_sha256"))

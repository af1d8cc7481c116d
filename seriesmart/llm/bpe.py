"""Operator 2: BPE encoding and decoding of whole texts.

Each pre-token is encoded by a priority queue of merge ranks over a doubly
linked list of symbols: the best (rank, place) entry is popped, skipped when it
is stale (a symbol changed since it was queued), and otherwise merged, which
queues the two new neighbour pairs. Decoding concatenates vocabulary strings.

The vocabulary file is read once on the driver and broadcast; its size is
fixed by the vocabulary and does not grow with the corpus. Tasks keep a bounded
memo of encoded pre-tokens, so repeated words cost a dictionary lookup.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import pick, slices

MEMO_WORDS = 300_000  # entries kept per task; the memo starts anew beyond it (speed only)
END = "</w>"


def byte_symbols() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest
    take code points from 256 on, in byte order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks and token strings of a ``tokenizers`` BPE file."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.strings = {i: s for s, i in self.ids.items()}
        self.strings |= {t["id"]: t["content"] for t in d["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.suffix: str = model.get("end_of_word_suffix") or ""

    def merge(self, symbols: list[str]) -> list[str]:
        """The final symbols of one pre-token."""
        n = len(symbols)
        if n < 2:
            return symbols
        sym: list[str | None] = list(symbols)
        prev, after = list(range(-1, n - 1)), [*range(1, n), -1]
        ranks = self.ranks
        queue = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                 if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if sym[i] != left or j < 0 or sym[j] != right:
                continue  # stale: one of the two symbols has been merged meanwhile
            sym[i], sym[j] = left + right, None
            after[i] = after[j]
            if after[i] >= 0:
                prev[after[i]] = i
            for a, b in ((prev[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := ranks.get((sym[a], sym[b]))) is not None:
                    heapq.heappush(queue, (r, a, sym[a], sym[b]))
        return [s for s in sym if s is not None]


class WordEncoder:
    """Lower-cased NFC words with word ends, as the vocabulary file declares them."""

    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")

    def __init__(self, spec: str):
        self.v = Vocabulary(spec)
        self.alphabet = byte_symbols()
        self.specials = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.v.special, key=len, reverse=True)) + ")")
        self.memo: dict[str, bytes] = {}

    def word(self, piece: str) -> bytes:
        """Little-endian ids of one pre-token."""
        got = self.memo.get(piece)
        if got is None:
            symbols = [self.alphabet[b] for b in piece.encode()]
            symbols[-1] += self.v.suffix
            got = pack(array("I", [self.v.ids[t] for t in self.v.merge(symbols)]))
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[piece] = got
        return got

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        ids, memo = [], self.memo
        for part in self.specials.split(text) if "<|" in text else [text]:
            if part in self.v.special:
                ids.append(pack(array("I", [self.v.special[part]])))
                continue
            # Lower-casing is per character: no final-sigma rule.
            norm = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            ids += [memo.get(piece) or self.word(piece) for piece in self.PIECES.findall(norm)]
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings of packed ids, one blank between them."""
        return " ".join(map(self.v.strings.__getitem__, unpack(ids)))


@lru_cache(maxsize=1)
def encoder(spec: str) -> WordEncoder:
    """One encoder per Python worker, shared by the tasks that it runs."""
    return WordEncoder(spec)


def pack(ids: array) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def unpack(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """Encode and decode every whole text (null: empty).

    Returns id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if wanted,
    the packed ``ids`` and the ``decoded`` string. One row out
    per row in: repeated rows stay, an empty table gives an empty result, other
    columns of the input are not read. A null id stays null.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    src = pick(docs, {"id": id_col, "text": text_col})

    def run(batches):
        enc = encoder(shared.value)
        for batch in (part for whole in batches for part in slices(whole)):
            n, ids_sha, dec_sha, ids_out, dec_out = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = enc.encode(text or "")
                decoded = enc.decode(ids)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                dec_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    ids_out.append(ids)
                if with_text:
                    dec_out.append(decoded)
            cols = {"id": batch.column(0), "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(dec_sha, pa.string())}
            if with_ids:
                cols["ids"] = pa.array(ids_out, pa.binary())
            if with_text:
                cols["decoded"] = pa.array(dec_out, pa.string())
            yield pa.RecordBatch.from_pydict(cols)

    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids binary" if with_ids else "") + (", decoded string" if with_text else "")
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)

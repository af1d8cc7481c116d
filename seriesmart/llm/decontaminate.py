"""Operator 7: benchmark items in documents, re-parameterised ones included.
DataFrame functions only.

Texts are reduced to templates: numbers, names and units become typed
placeholders, words are lower-cased and stripped of punctuation. Windows of
template words are hash-joined with the benchmark's windows. A match only counts
when its slots are consistent: along one alignment of item and document, every
slot value of the item must stand for one and the same value in the document.

With ``verbatim``, windows of the plain lower-cased words, numbers and names as
they stand, go through the same join, and an item shorter than a window is one
window of its own length. They find exact copies whose templates say too little:
items of numbers, names in another case, short questions inside a document.

The first pass over all documents only finds those that may hold enough of an item.
A document that lacks all of an item's rarest windows, chosen one more in number
than a reported document may lack, cannot hold the share that counts. Each of
these windows is looked for where its rarest word stands, so the other words of a
document cost one look-up and no window. What is broadcast is behind a size check,
beyond which the joins shuffle; slots and alignments are worked out for the
documents found alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import checked_broadcast
from .common import materialize, pick

WINDOW = 8
COVERAGE = 0.5         # share of an item's windows that a document must hold
BROADCAST_ROWS = 500_000
TEMPLATE, VERBATIM = 0, 1  # kinds of windows

# Units that follow a number.
UNITS = ("km", "cm", "mm", "m", "kg", "mg", "g", "l", "ml", "lb", "lbs", "oz", "ft", "feet", "inches", "inch",
         "miles", "mile", "meters", "metres", "kilometers", "kilograms", "grams", "liters", "litres", "hours",
         "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "months", "years", "dollars",
         "dollar", "euros", "euro", "cents", "percent", "mph", "kmh", "degrees")
# Private-use characters that stand for a number, a name and a unit.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
_MARKS = f"{NUMBER}-{UNIT}"


def words_of(text: Column) -> Column:
    """Template words of a text; placeholders carry what they replaced, with any
    characters attached to it ("YouTube", "1990s" are one slot each)."""
    t = F.coalesce(text, F.lit(""))
    t = F.regexp_replace(t, f"[{_MARKS}]", " ")
    # A capitalised word that does not begin a sentence.
    t = F.regexp_replace(t, r"(\p{Lu}(?<=[\p{Ll}\p{N},;:] .)\p{Ll}+)", NAME + "$1")
    t = F.regexp_replace(t, r"[.,](?<=[0-9].)(?=[0-9])", "")
    t = F.regexp_replace(t, rf"([0-9]) ?(?i:({'|'.join(sorted(UNITS, key=len, reverse=True))}))(?!\p{{L}})",
                         f"$1 {UNIT}$2")
    t = F.regexp_replace(t, r"([0-9](?<![\p{L}\p{N}][0-9])[0-9]*)(?!\p{L})", NUMBER + "$1")
    return F.filter(F.split(F.lower(t), rf"[^\p{{L}}\p{{N}}{_MARKS}]+"), lambda w: w != "")


def is_slot(word: Column) -> Column:
    return F.ascii(word).between(ord(NUMBER), ord(UNIT))


def bare(word: Column) -> Column:
    return F.when(is_slot(word), F.substring(word, 1, 1)).otherwise(word)


def plain_word(word: Column) -> Column:
    return F.when(is_slot(word), F.substr(word, F.lit(2))).otherwise(word)


def _starts(words: Column, window: int) -> Column:
    """First positions (from 1) of the windows; a shorter text is one window."""
    return F.when(F.size(words) > 0, F.sequence(F.lit(1), F.greatest(F.size(words) - window + 1, F.lit(1)))
                  ).otherwise(F.array().cast("array<int>"))


def _windows(df: DataFrame, window: int, keys: list[str]) -> DataFrame:
    """(keys, kind, pos, h, slots) of the ``words`` with their values."""
    df = df.withColumn("plain", F.transform("words", bare))
    df = df.select(*keys, F.explode(F.transform(_starts(F.col("words"), window), lambda i: F.struct(
        i.alias("pos"), F.xxhash64(F.slice("plain", i, window)).alias("h"),
        F.slice("words", i, window).alias("w")))).alias("x"))
    return df.select(*keys, F.lit(TEMPLATE).alias("kind"), "x.pos", "x.h", F.filter("x.w", is_slot).alias("slots"),
                     F.size("x.w").alias("n"))


def _verbatim_windows(df: DataFrame, lengths: list[int], keys: list[str]) -> DataFrame:
    """The same of the plain words, which have no slots, for each length of window."""
    df = df.withColumn("plain", F.transform("words", plain_word))
    hashes = lambda n: F.transform(_starts(F.col("plain"), n), lambda i: F.struct(
        i.alias("pos"), F.xxhash64(F.slice("plain", i, n)).alias("h")))
    return (df.select(*keys, F.explode(F.concat(*map(hashes, lengths))).alias("x"))
            .select(*keys, F.lit(VERBATIM).alias("kind"), "x.pos", "x.h", F.array().cast("array<string>").alias("slots")))


def _probes(items: DataFrame, window: int, coverage: float, kinds: list[int]) -> DataFrame:
    """(word, offset, n, kind, h): where to look for windows, and the hash to find there.

    An item's windows of a kind stand at m positions; a reported document matches at
    least ``ceil(coverage * m)`` of them, so it matches one of any ``m - ceil(coverage
    * m) + 1``: the ones whose rarest word is rarest, by the items' own words.
    ``word`` is the hash of that word without its placeholder, ``offset`` its place."""
    word = lambda w, i: F.struct(i.alias("at"), F.xxhash64(plain_word(w)).alias("word"), is_slot(w).alias("slot"))
    uses = items.select(F.explode("words").alias("w")).groupBy(F.xxhash64(plain_word(F.col("w"))).alias("word")).agg(
        F.count("*").alias("uses"))
    # Items that share an id keep their own words: everything stays in the row of a window.
    spots = items.select("item", F.explode(F.transform(_starts(F.col("words"), window), lambda i: F.struct(
        i.alias("pos"), F.slice("words", i, window).alias("w")))).alias("x")).select("item", "x.*")
    spots = spots.where(F.size("w") > 0).withColumn("n", F.size("w"))
    both = None
    for kind in kinds:
        form = bare if kind == TEMPLATE else plain_word
        rows = spots.withColumn("kind", F.lit(kind)).withColumn("h", F.xxhash64(F.transform("w", form)))
        if kind == TEMPLATE:
            rows = rows.where(F.col("n") >= 2 * F.size(F.filter("w", is_slot)))
        both = rows if both is None else both.unionByName(rows)
    each = both.select("item", "kind", "pos", "n", "h", F.explode(F.transform("w", word)).alias("x")).select(
        "item", "kind", "pos", "n", "h", "x.*")
    # A placeholder of a template may stand for anything, so it is no word to look for.
    each = each.where((F.col("kind") == VERBATIM) | ~F.col("slot")).join(uses, "word")
    rarest = each.groupBy("item", "kind", "pos", "n", "h").agg(F.min(F.struct(
        "uses", "word", F.col("at").alias("offset"))).alias("x"))
    of_item = Window.partitionBy("item", "kind")
    ranked = (rarest.withColumn("worst", F.max("x.uses").over(Window.partitionBy("item", "kind", "pos")))
              .withColumn("rank", F.dense_rank().over(of_item.orderBy("worst", "pos")))
              .withColumn("m", F.max("rank").over(of_item)))
    needed = F.ceil(F.col("m") * coverage - 1e-9)
    return ranked.where(F.col("rank") <= F.col("m") - needed + 1).select("x.word", "x.offset", "n", "kind", "h").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", verbatim: bool = False) -> DataFrame:
    """Documents that hold a benchmark item, one row per (document, item):
    ``item_windows``, ``matched_windows``, ``coverage``, ``exact`` (all slot values
    equal), ``start_word`` (from 0) and ``slots`` = ``{item, doc}`` value pairs.

    An item's template windows count when at least half of their words are not
    placeholders. Texts with fewer words than a window are one window of all their
    words, so templates find short items as whole documents only, and an item
    without a window that counts never.

    With ``verbatim``, a document is also reported when it holds that share of the
    item's windows word for word (any case, blanks and punctuation); a row is the
    template's where that suffices, else it counts verbatim windows and has no
    slots. Every item with a word can be found then; an item of one word is found
    wherever that word stands.

    Null and empty texts match nothing; rows with a null id take no part; rows that
    repeat an id are one document, items with one id one item. Other columns are
    not read. Windows are compared by 64-bit hashes.
    """
    items = (pick(benchmark, {"item": item_col, "text": item_text_col}).where("item is not null")
             .select("item", words_of(F.col("text")).alias("words")))
    item_windows = _windows(items, window, ["item"]).where(F.col("n") >= 2 * F.size("slots")).drop("n")
    lengths = []
    if verbatim:
        # The window, and the lengths of shorter items: window - 1 numbers at most.
        short = items.select(F.size("words").alias("n")).where(F.col("n").between(1, window - 1)).distinct()
        lengths = [window, *sorted(r.n for r in short.collect())]
        item_windows = item_windows.unionByName(_verbatim_windows(items, [window], ["item"]))
    item_windows = materialize(item_windows.select("item", "kind", F.col("pos").alias("item_pos"), "h",
                                                   F.col("slots").alias("item_slots")).distinct(), "leak-items")
    probes = materialize(_probes(items, window, coverage, [TEMPLATE, VERBATIM] if verbatim else [TEMPLATE]), "leak-probes")
    places = checked_broadcast(probes.select("word", "offset", "n", "kind").distinct(), BROADCAST_ROWS)
    hashes = checked_broadcast(probes.select("h").distinct(), BROADCAST_ROWS)

    src = pick(docs, {"id": id_col, "text": text_col}).where("id is not null")
    spread = src.select("id", words_of(F.col("text")).alias("words")).select("id", "words", F.posexplode("words").alias("p", "w"))
    spread = spread.select("id", "words", "p", F.xxhash64(plain_word(F.col("w"))).alias("word"))
    held = (spread.join(places, "word").withColumn("start", F.col("p") - F.col("offset") + 1).where("start >= 1")
            .withColumn("part", F.slice("words", F.col("start"), F.col("n"))))
    held = held.select("id", F.xxhash64(F.when(F.col("kind") == TEMPLATE, F.transform("part", bare)).otherwise(
        F.transform("part", plain_word))).alias("h"))
    seen = materialize(held.join(hashes, "h", "left_semi").select("id").distinct(), "leak-documents")

    # The documents found, read from the table once.
    found = materialize(src.join(checked_broadcast(seen, BROADCAST_ROWS), "id", "left_semi")
                        .select("id", words_of(F.col("text")).alias("words")), "leak-texts")
    doc_windows = _windows(found, window, ["id"]).drop("n")
    if verbatim:
        doc_windows = doc_windows.unionByName(_verbatim_windows(found, lengths, ["id"]))
    matched = doc_windows.join(checked_broadcast(item_windows, BROADCAST_ROWS), ["kind", "h"])
    aligned = matched.groupBy("id", "item", "kind", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set("item_pos").alias("at"), F.min("pos").alias("pos"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip(
            F.col("item_slots").alias("item"), F.col("slots").alias("doc"))))).alias("pairs"))
    aligned = aligned.where(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"]))))
    per_item = aligned.groupBy("id", "item", "kind").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("matched_windows"),
        F.min("pos").alias("pos"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    totals = item_windows.groupBy("item", "kind").agg(F.countDistinct("item_pos").alias("item_windows"))
    share = F.col("matched_windows") / F.col("item_windows")
    value = lambda w: F.substr(w, F.lit(2))
    enough = per_item.join(checked_broadcast(totals, BROADCAST_ROWS), ["item", "kind"]).where(share >= coverage)
    if verbatim:  # one row per (document, item), the template's first
        rest = [c for c in enough.columns if c not in ("id", "item", "kind")]
        enough = (enough.groupBy("id", "item").agg(F.min_by(F.struct(*rest), "kind").alias("x"))
                  .select("id", "item", "x.*"))
    return (enough
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "item_windows", "matched_windows",
                    share.alias("coverage"),
                    F.forall("pairs", lambda p: p["item"] == p["doc"]).alias("exact"),
                    (F.col("pos") - 1).cast("long").alias("start_word"),
                    F.transform("pairs", lambda p: F.struct(
                        value(p["item"]).alias("item"), value(p["doc"]).alias("doc"))).alias("slots")))

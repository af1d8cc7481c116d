"""Operator 10: drop lines that many documents repeat. DataFrame functions only.

Every line's key is hashed. (hash, document, position) rows are partitioned by
range of hash and document, so a line that a third of the documents hold is
spread over many tasks, and sorted by position within: the first row of each
(hash, document) streams out as that document's first occurrence. Counting
first occurrences per hash combines before its shuffle. Decisions come back as
run-length compressed keep bitmaps, one per document; texts are not moved until
a caller applies the bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

# The characters stripped at both ends of a line.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    core = F.btrim(line, F.lit(STRIPPED))
    # All-ASCII text has the same lower case either way; the built-in is much the faster.
    return F.when(F.char_length(core) == F.octet_length(core), F.lower(core)).otherwise(F.translate(core, UPPER, LOWER))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", tasks: int | None = None) -> DataFrame:
    """Documents that lose lines: id, ``drops`` = runs ``{start, length}`` of the
    dropped line positions, ascending (a run-length keep bitmap).

    A key of at least ``min_chars`` characters found in at least ``min_docs``
    documents loses all its lines. Documents are told apart by id, so rows that
    repeat an id count as one document; rows with a null id are no document and
    neither count nor lose lines. Null and empty texts hold one empty line.
    """
    spark = docs.sparkSession
    src = pick(docs, {"id": id_col, "text": text_col}).where(F.col("id").isNotNull())
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = line_key(F.col("line"))
    rows = (src.select("id", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
            .select("id", "pos", F.when(F.char_length(key) >= min_chars, F.xxhash64(key)).alias("h"))
            .where(F.col("h").isNotNull()))
    placed = rows.repartitionByRange(tasks, "h", "id").sortWithinPartitions("h", "id", "pos")
    seen = Window.partitionBy("h", "id").orderBy("pos")
    firsts = placed.withColumn("nth", F.row_number().over(seen)).where("nth = 1")
    common = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h")
    dropped = placed.join(common, "h").select("id", "pos").groupBy("id").agg(
        F.sort_array(F.collect_set("pos")).alias("p"))
    return dropped.select(F.col("id").alias(id_col), runs_of(F.col("p")).alias("drops"))


def runs_of(positions: Column) -> Column:
    """Ascending positions as an array of ``{start, length}`` runs."""
    n = F.size(positions)
    at = lambda i: F.get(positions, i)
    first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (at(i - 1) + 1 < at(i)))
    return F.transform(first, lambda i, k: F.struct(
        at(i).alias("start"), (F.coalesce(F.get(first, k + 1), n) - i).alias("length")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """Every input row with its columns, the text replaced by its kept lines, and
    ``n_lines``, ``n_dropped`` beside it. A text that loses nothing is unchanged,
    null included. Other ``names`` keep input columns that are called so."""
    marks = bitmaps.select(F.col(id_col).alias("__id"), F.col("drops").alias("__drops"))
    joined = docs.join(marks, F.col(id_col) == F.col("__id"), "left")
    lines = lines_of(F.col(text_col))
    # One flag per line, from alternating kept and dropped runs: constant time per line.
    runs = F.col("__drops")
    end = lambda r: r["start"] + r["length"]
    flags = F.flatten(F.transform(runs, lambda r, i: F.concat(
        F.array_repeat(F.lit(True), (r["start"] - F.when(i > 0, end(F.get(runs, i - 1))).otherwise(0)).cast("int")),
        F.array_repeat(F.lit(False), r["length"].cast("int")))))
    kept = F.array_join(F.filter(F.col("__lines"), lambda _, i: F.coalesce(F.get(F.col("__flags"), i), F.lit(True))), "\n")
    out = (joined.withColumn("__lines", lines).withColumn("__flags", flags)
           .withColumn("__n_lines", F.size("__lines").cast("long"))
           .withColumn("__n_dropped", F.coalesce(F.aggregate(
               runs, F.lit(0).cast("long"), lambda a, r: a + r["length"]), F.lit(0).cast("long")))
           .withColumn("__kept", F.when(F.col("__n_dropped") > 0, kept).otherwise(F.col(text_col))))
    return out.select(*[F.col("__kept").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
                      F.col("__n_lines").alias(names[0]), F.col("__n_dropped").alias(names[1]))

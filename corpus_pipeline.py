"""A training-corpus pipeline over the ``documents`` table.

Five stages, each on all that its predecessor kept: quality ranking, line
deduplication, near-duplicate removal, benchmark decontamination, BPE encoding.
A stage takes (spark, docs, sf_dir) and returns a frame; every stage but the last
returns the columns of its input. ``run`` writes each stage's rows to the shared
folder and reads them again, so a lost executor never costs an earlier stage.

Null and empty texts, repeated rows, empty tables and extra columns pass as the
operators define them; rows with a null ``doc_id`` are kept by the stages that
tell documents by id (line deduplication, near duplicates, decontamination).
Columns of the input keep their values, whatever they are called; only ``text`` and
``n_chars`` follow the dropped lines.

A text of ``LINE_DOCS`` or more exact copies loses all its lines to line
deduplication, in every copy: its documents stay as empty texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmart.llm.bpe import encode
from seriesmart.llm.common import materialize, table
from seriesmart.llm.decontaminate import leaks
from seriesmart.llm.jaccard import jaccard_join
from seriesmart.llm.line_dedup import apply_bitmaps, keep_bitmaps
from seriesmart.llm.quality import score, train
from seriesmart.llm.queries import WORD_BPE, tokenizer

THRESHOLD = 0.3              # least quality score that stays
LINE_DOCS = 10               # documents that share a line from which it goes
SHINGLE, NUM, DEN = 5, 80, 100   # near duplicates: five words, Jaccard 0.8
OWN = ("__pipeline_1", "__pipeline_2")   # names for what operators add beside the input's columns


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold. Labels of a fifth of
    the ids (crc32) are left out of the fit, as in the classifier's own query."""
    labels = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    ranking = train(docs, labels, label_col="quality", threshold=THRESHOLD)
    return score(docs, ranking, names=OWN).where(F.col(OWN[1]) == 1).select(*columns(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents share; ``n_chars`` follows the text."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=LINE_DOCS), names=OWN)
    return kept.withColumn("n_chars", F.when(F.col(OWN[1]) > 0, F.char_length("text").cast("long"))
                           .otherwise(F.col("n_chars"))).select(*columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents. Rows
    that repeat an id are one document and stay together."""
    groups = jaccard_join(docs, words=SHINGLE, num=NUM, den=DEN)
    gone = materialize(groups.where("component_id < doc_id").select("doc_id").distinct(), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    held = leaks(docs, table(spark, sf_dir, "benchmark"), verbatim=True)
    gone = materialize(held.select("doc_id").distinct(), "leaks")
    return docs.join(gone, "doc_id", "left_anti").select(*columns(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian 32-bit) of the kept texts, with digests of the
    ids and of the text that they decode to."""
    return encode(docs, tokenizer(WORD_BPE), with_text=False)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

# The quality stage is a fitted model and the last a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

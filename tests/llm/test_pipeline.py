"""The queries with SQL against DuckDB, and the pipeline against a brute-force version."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import zlib

import corpus_pipeline as P
from seriesmart.llm.quality import features, fit
from seriesmart.llm.queries import ORACLES, QUERIES, WORD_BPE, tokenizer

from ..conftest import SF_SMALL
from .test_groups import brute_jaccard, brute_leaks
from .test_texts import brute_lines

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = Counter(tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall())
    assert Counter(map(tuple, df.collect())) == want


@pytest.mark.parametrize("name", ["op6_licenses", "op7_decontaminate", "op10_line_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def brute_pipeline(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    learn = [i for i in labels if i in docs and zlib.crc32(str(i).encode()) % 5]
    ranking = fit(np.array([features(docs[i]) for i in learn]), np.array([labels[i] for i in learn]), P.THRESHOLD)
    scores = dict(zip(docs, ranking.scores(np.array([features(t or "") for t in docs.values()]))))
    rows = [(i, t) for i, t in docs.items() if scores[i] >= P.THRESHOLD]
    rows = [(i, kept) for i, (_, kept) in brute_lines(rows, P.LINE_DOCS).items()]
    groups = brute_jaccard(rows, P.SHINGLE, P.NUM, P.DEN)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaky = {d for d, _ in brute_leaks(rows, items, 8, 0.5)}
    lib = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer(WORD_BPE))
    out = {}
    for i, t in rows:
        if i not in leaky:
            ids = np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            out[i] = (len(ids) // 4, hashlib.sha256(ids).hexdigest())
    return out


def test_pipeline_equals_brute_force(spark):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in P.run(spark, SF_SMALL).collect()}
    want = brute_pipeline(spark)
    # Fitting sums in another order: a score on the very threshold may fall either way.
    assert len(set(got) ^ set(want)) <= 1
    assert all(got[i] == want[i] for i in set(got) & set(want))
    assert 0 < len(got) < 200


CLASHING = ("score", "predicted", "n_lines", "n_dropped", "component_id", "item_id", "h", "drops", "a.b")


def test_stages_keep_the_values_of_all_columns(spark, fixture_dir):
    """Columns that are called like those of the operators pass unchanged."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    wide = docs.withColumns({c: docs.doc_id * 10 + k for k, c in enumerate(CLASHING)})
    d = fixture_dir(documents=wide, **{t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("labels", "benchmark")})
    frame = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, frame, d)
        assert out.columns == frame.columns
        rows = out.collect()
        assert rows and all(r[c] == r.doc_id * 10 + k for r in rows for k, c in enumerate(CLASHING))


def test_many_exact_copies_end_as_empty_texts(spark, fixture_dir):
    """Twelve copies of a text lose every line to line deduplication, as its contract has it."""
    text = "The first line of the copies stands here.\nThe second line of the copies follows."
    rows = [(i, text, "en", "s", len(text)) for i in range(12)] + [(20, "A text of its own, with words that no other has.", "en", "s", 48)]
    d = fixture_dir(documents=spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
                    labels=spark.createDataFrame([(20, 1, 0)], "doc_id long, quality int, toxic int"),
                    benchmark=spark.createDataFrame([(1, "an item that no document holds")], "item_id long, text string"))
    kept = P.lines(spark, spark.read.parquet(f"{d}/documents.parquet"), d).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in kept} == {**{i: ("", 0) for i in range(12)}, 20: (rows[-1][1], 48)}
    assert {r.doc_id: r.n_tokens > 0 for r in P.run(spark, d).collect()} == {**{i: False for i in range(12)}, 20: True}


def test_stages_keep_the_columns(spark, fixture_dir):
    docs = spark.createDataFrame(
        [(1, "One two three four five six.\nsecond line", "en", "a", 40, "x"), (1, "One two three four five six.\nsecond line", "en", "a", 40, "x"),
         (2, None, "en", "a", None, "y"), (3, "", None, None, 0, "z"), (None, "no id here", "en", "a", 10, "w")],
        "doc_id long, text string, lang string, source string, n_chars long, score string")
    d = fixture_dir(documents=docs, labels=spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"),
                    benchmark=spark.createDataFrame([(1, "a benchmark item that no document holds at all")], "item_id long, text string"))
    frame = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, frame, d)
        assert out.columns == frame.columns and out.count() == 5
        assert stage(spark, frame.limit(0), d).count() == 0
    assert P.run(spark, d).count() == 5

"""The registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align
from .bpe import encode
from .collocations import collocations
from .common import table
from .decontaminate import leaks
from .fingerprints import fingerprints
from .jaccard import jaccard_join
from .licenses import scan
from .line_dedup import apply_bitmaps, keep_bitmaps
from .quality import score, train
from .substring_dedup import dedup_substrings
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .vector_search import nearest

WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), tokenizer(WORD_BPE), with_ids=False, with_text=False)


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    labels = table(spark, sf_dir, "labels").where(part != 0)
    ranking = train(docs, labels, label_col="quality", threshold=0.3)
    return score(docs, ranking).select("doc_id", (part == 0).alias("held_out"), "score", "predicted")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), verbatim=True)


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


OP8_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
sh as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(ws) = 0 then []::varchar[]
      when len(ws) < 4 then [array_to_string(ws, ' ')]
      else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as s from w)),
n as (select doc_id, count(*) as n from sh group by doc_id),
rare as (select s from sh group by s having count(*) > 1),
pairs as (
  select a.doc_id as u, b.doc_id as v, count(*) as k
  from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id
  where a.s in (select s from rare) group by 1, 2),
links as (
  select u, v from pairs join n x on x.doc_id = u join n y on y.doc_id = v
  where 100 * k >= 85 * (x.n + y.n - k)),
edges as (select u, v from links union all select v, u from links),
reach(doc_id, c) as (
  select doc_id, doc_id from documents
  union
  select e.v, r.c from reach r join edges e on e.u = r.doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(r.c) as component_id
from documents d left join n using (doc_id) join reach r on r.doc_id = d.doc_id
group by d.doc_id, n.n
"""


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
starts as (
  select doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
first as (select h, min(doc_id) as d from starts group by h),
hit as (select s.doc_id, i from starts s join first f using (h) where f.d < s.doc_id),
words as (select doc_id, generate_subscripts(ws, 1) as p, unnest(ws) as word from w),
marked as (
  select w.doc_id, w.p, w.word,
         coalesce(max(hit.i) over (partition by w.doc_id order by w.p), -100) >= w.p - 49 as gone
  from words w left join hit on hit.doc_id = w.doc_id and hit.i = w.p),
kept as (
  select doc_id, count(*) as n_words, count(*) filter (gone) as n_removed,
         coalesce(string_agg(word, ' ' order by p) filter (not gone), '') as t
  from marked group by doc_id)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from documents d left join kept using (doc_id)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=10, min_chars=1))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP10_SQL = r"""
with lines as (
  select doc_id, generate_subscripts(l, 1) as pos, unnest(l) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
common as (
  select k from keyed where length(k) >= 1 group by k having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (k in (select k from common)) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (k not in (select k from common)), ''))
         as kept_sha256
from keyed group by doc_id
"""


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), tokenizer(PIECE_BPE))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), min_count=100, max_words=5, top=2000)


OP12_SQL = r"""
with w as (
  select lang, regexp_extract_all(p, '[^\x20\x09]+') as ws from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents)),
f as (
  select lang, k, phrase, count(*) as f from (
    select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
    from w cross join (values (1), (2), (3), (4), (5)) t(k) where len(ws) >= k)
  group by lang, k, phrase having count(*) >= 100),
n as (select lang, sum(len(ws))::hugeint as n from w group by lang),
cut as (select lang, phrase, f as a, string_split(phrase, ' ') as ws, unnest(range(1, k)) as p from f where k > 1),
scored as (
  select cut.lang, cut.phrase, cut.a, n.n, p, x.f as l, y.f as r, (1000::hugeint * cut.a * n.n) // (x.f::hugeint * y.f) as score
  from cut join n using (lang)
  join f x on x.lang = cut.lang and x.phrase = array_to_string(ws[1:p], ' ')
  join f y on y.lang = cut.lang and y.phrase = array_to_string(ws[p + 1:], ' ')),
lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, p) = 1),
inside as (
  select lang, array_to_string(ws[i:i + m - 1], ' ') as phrase, max(f) as held from (
    select lang, f, ws, m, unnest(range(1, len(ws) - m + 2)) as i from (
      select lang, f, string_split(phrase, ' ') as ws, unnest(range(2, k)) as m from f where k > 2))
  group by 1, 2),
ranked as (
  select lowest.*, row_number() over (partition by lowest.lang order by score desc, a desc, lowest.phrase) as rank
  from lowest left join inside on inside.lang = lowest.lang and inside.phrase = lowest.phrase
  where coalesce(100 * held < 100 * a, true))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
       score::bigint as score
from ranked where rank <= 2000
"""


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_bpe": op2_bpe,
    "op3_vector_search": op3_vector_search,
    "op4_token_counts": op4_token_counts,
    "op5_quality": op5_quality,
    "op6_licenses": op6_licenses,
    "op7_decontaminate": op7_decontaminate,
    "op8_jaccard": op8_jaccard,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12_collocations,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES = {
    "op8_jaccard": OP8_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_collocations": OP12_SQL,
}

"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edicto.llm import align as AL
from edicto.llm import ball_codes as BC
from edicto.llm import bpe as BP
from edicto.llm import exact_dedup as XD
from edicto.llm import html_extract as HX
from edicto.llm import lm_score as LM
from edicto.llm import near_dedup as ND
from edicto.llm import packing as PK
from edicto.llm import quality_rules as QR
from edicto.llm import secrets as SE
from edicto.llm import top_k as TK
from edicto.llm import toxicity as TX
from edicto.llm import url_filter as UF
from edicto.llm.common import importable, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


@register("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BP.encode(spark, read_table(spark, sf_dir, "documents"), BPE_FILE)


OP2_SQL = r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
WINDOW w AS (PARTITION BY text_sha256)
"""


@register("op2_exact_dedup", OP2_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    half = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]  # two batches in the order of their ids
    first = F.coalesce(F.col("doc_id") <= F.lit(half), F.lit(False))
    return XD.dedup_batches([docs.filter(first), docs.filter(~first)]).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, w[i:i+7] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
          SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
c AS (SELECT w.doc_id, lang, source, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS wc,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT doc_id, lang, source, n_words, coalesce(wc, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
             (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM c),
r AS (SELECT doc_id, lang, source, base_failed, m, v - v % (10 ** greatest(length(v::VARCHAR) - 3, 0))::BIGINT AS bin FROM (
        SELECT doc_id, lang, source, base_failed, unnest(['symbol', 'dup_line', 'repeat', 'word_len']) AS m,
               1000 * unnest([n_symbols, n_dup_lines, n_repeat_words, word_chars]) // greatest(n_words, 1) AS v FROM f)),
k AS (SELECT lang, source, m, bin, count(*)::HUGEINT AS n FROM r WHERE NOT base_failed GROUP BY lang, source, m, bin),
a AS (SELECT m, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY m) AS t FROM k GROUP BY m, bin),
kl AS (SELECT lang, m, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang, m) AS t FROM k GROUP BY lang, m, bin),
ks AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, m) AS t FROM k),
l AS (SELECT g.lang, a.m, a.bin, coalesce(x.n, 0) * a.t + 50 * a.n AS n, (coalesce(y.t, 0) + 50) * a.t AS t
      FROM (SELECT DISTINCT lang FROM f) g CROSS JOIN a
      LEFT JOIN kl x ON x.lang IS NOT DISTINCT FROM g.lang AND x.m = a.m AND x.bin = a.bin
      LEFT JOIN (SELECT DISTINCT lang, m, t FROM kl) y ON y.lang IS NOT DISTINCT FROM g.lang AND y.m = a.m),
o AS (SELECT g.lang, g.source, l.m, l.bin, coalesce(x.n, 0) * l.t + 50 * l.n AS n, (coalesce(y.t, 0) + 50) * l.t AS t
      FROM (SELECT DISTINCT lang, source FROM f) g JOIN l ON l.lang IS NOT DISTINCT FROM g.lang
      LEFT JOIN ks x ON x.lang IS NOT DISTINCT FROM g.lang AND x.source IS NOT DISTINCT FROM g.source AND x.m = l.m AND x.bin = l.bin
      LEFT JOIN (SELECT DISTINCT lang, source, m, t FROM ks) y ON y.lang IS NOT DISTINCT FROM g.lang
           AND y.source IS NOT DISTINCT FROM g.source AND y.m = l.m),
q AS (SELECT lang, source, m, min(CASE WHEN 100 * upto >= 25 * t THEN bin END) AS q25, min(CASE WHEN 100 * upto >= 75 * t THEN bin END) AS q75
      FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, m ORDER BY bin) AS upto FROM o) GROUP BY lang, source, m),
s(m, slack) AS (VALUES ('symbol', 100), ('dup_line', 100), ('repeat', 300), ('word_len', 4000)),
v AS (SELECT r.doc_id, bool_and(coalesce(bin <= q75 + 6 * (q75 - q25) + slack, true)) AS ok
      FROM r JOIN s USING (m)
      LEFT JOIN q ON q.m = r.m AND q.lang IS NOT DISTINCT FROM r.lang AND q.source IS NOT DISTINCT FROM r.source GROUP BY r.doc_id)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM f JOIN v ON f.doc_id = v.doc_id
"""


@register("op5_quality_rules", OP5_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QR.quality_rows(read_table(spark, sf_dir, "documents"))


@register("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SE.scan(spark, read_table(spark, sf_dir, "documents"), RANK_FILE)


@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PK.pack_documents(spark, read_table(spark, sf_dir, "documents"), BPE_FILE)


@register("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UF.judge_urls(read_table(spark, sf_dir, "pages"))


@register("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ND.near_rows(read_table(spark, sf_dir, "documents"))


@register("op4_lm_score")
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LM.score(spark, read_table(spark, sf_dir, "documents"))


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TX.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op8_html_extract")
def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return HX.extract(read_table(spark, sf_dir, "pages"))


@register("op12_align_tokens")
def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AL.align_documents(spark, read_table(spark, sf_dir, "documents"), BPE_FILE, PIECE_FILE, pattern=public_tokenizers.PATTERN)


def vectors_sql(scale: int) -> str:
    """Vectors that take part, as whole numbers."""
    return f"""v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER () AS row_no, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


OP11_SQL = f"""
WITH {vectors_sql(256)},
s AS (SELECT q.vec_id AS query_id, q.row_no AS q_row, p.vec_id,
             list_sum(list_transform(list_zip(q.x, p.x), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v p ON q.row_no <> p.row_no WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@register("op11_top_k", OP11_SQL)
def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % TK.EVERY == 0)


def codes_sql(rounds: int = BC.ROUNDS) -> str:
    """Plain k-means on every part, one step after the other."""
    steps = [f"""WITH {vectors_sql(4096)},
p AS MATERIALIZED (SELECT row_no, part, list_slice(x, part * len(x) // 8 + 1, (part + 1) * len(x) // 8) AS s FROM v, range(8) t(part)),
b0 AS MATERIALIZED (SELECT part, entry, s AS c FROM p JOIN (SELECT row_no, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v) USING (row_no) WHERE entry < 16)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT row_no, part, min(struct_pack(d := list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := entry)) AS m
  FROM p JOIN b{r} USING (part) GROUP BY row_no, part)""")
        steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n.c, b{r}.c) AS c FROM b{r} LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY i) AS c FROM (
      SELECT part, entry, i, floor(sum(x) / count(*))::BIGINT AS mean FROM (
        SELECT part, m.e AS entry, unnest(range(len(s))) AS i, unnest(s) AS x FROM a{r} JOIN p USING (row_no, part)) GROUP BY part, entry, i)
    GROUP BY part, entry) n USING (part, entry))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN (SELECT row_no, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY row_no) USING (row_no)
"""


@register("op13_vector_codes", codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BC.coded_rows(read_table(spark, sf_dir, "embeddings"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)

"""The registered queries of these operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm import (
    collocations, decontam, embed_quality, entropy_secrets, html_extract, jaccard, level_dedup, nb_toxicity, packing, periodic_runs,
    suffix_dedup, token_coder, topk,
)
from scanlake.llm.shared import documents
from scanlake.plans.query import Query, Registry

LLM_QUERIES: dict[str, Query] = Registry()


@LLM_QUERIES.add("op1_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_text(pages)


@LLM_QUERIES.add("op4_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_quality.score_quality(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@LLM_QUERIES.add("op6_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nb_toxicity.score_toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


@LLM_QUERIES.add("op8_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))


TOPK_SQL = """
WITH usable AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum([q.w[i] * c.w[i] FOR i IN range(1, len(q.w) + 1)]) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@LLM_QUERIES.add("op9_topk", TOPK_SQL)
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@LLM_QUERIES.add("op10_decontamination")
def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


@LLM_QUERIES.add("op5_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"))


@LLM_QUERIES.add("op3_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_coder.token_round_trip(documents(spark, sf_dir).select("doc_id", "text"))


@LLM_QUERIES.add("op7_repeats")
def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@LLM_QUERIES.add("op2_jaccard")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))


RUNS_SQL = """
WITH RECURSIVE step(v, k, c) AS (
  SELECT v, 0, v FROM range(256) r(v)
  UNION ALL SELECT v, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8
), crc_table AS (
  SELECT list(CAST(c AS BIGINT) ORDER BY v) AS t FROM step WHERE k = 8
), split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         [CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')] AS b
  FROM documents
), hashed AS (
  SELECT doc_id, w, len(w) AS n, 4294967295 - list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)) AS h
  FROM split, crc_table
), cut AS (
  SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a, h // 10 % 8 AS e FROM hashed
), texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
      THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + e)) END] FOR i IN range(n)] ELSE w END AS w
  FROM cut
), words AS (
  SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS w FROM texts
), equal AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i
  FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         min({'l': -length, 's': start, 'p': period}) AS top
  FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(-top.l AS BIGINT) AS length, CAST(top.p AS BIGINT) AS period,
       CAST(1000 * -top.l // top.p AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@LLM_QUERIES.add("op12_periodic_runs", RUNS_SQL)
def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(documents(spark, sf_dir).select("doc_id", "text"), rewrite=periodic_runs.plant_period)
    return periodic_runs.run_digest(found)


PASSAGES_SQL = """
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 13], ' ') AS s FROM (SELECT *, unnest(range(len(w) - 12)) AS i FROM split)
), least AS (
  SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN least USING (s) WHERE doc_id > least
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS w FROM split) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""


@LLM_QUERIES.add("op13_passages", PASSAGES_SQL)
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = level_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


PHRASES_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g FROM split, range(1, 4) r(k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
), counted AS (
  SELECT lang, k, g, array_to_string(g, ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(len(w)) AS n FROM split GROUP BY lang
), longer AS (
  SELECT lang, s, max(f) AS f FROM (SELECT lang, f, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')]) AS s FROM counted WHERE k = 3 AND f >= 10)
  GROUP BY ALL
), candidates AS (
  SELECT c.* FROM counted c LEFT JOIN longer x ON c.lang = x.lang AND c.phrase = x.s
  WHERE c.k > 1 AND c.f >= 10 AND NOT coalesce(100 * x.f >= 50 * c.f, false)
), cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(g[1:j], ' ') AS lp, array_to_string(g[j + 1:k], ' ') AS rp FROM candidates, range(1, 3) c(j) WHERE j < k
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN counted x ON x.lang = cuts.lang AND x.phrase = lp JOIN counted y ON y.lang = cuts.lang AND y.phrase = rp
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@LLM_QUERIES.add("op11_collocations", PHRASES_SQL)
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir).select("text", "lang"))

"""The registered queries of this subpackage, over whole tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentide.llm import byte_cnn, conversation_repair, decontaminate, fertility, hard_negatives, language_id, ngram_jaccard, posting_ann, revisits, secret_forest, site_templates, soft_mixing, toxicity
from retentide.llm.sampling import split_part

#: Weights of the domains that labels give, by tokens.
TARGETS = {"q1t0": 0.86, "q1t1": 0.06, "q0t0": 0.07, "q0t1": 0.01}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(parts: int, part: int) -> F.Column:
    return F.coalesce(split_part(F.col("doc_id"), parts) == part, F.lit(False)).alias("held_out")


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", _held_out(4, 2), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit_languages(language_id.training_rows(docs))
    found = language_id.predict_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _held_out(4, 2), "lang_pred", "score", F.size("shares").alias("n_languages"))


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(revisits.crawl_of_pages(_table(spark, sf_dir, "pages")))
    header = lambda name: F.col("headers")[name].alias(name.replace("-", "_"))
    return found.select("record_id", "url", "url_key", "ts", "verdict", "refers_to", "response_ts", "digest", *map(header, ("cache-control", "content-type", "date", "etag", "server")))


def op6_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_templates.extract_pages(_table(spark, sf_dir, "pages"))


def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan_secrets(_table(spark, sf_dir, "documents"))


def op8_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = byte_cnn.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return byte_cnn.score_quality(docs, net).select("doc_id", _held_out(3, 1), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = soft_mixing.label_domains(_table(spark, sf_dir, "labels"))
    return soft_mixing.mix_documents(_table(spark, sf_dir, "documents"), labelled, TARGETS, ["doc_id"])


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.similar_components(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(conversation_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.apply_rules(_table(spark, sf_dir, "documents"), language=F.col("lang")).drop("outside")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS bigint) + 1) % 10 ELSE label END")
    return hard_negatives.mine_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_template_decontamination,
        op2_posting_lists,
        op3_toxic_segments,
        op4_language_mixture,
        op5_revisits,
        op6_site_templates,
        op7_secret_forest,
        op8_byte_cnn,
        op9_soft_mixing,
        op10_ngram_jaccard,
        op11_conversation_repair,
        op12_tokeniser_fertility,
        op13_hard_negatives,
    )
}

_OP5 = r"""
WITH pages_ AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS tag,
         regexp_extract(url, '^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 2) AS host,
         regexp_extract(url, '^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3) AS path,
         regexp_extract(url, '^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 4) AS query
  FROM pages
), cleaned AS (
  SELECT page_id, url, tag,
         regexp_replace(regexp_replace(lower(host), '^.*@', ''), ':(80|443)?$', '') AS host,
         regexp_replace(regexp_replace(path, '/index\.(html?|php)$', '/'), '/+$', '') AS path,
         list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)'))) AS kept
  FROM pages_
), keyed AS (
  SELECT page_id, url, tag, 1700000000 + page_id * 60 AS start,
         CASE WHEN page_id % 7 <> 0 THEN '"' || substr(tag, 1, 16) || '"' END AS etag,
         CASE WHEN host <> '' THEN host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS url_key
  FROM cleaned
), visits AS (
  SELECT page_id * 2 + 1 AS record_id, url, url_key,
         start + CASE WHEN page_id % 11 = 0 THEN -600 ELSE 86400 + (page_id % 5) * 1800 END AS ts,
         CASE WHEN page_id % 10 = 0 THEN 'changed' ELSE tag END AS digest,
         CASE WHEN page_id % 7 <> 0 THEN CASE WHEN page_id % 10 = 0 THEN '"changed"' ELSE 'W/' || etag END END AS etag
  FROM keyed
), matched AS (
  SELECT v.*, f.page_id * 2 AS refers_to, f.start AS response_ts, f.tag AS stored, f.etag AS stored_etag,
         row_number() OVER (PARTITION BY v.record_id ORDER BY f.start DESC, f.page_id DESC) AS place
  FROM visits v LEFT JOIN keyed f ON f.url_key = v.url_key AND f.start < v.ts
), judged AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'missing'
                 WHEN etag IS NOT NULL AND stored_etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = stored_etag THEN 'resolved' ELSE 'mismatch' END
                 WHEN digest = stored THEN 'resolved' ELSE 'mismatch' END AS verdict
  FROM matched WHERE place = 1
)
SELECT record_id, url, url_key, ts, verdict, refers_to, response_ts,
       CASE WHEN verdict = 'resolved' THEN stored ELSE digest END AS digest,
       'max-age=600' AS cache_control,
       CASE WHEN verdict = 'resolved' THEN 'text/html' END AS content_type,
       CAST(ts AS VARCHAR) AS date,
       CASE WHEN verdict = 'resolved' THEN coalesce(etag, stored_etag) ELSE etag END AS etag,
       CASE WHEN verdict <> 'resolved' THEN 'edge' END AS server
FROM judged
"""

# The rows in order, then one step a row over the four states: (cost, audit, repaired text) compares by cost and audit.
_OP11 = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), hashed AS (
  SELECT *, xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 20 AS kind
  FROM keyed
), copied AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT conv_id AS conv, turn, role, text, substr(role, 1, 1) AS i,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS k
  FROM copied
), faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 'duplicate'
                 WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(i) OVER (PARTITION BY conv ORDER BY k) || i AS pair
  FROM placed
), faults AS (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM faulty
), steps AS (
  SELECT conv_id AS conv, 0 AS k, {'c': 0, 'a': '', 'r': ''} AS s0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS s1,
         {'c': 5, 'a': 'I', 'r': 'user:'} AS s2, {'c': 10, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv, k, t0, t1, u2, u3
  FROM (
    SELECT *, list_min([u2_, CASE WHEN u3 IS NOT NULL THEN {'c': u3.c + 5, 'a': u3.a || 'I', 'r': u3.r || chr(10) || 'user:'} END]) AS u2
    FROM (
      SELECT *, list_min([t3, CASE WHEN u2_ IS NOT NULL THEN {'c': u2_.c + 5, 'a': u2_.a || 'I', 'r': u2_.r || chr(10) || 'assistant:'} END]) AS u3
      FROM (
        SELECT *, list_min([t2, CASE WHEN t0 IS NOT NULL THEN {'c': t0.c + 5, 'a': t0.a || 'I', 'r': 'user:'} END,
                                CASE WHEN t1 IS NOT NULL THEN {'c': t1.c + 5, 'a': t1.a || 'I', 'r': t1.r || chr(10) || 'user:'} END]) AS u2_
        FROM (
          SELECT s.conv, f.k,
                 {'c': s0.c + 2, 'a': s0.a || 'D', 'r': s0.r} AS t0,
                 list_min([CASE WHEN s1 IS NOT NULL THEN {'c': s1.c + 2, 'a': s1.a || 'D', 'r': s1.r} END,
                           CASE WHEN NOT gone AND i = 's' THEN {'c': s0.c + extra, 'a': s0.a || 'K', 'r': role || ':' || text} END]) AS t1,
                 list_min([CASE WHEN s2 IS NOT NULL THEN {'c': s2.c + 2, 'a': s2.a || 'D', 'r': s2.r} END,
                           CASE WHEN NOT gone THEN {'c': s0.c + extra + CASE WHEN i = 'u' THEN 0 ELSE 1 END, 'a': s0.a || CASE WHEN i = 'u' THEN 'K' ELSE 'R' END, 'r': CASE WHEN i = 'u' THEN role ELSE 'user' END || ':' || text} END,
                           CASE WHEN NOT gone AND s1 IS NOT NULL THEN {'c': s1.c + extra + CASE WHEN i = 'u' THEN 0 ELSE 1 END, 'a': s1.a || CASE WHEN i = 'u' THEN 'K' ELSE 'R' END, 'r': s1.r || chr(10) || CASE WHEN i = 'u' THEN role ELSE 'user' END || ':' || text} END,
                           CASE WHEN NOT gone AND s3 IS NOT NULL THEN {'c': s3.c + extra + CASE WHEN i = 'u' THEN 0 ELSE 1 END, 'a': s3.a || CASE WHEN i = 'u' THEN 'K' ELSE 'R' END, 'r': s3.r || chr(10) || CASE WHEN i = 'u' THEN role ELSE 'user' END || ':' || text} END]) AS t2,
                 list_min([CASE WHEN s3 IS NOT NULL THEN {'c': s3.c + 2, 'a': s3.a || 'D', 'r': s3.r} END,
                           CASE WHEN NOT gone AND s2 IS NOT NULL THEN {'c': s2.c + extra + CASE WHEN i = 'a' THEN 0 ELSE 1 END, 'a': s2.a || CASE WHEN i = 'a' THEN 'K' ELSE 'R' END, 'r': s2.r || chr(10) || CASE WHEN i = 'a' THEN role ELSE 'assistant' END || ':' || text} END]) AS t3
          FROM steps s JOIN faults f ON f.conv IS NOT DISTINCT FROM s.conv AND f.k = s.k + 1
        )
      )
    )
  )
), counted AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv
)
SELECT s.conv AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(list_min([s0, s3]).c AS BIGINT) AS cost, list_min([s0, s3]).a AS audit, sha256(list_min([s0, s3]).r) AS repaired_sha256
FROM steps s LEFT JOIN counted c ON c.conv IS NOT DISTINCT FROM s.conv
WHERE s.k = coalesce(c.n, 0)
"""

_OP13 = """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {"op5_revisits": _OP5, "op11_conversation_repair": _OP11, "op13_hard_negatives": _OP13}

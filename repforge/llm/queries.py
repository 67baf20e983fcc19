"""Registered queries of the training-data operators: each applies its
operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repforge.llm import (centroids, licenses, ngram_join, packing, quality, revisits, sentencepieces, token_counts,
                          toxicity, trie_dedup, turns, walks, wrappers)
from repforge.llm.common import table
from repforge.llm.oracles import centroid_sql, repair_sql


def vocabulary(name: str) -> str:
    """Where the public vocabulary file lies (the same on every node)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(licenses.license_spans(table(spark, sf_dir, "documents")))


def op2_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walks.beside_next(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl is derived from every page (``revisits.crawl_of``)."""
    found = revisits.resolved(revisits.crawl_of(table(spark, sf_dir, "pages")))
    return found.select("record_id", "url_key", "ts", "source_id", "outcome",
                        revisits.header_lines(found["headers"]).alias("headers"), "digest")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_dedup.dedup(table(spark, sf_dir, "documents"), keep="largest")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encoded(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extracted(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), sequence=2048, end_id=1)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_digest(turns.damaged(turns.rows_of(table(spark, sf_dir, "conversations"))))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"), size=64, scale=64, k=16, rounds=3)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=1024)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_edit_fingerprints, op3_quality, op4_warc_revisits, op5_exact_dedup, op6_ngram_join, op7_sentencepiece, op8_html_wrappers,
    op9_toxicity, op10_packing, op11_turn_repair, op12_centroids, op13_token_counts)}

_CRAWL = """
WITH p AS (SELECT page_id, url, md5(coalesce(html, '')) AS digest, v AS visit
           FROM pages, range(4) r(v) WHERE page_id IS NOT NULL),
q AS (SELECT *, visit = 0 OR (visit = 2 AND page_id % 3 = 0) AS is_full,
        CASE WHEN visit >= 2 AND page_id % 3 = 0 THEN 'c' || digest ELSE digest END AS content,
        page_id + visit * 1000000000 AS ts,
        CASE WHEN visit = 3 THEN 'HTTP://WWW.' || regexp_replace(url, '^[a-z]+://(www\\.)?', '') ELSE url END AS spelled
      FROM p WHERE NOT (visit = 0 AND page_id % 13 = 0)),
h AS (SELECT page_id * 4 + visit AS record_id, ts, is_full, page_id, visit, content,
        CASE WHEN visit = 1 AND page_id % 5 = 0 THEN '"other"'
             WHEN visit = 1 AND page_id % 7 = 0 THEN 'W/"' || content || '"'
             WHEN NOT (visit = 1 AND page_id % 11 = 0) THEN '"' || content || '"' END AS tag,
        regexp_replace(regexp_replace(lower(regexp_extract(spelled, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)),
          ':(80|443)$', ''), '^www\\.', '') AS host,
        regexp_replace(regexp_extract(spelled, '^[^/?#]*//[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(spelled, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x:
          x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref|sessionid)(=|$)'))) AS kept
      FROM q),
k AS (SELECT *, CASE WHEN host <> '' THEN host || path ||
        CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS url_key FROM h),
f AS (SELECT url_key, ts, max(record_id) AS source_id FROM k WHERE is_full AND url_key IS NOT NULL GROUP BY ALL),
m AS (SELECT k.*, (SELECT arg_max(f.source_id, f.ts) FROM f WHERE f.url_key = k.url_key AND f.ts < k.ts) AS source_id
      FROM k WHERE NOT is_full),
o AS (SELECT m.*, s.page_id AS s_page, s.content AS s_content,
        CASE WHEN m.source_id IS NULL THEN 'no_earlier'
             WHEN m.tag IS NOT NULL THEN
               CASE WHEN regexp_replace(m.tag, '^W/', '') = s.tag THEN 'resolved' ELSE 'mismatch' END
             WHEN m.page_id = s.page_id THEN 'resolved' ELSE 'mismatch' END AS outcome
      FROM m LEFT JOIN k s ON s.record_id = m.source_id)
SELECT record_id, url_key, ts, source_id, outcome,
  CASE WHEN visit = 3 THEN 'cache-control: max-age=60' || chr(10) ELSE '' END ||
  CASE WHEN outcome = 'resolved' THEN 'content-type: text/html' ELSE 'content-type: text/plain' END || chr(10) ||
  'date: ' || ts || chr(10) ||
  CASE WHEN tag IS NOT NULL THEN 'etag: ' || tag || chr(10)
       WHEN outcome = 'resolved' THEN 'etag: "' || s_content || '"' || chr(10) ELSE '' END ||
  'last-modified: day ' || CASE WHEN outcome = 'resolved' THEN s_page ELSE page_id END AS headers,
  CASE WHEN outcome = 'resolved' THEN s_content END AS digest
FROM o"""

ORACLES = {
    "op4_warc_revisits": _CRAWL,
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_turn_repair": repair_sql(),
    "op12_centroids": centroid_sql(),
}

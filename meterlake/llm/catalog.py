"""Queries of the training-data operators and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from meterlake.llm import bpe, decontaminate, hamming, html, language, merkle, minhash, quality, records, repeats, shards, urls, whitening
from meterlake.llm.common import table

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
BPE_JSON = "byte_bpe_50k.json"


def op1_order_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_link_trust(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op4_html_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op5_suffix_repeats(spark, sf_dir):
    return repeats.byte_report(table(spark, sf_dir, "documents"))


def op6_benchmark_ngrams(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_kneser_ney(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_records(spark, sf_dir):
    return records.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_JSON))


def op9_rendezvous(spark, sf_dir):
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op10_hamming(spark, sf_dir):
    return hamming.search_embeddings(table(spark, sf_dir, "embeddings"))


def op11_chebyshev_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_merkle(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_ppm_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_order_minhash, op2_link_trust, op3_byte_bpe, op4_html_text, op5_suffix_repeats, op6_benchmark_ngrams, op7_kneser_ney,
    op8_records, op9_rendezvous, op10_hamming, op11_chebyshev_whitening,
    op12_merkle, op13_ppm_language)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op6_benchmark_ngrams": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, len, list_slice(w, p + 1, p + len) AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS len, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS p FROM items WHERE len(w) > 0)),
own AS (
  SELECT doc_id, p, len, list_slice(w, p + 1, p + len) AS win
  FROM (SELECT doc_id, w, l.len, unnest(range(0, len(w) - l.len + 1)) AS p
        FROM d, (SELECT DISTINCT len FROM wins) l WHERE len(w) >= l.len)),
found AS (SELECT doc_id, p, own.len, item_id FROM own JOIN wins USING (win)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(p, p + len)) AS pos FROM found) GROUP BY doc_id),
per AS (SELECT doc_id, count(*) AS n, sha256(string_agg(i, ',' ORDER BY i)) AS h
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(per.n, 0)::BIGINT AS n_items,
  coalesce(per.h, sha256('')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN per USING (doc_id)""",
    "op10_hamming": """
WITH bits AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END) AS b
  FROM embeddings WHERE embedding IS NOT NULL),
codes AS (SELECT vec_id, list_aggregate(b, 'string_agg', '')::BIT AS code FROM bits),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id, bit_count(xor(q.code, c.code))::INTEGER AS hamming
  FROM codes q, codes c WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, id, hamming FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hamming, id) AS rank FROM pairs)
WHERE rank <= 10""",
}

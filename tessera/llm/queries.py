"""The corpus operators registered over the driver's tables, whole tables and texts."""

from __future__ import annotations

from functools import wraps

from tessera.llm import bytebpe, conversations, fingerprint, langid, lexical, licenses, maxent, minmax, mixing, packing, pivots, suffixdedup, warc
from tessera.llm.common import prepare, read


def _shipped(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)
    return run


def op1_language_id(spark, sf_dir):
    return langid.report(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_minmax_dedup(spark, sf_dir):
    return minmax.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op3_pivot_dedup(spark, sf_dir):
    return pivots.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op4_maxent_scores(spark, sf_dir):
    return maxent.scores(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_suffix_dedup(spark, sf_dir):
    return suffixdedup.report(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_warc(spark, sf_dir):
    return warc.report(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_license_scan(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_mixing(spark, sf_dir):
    return mixing.report(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op9_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_fingerprint(spark, sf_dir):
    return fingerprint.edited_likeness(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_viterbi_repair(spark, sf_dir):
    return conversations.report(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_lexical_search(spark, sf_dir):
    return lexical.search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_byte_bpe(spark, sf_dir):
    return bytebpe.report(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {f.__name__: _shipped(f) for f in (
    op1_language_id, op2_minmax_dedup, op3_pivot_dedup, op4_maxent_scores, op5_suffix_dedup, op6_warc, op7_license_scan,
    op8_mixing, op9_packing, op10_fingerprint, op11_viterbi_repair,
    op12_lexical_search, op13_byte_bpe)}
ORACLE: dict[str, str] = {
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
             m AS (SELECT payload, max(page_id) AS top FROM p GROUP BY payload)
        SELECT p.page_id, CAST(strlen(p.payload) AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
               CASE WHEN strlen(p.payload) >= 1000 AND p.page_id <> m.top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(p.payload) >= 1000 AND p.page_id <> m.top THEN m.top END AS refers_to
        FROM p JOIN m USING (payload)""",
    "op8_mixing": mixing.oracle_sql(),
    "op12_lexical_search": lexical.ORACLE_SQL,
}

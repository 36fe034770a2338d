"""Registered queries of the text operators, over whole tables, and their DuckDB oracles."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm.cap_filters import vector_links
from tidepanel.llm.common import table
from tidepanel.llm.decontaminate import contaminated
from tidepanel.llm.exact_dedup import exact_duplicates
from tidepanel.llm.licenses import license_scan
from tidepanel.llm.merkle import every_fifth_by_crc, manifest_digests, merkle_manifest
from tidepanel.llm.oracle_sql import VECTOR_LINKS, merkle_sql
from tidepanel.llm.packing import pack_documents
from tidepanel.llm.periodic_runs import periodic_runs, planted, run_digests
from tidepanel.llm.sharding import shard_by_bytes
from tidepanel.llm.simhash import simhash_components
from tidepanel.llm.sparse_suffixes import repeated_passages
from tidepanel.llm.suffix_trees import remove_repeats
from tidepanel.llm.token_counts import token_counts
from tidepanel.llm.toxicity import toxicity
from tidepanel.session import shared_path


def op1_bm25_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op4_ball_hash_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_sparse_suffix_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op6_sampled_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)


def op7_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_license_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op9_block_max_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_digest_cached_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that every distinct text is encoded."""
    cache = shared_path(spark, f"token-cache-{uuid.uuid4().hex}")
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)


def op11_sibling_shift_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digests(merkle_manifest(table(spark, sf_dir, "documents"), tampered=every_fifth_by_crc()))


def op12_cap_filter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op13_branching_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted))


#: Words of each text, and the places covered by runs of {window} words that start more than once.
_COVERED = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
runs AS (SELECT r, i, array_to_string(ws[i : i + {window} - 1], ' ') AS run FROM w, unnest(range(1, len(ws) - {window} + 2)) AS t(i)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT DISTINCT r, i + k AS place FROM repeated, range({window}) AS t(k))
"""

ORACLES = {
    "op3_suffix_tree_repeats": _COVERED.format(window=35) + """,
words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM w),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY place) AS txt, count(*) AS n FROM words ANTI JOIN covered USING (r, place) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (r)
""",
    "op5_sparse_suffix_passages": _COVERED.format(window=50) + """,
islands AS (SELECT r, place, place - row_number() OVER (PARTITION BY r ORDER BY place) AS island FROM covered)
SELECT doc_id, min(place) - 1 AS start_word, count(*) AS n_words FROM islands JOIN w USING (r) GROUP BY r, doc_id, island
""",
    "op7_bloom_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
""",
    "op11_sibling_shift_merkle": merkle_sql(),
    "op12_cap_filter_links": VECTOR_LINKS,
}

QUERIES = {f.__name__: f for f in (op1_bm25_retrieval_packing, op2_subword_toxicity, op3_suffix_tree_repeats, op4_ball_hash_simhash, op5_sparse_suffix_passages, op6_sampled_splitter_shards, op7_bloom_exact_dedup, op8_license_similarity_join, op9_block_max_decontamination, op10_digest_cached_token_counts, op11_sibling_shift_merkle, op12_cap_filter_links, op13_branching_tandem_runs)}

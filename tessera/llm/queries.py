"""One registered query per operator: production parameters over the whole table.

Each query calls its operator and derives the digest columns of its contract from the
operator's real output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe, collocation, hnsw, importance, license_scan, packing, pii, quality, superminhash, token_store,
                         toxicity, url_filter, warc)
from tessera.llm.common import documents
from tessera.session import scratch_path

#: The rule list of the URL filter (verdict, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return superminhash.near_duplicates(documents(spark, sf_dir))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a content-addressed archive of all pages, rebuild every record from it, one row
    per page with the digests of the rebuilt records."""
    folder = scratch_path(spark, "warc")
    warc.write_archive(documents(spark, sf_dir, "pages"), folder)
    return warc.digests_of_records(warc.original_records(spark, folder))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the labelled rows that are not held out, score every document."""
    return toxicity.toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license templates of every document."""
    return license_scan.scan_licenses(documents(spark, sf_dir)).drop("places")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and the semi-Markov field's spans of every document."""
    docs = documents(spark, sf_dir)
    found = pii.scan_pii(docs, pii.train(pii.training_texts(docs)))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the byte-level vocabulary."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = bpe.round_trip_documents(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of all embeddings."""
    return hnsw.near_duplicate_vectors(documents(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into windows of 2048 tokens, one row per piece."""
    pieces = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and compression bands of every document."""
    return quality.quality_rules(documents(spark, sf_dir))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the rule list for every page's URL."""
    return url_filter.judge_urls(documents(spark, sf_dir, "pages"), URL_RULES)


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of all documents as ORC in ascending id order, read them back."""
    folder = scratch_path(spark, "tokens")
    token_store.write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.with_crc32(token_store.read_tokens(spark, folder))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language."""
    return collocation.mine_phrases(documents(spark, sf_dir)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark texts, and the drawn tenth in order."""
    return importance.resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_warc_archive, op3_toxicity, op4_license_scan, op5_pii, op6_byte_bpe,
                                   op7_embedding_dedup, op8_packing, op9_quality_rules, op10_url_filter, op11_token_store,
                                   op12_collocations, op13_importance)}

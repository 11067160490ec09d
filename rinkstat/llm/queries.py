"""Registered queries of the corpus operators; each runs on its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import decision_rules, merkle, mixing, near_dup, packing, prefix_free, prefix_trie, secrets, shard, site_quality, substring, version_sketch, warc
from .common import stored, table, word_count
from .oracle import ORACLE_SQL  # noqa: F401  registered beside the queries

SYMBOL_CHARS = "#*$%&|<>"


def noise_weight(text: str = "text", words: str = "size") -> Column:
    """Quality weight of a document: its words over its words and stray symbols (NULL for no words)."""
    symbols = F.length(text) - F.length(F.translate(F.col(text), SYMBOL_CHARS, ""))
    return F.col(words) / F.nullif(F.col(words) + F.coalesce(symbols, F.lit(0)), F.lit(0))


def op1_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("size", word_count("text"))
    sized = stored(docs.select("doc_id", "source", "size", noise_weight().alias("weight")), "mix-sizes")
    plan = mixing.mix_plan(sized, "size", F.col("weight"))
    mixed = mixing.apply_mix(sized, plan, "size", F.col("weight"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    judged = decision_rules.quality_rules(docs, table(spark, sf, "labels"), drop_text=True)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op3_chunked_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    manifest = warc.write_archives(warc.with_revisits(table(spark, sf, "pages").select("page_id", "url", "html")), folder)
    back = warc.records_of(warc.verified(warc.read_chunks(manifest, folder)))
    is_response = F.col("record_type") == "response"
    return back.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.when(is_response, F.col("stored_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(is_response, F.col("stored_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


def op4_seed_and_extend(spark: SparkSession, sf: str) -> DataFrame:
    return substring.dedup_substrings(table(spark, sf, "documents").select("doc_id", "text")).drop("kept_text")


def op5_invertible_sketch(spark: SparkSession, sf: str) -> DataFrame:
    rows = version_sketch.edited_and_next(table(spark, sf, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        version_sketch.fingerprint(F.col("sketch")).alias("fingerprint"),
        version_sketch.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        version_sketch.likeness(*map(F.col, ("keys", "edited_keys", "edited_first"))).alias("near_edited"),
        version_sketch.likeness(*map(F.col, ("keys", "next_keys", "next_first"))).alias("near_next"),
    )


def op6_feistel_shards(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = shard.feistel_shards(docs, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_site_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    return site_quality.classify(docs, table(spark, sf, "labels"))


def op8_multi_index_near_dup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"), threshold=85)


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    pieces = stored(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces")
    return packing.pack(pieces)


def op10_trigram_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["kind"] < len(secrets.BASE_RULES))

    def count(number: int):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == number)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(secrets.BASE_RULES)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secret_spans")).alias("spans"),
    )


def op11_prefix_free_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_free.dedup_bytes(table(spark, sf, "documents").select("doc_id", "text"), with_parts=False)


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select(
        "doc_id", "lang", merkle.leaf(*fields, F.col("text")).alias("leaf"),
        F.when(hit, merkle.leaf(*fields, lowered)).alias("tampered"),
    )
    proofs = merkle.manifest(leaves, F.col("leaf"), F.col("tampered"))
    return proofs.withColumn("proof_sha256", merkle.proof_sha256(F.col("path"))).drop("path")


def op13_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    convs = stored(prefix_trie.conversations(rows), "conversations")
    return prefix_trie.trie_nodes(prefix_trie.grafted(convs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_quality_rules, op3_chunked_warc, op4_seed_and_extend, op5_invertible_sketch,
        op6_feistel_shards, op7_site_quality, op8_multi_index_near_dup, op9_best_fit_packing, op10_trigram_secrets,
        op11_prefix_free_dedup, op12_merkle_manifest, op13_conversation_trie,
    )
}

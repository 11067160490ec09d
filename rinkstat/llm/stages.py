"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of ``docs``.  Columns that a stage doesn't
use travel through it as one struct, so no name of theirs can clash with its
own.  NULL, empty and long texts, ties, repeated rows and NULL ids are handled
as the stage's operator says; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import decision_rules, mixing, near_dup, packing, secrets
from .common import stored, table, word_count
from .queries import noise_weight


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The columns ``used`` and all others as one struct, ``_row``."""
    rest = [F.col(c) for c in docs.columns if c not in used] or [F.lit(None).cast("int").alias("_")]
    return docs.select(*used, F.struct(*rest).alias("_row"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` made by way of ``packed(docs, ...)`` with the columns of ``docs`` again."""
    inside = rows.schema["_row"].dataType.names
    return rows.select(*[F.col("_row")[c].alias(c) if c in inside else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the base and the learned rules accept."""
    judged = decision_rules.quality_rules(packed(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return unpacked(judged.filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates.

    Rows that share an id are judged by their own texts; one row is kept of
    those in one group, and of those without words.
    """
    found = stored(near_dup.judged(docs, threshold=80), "near-duplicates")
    again = stored(docs.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1").select("doc_id"), "repeated-ids")
    gone = stored(found.filter("NOT kept").select("doc_id").distinct(), "near-duplicates-gone")
    single = docs.join(again, "doc_id", "left_anti").join(gone, "doc_id", "left_anti")
    left = found.filter("kept").join(again, "doc_id", "left_semi")
    left = stored(left.select("doc_id", F.col("digest").alias("_digest"), F.col("comp").alias("_comp")).distinct(), "repeated-ids-left")
    rows = near_dup.with_digest(packed(docs, "doc_id", "text").join(again, "doc_id", "left_semi"))
    rows = rows.join(left.withColumnRenamed("doc_id", "_id"), (F.col("doc_id") == F.col("_id")) & F.col("digest").eqNullSafe(F.col("_digest")))
    order = W.partitionBy("doc_id", "_comp").orderBy("text", *[F.col("_row")[c] for c in ("lang", "source", "n_chars")])
    once = unpacked(rows.withColumn("_i", F.row_number().over(order)).filter("_i = 1"), docs)
    return single.select(docs.columns).unionByName(once)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` counted anew where that changed the text."""
    scanned = secrets.scan(packed(docs, "doc_id", "text", "n_chars"))
    hit = F.size("secret_spans") > 0
    clean = secrets.redacted(F.col("text"), F.col("secret_spans"))
    chars = F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return unpacked(scanned.withColumn("text", clean).withColumn("n_chars", chars), docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it (a row per time)."""
    sized = packed(docs, "doc_id", "source", "text").withColumn("size", word_count("text")).withColumn("weight", noise_weight())
    plan = mixing.mix_plan(stored(sized.select("doc_id", "source", "size", "weight"), "mix-sizes"), "size", F.col("weight"))
    mixed = mixing.apply_mix(sized, plan, "size", F.col("weight"))
    times = F.col("taken") / F.greatest(F.col("size"), F.lit(1))
    return unpacked(mixed.withColumn("_time", F.explode(F.array_repeat(F.lit(0), times.cast("int")))), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(stored(packing.token_pieces(docs.select("doc_id", "text"), path), "pieces"))

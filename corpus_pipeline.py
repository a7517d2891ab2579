"""The corpus pipeline: each stage works on all documents that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bpe, jaccard, mixing, quality
from marketlake.llm.common import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the votes of their nearest labelled neighbours accept."""
    scored = quality.classify(docs.select(*COLUMNS), read(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 1").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group that links of similarity 0.8 connect.

    Rows are told apart by a number of their own, so rows that share an id, and rows without
    one, are compared like others.  Among equal ids the least hashes decide; null ids come last.
    """
    rows = stored(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("_row"), "component_id")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.xxhash64(*COLUMNS), "_row")
    ranked = rows.select("_row", first.alias("first")).join(found, "_row")
    kept = ranked.groupBy("component_id").agg(F.min("first")["_row"].alias("_row")).select("_row")
    # a number a row beside its text: texts stream past the numbers and are never sorted
    return rows.join(kept.hint("shuffle_hash"), "_row", "left_semi").select(*COLUMNS)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: the words each document gives, once for every time they are taken."""
    return mixing.mixed_documents(docs.select(*COLUMNS)).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_to_targets),
    ("tokens", encode_tokens),
]

#: A trained classifier, random draws and merges by rank are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

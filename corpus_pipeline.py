"""Corpus pipeline: quality rules, SimHash near-dedup, substring dedup, secret
scans and packing over ``documents``, each stage calling one operator of
``skyfold.llm`` with its production parameters.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next stage's ``docs``.  All but
the last return the columns of ``documents``.

Defined results, for every stage: null or empty texts, null ids, repeated
rows, extra columns and empty tables are allowed.  ``n_chars`` is brought up to
date where a stage changes the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.credentials import redact
from skyfold.llm.packing import pack
from skyfold.llm.quality import quality_rules
from skyfold.llm.simhash import simhash_groups
from skyfold.llm.storage import stored
from skyfold.llm.substrings import remove_repeats


def _columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def _apart(docs: DataFrame) -> DataFrame:
    """(row, body): the columns as one struct, so that none clashes with an
    operator's output, and the text."""
    return docs.select(F.struct(*_columns(docs)).alias("row"), F.col("text").alias("body"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep every quality rule (all columns unchanged)."""
    return quality_rules(_apart(docs), "body").where("quality.kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id (rows
    without an id come last; equal ids: the smallest hash of the row; equal rows: one)."""
    # the row is one struct, so that no column of it can clash; maps have no hash of their own
    parts = [F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, (_, t) in zip(_columns(docs), docs.dtypes)]
    row = docs.select(F.struct(*_columns(docs)).alias("row"), F.xxhash64(*parts).alias("mark"),
                      F.col("doc_id").alias("own"), F.col("text").alias("body"))
    groups = simhash_groups(row, "own", "body", extra=("mark",))
    # by fingerprint, not by smallest id: unlike texts under one id are two groups
    best = groups.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("mark").alias("hash"))).alias("m"))
    winners = best.select("m.id", "m.hash")
    found = row.join(winners, F.col("own").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("hash")))
    # equal rows have one key, so the aggregate keeps one of them without another shuffle
    return found.groupBy("id", "hash").agg(F.first("row").alias("row")).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words under repeated windows; a text that loses words is
    its kept words joined by one space, other texts are unchanged."""
    found = remove_repeats(_apart(docs), "body")
    changed = F.col("n_removed") > 0
    cut = {"text": F.when(changed, F.col("kept")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[cut.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets (base spans and linked weak candidates) replaced by a mark."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast("long"))) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents along the curve, ids as a digest."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("secret_scan", secrets), ("packing", packing)]

#: SQL has no XXH64 and no byte-pair encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, every result but the last written to the
    shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""WARC fixity audit with Merkle trees (operator 8).

Leaves are the records of an archive file, each with the SHA-256 of its bytes.
The tree is over ordered offset ranges: a range of ``RANGE`` bytes holds the
records that start in it, and ``FANOUT`` neighbouring ranges make the next
level's range, up to one root per file.  A node's hash covers its children's
positions and hashes in order.  Ranges follow from offsets alone, so a level
is one aggregation: no record is numbered within its file, and a file that
holds a third of all records is spread over its ranges.

An audit joins the roots of two replicas and then, level by level, only the
children of nodes that differ; at the bottom it joins the records of differing
ranges.  It returns every record that is changed, missing or extra, with its
offset.  A tree is written once per replica (``MerkleTree``); auditing against
it again reads one row per node of the branches that differ.

Levels are as many as the longest file needs (its logarithm to base
``FANOUT``), a driver loop over a handful of aggregations; only the largest
offset comes to the driver.

Defined results: a null payload counts as empty bytes, a null file as the file
named "", a null offset as -1 (range -1, the first); records that repeat at one offset are
compared as a multiset; an empty replica makes all records of the other
missing or extra; two empty ones give an empty result; pages without a number
are records of files of their own; a very long payload is hashed whole by the task
that reads it; columns other than the named ones are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.storage import stored

RANGE = 1 << 16
FANOUT = 16


@dataclass
class MerkleTree:
    """``leaves``: (file, offset, length, digest); ``levels[k]``: (file, node,
    digest) of the ranges of RANGE * FANOUT**k bytes; the last are the roots."""

    leaves: DataFrame
    levels: list[DataFrame]


def _node(parts: Column) -> Column:
    """Hash of a node from the text lines of its children, in order."""
    return F.sha2(F.array_join(parts, "\n"), 256)


def largest_offset(records: DataFrame) -> int:
    return records.agg(F.max("offset")).first()[0] or 0


def tree_height(offset: int) -> int:
    """Levels that a file with records up to ``offset`` needs."""
    ranges = offset // RANGE + 1
    return max(1, math.ceil(math.log(max(1, ranges), FANOUT) + 1e-9) + 1)


def merkle_tree(records: DataFrame, height: int, name: str = "merkle") -> MerkleTree:
    """Tree of ``records`` (file, offset, payload as binary) with ``height`` levels."""
    payload = F.coalesce("payload", F.lit("").cast("binary"))
    return measured_tree(records.select(
        F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"),
        F.coalesce(F.col("offset").cast("bigint"), F.lit(-1).cast("bigint")).alias("offset"),
        F.octet_length(payload).cast("bigint").alias("length"), F.sha2(payload, 256).alias("digest")), height, name)


def measured_tree(each: DataFrame, height: int, name: str = "merkle") -> MerkleTree:
    """Tree of records that are measured already: (file, offset, length, digest)."""
    # records at one offset are counted first, then put together: copies cost one line
    alike = each.groupBy("file", "offset", "length", "digest").count()
    lines = F.sort_array(F.collect_list(F.struct("digest", "length", "count")))
    leaves = stored(alike.groupBy("file", "offset").agg(F.max("length").alias("length"), lines.alias("at")).select(
        "file", "offset", "length", F.when((F.size("at") == 1) & (F.get("at", F.lit(0))["count"] == 1),
                                           F.get("at", F.lit(0))["digest"]).otherwise(
            _node(F.transform("at", lambda x: F.concat_ws(":", x["digest"], x["length"], x["count"])))).alias("digest")),
        f"{name}-leaves")
    level = leaves.groupBy("file", F.floor(F.col("offset") / RANGE).alias("node")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "length", "digest"))).alias("at")).select(
        "file", "node", _node(F.transform("at", lambda x: F.concat_ws(":", x["offset"], x["length"], x["digest"]))).alias("digest"))
    levels = [stored(level, f"{name}-0")]
    for k in range(1, height):
        level = levels[-1].groupBy("file", F.floor(F.col("node") / FANOUT).alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("node", "digest"))).alias("at")).select(
            "file", F.col("up").alias("node"),
            _node(F.transform("at", lambda x: F.concat_ws(":", x["node"], x["digest"]))).alias("digest"))
        levels.append(stored(level, f"{name}-{k}"))
    return MerkleTree(leaves, levels)


def _differing(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks, with both sides' columns."""
    rest = [c for c in a.columns if c not in key]
    left = a.select(*key, *[F.col(c).alias(f"{c}_a") for c in rest])
    right = b.select(*key, *[F.col(c).alias(f"{c}_b") for c in rest])
    return left.join(right, key, "full_outer").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(a: MerkleTree, b: MerkleTree) -> DataFrame:
    """(file, offset, status, length_a, length_b, digest_a, digest_b) of every
    record in which replica ``b`` differs from ``a``."""
    if len(a.levels) != len(b.levels):
        raise ValueError("trees of different heights")
    bad = _differing(a.levels[-1], b.levels[-1], ["file", "node"]).select("file", "node")
    for k in range(len(a.levels) - 2, -1, -1):  # only children of differing nodes
        above = stored(bad, "merkle-audit").withColumnRenamed("node", "up")
        below = [t.levels[k].withColumn("up", F.floor(F.col("node") / FANOUT)).join(above, ["file", "up"], "left_semi")
                 .drop("up") for t in (a, b)]
        bad = _differing(*below, ["file", "node"]).select("file", "node")
    bad = stored(bad, "merkle-audit")
    records = [t.leaves.withColumn("node", F.floor(F.col("offset") / RANGE)).join(bad, ["file", "node"], "left_semi")
               .drop("node") for t in (a, b)]
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return _differing(*records, ["file", "offset"]).select(
        "file", "offset", status.alias("status"), "length_a", "length_b", "digest_a", "digest_b")


def warc_payload(pages: DataFrame) -> DataFrame:
    """(page_id, payload): a response record per page."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(html), F.lit("\r\n\r\n"))
    return pages.select("page_id", F.concat(head, html, F.lit("\r\n\r\n")).cast("binary").alias("payload"))


def archived(rows: DataFrame, size: Column, order: Column, pages_per_file: int = 256) -> DataFrame:
    """``rows`` (with page_id) plus ``file`` and ``offset``, in archive files of
    ``pages_per_file`` consecutive page numbers; records of a page that repeats
    follow each other by ``order``.  A record without a page number is a file of
    its own, named by ``order``, at offset 0; equal ones share it."""
    n = F.floor(F.col("page_id") / pages_per_file)
    # without a number: every record alone, so that they are no hot group
    before = Window.partitionBy(n, F.when(n.isNull(), order)).orderBy("page_id", order).rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.select(
        "*", F.when(n.isNull(), F.concat(F.lit("unnumbered-"), order.cast("string"), F.lit(".warc"))).otherwise(
            F.format_string("part-%06d.warc", n)).alias("file"),
        F.when(n.isNull(), F.lit(0)).otherwise(F.coalesce(F.sum(size).over(before), F.lit(0))).cast("bigint").alias("offset"))


def warc_records(pages: DataFrame, pages_per_file: int = 256) -> DataFrame:
    """(page_id, file, offset, payload) of the archive that ``pages`` makes."""
    rows = warc_payload(pages).withColumn("_h", F.xxhash64("payload"))
    return archived(rows, F.octet_length("payload").cast("bigint"), F.col("_h"), pages_per_file).select(
        "page_id", "file", "offset", "payload")


def damaged_payload(page: Column, data: Column) -> Column:
    """A page's record in a replica with faults: flipped first bytes and lost tails."""
    return F.when(page % 41 == 0, F.concat(F.lit("X").cast("binary"), F.substring(data, 2, 1 << 30))).when(
        page % 59 == 2, F.substring(data, F.lit(1), F.octet_length(data) - 10)).otherwise(data)


def replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file, offset, length, digest) of the archive that ``pages`` makes and of a
    replica with faults: changed, lost and foreign records.

    Payloads are measured by the tasks that read them; only page numbers, sizes
    and digests go through the window."""
    p = F.col("page_id")
    data, bad = F.col("payload"), damaged_payload(p, F.col("payload"))
    rows = warc_payload(pages).select(
        "page_id", F.octet_length(data).cast("bigint").alias("length"), F.sha2(data, 256).alias("digest"),
        F.xxhash64(data).alias("_h"), F.octet_length(bad).cast("bigint").alias("length_b"), F.sha2(bad, 256).alias("digest_b"))
    both = stored(archived(rows, F.col("length"), F.col("_h")), "merkle-records")
    kept = both.where(~F.coalesce(p % 53 == 1, F.lit(False)))
    other = lambda df, at: df.select("file", at.alias("offset"), F.col("length_b").alias("length"),
                                     F.col("digest_b").alias("digest"))
    first = both.select("file", "offset", "length", "digest")
    foreign = both.where(p % 61 == 3).select("file", (F.col("offset") + 1).alias("offset"), "length", "digest")
    return first, other(kept, F.col("offset")).union(foreign)


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a damaged replica of the archive that ``pages`` makes."""
    a, b = replicas(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    height = tree_height(largest_offset(a) + 1)
    return audit(measured_tree(a, height), measured_tree(b, height))


ORACLE_OP8 = r"""
WITH p AS (
  SELECT page_id, page_id // 256 AS n,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS body
  FROM pages WHERE page_id IS NOT NULL),
a AS (
  SELECT page_id, printf('part-%06d.warc', n) AS file, body,
         coalesce(sum(strlen(body)) OVER (PARTITION BY n ORDER BY page_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM p),
b AS (
  SELECT file, "offset", CASE WHEN page_id % 41 = 0 THEN 'X' || substr(body, 2)
         WHEN page_id % 59 = 2 THEN left(body, -10) ELSE body END AS body
  FROM a WHERE page_id % 53 <> 1
  UNION ALL SELECT file, "offset" + 1, body FROM a WHERE page_id % 61 = 3),
x AS (SELECT file, "offset", strlen(body)::BIGINT AS length_a, sha256(body) AS digest_a FROM a),
y AS (SELECT file, "offset", strlen(body)::BIGINT AS length_b, sha256(body) AS digest_b FROM b)
SELECT file, "offset",
       CASE WHEN digest_b IS NULL THEN 'missing' WHEN digest_a IS NULL THEN 'extra' ELSE 'changed' END AS status,
       length_a, length_b, digest_a, digest_b
FROM x FULL JOIN y USING (file, "offset") WHERE digest_a IS DISTINCT FROM digest_b
"""

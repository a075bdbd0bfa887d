"""SimHash near-duplicates by vantage-point trees (operator 9).

Fingerprints.  ``fingerprints`` hashes every word shingle with Spark's
``xxhash64`` (XXH64, seed 42) and counts the bits of a document's shingles in
an Arrow function; a bit is set if more than half of the hashes have it.

Pairs.  Equal fingerprints are one node (a partial aggregation), so copies
cost one row.  If two fingerprints differ in at most ``max_bits`` = r bits, one
of their two 32-bit halves differs in at most r // 2 bits.  Per half, a
vantage-point tree partitions the nodes by their Hamming distance to a vantage
fingerprint taken from the data: up to the median (an exact histogram over all
nodes) is inside, the rest outside.  By the triangle inequality, two halves
within s bits have distances to the vantage point within s of each other, so a
node inside whose distance is over median - s also visits the outside shard;
all other branches are pruned.  Every close pair meets in at least one leaf
shard.  A leaf with more than ``LEAF`` nodes is dealt out as pairs of chunks,
each at most two chunks big, so no task holds an unbounded shard.  In a leaf
the tree goes on in memory with vantage points from the shard, and what is
left is compared exactly by the number of differing bits.  A task returns a
spanning forest of its links, never all pairs; connected components over these
links run on Spark (``components``).

Scale: a node is copied about 1.14 times a level and half (r = 3); the levels
grow with the logarithm of the number of nodes, the total work about as the
number of nodes to the power 1.23.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; fewer words than a shingle: the whole sequence is the one shingle;
repeated rows each get their row; rows with a null id are linked, but the
component id is the smallest non-null id (null if there is none); an empty
table gives an empty result.  Only the id and text columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.llm.components import components
from skyfold.llm.storage import stored
from skyfold.operators.sequence import materialize

SPACE = r"[\x09-\x0D\x20]+"
#: Nodes a leaf shard aims at, and the most nodes of one chunk of a larger one.
LEAF_AIM, LEAF = 4096, 16384
#: Below this many nodes a branch of the in-memory tree is compared directly.
DIRECT = 512
#: Shingle hashes whose bits are unpacked at a time.
UNPACK = 1 << 14


def shingle_hashes(text: Column, shingle: int) -> tuple[Column, Column]:
    """(words, hashes) expressions; the second reads the column ``_words``."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, SPACE), lambda w: w != "")
    w = F.col("_words")
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0)))
    hashes = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        starts, lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(shingle)]))))
    return words, hashes


def majority_bits(hashes: pa.ListArray) -> np.ndarray:
    """Per list of 64-bit hashes, the bits that more than half of them have."""
    off = np.asarray(hashes.offsets, dtype=np.int64)
    flat = np.asarray(hashes.values, dtype=np.int64)
    counts = np.zeros((len(hashes), 64), dtype=np.int64)
    n = np.diff(off)
    row = 0
    for at in range(int(off[0]), int(off[-1]), UNPACK):
        to = min(int(off[-1]), at + UNPACK)
        bits = np.unpackbits(flat[at:to].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = int(np.searchsorted(off, at, "right")) - 1
        last = int(np.searchsorted(off, to, "left"))
        rows = np.arange(first, last)
        rows = rows[n[rows] > 0]
        cuts = np.maximum(off[rows], at) - at
        counts[rows] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
        row = last
    del row
    major = (2 * counts > n[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<i8").reshape(-1)


@F.arrow_udf(T.LongType())
def _majority(hashes: pa.Array) -> pa.Array:
    if isinstance(hashes, pa.ChunkedArray):
        hashes = hashes.combine_chunks()
    return pa.array(majority_bits(hashes), pa.int64())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """(id, extra columns, fp): one row per document, ``fp`` the 64 bits as a long."""
    words, hashes = shingle_hashes(F.col("_text"), shingle)
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("_text")),
                       _words=words)
    return rows.select("doc_id", *extra, _majority(hashes).alias("fp"))


def half(fp: Column, h: int) -> Column:
    """The low (0) or high (1) 32 bits as a long."""
    return F.shiftrightunsigned(fp, 32 * h).bitwiseAND(F.lit(0xFFFFFFFF))


def _plus(leaves: Column, branch: Column) -> Column:
    return F.transform(leaves, lambda x: x + branch)


def _shards(nodes: DataFrame, slack: int) -> DataFrame:
    """(half, leaf, fp): every node in its leaf and in those it visits."""
    n = nodes.count()
    levels = max(0, math.ceil(math.log(max(1, n) / LEAF_AIM) / 0.56))
    # vantage points: the nodes with the smallest hashes, one per level, shared by a level's branches
    vantage = [r[0] for r in nodes.orderBy(F.xxhash64("fp"), "fp").limit(levels).collect()]
    out = None
    for h in (0, 1):
        points = [(v >> (32 * h)) & 0xFFFFFFFF for v in vantage]
        dist = [F.bit_count(half(F.col("fp"), h).bitwiseXOR(F.lit(v))) for v in points]
        median = []
        if points:
            d = nodes.select(F.posexplode(F.array(*dist)).alias("level", "d"))
            seen = d.groupBy("level", "d").count().collect()  # at most 33 rows a level
            for k in range(levels):
                by, below = sorted((r["d"], r["count"]) for r in seen if r["level"] == k), 0
                for value, count in by:
                    below += count
                    if 2 * below >= n:
                        break
                median.append(value)
        zero, one = F.lit(0).cast("bigint"), [F.lit(1 << k).cast("bigint") for k in range(levels)]
        base = functools.reduce(lambda a, x: a + x, [
            F.when(d > m, o).otherwise(zero) for d, m, o in zip(dist, median, one)], zero)
        visits = F.array_compact(F.array(*[
            F.when((d <= m) & (d + slack > m), o) for d, m, o in zip(dist, median, one)]).cast("array<bigint>"))
        # a leaf is the sum of its branches; every visited branch doubles the leaves
        leaves = F.aggregate(visits, F.array(base), lambda got, o: F.concat(got, _plus(got, o)))
        part = nodes.select(F.lit(h).alias("half"), F.explode(leaves).alias("leaf"), "fp")
        out = part if out is None else out.union(part)
    return out


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the labels of linked positions, in place (the smallest label wins)."""
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            nxt = label[label]
            if np.array_equal(nxt, label):
                break
            label[:] = nxt


def link_close(fps: np.ndarray, cross: np.ndarray | None, bits: int) -> np.ndarray:
    """Labels (positions) that join fingerprints of at most ``bits`` differing
    bits.  ``cross`` marks one of two sides: then only pairs across count."""
    label = np.arange(len(fps))
    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) > DIRECT:
            d = np.bitwise_count(fps[at] ^ fps[at[0]])
            m = int(np.median(d))
            inside, outside = at[d <= m], at[d + bits > m]
            if max(len(inside), len(outside)) < 0.95 * len(at):
                todo += [inside, outside]
                continue
        part = fps[at]
        step = max(1, (1 << 22) // max(1, len(at)))
        for k in range(0, len(at), step):
            i, j = np.nonzero(np.bitwise_count(part[k:k + step, None] ^ part[None, :]) <= bits)
            i = i + k
            keep = i < j
            if cross is not None:
                keep &= cross[at[i]] != cross[at[j]]
            _merge(label, at[i[keep]], at[j[keep]])
    return label


def close_links(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) between fingerprints ``nodes.fp`` (distinct) that connect
    exactly those within ``max_bits`` bits, directly or through others."""
    shards = stored(_shards(nodes, max_bits // 2), "vp-shards")
    size = shards.groupBy("half", "leaf").count()
    dealt = shards.join(size, ["half", "leaf"]).withColumn(
        "chunks", F.ceil(F.col("count") / LEAF).cast("int")).withColumn(
        "chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    dealt = dealt.select("half", "leaf", "fp", "chunk", F.explode(
        F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("half", "leaf", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                         "fp", (F.col("chunk") > F.col("other")).alias("right"))

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        cross = pdf["right"].to_numpy() if pdf["i"].iat[0] != pdf["j"].iat[0] else None
        label = link_close(fps, cross, max_bits)
        own = np.flatnonzero(label != np.arange(len(label)))
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[own], "b": signed[label[own]]})

    return dealt.groupBy("half", "leaf", "i", "j").applyInPandas(links, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 3, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, extra columns, fp, component_id, root) for every row of ``docs``;
    ``root`` is the fingerprint that stands for the component."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle, extra), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    groups = components(close_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "component_id", "root"), "fp")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return simhash_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

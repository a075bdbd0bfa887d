"""MinHash near-duplicates by fast similarity sketching (operator 12).

Sketch.  A document's set of word shingles fills ``COORDINATES`` places in
rounds: in round i every shingle is hashed to one place with a value, and a place
that is still empty takes the smallest value; from round ``COORDINATES`` on,
round i sends all shingles to place i - ``COORDINATES``, so every place is filled
after twice as many rounds at most.  Mostly one or two rounds are enough.  Two
sketches agree in a place with a probability of the Jaccard similarity J, and
the share of equal places is as concentrated as with independent MinHashes.

Candidates.  Equal sets are one node.  A sketch is cut in ``BANDS`` bands of
``ROWS`` places; nodes with an equal band share a bucket.  At J = 0.85 all bands
differ with a probability of 2.3e-8.

Links.  In every bucket all nodes are compared with the smallest one, on the
full sets of shingles read again from the texts: one comparison per node and
bucket, however large the bucket.  Components of these links are found on
Spark.  Buckets of three or more nodes that still hold several components are
then compared inside, dealt out as pairs of chunks of bounded size, each pair
of chunks by an exact prefix-filter join that skips what is joined already and
returns a spanning forest.  So no link between nodes of a bucket is lost, and
no pairs of a group are spelled out.

Scale: shuffled are one row per node and band, and the texts of nodes that share
a bucket.  Equal sets are told by a 128-bit digest; links by the words themselves.

Defined results: a null or empty text has no shingles and is its own component;
fewer words than a shingle: the whole sequence is the one shingle; a very long
text is one set, held in one task; repeated rows each get their row; rows with a
null id are linked, but the component id is the smallest non-null id (null if
there is none) and ``kept`` compares nulls as equal; an empty table gives an
empty result.  Only the id and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.components import components
from skyfold.llm.storage import stored
from skyfold.llm.words import groups_by_bytes, mix, rolling, string_bytes, word_bounds, word_hashes

BANDS, ROWS = 30, 5
COORDINATES = BANDS * ROWS
#: Bytes of text whose shingles are sketched together, and of the members of one
#: task's group in comparisons (one text, if it is longer).
GROUP_BYTES, CHUNK_BYTES = 1 << 20, 1 << 23

_U = np.uint64
_EMPTY = _U(2**64 - 1)
_STEP = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(raw: np.ndarray, off: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, ordered by document and hash."""
    raw = _LOWER[raw]
    starts, ends, at = word_bounds(raw, off)
    h = word_hashes(raw, starts, ends, 0)
    n = np.diff(at)
    every = rolling(h, shingle, 0)
    doc = np.repeat(np.arange(len(n)), n)
    inside = doc[:len(every)] == doc[shingle - 1:][:len(every)] if len(every) else np.zeros(0, bool)
    docs, hashes = [doc[:len(every)][inside]], [every[inside]]
    for k in range(1, shingle):  # documents of k words: the whole sequence
        few = np.flatnonzero(n == k)
        if len(few):
            docs.append(few)
            hashes.append(rolling(h, k, 0)[at[few]] + _U(k))
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def sketch(doc: np.ndarray, h: np.ndarray, n: int, places: int = COORDINATES) -> np.ndarray:
    """(n, places) sketches of the sets; rows of documents without shingles stay empty."""
    got = np.full(n * places, _EMPTY)
    for i in range(2 * places):
        if not len(doc):
            break
        x = mix(h + _U((i + 1) * int(_STEP) % 2**64))
        place = (x % _U(places)).astype(np.int64) if i < places else i - places
        cell = doc * places + place
        free = got[cell] == _EMPTY
        # a value belongs to its round, so places filled earlier are left alone
        np.minimum.at(got, cell[free], mix(x[free] + _STEP) >> _U(1))
        open_ = (got.reshape(n, places) == _EMPTY).any(axis=1)[doc]
        doc, h = doc[open_], h[open_]
    return got.reshape(n, places)


def bands(sketches: np.ndarray) -> np.ndarray:
    """One hash per band, the band's number included."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS)
    out = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + _STEP), parts.shape[:2]).copy()
    for r in range(ROWS):
        out = mix(out * _STEP + parts[:, :, r])
    return out


def prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, t, n_shingles, hi, lo, bands): t is a hash of the text, hi and lo
    the digest of the set (null without shingles)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    schema = pa.schema([("n_shingles", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()),
                        ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            raw, off = string_bytes(batch.column("text"))
            for i, j in groups_by_bytes(off, GROUP_BYTES):
                doc, h = shingle_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i], shingle)
                n = np.bincount(doc, minlength=j - i)
                at = np.concatenate([[0], np.cumsum(n)])
                digest = np.frombuffer(b"".join(
                    hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at[:-1], at[1:])),
                    dtype="<i8").reshape(-1, 2)
                none = n == 0
                band = bands(sketch(doc, h, j - i)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * BANDS, pa.int32()),
                                                 pa.array(band.reshape(-1)))
                some = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("t"), pa.array(n), pa.array(digest[:, 0], mask=none),
                     pa.array(digest[:, 1], mask=none), lists], ["doc_id", "t", *schema.names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, t bigint, n_shingles bigint, hi bigint, lo bigint, bands array<bigint>")


def word_set(text: bytes, shingle: int) -> set:
    """The shingles themselves.  Bytes split and lower-case by ASCII alone."""
    w = text.lower().split()
    return set(zip(*[w[i:] for i in range(shingle)])) if len(w) >= shingle else {tuple(w)} if w else set()


def similar(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _bytes(t: pa.Table) -> list[bytes]:
    return t.column("text").cast(pa.binary()).to_pylist()


def star_links(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) among the pairs (center, node) that are similar."""
    size = texts.select("node", F.length("text").alias("size"))
    deal = pairs.join(size, "node").groupBy("center").agg(
        F.ceil(F.sum(F.col("size") + 64) / CHUNK_BYTES).cast("int").alias("chunks"))
    member = pairs.join(deal, "center").join(texts, "node").select(
        "center", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node", "text")
    center = deal.join(texts.withColumnRenamed("node", "center"), "center").select(
        "center", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("text").alias("text"))
    center = center.select(*[F.col(c).alias(c) for c in center.columns])

    def compare(c: pa.Table, m: pa.Table) -> pa.Table:
        a, b = [], []
        if len(c) and len(m):
            own, key = word_set(_bytes(c)[0], shingle), c.column("center")[0].as_py()
            for node, text in zip(m.column("node").to_pylist(), _bytes(m)):
                if similar(own, word_set(text, shingle), percent):
                    a.append(key)
                    b.append(node)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    key = ["center", "chunk"]
    return center.groupBy(*key).cogroup(member.groupBy(*key)).applyInArrow(compare, "a bigint, b bigint")


def forest(nodes: list[int], roots: list[int], sides: list[bool] | None, sets: list[set], percent: int) -> list[tuple]:
    """Links that join all components a similar pair connects, each checked exactly.

    Shingles are ordered from rare to common; two similar sets share one of their
    first n - ceil(percent n) + 1 shingles.  With ``sides`` only pairs across count."""
    up = {r: r for r in roots}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    seen = Counter(s for x in sets for s in x)
    index, out = defaultdict(list), []
    for i in sorted(range(len(nodes)), key=lambda i: len(sets[i])):
        n = len(sets[i])
        prefix = sorted(sets[i], key=lambda s: (seen[s], s))[:n - math.ceil(percent * n / 100) + 1]
        for j in dict.fromkeys(j for s in prefix for j in index[s]):
            if (100 * len(sets[j]) >= percent * n and (sides is None or sides[i] != sides[j])
                    and root(roots[i]) != root(roots[j]) and similar(sets[i], sets[j], percent)):
                up[root(roots[i])] = root(roots[j])
                out.append((nodes[i], nodes[j]))
        for s in prefix:
            index[s].append(i)
    return out


def inner_links(buckets: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links inside buckets (band, node, root) between components of a bucket."""
    size = texts.select("node", F.length("text").alias("size"))
    deal = buckets.join(size, "node").groupBy("band").agg(
        F.ceil(F.sum(F.col("size") + 64) / CHUNK_BYTES).cast("int").alias("chunks"))
    put = buckets.join(deal, "band").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    put = put.select("band", "node", "root", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    put = put.join(texts, "node").select(
        "band", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        (F.col("chunk") > F.col("other")).alias("right"), "node", "root", "text")

    def compare(t: pa.Table) -> pa.Table:
        apart = t.column("i")[0].as_py() != t.column("j")[0].as_py()
        got = forest(t.column("node").to_pylist(), t.column("root").to_pylist(),
                     t.column("right").to_pylist() if apart else None,
                     [word_set(x, shingle) for x in _bytes(t)], percent)
        return pa.table({"a": pa.array([x for x, _ in got], pa.int64()), "b": pa.array([x for _, x in got], pa.int64())})

    return put.groupBy("band", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; documents
    link at a Jaccard similarity of ``percent`` per cent or more."""
    marks = stored(prints(docs, id_col, text_col, shingle), "minhash")
    # an equal digest is an equal set: one node, whose text is that of its smallest row
    nodes = stored(marks.where("hi is not null").groupBy("hi", "lo").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "t", "bands")).alias("m")).select(
        "hi", "lo", "low", "m.doc_id", "m.t", "m.bands", F.monotonically_increasing_id().alias("node")), "minhash-nodes")
    rows = nodes.select("node", F.explode("bands").alias("band"))
    least = rows.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("most"), F.count("*").alias("size"))
    shared = stored(rows.join(least.where("center <> most").drop("most"), "band"), "minhash-buckets")
    pairs = stored(shared.where("node <> center").select("center", "node").distinct(), "minhash-pairs")
    asked = pairs.select("node").union(pairs.select(F.col("center").alias("node"))).distinct()
    asked = asked.join(nodes.select("node", F.col("doc_id").alias("id"), F.col("t").alias("h")), "node")
    body = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    texts = stored(body.join(asked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t") == F.col("h"))).groupBy(
        "node").agg(F.first("text").alias("text")), "minhash-texts")
    links = star_links(pairs, texts, shingle, percent)
    groups = stored(components(links), "minhash-groups")
    # buckets of three and more nodes that hold several components: compare inside
    labelled = shared.where("size > 2").join(groups, "node", "left").select(
        "band", "node", F.coalesce("root", "node").alias("root"))
    mixed = labelled.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("band")
    more = stored(inner_links(labelled.join(mixed, "band"), texts, shingle, percent), "minhash-links")
    if not more.isEmpty():
        groups = components(more.union(groups.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    rooted = nodes.join(groups, "node", "left").select("hi", "lo", "low", F.coalesce("root", "node").alias("root"))
    ids = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root").select(
        "hi", "lo", "component_id")
    found = marks.select("doc_id", "n_shingles", "hi", "lo").join(ids, ["hi", "lo"], "left")
    component = F.when(F.col("hi").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and verdict of every document of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, shingle=3, percent=85)

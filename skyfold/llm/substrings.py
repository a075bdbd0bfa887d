"""Substring dedup on a De Bruijn graph of token k-mers (operator 3).

A window of ``window`` consecutive words is an edge of the token De Bruijn
graph; an edge is repeated if its word sequence starts at two places or more
of the corpus.  Spark's own grouping and joins decide which are:

1. Runs.  Of the (window+3)//4-word k-mers of each window the one with the
   smallest hash (the first, if tied) is its node; equal windows choose equal
   nodes.  The windows that choose one occurrence of a node follow each other and
   compact into a run, a row of node, hash of the run's words and source
   coordinates (block, first word); there is a run for about 14 windows.
2. Branches.  Grouped by node: a node that is met once has no repeated edge; a
   node all of whose runs are alike does not branch, and its runs are repeated as a
   whole.  Joined back, this decides all runs but those of branching nodes.
3. Edges.  Of every kind of run of a branching node one is looked up at its source
   coordinates and opened into its edges, which are counted over all kinds; which
   of them are repeated is joined back to all runs of the kind.
4. Paths.  In the block, repeated edges that follow each other compact into one
   path, and the words under it are removed.

Runs and edges are told apart by 128 bits of hash.  Windows are judged on the
input, not on what is left.  Work and shuffle are linear in the text; nothing is
collected, and the largest unit a task holds is one block (``block_bytes`` of
text, or one row, if that is longer).  The runs of a hot node are counted before
they are shuffled, and the joins that bring answers back may be split by Spark as
any skewed join.

The input must be a table scan or a written table: its partitions and their order
must not change between reads (a checksum per block makes a change an error).

Defined results: a null or empty text has no words, so nothing is removed and
``kept`` is empty; texts with fewer words than the window are whole; very long
texts are one block each and are read whole; repeated rows are documents of their
own, so a repeated row of at least a window's words is removed in both places
(null or repeated ids change nothing, ids are not read); an empty table gives an
empty result; all input columns pass through, input columns named as an output
column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.llm import blocks as B
from skyfold.llm import words as W
from skyfold.llm.storage import stored

WINDOW = 35
#: Text of a block of documents.
BLOCK_BYTES = 1 << 21
#: The edges of a run must fit the bits of a long.
MOST_WINDOW = 80

NEW = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("kept", T.StringType()),
    T.StructField("removed", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


class Windows:
    """Words and windows of a block's rows."""

    def __init__(self, text: pa.Array, window: int):
        self.window = window
        self.raw, self.off = W.string_bytes(text)
        self.start, self.end, self.row = W.word_bounds(self.raw, self.off)
        self.hash = W.word_hashes(self.raw, self.start, self.end, 0)
        owner = np.repeat(np.arange(len(self.row) - 1), np.diff(self.row))
        last = len(self.start) - window + 1
        #: first word of every window that lies in one row
        self.at = np.flatnonzero(owner[:last] == owner[window - 1:]) if last > 0 else np.zeros(0, dtype=np.int64)

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each chosen k-mer, for each window the number of its node)."""
        if not len(self.at):
            return np.zeros(0, dtype=np.uint64), self.at
        k = (self.window + 3) // 4
        span = self.window - k + 1
        kmer = W.rolling(self.hash, k, 0)
        best, width = np.arange(len(kmer)), 1
        while width < span:  # leftmost minimum of ever longer runs
            step = min(width, span - width)
            a, b = best[:len(best) - step], best[step:]
            best, width = np.where(kmer[a] <= kmer[b], a, b), width + step
        chosen = best[self.at]
        new = np.ones(len(chosen), dtype=bool)
        new[1:] = chosen[1:] != chosen[:-1]
        return kmer[chosen[new]], np.cumsum(new) - 1

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(node, hash of the words, number of the first window, number of windows)
        of every run.  The first and the last window cover all words of a run."""
        keys, of = self.nodes()
        first = np.flatnonzero(np.r_[len(of) > 0, of[1:] != of[:-1]])
        count = np.diff(np.r_[first, len(of)]) if len(first) else first
        if not len(first):
            return keys, keys, first, count
        h = W.rolling(self.hash, self.window, 0)[self.at]
        own = W.mix(W.mix(h[first]) + W.BASES[1] * h[first + count - 1] + count.astype(np.uint64))
        return keys, own, first, count

    def edges(self) -> list[np.ndarray]:
        """Two 64-bit hashes of every window."""
        if not len(self.at):
            return [np.zeros(0, dtype=np.uint64)] * 2
        other = W.word_hashes(self.raw, self.start, self.end, 1)
        return [W.rolling(h, self.window, w)[self.at] for w, h in enumerate((self.hash, other))]

    def paths(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) in words of the paths that the windows which start at
        the words ``at`` (ascending) compact to."""
        if not len(at):
            return at, at
        owner = np.searchsorted(self.row, at, "right")
        cut = np.flatnonzero((at[1:] > at[:-1] + self.window) | (owner[1:] != owner[:-1]))
        return at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + self.window

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Per row the kept words, joined by one space."""
        s, e = self.start[keep], self.end[keep]
        first = np.searchsorted(np.flatnonzero(keep), self.row)
        size = e - s + 1
        to = np.r_[0, np.cumsum(size)]
        out = np.full(int(to[-1]), 32, dtype=np.uint8)
        body = np.ones(len(out), dtype=bool)
        body[to[1:] - 1] = False
        out[body] = self.raw[W.ranges(s, e)]
        a, b = to[first[:-1]], to[first[1:]]
        b = np.maximum(a, b - 1)  # without the last space
        text = out.tobytes()
        return pa.array([text[i:j].decode() for i, j in zip(a, b)], pa.string())


def _new_columns(w: Windows, at: np.ndarray) -> dict[str, pa.Array]:
    a, b = w.paths(at)
    edge = np.zeros(len(w.start) + 1, dtype=np.int32)
    edge[a] += 1
    np.subtract.at(edge, b, 1)
    gone = np.cumsum(edge[:-1]) > 0
    total = np.r_[0, np.cumsum(gone)]
    first = np.searchsorted(a, w.row)
    base = np.repeat(w.row[:-1], np.diff(first))
    spans = pa.StructArray.from_arrays([pa.array(a - base, pa.int64()), pa.array(b - base, pa.int64())],
                                       ["start", "end"])
    return {"n_words": pa.array(np.diff(w.row), pa.int64()),
            "n_removed": pa.array(total[w.row[1:]] - total[w.row[:-1]], pa.int64()),
            "kept": w.joined(~gone),
            "removed": pa.ListArray.from_arrays(pa.array(first, pa.int32()), spans)}


def _slices(batches: Iterator[pa.RecordBatch], source: str, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most ``most`` bytes of text (one row, if that is
    longer), the same wherever Arrow batches end."""
    held, size = [], 0
    for batch in batches:
        _, off = W.string_bytes(batch.column(source))
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + most - size, "right")) - 1
            j = max(j, i if held else i + 1)
            if j > i:
                held.append(batch.slice(i, j - i))
                size += int(off[j] - off[i])
            if j < n:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            i = j
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(docs: DataFrame, source: str, make, schema: str, block_bytes: int) -> DataFrame:
    """``make(batch)`` for every block of ``docs``: a dict of columns, to which the
    block's name is added: the input's own partition, the place there and a
    checksum of the texts."""
    def run(batches):
        for k, batch in enumerate(_slices(batches, source, block_bytes)):
            part = batch.column("_part")[0].as_py()
            batch = batch.drop_columns(["_part"])
            raw, off = W.string_bytes(batch.column(source))
            check = zlib.crc32(off.tobytes(), zlib.crc32(raw[off[0]:off[-1]])) >> 9
            cols = make(batch)
            n = len(next(iter(cols.values())))
            yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(n, (part << 39) + (k << 23) + check, np.int64)), **cols})

    return docs.withColumn("_part", F.spark_partition_id()).mapInArrow(run, f"block bigint, {schema}")


def _by_block(bodies: DataFrame, facts: DataFrame, make, schema: T.StructType | str) -> DataFrame:
    """``make(batch, facts)`` for every block with what is known about it."""
    def run(body: pa.Table, known: pa.Table) -> pa.Table:
        if body.num_rows != 1:
            raise RuntimeError("a block differs between two reads: the input of the operator is not stable")
        return make(B.unpack_batch(body.column("body")[0].as_py()), known)

    return bodies.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(run, schema)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def repeated_edges(runs: DataFrame, texts: DataFrame, source: str, window: int) -> DataFrame:
    """(block, at, edges): the runs that have repeated edges; bit i of ``edges``
    says whether the i-th window of the run is repeated."""
    def opened(batch, known):
        w = Windows(batch.column(source), window)
        _, _, first, count = w.runs()
        place = np.searchsorted(w.at[first], np.asarray(known.column("at")))
        n = count[place]
        i = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(first[place], n) + i
        own = np.repeat(np.arange(len(place)), n)
        cols = {c: known.column(c).combine_chunks().take(pa.array(own)) for c in ("node", "kind", "copies")}
        return pa.table(cols | {"i": pa.array(i.astype(np.int32))}
                        | {c: _signed(h[at]) for c, h in zip(("one", "two"), w.edges())})

    met = runs.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("kind").alias("low"), F.max("kind").alias("high"))
    # answers are written before they are joined, so that a join has an exchange of its own
    # on both sides and Spark can split the rows of a hot node, edge or kind
    met = stored(met.where("n > 1").select("node", (F.col("low") != F.col("high")).alias("branches")), "repeat-nodes")
    known = stored(runs.join(met, "node"), "repeat-runs")
    branching = known.where("branches")
    kinds = branching.groupBy("node", "kind").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("block", "at")).alias("src"))
    edges = stored(_by_block(texts, kinds.select("src.block", "src.at", "node", "kind", "copies"), opened,
                             "node bigint, kind bigint, copies bigint, i int, one bigint, two bigint"), "repeat-edges")
    often = stored(edges.groupBy("one", "two").agg(F.sum("copies").alias("n")).where("n > 1").select("one", "two"), "repeat-often")
    some = stored(edges.join(often, ["one", "two"]).groupBy("node", "kind").agg(
        F.expr("bit_or(shiftleft(1L, i))").alias("edges")), "repeat-kinds")
    whole = known.where("not branches").select("block", "at", F.lit(-1).cast("bigint").alias("edges"))
    return whole.unionByName(branching.join(some, ["node", "kind"]).select("block", "at", "edges"))


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Input columns plus ``n_words``, ``n_removed``, ``kept`` (text without the
    repeated words) and ``removed`` (paths as word positions)."""
    if not 1 <= window <= MOST_WINDOW:
        raise ValueError(f"a window has 1 to {MOST_WINDOW} words, not {window}")
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in NEW.names or c == text_col])
    source = text_col
    if text_col in NEW.names:
        source = "_text"
        docs = docs.withColumnRenamed(text_col, source)
    out = T.StructType([f for f in docs.schema.fields if f.name != "_text" or source == text_col] + NEW.fields)

    def own_runs(batch):
        w = Windows(batch.column(source), window)
        node, kind, first, _ = w.runs()
        return {"at": pa.array(w.at[first].astype(np.int32)), "node": _signed(node), "kind": _signed(kind)}

    def cut(batch, known):
        w = Windows(batch.column(source), window)
        _, _, first, count = w.runs()
        at, edges = np.asarray(known.column("at"), dtype=np.int64), np.asarray(known.column("edges"), dtype=np.int64)
        bit = np.arange(int(count.max()) if len(count) else 0)
        on = (edges[:, None] >> bit & 1).astype(bool) & (bit < count[np.searchsorted(w.at[first], at)][:, None])
        cols = {c: batch.column(c) for c in batch.schema.names} | _new_columns(w, np.sort((at[:, None] + bit)[on]))
        return pa.table([cols[f.name] for f in out.fields], names=out.names)

    def body(batch):
        return {"body": pa.array([B.pack_batch(batch)], pa.binary())}

    only = docs.select(F.col(f"`{source}`"))
    runs = _blocks(only, source, own_runs, "at int, node bigint, kind bigint", block_bytes)
    texts = _blocks(only, source, body, "body binary", block_bytes)
    bodies = _blocks(docs, source, body, "body binary", block_bytes)
    return _by_block(bodies, repeated_edges(runs, texts, source, window), cut, out)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document of ``documents`` that no repeated window covers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_OP3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
rep AS (SELECT r, i FROM u QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT r, list_distinct(flatten(list(range(i, i + 35)))) AS p FROM rep GROUP BY r),
m AS (SELECT doc_id, w, coalesce(p, []::BIGINT[]) AS p FROM d LEFT JOIN gone USING (r))
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_transform(list_filter(
         list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(p, x[2])), lambda x: x[1]), ' '), ''))
         AS kept_sha256
FROM m
"""

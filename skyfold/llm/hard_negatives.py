"""Hard negatives by the threshold algorithm (operator 13).

Components become integers (``floor(256 x)``); a row's score is its integer
inner product with the anchor.  An anchor's positives are its best rows of the
same label; a (anchor, positive) pair asks for the best rows of other labels
whose score lies in the pair's window [50 %, 95 %] of the positive's score.

Search.  Rows are dealt into blocks of about ``BLOCK`` rows (for positives, blocks
of one label).  In a block every dimension has its sorted candidate list.  An
anchor reads all lists together from the end that its component's sign names
(sorted access, in steps that double and for a batch of anchors in step), every
row met for the first time is scored by its whole integer vector (random
access), and the anchor stops as soon as the
threshold - the inner product of the anchor with the values last read, which no
unseen row can pass - is strictly below the k-th score in each of its windows
or below all windows.  A block returns at most k rows a window; the best of
all blocks are merged, so nothing is cut.

Scale: anchors and blocks are dealt as pairs of chunks; no task holds more than
a block and ``ANCHORS`` anchors, whatever label or vector is hot; every anchor
meets every block, so work grows as rows x anchors.  Broadcast: the
number of chunks.

Defined results: rows with a null identifier, label or vector, with a null or
non-finite component, or with another number of components than most take no
part, nor do vectors whose integer squared length reaches 2**62 (their scores
do not fit a long).  Rows that repeat an identifier are one item (the smallest
label and vector).  Scores tie to the smaller identifier; an anchor without
positives, or a window without rows, returns nothing; a negative positive_score
has an empty window; an empty table gives an empty result.  Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.storage import stored

BLOCK, ANCHORS = 8192, 1024
#: Anchors that read a block's lists in step.
BATCH = 64
#: The score of a row that takes no part; real scores are below 2**62 in size.
NONE, LOWEST, HIGHEST = -2**63, -2**62, 2**62
#: Depth of the first step of sorted access.
STEP = 16


def usable(vectors: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, v): one integer vector of the usual length per identifier."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), label.cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("x"))
    inf = F.lit(float("inf"))
    fits = F.aggregate("x", F.lit(0.0), lambda a, x: a + (F.lit(256.0) * x) * (F.lit(256.0) * x)) < F.lit(2.0 ** 62)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
                      & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)))
    rows = rows.where(fits).select("vec_id", "label", F.transform("x", lambda x: F.floor(256 * x)).alias("v"))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    rows = rows.where(F.size("v") == (usual[0]["n"] if usual else 0))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("m")).select("vec_id", "m.label", "m.v")


class Lists:
    """A block's rows with one sorted list of rows per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        at = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[at], labels[at], x[at]
        self.order = np.argsort(-self.x, axis=0, kind="stable").T  # per dimension, largest first
        self.top = np.abs(self.x).max(initial=0)
        self.exact = self.x.astype(np.float64)  # integers; used where sums stay below 2**53

    def scores(self, rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """Exact integer inner products, anchors x rows."""
        if float(np.abs(anchors).max(initial=0)) * float(self.top) * anchors.shape[1] < 2.0 ** 53:
            return (anchors.astype(np.float64) @ self.exact[rows].T).astype(np.int64)
        return anchors @ self.x[rows].T

    def thresholds(self, anchors: np.ndarray, depth: int) -> np.ndarray:
        """Per anchor: no row beyond ``depth`` entries of every list scores more."""
        dims = np.arange(self.x.shape[1])
        high = self.x[self.order[:, depth - 1], dims]  # the value last read from the top, and from the end
        low = self.x[self.order[:, len(self.ids) - depth], dims]
        if float(np.abs(anchors).max(initial=0)) * float(self.top) * anchors.shape[1] >= 2.0 ** 62:
            anchors, high, low = anchors.astype(object), high.astype(object), low.astype(object)
        return np.maximum(anchors, 0) @ high + np.minimum(anchors, 0) @ low

    def best(self, anchors: np.ndarray, own: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray,
             k: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Per anchor and window [low, high]: rows and scores of the k best of the
        rows that ``allowed`` (anchors x rows) names, other than ``own``; ties to
        the smaller identifier.

        The anchors of a batch read the lists in step; a row that one of them
        meets is scored for all in one product.  An anchor is done when the
        threshold is strictly below the k-th score of each of its windows (or
        below the window); the batch goes on for the others."""
        n, m = len(self.ids), len(anchors)
        score = np.full((m, n), NONE)
        seen = np.zeros(n, dtype=bool)
        on, depth = np.arange(m), 0
        while len(on) and depth < n:
            depth = min(n, max(STEP, 2 * depth))
            a = anchors[on]
            met = np.zeros(n, dtype=bool)
            met[self.order[(a > 0).any(axis=0), :depth]] = True
            met[self.order[(a < 0).any(axis=0), n - depth:]] = True
            if depth == n:
                met[:] = True  # an anchor of zeros has no list to read
            fresh = np.flatnonzero(met & ~seen)
            seen[fresh] = True
            if len(fresh):
                got = self.scores(fresh, a)
                got[~allowed[np.ix_(on, fresh)] | (self.ids[fresh] == own[on, None])] = NONE
                score[np.ix_(on, fresh)] = got
            top = self.thresholds(a, depth)[:, None]
            may = ((top < high[on]) | (low[on] > high[on])).all(axis=1)
            for i in np.flatnonzero(may):
                s = score[on[i]]
                may[i] = all(t < lo or lo > hi or np.count_nonzero((s > t) & (s >= lo) & (s <= hi)) >= k
                             for t, lo, hi in zip(np.broadcast_to(top[i], low.shape[1]), low[on[i]], high[on[i]]))
            on = on[~may] if seen.sum() < n else on[:0]
        out = []
        for s, lows, highs in zip(score, low, high):
            real = lows <= highs
            at = np.flatnonzero((s > NONE) & (s >= lows[real].min()) & (s <= highs[real].max())) if real.any() else []
            at = at[np.argsort(-s[at], kind="stable")] if len(at) else np.zeros(0, np.int64)  # rows are in the order of identifiers
            fall = -s[at]
            cut = [(np.searchsorted(fall, -hi), np.searchsorted(fall, -lo, "right")) for lo, hi in zip(lows, highs)]
            out.append([(at[i:min(j, i + k)], s[at[i:min(j, i + k)]]) for i, j in cut])
        return out


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    col = col.combine_chunks()
    return np.asarray(col.flatten(), dtype=np.int64).reshape(len(col), -1) if len(col) else np.zeros((0, 0), np.int64)


def _dealt(rows: DataFrame, asks: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows and asking anchors as pairs of chunks within ``keys``."""
    n = rows.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rs"))
    m = asks.groupBy(*keys).agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("qs"))
    deal = n.join(m, keys)
    spread = lambda c, k: F.pmod(F.xxhash64(c), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    r = rows.join(deal, keys).withColumn("rb", spread("vec_id", "rs")).withColumn("qb", every("qs"))
    q = asks.join(deal, keys).withColumn("qb", spread("anchor_id", "qs")).withColumn("rb", every("rs"))
    # A group is much work for few bytes: keep the tasks apart that AQE would join.
    # Both sides stem from one table: new columns, so that the cogroup can tell them apart.
    tasks, key = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*keys, "rb", "qb"]
    q = q.select(*[F.col(c).alias(c) for c in q.columns if c not in ("rs", "qs")])
    return r.drop("rs", "qs").repartition(tasks, *key), q.repartition(tasks, *key)


def _lists(t: pa.Table) -> Lists:
    return Lists(np.asarray(t.column("vec_id")), np.asarray(t.column("label")), _matrix(t.column("v")))


def positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the k best other rows of the anchor's label."""
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])

    def find(x: pa.Table, q: pa.Table) -> pa.Table:
        out = [[], [], []]
        if len(x) and len(q):
            lists, ids, a = _lists(x), np.asarray(q.column("anchor_id")), _matrix(q.column("a"))
            for i in range(0, len(ids), BATCH):
                own = ids[i:i + BATCH]
                every = np.ones((len(own), len(lists.ids)), dtype=bool)
                whole = np.full((len(own), 1), LOWEST), np.full((len(own), 1), HIGHEST)
                for o, ((at, score),) in zip(own, lists.best(a[i:i + BATCH], own, every, *whole, k)):
                    for c, v in zip(out, ([o] * len(at), lists.ids[at], score)):
                        c.extend(v)
        return pa.table([pa.array(np.array(c, dtype=np.int64)) for c in out], schema=schema)

    r, q = _dealt(rows, anchors, ["label"])
    key = ["label", "rb", "qb"]
    found = r.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(
        find, "anchor_id bigint, positive_id bigint, positive_score bigint")
    nth = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    return found.withColumn("nth", nth).where(F.col("nth") <= k).drop("nth")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 3,
                   low: int = 50, high: int = 95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score);
    ``is_anchor`` is a condition on vec_id, ``label`` an expression over the table,
    ``low`` and ``high`` the window in per cent of the positive's score."""
    rows = stored(usable(vectors, label, id_col, vector_col), "hard-rows")
    anchors = rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", F.col("v").alias("a"))
    pos = stored(positives(rows, anchors, n_positives), "hard-positives")
    # low * ps <= 100 * ns <= high * ps; the windows of an anchor travel with it
    asked = pos.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("ps"))
    asks = anchors.join(asked, "anchor_id").withColumn("all", F.lit(0))
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                        ("negative_id", pa.int64()), ("negative_score", pa.int64())])

    def find(x: pa.Table, q: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if len(x) and len(q):
            lists, ids, a = _lists(x), np.asarray(q.column("anchor_id")), _matrix(q.column("a"))
            tags, asked = np.asarray(q.column("label")), q.column("ps").to_pylist()
            for i in range(0, len(ids), BATCH):
                own = ids[i:i + BATCH]
                lows, highs = np.ones((2, len(own), n_positives), dtype=np.int64)  # low > high: no window
                highs[:] = 0
                for w, ps in enumerate(asked[i:i + BATCH]):
                    for j, p in enumerate(ps):
                        lows[w, j], highs[w, j] = -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100
                other = lists.labels[None, :] != tags[i:i + BATCH, None]
                for o, ps, found in zip(own, asked[i:i + BATCH],
                                        lists.best(a[i:i + BATCH], own, other, lows, highs, n_negatives)):
                    for p, (at, score) in zip(ps, found):
                        for c, v in zip(out, ([o] * len(at), [p["positive_id"]] * len(at),
                                              [p["positive_score"]] * len(at), lists.ids[at], score)):
                            c.extend(v)
        return pa.table([pa.array(np.array(c, dtype=np.int64)) for c in out], schema=schema)

    r, q = _dealt(rows.withColumn("all", F.lit(0)), asks, ["all"])
    key = ["all", "rb", "qb"]
    found = r.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(
        find, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    nth = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for every positive of the anchors of ``embeddings``."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 50 == 0, label)


ORACLE_OP13 = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other,
         list_inner_product(a.v::double[], b.v::double[])::bigint as score
  from rows a join rows b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positive as (
  select * from (select *, row_number() over (partition by anchor_id order by score desc, other) as nth
                 from scored where same) p where nth <= 5),
found as (
  select p.anchor_id, p.other as positive_id, n.other as negative_id, p.score as positive_score,
         n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other) as rank
  from positive p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score
from found where rank <= 3
"""

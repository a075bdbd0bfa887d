"""Approximate nearest neighbours by learned partitions (operator 6).

Fitting, on a bounded sample (``SAMPLE`` vectors with the smallest hashes): the
neighbour graph of the sample is cut into balanced parts, and a small
classifier learns to tell a vector's part (``partition_index``).  The number
of parts grows with the number of vectors.  How many parts a query visits is
read off the sample: the fewest for which ``TARGET`` of the true neighbours of
sample queries are reached.

Indexing: every vector is put in its most probable part.  Searching: a query
goes to its most probable parts (to more, as long as these hold fewer vectors
than asked for), is compared with all their vectors exactly, and the best of
all parts are merged.

Parts are dealt out as blocks of at most ``BLOCK`` vectors by ``BLOCK`` queries,
so a part that holds a third of all vectors (copies of one vector, say) is many
tasks, and no block is unbounded.  Every block returns at most ``k`` rows a
query; a query's most probable part is searched first, and other parts return
only what reaches the k-th score found there.  The model and one count per part are all that is broadcast.

Defined results: vectors that are null, zero, of another length than most, or
that hold null or non-finite components take no part, nor do rows without an
identifier; rows that repeat an identifier are one item (the smallest vector);
ties go to the smaller identifier; fewer candidates than k: all of them; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.partition_index import fit, neighbour_graph, probabilities
from skyfold.llm.storage import stored

SAMPLE = 8192
#: Vectors a part aims at; parts are at least 2 and at most ``MOST_PARTS``.
PART_AIM, MOST_PARTS = 2048, 64
BLOCK = 4096
#: Share of the sample's true neighbours that the visited parts must hold.
TARGET = 0.95


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): one finite, non-zero vector of the usual length per identifier."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    inf = F.lit(float("inf"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1)
    usual = [r["n"] for r in lengths.collect()]
    rows = rows.where(F.size("v") == (usual[0] if usual else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def learn(rows: DataFrame, k: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """(classifier, number of parts a query visits), fitted in one task on the sample."""
    n = rows.count()
    parts = int(min(MOST_PARTS, max(2, round(n / PART_AIM))))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf.sort_values("vec_id")["v"].tolist(), dtype=np.float64)
        model = fit(x, parts)
        p = probabilities(_unit(x), model)
        # where the true neighbours of sample rows rank among the parts of these rows
        queries = np.arange(0, len(x), max(1, len(x) // 512))
        near = neighbour_graph(x, k)[queries] if len(x) > 1 else np.zeros((1, 0), dtype=np.int64)
        rank = np.argsort(np.argsort(-p[queries], axis=1, kind="stable"), axis=1, kind="stable")
        found = np.sort(rank[np.arange(len(queries))[:, None], p.argmax(axis=1)[near]].reshape(-1))
        visits = int(found[min(len(found) - 1, int(np.ceil(TARGET * len(found))))]) + 1 if len(found) else 1
        return pd.DataFrame({"w": [model[0].reshape(-1).tolist()], "b": [model[1].tolist()], "visits": [visits]})

    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    got = sample.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(train, "w array<double>, b array<double>, visits int").collect()
    if not got:
        return (np.zeros((0, 1)), np.zeros(1)), 1
    b = np.array(got[0]["b"])
    return (np.array(got[0]["w"]).reshape(-1, len(b)), b), got[0]["visits"]


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    return np.asarray(col.flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def ranked_parts(rows: DataFrame, model) -> DataFrame:
    """``rows`` plus ``parts``: all parts, most probable first."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                some = batch.slice(i, 4096)
                x = _matrix(some.column("v"))
                order = np.argsort(-probabilities(_unit(x), shared.value), axis=1, kind="stable").astype(np.int32)
                parts = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * order.shape[1], pa.int32()), pa.array(order.reshape(-1), pa.int32()))
                yield pa.RecordBatch.from_arrays([*some.columns, parts], [*some.schema.names, "parts"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, fields + ", parts array<int>")


def best_rows(q: np.ndarray, qid: np.ndarray, floor: np.ndarray, x: np.ndarray, xid: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of a block for each query, scores added up in order;
    rows below the query's ``floor`` are left out."""
    out = []
    for i in range(0, len(q), 512):
        s = q[i:i + 512] @ x.T
        s[qid[i:i + 512, None] == xid[None, :]] = -np.inf
        m = min(k, len(x))
        edge = np.maximum(np.partition(s, len(x) - m, axis=1)[:, len(x) - m], floor[i:i + 512])
        # products of a matrix may differ in their last bits from sums in order
        slack = 1e-9 * (1 + np.abs(edge))
        a, b = np.nonzero((s >= (edge - np.where(np.isfinite(edge), slack, 0))[:, None]) & np.isfinite(s))
        for j in range(0, len(a), 1 << 16):
            aa, bb = a[j:j + (1 << 16)], b[j:j + (1 << 16)]
            score = np.cumsum(q[i + aa] * x[bb], axis=1)[:, -1]
            high = score >= floor[i + aa]
            out.append(pd.DataFrame({"query_id": qid[i + aa][high], "vec_id": xid[bb][high], "score": score[high]}))
    if not out:
        return pd.DataFrame({"query_id": qid[:0], "vec_id": xid[:0], "score": np.zeros(0)})
    got = pd.concat(out).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return got[got.groupby("query_id").cumcount() < k]


def compare_in_blocks(index: DataFrame, queries: DataFrame, size: dict[int, int], k: int) -> DataFrame:
    """(query_id, vec_id, score): per block the k best of each query that reach
    its floor.  ``index``: vec_id, v, part; ``queries``: query_id, q, part, floor."""
    asked = {r["part"]: r["count"] for r in queries.groupBy("part").count().collect()}  # one row a part
    blocks = lambda n: -(-n // BLOCK)
    deal = index.sparkSession.createDataFrame(
        [(p, blocks(n), blocks(asked[p])) for p, n in size.items() if asked.get(p)], "part int, vs int, qs int")
    vs = index.join(F.broadcast(deal), "part").select(
        "part", F.pmod(F.xxhash64("vec_id"), "vs").cast("int").alias("vb"),
        F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("qb"), "vec_id", "v")
    qs = queries.join(F.broadcast(deal), "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("vs") - 1)).alias("vb"),
        F.pmod(F.xxhash64("query_id"), "qs").cast("int").alias("qb"), "query_id", "q", "floor")

    def compare(x: pa.Table, q: pa.Table) -> pa.Table:
        if not len(x) or not len(q):
            got = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        else:
            got = best_rows(_matrix(q.column("q")), np.asarray(q.column("query_id")), np.asarray(q.column("floor")),
                            _matrix(x.column("v")), np.asarray(x.column("vec_id")), k)
        return pa.Table.from_pandas(got, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                                                    ("score", pa.float64())]), preserve_index=False)

    key = ["part", "vb", "qb"]
    return vs.groupBy(*key).cogroup(qs.groupBy(*key)).applyInArrow(
        compare, "query_id bigint, vec_id bigint, score double")


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that
    ``is_query`` (a condition on vec_id) names."""
    rows = stored(usable(vectors, id_col, vector_col), "ann-vectors")
    model, visits = learn(rows, k)
    placed = stored(ranked_parts(rows, model).select(
        "vec_id", "v", F.get("parts", F.lit(0)).alias("part"), F.when(is_query, F.col("parts")).alias("parts")), "ann-parts")
    size = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    total = F.create_map(*[F.lit(x) for p, n in size.items() for x in (p, n)]) if size else F.lit(None).cast("map<int,bigint>")
    index = placed.select("vec_id", "v", "part")
    # a query's parts: the first ``visits``, and on while those before hold too few vectors
    before = lambda i: F.aggregate(F.slice("parts", 1, i), F.lit(0).cast("bigint"),
                                   lambda a, p: a + F.coalesce(total[p], F.lit(0)))
    queries = placed.where(F.col("parts").isNotNull()).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.posexplode(F.filter(F.transform(
            "parts", lambda p, i: F.when((i < visits) | (before(i) <= k), p)), lambda p: p.isNotNull())).alias("nth", "part"))
    # the most probable part first: its k-th score is a floor for what other parts need to report
    low = F.lit(float("-inf"))
    home = stored(compare_in_blocks(index, queries.where("nth = 0").withColumn("floor", low), size, k), "ann-home")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    floor = home.withColumn("n", best).where(F.col("n") == k).select("query_id", F.col("score").alias("floor"))
    rest = queries.where("nth > 0").join(floor, "query_id", "left").withColumn("floor", F.coalesce("floor", low))
    found = home.union(compare_in_blocks(index, rest, size, k))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of ``embeddings`` for every vec_id divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 20 == 0)

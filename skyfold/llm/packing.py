"""Packing along a space-filling curve (operator 7).

1. Tokenise.  Every distinct pre-token of a chunk is encoded once (a bounded
   cache per worker spans chunks); ids are stored with the document.
2. Place.  The document's ids are hashed into ``BUCKETS`` counts; the
   normalised counts are projected by a fixed Gaussian matrix to ``DIMS``
   dimensions, and the cell of that point is numbered along the Hilbert curve.
3. Sort.  (key, id, row) is range-partitioned and sorted; each partition adds
   up its lengths, and one number per partition (not per document) goes
   through the driver to make running totals.
4. Pack.  Documents lie end to end along the curve; a sequence is the next
   ``SEQUENCE`` ids, so documents are cut where a sequence ends, neighbours on
   the curve share sequences, and only the last sequence of all is short.

Only step 4's join moves the ids.  No task holds more than a partition of
small rows or one batch of documents.  A hot key (many equal documents) is
split by id and row in the range partitioning.

Defined results: a null or empty text is the end id alone; repeated rows and
null ids are documents of their own (nulls first within a key); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.pretokens import distinct, expand
from skyfold.llm.storage import stored

SEQUENCE = 2048
END_ID = 1
BUCKETS, DIMS, BITS = 256, 3, 16
#: Pre-tokens a worker remembers.
CACHE = 200_000
#: Rows that are tokenised at a time.
ROWS = 512
#: Pre-tokens whose ids are put together at a time.
SLICE = 512


def byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.cache
def piece_encoder(path: str):
    """Encoder of single pre-tokens by the tokenizer file ``path``.

    A byte-level file whose merges come in the order of the ids they make is
    encoded by rank (same ids, several times faster); any other file goes to
    its own library."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocab = byte_letters(), model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocab["".join(m)] for m in merges]
    if made == sorted(made) and len(merges) + 256 == len(vocab) and all(set(t) <= set(letters) for t in vocab):
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return lambda piece: whole.encode(piece.decode(), add_special_tokens=False).ids


_known: dict[str, dict[bytes, bytes]] = {}


@functools.cache
def added_tokens(path: str) -> dict[str, int]:
    """The strings that the tokenizer file takes out of a text before all else.
    (Flags that reach beyond the string itself, such as lstrip, are refused.)"""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens", [])
    if any(t.get(flag) for t in tokens for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError("added tokens that take in their surroundings")
    return {t["content"]: t["id"] for t in tokens}


def tokenise(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, number of ids of each text), as the
    tokenizer library encodes by default: texts are split at the added tokens first."""
    added = added_tokens(path)
    if not any(token in text for text in texts for token in added):
        return _tokenise(texts, path)
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")
    parts = [cut.split(text) for text in texts]  # plain, token, plain, ...
    ids, count = _tokenise([p for some in parts for p in some[::2]], path)
    plain, flat, total, k = np.split(ids, np.cumsum(count)[:-1]), [], [], 0
    for some in parts:
        n = 0
        for i, part in enumerate(some):
            if i % 2:
                got = np.array([added[part]], dtype=np.uint32)
            else:
                got, k = plain[k], k + 1
            flat.append(got)
            n += len(got)
        total.append(n)
    return np.concatenate(flat).astype(np.uint32), np.array(total, dtype=np.int64)


def _four_bytes(ids: list[list[int]]) -> list[bytes]:
    """Each list of ids as little-endian unsigned 32-bit integers."""
    end = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) * 4).tolist()
    flat = np.fromiter(itertools.chain.from_iterable(ids), "<u4", end[-1] // 4).tobytes()
    return [flat[i:j] for i, j in zip([0, *end], end)]


def _tokenise(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    encode, known = piece_encoder(path), _known.setdefault(path, {})
    flat, count = [], np.zeros(len(texts), dtype=np.int64)
    for words, inverse, rows, sizes in distinct(texts):
        ids = list(map(known.get, words))
        new = [i for i, got in enumerate(ids) if got is None]
        if new:
            fresh = [words[i] for i in new]
            for k in range(0, len(new), SLICE):  # lists of ids do not pile up
                for i, got in zip(new[k:k + SLICE], _four_bytes(list(map(encode, fresh[k:k + SLICE])))):
                    ids[i] = got
            if len(known) + len(new) > CACHE:
                known.clear()
            known.update(zip(fresh, [ids[i] for i in new][:CACHE]))
        if not ids:
            continue
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat.append(expand(np.frombuffer(b"".join(ids), "<u4"), size, inverse))
        total = np.r_[0, np.cumsum(size[inverse])]
        at = np.r_[0, np.cumsum(sizes)]
        np.add.at(count, rows, total[at[1:]] - total[at[:-1]])
    return np.concatenate(flat) if flat else np.zeros(0, dtype=np.uint32), count


@functools.cache
def _gauss() -> np.ndarray:
    return np.random.default_rng(20).standard_normal((BUCKETS, DIMS))


def curve_cells(ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Cell of each document's projected vector: integers of ``BITS`` bits, (documents, DIMS)."""
    bucket = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
    out = np.zeros((len(count), DIMS))
    end = np.cumsum(count)
    for i in range(0, len(count), 2048):  # documents by documents: a bounded table of counts
        j = min(len(count), i + 2048)
        a, b = int(end[i] - count[i]), int(end[j - 1])
        row = np.repeat(np.arange(j - i), count[i:j])
        seen = np.bincount(row * BUCKETS + bucket[a:b], minlength=(j - i) * BUCKETS).reshape(j - i, BUCKETS)
        norm = np.sqrt((seen * seen).sum(axis=1, dtype=np.float64))
        out[i:j] = seen @ _gauss() / np.maximum(norm, 1)[:, None]
    unit = 0.5 + 0.5 * np.tanh(out / 4)
    return np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Number of each cell along the Hilbert curve (John Skilling's method,
    "Programming the Hilbert curve", 2004), for all rows at once."""
    x = [cells[:, k].astype(np.int64).copy() for k in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> b) & 1)
    return key


def tokenised(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """(doc_id, tokens, key, ids, row): written once; ``row`` numbers the rows;
    ``ids`` have two bytes each where they fit, else four."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, count = tokenise(part.column("_text").to_pylist(), path)
                key = hilbert_key(curve_cells(ids, count))
                ids = np.insert(ids, np.cumsum(count), end_id)
                narrow = not len(ids) or int(ids.max()) < 1 << 16
                data = ids.astype("<u2" if narrow else "<u4").tobytes()
                cut = np.r_[0, np.cumsum(count + 1)] * (2 if narrow else 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(count + 1, pa.int64()), pa.array(key, pa.int64()),
                     pa.array([data[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.binary())],
                    ["doc_id", "tokens", "key", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, tokens bigint, key bigint, ids binary")
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "packing", compression="zstd")


def running_start(docs: DataFrame) -> DataFrame:
    """(row, at): the ids before each document along the curve."""
    def add_up(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = np.asarray(batch.column("tokens"))
            end = before + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(end - n, pa.int64()), batch.column("tokens"),
                 pa.array(np.full(len(n), part), pa.int32())], ["row", "before", "tokens", "part"])
            before = int(end[-1]) if len(end) else before

    order = ["key", "doc_id", "row"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(docs.select(*order, "tokens").repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .mapInArrow(add_up, "row bigint, before bigint, tokens bigint, part int"), "packing-order")
    total = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.sum("tokens").alias("n")).collect())
    base, rows = 0, []
    for part, n in total:  # one number per partition
        rows.append((part, base))
        base += n
    starts = docs.sparkSession.createDataFrame(rows, "part int, base bigint")
    return placed.join(F.broadcast(starts), "part").select("row", (F.col("before") + F.col("base")).alias("at"))


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
         end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces
    of every document; ``ids`` are little-endian unsigned 32-bit integers."""
    rows = tokenised(docs, path, id_col, text_col, end_id)
    rows = rows.join(running_start(rows), "row")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                row, start, length, ids, tokens, where, offset = [], [], [], [], [], [], []
                for r, (at, n, data) in enumerate(zip(*(part.column(c).to_pylist() for c in ("at", "tokens", "ids")))):
                    wide = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")
                    done = 0
                    while done < n:
                        seq, off = divmod(at + done, sequence)
                        m = min(sequence - off, n - done)
                        row.append(r)
                        start.append(done)
                        length.append(m)
                        ids.append(wide[done:done + m].tobytes())
                        tokens.append(n)
                        where.append(seq)
                        offset.append(off)
                        done += m
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens, pa.int64()),
                     pa.array(where, pa.int64()), pa.array(offset, pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return rows.select("doc_id", "at", "tokens", "ids").mapInArrow(
        cut, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
             "sequence_id bigint, offset bigint")


def op7_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document of ``documents``."""
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

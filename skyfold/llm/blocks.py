"""Blocks of documents, and a two-way exchange between blocks and key buckets.

A block is a run of whole rows of one input partition, at most ``BLOCK_BYTES``
of text (one row, if that is longer).  Operators that need to know something
about every word or window of the corpus reduce each block to its distinct
keys, pack them by bucket (a hash range) and send one small row per block and
bucket, instead of a row per word.  Bucket tasks see all blocks' keys of their
hash range; their answers travel back to the blocks, aligned with the keys
that were sent.  Every exchange is a Spark shuffle, so it spills and survives
lost executors as any other.

Rows of an exchange: ``dest`` (where the shuffle deals the row), ``block``,
``kind`` ("keys", "body" or "answer"), ``part`` (bucket, or chunk of the
body), ``of`` (number of parts) and ``data``.  A block's body, an Arrow batch
compressed by zstd, travels in chunks of ``BODY_BYTES`` that are dealt evenly.
Assembly checks that every part of a block is there, once.  An operator may
send keys and bodies in one pass over the input (bodies then pass through the
bucket tasks) or read the input again for the bodies, which halves what they
shuffle.

The number of buckets is ``spark.sql.shuffle.partitions`` (all bucket rows of a
task are held together: choose it as for any other shuffle, so that a
partition fits an executor's memory).  The input must be a table scan or a
written table: its partitions and their order must not change between reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.llm.words import groups_by_bytes, string_bytes

BLOCK_BYTES = 1 << 22
BODY_BYTES = 1 << 16

SCHEMA = "dest int, block string, kind string, part int, of int, data binary"
_ARROW = pa.schema([("dest", pa.int32()), ("block", pa.string()), ("kind", pa.string()), ("part", pa.int32()),
                    ("of", pa.int32()), ("data", pa.binary())])


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(
            compression=pa.Codec("zstd", compression_level=3))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(data)) as r:
        return r.read_all().combine_chunks().to_batches()[0]


def slices(batches: Iterator[pa.RecordBatch], text_col: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches regrouped to about ``most`` bytes of text each."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = string_bytes(batch.column(text_col))
        for i, j in groups_by_bytes(off, most):
            n = int(off[j] - off[i])
            if held and size + n > most:
                yield _joined(held)
                held, size = [], 0
            held.append(batch.slice(i, j - i))
            size += n
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def body_rows(block: str, body: bytes, parts: int, kind: str = "body") -> list[tuple]:
    n, first = max(1, -(-len(body) // BODY_BYTES)), zlib.crc32(block.encode())
    return [((first + k) % parts, block, kind, k, n, body[k * BODY_BYTES:(k + 1) * BODY_BYTES]) for k in range(n)]


def key_rows(block: str, packed: list[bytes], parts: int) -> list[tuple]:
    """One row per bucket; buckets without keys still get their row, so that
    the assembly can tell a lost row from an empty one."""
    return [(b, block, "keys", b, parts, data) for b, data in enumerate(packed)]


def bucket_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bucket of each 64-bit hash."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def blocks_out(docs: DataFrame, text_col: str, parts: int, split: Callable, most: int = BLOCK_BYTES) -> DataFrame:
    """Cuts ``docs`` into blocks; ``split(batch)`` gives (body, packed keys by
    bucket), either of which may be None.  A block is named by its partition,
    its place there and a checksum of its texts: if ``docs`` is read twice and
    differs, the names do not meet and the assembly raises."""
    def run(batches):
        for k, batch in enumerate(slices(batches, text_col, most)):
            part = batch.column("_part")[0].as_py()
            batch = batch.drop_columns(["_part"])
            body, packed = split(batch)
            raw, off = string_bytes(batch.column(text_col))
            block = f"{part}-{k}-{zlib.crc32(off.tobytes(), zlib.crc32(raw[off[0]:off[-1]]))}"
            if packed is not None:
                yield to_batch(key_rows(block, packed, parts))
            rows = body_rows(block, body, parts) if body is not None else []
            for i in range(0, len(rows), 64):
                yield to_batch(rows[i:i + 64])

    # the input's own partition number: a task's differs under a union
    return docs.withColumn("_part", F.spark_partition_id()).mapInArrow(run, SCHEMA)


def by_bucket(rows: DataFrame, parts: int, answer: Callable) -> DataFrame:
    """Deals keys to their buckets; ``answer(list of data)`` gives one answer
    per block's data, in order.  Bodies pass through."""
    def run(batches):
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            kinds = np.asarray(batch.column("kind").to_pylist(), dtype=object)
            mine = np.flatnonzero(kinds == "keys")
            if len(mine) < batch.num_rows:
                yield batch.filter(pa.array(kinds != "keys")).cast(_ARROW)
            part, block, data = batch.column("part"), batch.column("block"), batch.column("data")
            for i in mine:
                held.setdefault(part[int(i)].as_py(), []).append((block[int(i)].as_py(), data[int(i)].as_py()))
        for b in sorted(held):
            got = held.pop(b)
            out = answer([d for _, d in got])
            yield to_batch([(0, block, "answer", b, parts, a) for (block, _), a in zip(got, out)])

    return rows.repartition(parts, "dest").mapInArrow(run, SCHEMA)


def parts_of(table: pa.Table, kinds: tuple[str, ...]) -> list[list[bytes]]:
    """The parts of each kind of a block, in order; raises if one is missing."""
    found: dict[str, dict[int, bytes]] = {k: {} for k in kinds}
    want: dict[str, int] = {}
    for kind, part, of, data in zip(*(table.column(c).to_pylist() for c in ("kind", "part", "of", "data"))):
        if part in found[kind]:
            raise RuntimeError("a part of a block came twice: the input of the operator is not stable")
        found[kind][part] = data
        want[kind] = of
    for kind, got in found.items():
        if len(got) != want.get(kind):
            raise RuntimeError("a part of a block is missing: the input of the operator is not stable")
    return [[got[k] for k in range(want[kind])] for kind, got in found.items()]


def by_block(rows: DataFrame, assemble: Callable, schema: T.StructType | str,
             kinds: tuple[str, ...] = ("body", "answer")) -> DataFrame:
    """Brings a block's parts together: ``assemble(block, *parts by kind)`` gives
    an Arrow table of ``schema``; a body comes as one piece, answers as a list."""
    def run(key, table):
        parts = parts_of(table, kinds)
        return assemble(key[0].as_py(), *[p if kind == "answer" else b"".join(p) for kind, p in zip(kinds, parts)])

    return rows.groupBy("block").applyInArrow(run, schema)


# Keys of one or more 64-bit columns ---------------------------------------

def _runs(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the keys, for each sorted key the number of its run)."""
    order = np.lexsort(cols[::-1])
    new = np.zeros(len(order), dtype=bool)
    for c in cols:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, np.cumsum(new)


def pack_keys(cols: list[np.ndarray], parts: int) -> tuple[list[bytes], np.ndarray]:
    """A block's distinct keys by bucket, each with a bit that says whether the
    block has it more than once; and for every key its place among them."""
    n = len(cols[0])
    order, run = _runs(cols)
    distinct = int(run[-1]) + 1 if n else 0
    first = np.searchsorted(run, np.arange(distinct))
    inverse = np.empty(n, dtype=np.int64)
    inverse[order] = run
    again = np.bincount(run, minlength=distinct)[:distinct] > 1
    unique = [c[order][first] for c in cols]
    cuts = np.searchsorted(bucket_of(unique[0], parts), np.arange(parts + 1))
    packed = []
    for b in range(parts):
        i, j = int(cuts[b]), int(cuts[b + 1])
        packed.append(b"".join([np.int64(j - i).tobytes(), *[u[i:j].tobytes() for u in unique],
                                np.packbits(again[i:j]).tobytes()]))
    return packed, inverse


def answer_repeated(width: int) -> Callable[[list[bytes]], list[bytes]]:
    """Bucket answers for ``pack_keys`` of ``width`` columns: a bit per key that
    says whether the key occurs more than once in the corpus."""
    def answer(datas: list[bytes]) -> list[bytes]:
        sizes = [int(np.frombuffer(d, np.int64, 1)[0]) for d in datas]
        if not sum(sizes):
            return [b""] * len(datas)
        cols = [np.concatenate([np.frombuffer(d, np.uint64, n, 8 + 8 * n * w) for d, n in zip(datas, sizes)])
                for w in range(width)]
        again = np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8, offset=8 + 8 * n * width), count=n)
                                for d, n in zip(datas, sizes)])
        order, run = _runs(cols)
        total = np.bincount(run) + np.bincount(run, weights=again[order])
        out = np.empty(len(order), dtype=np.uint8)
        out[order] = total[run] > 1
        return [np.packbits(x).tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])]

    return answer


def unpack_bits(answers: list[bytes], packed: list[bytes]) -> np.ndarray:
    """The answers' bits for the distinct keys that ``packed`` holds."""
    sizes = [int(np.frombuffer(d, np.int64, 1)[0]) for d in packed]
    bits = [np.unpackbits(np.frombuffer(a, np.uint8), count=n) for a, n in zip(answers, sizes) if n]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, dtype=bool)

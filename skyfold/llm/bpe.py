"""Byte-level BPE encoding and decoding (operator 4).

Encoding.  Documents are cut into pre-tokens, block by block (``blocks``).  A
block sends each distinct pre-token once, packed by hash bucket, with its
place in the block; where the pre-tokens stand stays in the block's body as a
stream of numbers.  A bucket task sees a word's rows of all blocks, encodes
each distinct word once, and the ids are joined back to the blocks, which
reassemble every document by position.

Decoding.  The token-byte table (one row per token; its size is fixed by the
vocabulary, so it is broadcast) is joined to the ids, batch by batch, and the
bytes are put together by position.

A frequent word costs one small row per block, whatever its count.  Nothing is
collected; the largest unit a task holds is a block or a bucket.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows and null ids are documents of their own (row by row, ids are
only carried along); an empty table gives an empty result; other columns are
not read.  Ids outside the table raise an error when decoded.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.llm import blocks as B
from skyfold.llm.pretokens import distinct, expand, rank_encoder, read_ranks
from skyfold.llm.words import groups_by_bytes, ranges, word_hashes

#: Larger blocks repeat fewer words between blocks.
BLOCK_BYTES = 10 << 20
#: Pre-tokens put together at a time.
ASSEMBLE = 1 << 18
#: Ids decoded at a time.
DECODE = 1 << 18


def _planes(a: np.ndarray) -> np.ndarray:
    """Bytes of 32-bit numbers, by significance: small numbers compress well."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _dump(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=9).compress(pickle.dumps(parts, protocol=5))


def _load(data: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _split(batch: pa.RecordBatch, parts: int) -> tuple[bytes, list[bytes]]:
    """A block's body (ids of the documents, pre-tokens of each, the stream of
    word numbers) and its distinct words by bucket."""
    known: dict[bytes, int] = {}
    count = np.zeros(batch.num_rows, dtype=np.int64)
    stream = []
    for words, inverse, rows, sizes in distinct(batch.column("_text").to_pylist()):
        number = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
        stream.append(number[inverse].astype(np.int32))
        np.add.at(count, rows, sizes)
    words = list(known)
    flat = np.concatenate(stream) if stream else np.zeros(0, dtype=np.int32)
    # frequent words get small numbers
    order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), dtype=np.int32)
    rank[order] = np.arange(len(words))
    words = [words[k] for k in order]
    body = _dump(B.pack_batch(batch.select(["doc_id"])), _planes(count), _planes(rank[flat]))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size)
    bucket = B.bucket_of(word_hashes(np.frombuffer(b"".join(words), np.uint8), end - size, end, 0), parts)
    packed = []
    for b in range(parts):
        mine = np.flatnonzero(bucket == b)
        packed.append(_dump(_planes(np.diff(mine, prepend=0)), _planes(size[mine]),
                            b"".join([words[k] for k in mine])))
    return body, packed


def _encode_words(path: str):
    """Bucket answers: the ids of every word sent; a distinct word is encoded once."""
    def answer(datas: list[bytes]) -> list[bytes]:
        encode, known, out = rank_encoder(path)._encode_single_piece, {}, []
        for data in datas:
            place, size, text = _load(data)
            end = np.cumsum(_numbers(size))
            found, at = [], 0
            for to in end.tolist():
                word = text[at:to]
                at = to
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = np.array(encode(word), dtype="<u4")
                found.append(ids)
            many = np.fromiter(map(len, found), np.int64, len(found))
            out.append(_dump(place, _planes(many), _planes(np.concatenate(found) if found else many)))
        return out

    return answer


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids): ``ids`` are little-endian unsigned 32-bit integers."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids", T.BinaryType())])

    def assemble(block, body, answers):
        batch, count, stream = _load(body)
        which, count = _numbers(stream).astype(np.int32), _numbers(count)
        sizes, flats, places = [], [], []
        for data in answers:
            place, many, ids = _load(data)
            places.append(np.cumsum(_numbers(place)))
            sizes.append(_numbers(many))
            flats.append(_numbers(ids))
        # words in the order of their numbers
        place, size = np.concatenate(places), np.concatenate(sizes)
        order = np.argsort(place)
        flat = expand(np.concatenate(flats), size, order).astype("<u4")
        size = size[order]
        at, found, many = np.r_[0, np.cumsum(count)], [], []
        for i, j in groups_by_bytes(at, ASSEMBLE):  # some documents at a time
            some = which[at[i]:at[j]]
            data = expand(flat, size, some).tobytes()
            cut = np.r_[0, np.cumsum(size[some])][at[i:j + 1] - at[i]]
            many.append(np.diff(cut))
            found += [data[a:b] for a, b in zip((cut[:-1] * 4).tolist(), (cut[1:] * 4).tolist())]
        return pa.table([
            B.unpack_batch(batch).column(0), pa.array(np.concatenate(many), pa.int64()), pa.array(found, pa.binary())],
            names=["doc_id", "n_tokens", "ids"])

    sent = B.blocks_out(rows, "_text", parts, lambda batch: _split(batch, parts), block_bytes)
    return B.by_block(B.by_bucket(sent, parts, _encode_words(ranks_path)), assemble, out)


def token_table(ranks_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens, start and end of each id)."""
    tokens = sorted(read_ranks(ranks_path).items(), key=lambda t: t[1])
    n = tokens[-1][1] + 1 if tokens else 0
    size = np.zeros(n, dtype=np.int64)
    for token, i in tokens:
        size[i] = len(token)
    end = np.cumsum(size)
    return np.frombuffer(b"".join(t for t, _ in tokens), np.uint8), end - size, end


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Input columns plus ``decoded``: the bytes of the ids."""
    table = encoded.sparkSession.sparkContext.broadcast(token_table(ranks_path))
    encoded = encoded.drop("decoded")

    def one(data: bytes | None) -> bytes:
        raw, start, end = table.value
        ids, out = np.frombuffer(data or b"", "<u4"), []
        for k in range(0, len(ids), DECODE):
            some = ids[k:k + DECODE]
            if int(some.max()) >= len(end) or not (end - start)[some].all():
                raise ValueError("an id is not in the token table")
            out.append(raw[ranges(start[some], end[some])].tobytes())
        return b"".join(out)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = pa.array([one(x) for x in part.column(ids_col).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, data], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document of ``documents``, and what they decode to."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return decode(encode(docs, path), path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

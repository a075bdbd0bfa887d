"""Operator 7: ids as the tokenizer library gives them, a gapless round trip, order along the curve."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyfold.llm import packing as P
from skyfold.llm import pretokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def corpus():
    rnd = random.Random(2)
    bits = ["the", " of", "é", "漢字", "😀", "'s", "'S", "  ", "\n\n", "\t", "12", " 3٣", "!?", "<|endoftext|>", "a" * 300,
            " ", "՘", "\x85", " it's", "''re"]
    texts = [None, "", " ", "x", "word " * 9000, "é漢" * 4000]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 400))) for _ in range(60)]
    return texts + texts[8:12]


@pytest.mark.parametrize("chunk", [1 << 21, 50])
def test_pieces(spark, monkeypatch, chunk):
    monkeypatch.setattr(pretokens, "CHUNK", chunk)
    texts = corpus()
    whole = Tokenizer.from_file(PATH)
    want = sorted((len(e.ids) + 1, tuple(e.ids) + (1,)) for e in
                  whole.encode_batch([t or "" for t in texts], add_special_tokens=False))
    df = spark.createDataFrame([(None if i % 9 == 0 else i // 2, t, 1, "k") for i, t in enumerate(texts)],
                               "doc_id long, text string, row int, key string")
    got = P.pack(df, PATH).orderBy("sequence_id", "offset").collect()
    # sequences are gapless and full but the last
    at = 0
    for r in got:
        assert (r["sequence_id"], r["offset"]) == divmod(at, 2048) and 0 < r["length"] <= 2048 - r["offset"]
        assert len(r["ids"]) == 4 * r["length"]
        at += r["length"]
    assert at == sum(n for n, _ in want)
    # pieces of a document follow each other along the curve
    docs, open_ = [], None
    for r in got:
        if r["start"] == 0:
            open_ = (r["doc_tokens"], [])
            docs.append(open_)
        assert r["start"] == len(open_[1])
        open_[1].extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert sorted((n, tuple(ids)) for n, ids in docs) == want


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_one_batch_of_many_rows(spark):
    """A partition of over 1024 rows, which Spark hands over as one batch: one set of pieces per row."""
    n = 2500
    df = spark.range(0, n, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word ', id, ' '), int(id % 7)) AS text")
    texts = [f"word {i} " * (i % 7) for i in range(n)]
    want = [e.ids + [1] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    pieces = {}
    at = 0
    for r in P.pack(df, PATH).orderBy("sequence_id", "offset").collect():
        assert (r["sequence_id"], r["offset"]) == divmod(at, 2048)
        at += r["length"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    assert at == sum(map(len, want)) and sorted(pieces) == list(range(n))
    for i, ids in enumerate(want):
        start = 0
        for first, part in sorted(pieces[i]):
            assert first == start
            start += len(part)
        assert [x for _, part in sorted(pieces[i]) for x in part] == ids


@pytest.mark.parametrize("dims", [2, 3])
def test_hilbert_key_visits_neighbours(dims):
    cells = np.array(list(itertools.product(range(8), repeat=dims)))
    key = P.hilbert_key(cells, bits=3)
    assert sorted(key) == list(range(8 ** dims))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_similar_documents_are_near(spark):
    a, b = "the cat and the dog " * 30, "le chat et le chien " * 30
    ids, count = P.tokenise([a, b, a + "the", b + "le"], PATH)
    key = P.hilbert_key(P.curve_cells(ids, count))
    assert abs(key[0] - key[2]) < abs(key[0] - key[1]) and abs(key[1] - key[3]) < abs(key[0] - key[1])


def test_added_tokens_are_taken_out_first():
    """Literal ids of the library's default settings."""
    ids, count = P.tokenise(["a <|endoftext|> b", "", "<|endoftext|><|endoftext|>", "<|endoftext", "a"], PATH)
    assert list(count) == [4, 0, 2, len(count) and count[3], 1]
    assert list(ids[:4]) == [64, 220, 50256, 275] and list(ids[4:6]) == [50256, 50256] and ids[-1] == 64
    plain = Tokenizer.from_file(PATH).encode("<|endoftext", add_special_tokens=False).ids
    assert list(ids[6:6 + count[3]]) == plain


def test_new_pre_tokens_are_encoded_together_within_the_cache(monkeypatch):
    import public_tokenizers
    from skyfold.llm import packing, pretokens
    path = public_tokenizers.path("byte_bpe_50k.json")
    words, inverse, _, _ = next(iter(pretokens.distinct(["b a b", "c b"])))
    assert words == [b"b", b" a", b" b", b"c"]  # as they appear: no sort
    assert [words[i] for i in inverse] == [b"b", b" a", b" b", b"c", b" b"]
    assert packing._four_bytes([[1], [2, 65536], []]) == [b"\1\0\0\0", b"\2\0\0\0\0\0\1\0", b""]
    texts = [" ".join(f"w{i * k}x" for i in range(40)) for k in range(1, 9)]
    want = packing.tokenise(texts, path)
    monkeypatch.setattr(packing, "CACHE", 7)
    monkeypatch.setattr(packing, "SLICE", 3)
    packing._known[path].clear()
    got = packing.tokenise(texts, path)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and len(packing._known[path]) <= 7
    packing._known[path].clear()

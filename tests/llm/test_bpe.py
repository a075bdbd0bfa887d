"""Operator 4: ids as the tokenizer library gives them, and the exact round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from skyfold.llm import bpe, pretokens

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def corpus():
    rnd = random.Random(5)
    bits = ["the", " of", "é", "漢字", "😀", "'s", "'S", "'ll", "  ", "\n\n", "\t", "12", " 3٣", "!?", "<|endoftext|>",
            "b" * 700, " ", "\x85", " it's", "''re", " ", "\x00"]
    texts = [None, "", " ", "x", "word " * 9000, "é漢" * 4000, " " * 5000]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 300))) for _ in range(60)]
    texts += ["".join(c for c in map(chr, (rnd.randrange(0x11000) for _ in range(200))) if not "\ud800" <= c < "")
              for _ in range(20)]
    return texts + texts[8:12]


@pytest.mark.parametrize("chunk,block", [(1 << 21, 1 << 24), (60, 500)])
def test_round_trip(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(pretokens, "CHUNK", chunk)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                            special_tokens={})
    texts = corpus()
    df = spark.createDataFrame([(None if i % 9 == 0 else i // 2, t, b"x") for i, t in enumerate(texts)],
                               "doc_id long, text string, ids binary")
    got = bpe.decode(bpe.encode(df.coalesce(2), PATH, block_bytes=block), PATH).collect()
    key = lambda r: tuple(map(str, r))
    have = sorted(((r["doc_id"], r["n_tokens"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["decoded"]))
                   for r in got), key=key)
    want = []
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        want.append((None if i % 9 == 0 else i // 2, len(ids), tuple(ids), (t or "").encode()))
    assert have == sorted(want, key=key)


def test_unknown_ids_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, b"")], "a int, ids binary")
    assert {bytes(r["decoded"]) for r in bpe.decode(df, PATH).collect()} == {b""}
    bad = spark.createDataFrame([(1, np.array([50_256], "<u4").tobytes())], "a int, ids binary")
    with pytest.raises(Exception, match="not in the token table"):
        bpe.decode(bad, PATH).collect()


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0

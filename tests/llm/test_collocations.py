"""Operator 11: tries against dictionaries, and the whole result against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from skyfold.llm import byte_trie
from skyfold.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, max_words=5, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    frequent = {p: a for p, a in f.items() if a >= min_count}
    out = []
    for lang in n:
        mine = {p: a for (g, p), a in frequent.items() if g == lang}
        got = []
        for p, a in mine.items():
            if len(p) < 2:
                continue
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in mine.items()):
                continue
            score, k = min((1000 * a * n[lang] // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p)))
            got.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(got)[:top])]
    return sorted(out)


def corpus():
    rnd = random.Random(3)
    vocab = ["Ä", "b", "New", "york", "NEW", "dé", "漢字", "𝔘", "x" * 300, "a-b", "'t"] + [f"w{i}" for i in range(12)]
    rows = [(None, None), ("en", ""), (None, " \t\n.;"), ("und", "b b b b b b b"), ("en", "b")]
    for _ in range(120):
        text = "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\t ", "  ", ". ", ",", "\n", "\x0b"])
                       for _ in range(rnd.randint(1, 60)))
        rows.append((rnd.choice(["en", "fr", None, "a\nb"]), text))
    return rows + rows[10:14] + [("fr", "new york w1 w2 w3 w4 " * 2000)]


@pytest.mark.parametrize("shard_bytes,bits,top", [(1 << 22, 1 << 22, 2000), (1500, 8, 7)])
def test_equals_brute_force(spark, monkeypatch, shard_bytes, bits, top):
    """One trie, and many tries with a table of bits that tells nearly nothing."""
    monkeypatch.setattr(C, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(C, "FREQUENT_BITS", bits)
    rows = corpus()
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "lang string, text string, phrase string, n int")
    if shard_bytes < 2000:  # many tries are many passes: two levels are enough here
        got, want = C.collocations(df, min_count=5, max_words=2, top=top), brute(rows, 5, 2, top)
    else:
        got, want = C.collocations(df, min_count=5), brute(rows, 5)
    assert len(want) > 10
    assert sorted(map(tuple, got.collect())) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(df).collect() == []
    assert C.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_words_of_a_group():
    w = C.Words(np.frombuffer(" Ab c.d\te".encode() + b"f", dtype=np.uint8), np.array([0, 9, 9, 10]))
    assert bytes(w.buf) == b"ab c\nd e\nf\n"
    assert list(w.doc) == [0, 0, 0, 0, 2] and list(w.follow) == [1, 0, 1, 0, 0]


def test_trie_accepts_its_strings_only():
    rnd = random.Random(1)
    strings = sorted({bytes(rnd.choice(b"abcdefghijklmnopqrstuvwxyz \xc3\xa4") for _ in range(rnd.randint(1, 9)))
                      for _ in range(3000)})
    trie = byte_trie.build(strings)
    asked = strings + [s + b"q" for s in strings] + [s[:-1] for s in strings if len(s) > 1]
    buf = np.frombuffer(b"\n".join(asked) + b"\n", dtype=np.uint8)
    size = np.array([len(s) for s in asked])
    first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    number = {s: i for i, s in enumerate(strings)}
    got = trie.accepted(buf, first, first + size, np.zeros(len(asked), dtype=np.int32))
    assert list(got) == [number.get(s, -1) for s in asked]
    assert byte_trie.build([]).state_of(b"a") == -1

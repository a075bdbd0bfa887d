"""Operator 12 against brute force over sets of words."""

import random
import re

import numpy as np
import pytest

from skyfold.llm import minhash as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(texts, percent=85):
    sets = [shingles(t) for t in texts]
    low = list(range(len(texts)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                low[b] = a
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


def corpus():
    rnd = random.Random(5)
    vocab = ["Ä", "b", "Cc", "dé", "E", "ß", "x" * 700, "漢字", "a b"] + [f"w{i}" for i in range(300)]
    texts = [None, "", " \t\n", "One", "one", "a b", "A  B", "a b c", "A b\x0bC", "x" * 50_000, "w1 " * 20_000]
    for _ in range(25):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([7, 8, 9, 20, 60, 200]))]
        texts.append(" ".join(w))
        for _ in range(rnd.randint(0, 5)):  # chains of edits around the threshold
            w = list(w)
            for _ in range(max(1, int(len(w) * rnd.uniform(0.005, 0.04)))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append(rnd.choice(["\n", " \x0b"]).join(w))
    return texts + texts[12:15] * 20


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, t int")
    return M.near_duplicates(df, shingle=3, percent=85, **kw).collect()


@pytest.mark.parametrize("chunk", [1 << 23, 2000])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(M, "CHUNK_BYTES", chunk)
    texts = corpus()
    got = {r["doc_id"]: r for r in run(spark, enumerate(texts))}
    sizes, low = brute(texts)
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == low
    assert all(got[i]["kept"] == (low[i] == i) for i in range(len(texts)))
    assert len(set(low)) < len(texts) - 60


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "p q r s"), (5, "p q r s"), (5, "p q r s"), (None, "other words here now"), (2, "P Q R S"), (None, "")]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in run(spark, rows)), key=str)
    assert got == sorted([(None, 2, False), (5, 2, False), (5, 2, False), (None, None, True), (2, 2, True),
                          (None, None, True)], key=str)
    assert run(spark, []) == []


def test_links_that_the_center_does_not_have(spark):
    """A bucket whose smallest node is unlike two others that are alike."""
    a = [f"s{i}" for i in range(100)]
    texts = [" ".join(a[:80] + [f"{k}x{i}" for i in range(20)] + tail) for k in range(6) for tail in ([], ["end"])]
    got = {r["doc_id"]: r["component_id"] for r in run(spark, enumerate(texts))}
    assert [got[i] for i in range(12)] == brute(texts)[1]
    assert len(set(got.values())) == 6


def test_forest_is_exact_and_small():
    rnd = random.Random(2)
    base = [rnd.sample(range(400), 40) for _ in range(12)]
    sets = [set(b[:40 - rnd.randint(0, 4)]) | {500 + rnd.randrange(3)} for b in base for _ in range(6)]
    want = [set(p) for p in ((i, j) for i in range(72) for j in range(i) if M.similar(sets[i], sets[j], 85))]
    links = M.forest(list(range(72)), list(range(72)), None, sets, 85)
    assert len(links) < 72 and all({i, j} in want for i, j in links)

    def label(pairs):
        low = list(range(72))
        for _ in low:
            for i, j in map(tuple, pairs):
                low[i] = low[j] = min(low[i], low[j])
        return low

    assert label([{i, j} for i, j in links]) == label(want)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 2**63, 1200).astype(np.uint64)
    for n, shared in ((1, 1), (4, 3), (600, 540)):
        one, two = h[:n], np.concatenate([h[:shared], h[600:600 + n - shared]])
        doc = np.repeat([0, 2], [n, n])
        s = M.sketch(doc, np.concatenate([one, two]), 3)
        assert (s[[0, 2]] != M._EMPTY).all() and (s[1] == M._EMPTY).all()
        j = shared / (2 * n - shared)
        assert abs((s[0] == s[2]).mean() - j) < 0.15

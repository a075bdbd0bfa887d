"""Operator 9 against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyfold.llm import simhash
from skyfold.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(fps):
    """Smallest position reachable over links of at most 3 bits."""
    low = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if bin(fps[i] ^ fps[j]).count("1") <= 3 and low[j] > low[i]:
                    low[j], changed = low[i], True
    return low


def corpus():
    rnd = random.Random(7)
    vocab = ["Ä", "b", "Cc", "dé", "E", "ß", "token", "x" * 70, "漢字"] + [f"w{i}" for i in range(40)]
    texts = [None, "", " \t\n", "One", "one", "a b", "A  B", "x" * 50_000, "w1 " * 20_000]
    for _ in range(60):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(3, 60))]
        texts.append(" ".join(w))
        if rnd.random() < 0.5:
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append(rnd.choice(["\n", " \x0b"]).join(w))
    return texts + texts[10:14]


def test_groups_equal_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, a int")
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.simhash_groups(df).collect()}
    fps = [fingerprint(t) for t in texts]
    assert [got[i][0] for i in range(len(texts))] == fps
    assert [got[i][1] for i in range(len(texts))] == brute(fps)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "p q r s"), (5, "p q r s"), (5, "p q r s"), (None, "other words here now"), (2, "P Q R S")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(df).collect()), key=str)
    assert got == sorted([(None, 2), (5, 2), (5, 2), (None, None), (2, 2)], key=str)
    assert simhash.simhash_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("aim,leaf", [(32, 50), (8, 10)])
def test_tree_and_chunks_lose_no_link(spark, monkeypatch, aim, leaf):
    """Many small shards, shards dealt out in chunks, dense clusters."""
    monkeypatch.setattr(simhash, "LEAF_AIM", aim)
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 60)] + [0]
    fps = set(base)
    for b in base:
        x = b
        for _ in range(int(rng.integers(0, 8))):  # chains of links
            for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    leaves = simhash._shards(nodes, 1).groupBy("half", "leaf").count().collect()
    assert len(leaves) > 4 and max(r["count"] for r in leaves) < 0.9 * len(fps)
    root = {r["node"]: r["root"] for r in components(simhash.close_links(nodes)).collect()}
    got = [root.get(x, x) for x in signed]
    want = brute(fps)
    classes = {}
    for g, w in zip(got, want):
        assert classes.setdefault(w, g) == g
    assert len(set(got)) == len(set(want))


def test_in_memory_tree(monkeypatch):
    monkeypatch.setattr(simhash, "DIRECT", 16)
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 2**63, 300, dtype=np.uint64)
    fps[150:] = fps[:150] ^ (np.uint64(1) << rng.integers(0, 60, 150).astype(np.uint64))
    fps[200:250] ^= np.uint64(0b110 << 60)
    label = simhash.link_close(fps, None, 3)
    assert list(label) == brute([int(x) for x in fps])


def test_long_component_chain(spark):
    links = spark.range(0, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(links.union(spark.createDataFrame([(1000, 1000), (None, 4)], "a long, b long")))
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(301)}

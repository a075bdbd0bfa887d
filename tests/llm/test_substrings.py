"""Operator 3 against a brute-force version, with blocks of a few rows."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from skyfold.llm import substrings, words
from skyfold.llm.substrings import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, k):
    docs = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + k]) for w in docs for i in range(len(w) - k + 1))
    out = []
    for w in docs:
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone), sorted(gone)))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["é", "b", "漢", "d" * 600, "e,", "\x85f", "\x1f"] + [f"w{i}" for i in range(rnd.choice([3, 60, 400]))]
    passage = [rnd.choice(vocab) for _ in range(90)]
    texts = [None, "", "  \n", "a " * 200, "a b " * 100, "x", " ".join(passage)]
    for _ in range(25):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([5, 34, 35, 36, 120]))]
        if rnd.random() < 0.5:
            i, j = sorted(rnd.sample(range(91), 2))
            w[rnd.randrange(len(w)):0] = passage[i:j]
        texts.append(rnd.choice([" ", "\t", " \n "]).join(w))
        if rnd.random() < 0.3:
            texts.append(texts[-1])
    return texts


@pytest.mark.parametrize("seed,k,chunk", [(1, 35, 1 << 21), (2, 35, 64), (3, 6, 256), (4, 35, 1 << 21)])
def test_equals_brute_force(spark, monkeypatch, seed, k, chunk):
    if chunk < 1 << 20:  # word helpers in many pieces, here and in the workers
        monkeypatch.setattr(words, "CHUNK_BYTES", chunk)
    texts = corpus(seed)
    # clashing and extra columns, null and repeated ids
    df = spark.createDataFrame([(None if i % 5 == 0 else i // 2, t, i, "kept", i) for i, t in enumerate(texts)],
                               "doc_id long, text string, i long, kept string, n_words long")
    got = remove_repeats(df.coalesce(2), window=k, block_bytes=700).orderBy("i").collect()
    assert [r["doc_id"] for r in got] == [None if i % 5 == 0 else i // 2 for i in range(len(texts))]
    want = brute(texts, k)
    assert [(r["n_words"], r["n_removed"], r["kept"]) for r in got] == [w[:3] for w in want]
    assert [[p for s in r["removed"] for p in range(s["start"], s["end"])] for r in got] == [w[3] for w in want]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    got = remove_repeats(df)
    assert got.count() == 0 and got.columns == ["doc_id", "text", "lang", "n_words", "n_removed", "kept", "removed"]


def test_blocks_do_not_depend_on_batches():
    rnd = random.Random(9)
    texts = [None if rnd.random() < 0.1 else "x" * rnd.choice([0, 0, 3, 10, 70]) for _ in range(60)]

    def cut(sizes):
        batches, i = [], 0
        while i < len(texts):
            n = rnd.choice(sizes)
            batches.append(pa.RecordBatch.from_pydict({"text": pa.array(texts[i:i + n], pa.string())}))
            i += n
        return [b.column("text").to_pylist() for b in substrings._slices(iter(batches), "text", 50)]

    whole = cut([60])
    assert sum(whole, []) == texts and len(whole) > 5
    assert all(sum(len(t or "") for t in b) <= 50 or sum(1 for t in b if t) == 1 for b in whole)
    for sizes in ([1], [2, 7], [0, 5]):
        assert cut([n for n in sizes if n] if len(sizes) == 1 else sizes) == whole


def test_a_shared_passage_in_unlike_surroundings_branches(spark):
    """One passage inside many texts: its nodes at the ends branch, the inner ones
    do not; a copy that begins in the middle of a run is found, too."""
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(120)]
    texts = [" ".join([f"a{k}_{rnd.random()}" for _ in range(9 + k)] + passage[k % 7:120 - k % 5]
                      + [f"b{k}_{rnd.random()}" for _ in range(8)]) for k in range(30)]
    texts += [" ".join(passage[50:85]), " ".join(passage[50:84])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["n_removed"] for r in remove_repeats(df).orderBy("doc_id").collect()]
    assert got == [w[1] for w in brute(texts, 35)]
    assert got[0] == 120 and got[-2:] == [35, 0]

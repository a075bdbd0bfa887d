"""Pipeline: every stage against a brute-force version, on hand-made rows and on a real table."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm import test_credentials, test_simhash, test_substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality int, body string"


def rows():
    rnd = random.Random(9)
    vocab = ["the", "of", "and", "de", "der"] * 15 + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    make = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    texts = [make(rnd.randint(60, 200)) for _ in range(25)]
    texts += [f"{make(80)} {passage} {make(70)}" for _ in range(4)]
    texts += [f"{make(60)} AKIA{'Q' * 16} password=abcdef0123 \n {make(30)}" for _ in range(3)]
    texts += texts[:5] + [texts[6] + " more", texts[7].upper(), None, "", "short text", "# % & " * 100, make(9000)]
    out = [(i * 3 % 101, t, "en", "s", len(t or ""), i, "b") for i, t in enumerate(texts)]
    return out + [(None, texts[8], None, None, None, 1, None), (None, make(100), None, None, None, 1, None),
                  (None, texts[9], None, "s", 1, 1, None), out[3], out[3], out[10]]


def kept_by_groups(table):
    """One row of each near-duplicate group, by comparing all fingerprints."""
    fps = [test_simhash.fingerprint(r["text"]) for r in table]
    low = test_simhash.brute(fps)
    best = {}
    for r, g in zip(table, low):
        best.setdefault(g, []).append(r)
    return [sorted(x, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))[0]["doc_id"] for x in best.values()]


def test_stages(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    good = P.quality(spark, docs, "")
    assert good.columns == docs.columns
    texts = [r["text"] for r in good.collect()]
    assert None not in texts and "" not in texts and "short text" not in texts and not any(t[0] == "#" for t in texts)
    assert len(texts) == len(rows()) - 4

    good = good.cache()
    table = good.collect()
    one = P.near_dedup(spark, good, "")
    assert one.columns == docs.columns
    got = [r["doc_id"] for r in one.collect()]
    assert sorted(got, key=str) == sorted(kept_by_groups(table), key=str)
    assert set(one.collect()) <= set(table)

    one = one.cache()
    table = sorted(one.collect(), key=str)
    cut = P.substring_dedup(spark, one, "")
    assert cut.columns == docs.columns
    want = test_substrings.brute([r["text"] for r in table], 35)
    have = sorted(cut.collect(), key=str)
    by = lambda rs: sorted((str(r["doc_id"]), r["text"], r["n_chars"]) for r in rs)
    expect = [r.asDict() | ({"text": w[2], "n_chars": len(w[2])} if w[1] else {}) for r, w in zip(table, want)]
    assert by(have) == by(expect) and any(w[1] for w in want)

    cut = cut.cache()
    safe = P.secrets(spark, cut, "")
    assert safe.columns == docs.columns and safe.count() == cut.count()
    for r in safe.collect():
        assert not test_credentials.base(r["text"]) and (r["n_chars"] == len(r["text"]))
    assert safe.where(F.col("text").contains("[SECRET] [SECRET]")).count() == 3

    safe = safe.cache()
    pieces = P.packing(spark, safe, "").collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(e.ids) + 1 for e in whole.encode_batch([r["text"] for r in safe.collect()], add_special_tokens=False))
    assert sum(r["length"] for r in pieces) == tokens
    at = sorted(r["sequence_id"] * 2048 + r["offset"] for r in pieces)
    assert at[0] == 0 and len(set(at)) == len(at)


def test_unlike_texts_under_one_id(spark):
    """Two unlike texts with the smallest id, each with a copy: one row of each group stays."""
    a, b = (" ".join(f"{c}{i * i}" for i in range(120)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (3, b)], "doc_id long, text string")
    assert sorted(map(tuple, P.near_dedup(spark, docs, "").collect())) == sorted([(1, a), (1, b)])


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, docs, "").count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_run_on_a_table(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = P.run(spark, path)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {r["doc_id"] for r in out.collect()}
    clean = docs.join(P.quality(spark, docs, path).select("doc_id"), "doc_id")
    assert ids <= {r["doc_id"] for r in clean.collect()} and len(ids) > 0.6 * clean.count()
    assert np.all(np.diff(sorted(r["sequence_id"] for r in out.collect())) <= 1)


def test_clashing_columns_in_every_stage(spark):
    """Columns named like those that the stages and operators use, and a map."""
    names = ["id", "row", "_row", "_spans", "mark", "own", "body", "k1", "root", "fp", "hash", "quality", "kept", "n_removed"]
    docs = spark.createDataFrame(rows(), SCHEMA).drop("quality", "body").select(
        "*", *[F.lit(n).alias(n) for n in names], F.create_map(F.lit("a"), F.col("n_chars")).alias("map"))
    for name, stage in P.STAGES:
        before, docs = docs, stage(spark, docs, "")
        if name != "packing":
            assert docs.columns == before.columns
            assert all(r[n] == n for r in docs.collect() for n in names)
            docs = P.stored(docs, "clash")
    assert docs.count() > 0

"""Operator 1: automata against plain substring search, phrases against a direct parse, held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.llm import langid as L

SF = "/root/testdata/sf0.01"


def test_automaton_knows_every_substring():
    rnd = random.Random(1)
    for _ in range(30):
        text = [rnd.randrange(3) for _ in range(rnd.randint(0, 40))]
        table = L.suffix_automaton(np.array(text, dtype=np.int64), 3)
        have = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
        for _ in range(200):
            w = tuple(rnd.randrange(3) for _ in range(rnd.randint(1, 8)))
            state = 0
            for c in w:
                state = int(table.step(np.array([state]), np.array([c]))[0]) if state >= 0 else -1
            assert (state >= 0) == (w in have)


def direct(train, text):
    """Greedy longest-match phrases by substring search; a character that the
    training text lacks is a phrase with whatever stood before it."""
    count, phrase = 1, ""
    for c in text:
        if phrase + c in train:
            phrase += c
        else:
            count += 1
            phrase = c if c in train else ""
    return count


@pytest.mark.parametrize("segment", [1 << 20, 7])
def test_phrases_equal_direct_parse(monkeypatch, segment):
    monkeypatch.setattr(L, "SEGMENT", segment)
    rnd = random.Random(3)
    make = lambda a, n: "".join(rnd.choice(a) for _ in range(n))
    train = {"x": make("ab c", 300), "y": make("bcd ", 300)}
    models = L.Models(train)
    texts = [make("abcd zé", rnd.randint(0, 60)) for _ in range(50)]
    symbols, size = models.symbols(*L.code_points(texts))
    got = models.phrases(symbols, size)
    read = lambda t: "".join(chr(65 + int(c)) for c in models.symbols(*L.code_points([t]))[0])
    for r, text in enumerate(texts):
        t = read(text)
        assert len(t) == size[r]
        for k, lang in enumerate(models.languages):
            pieces = [t[i:i + segment] for i in range(0, len(t), segment)]
            assert got[r, k] == sum(direct(read(train[lang]), p) for p in pieces)


def test_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from skyfold.llm.langid import op1_language_id
    got = op1_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = got.count(), got.where(F.col("lang") == F.col("lang_pred")).count()
    assert n > 300 and right / n >= 0.98
    assert got.where((F.col("score") < 0) | (F.col("score") > 1) | F.col("score").isNull()).count() == 0


def test_defined_cases(spark):
    labelled = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "de"),
                                      ("x", None)], "text string, lang string")
    rows = [(1, None), (1, ""), (2, "12 !? 34"), (None, "the dog and the cat " * 5000), (3, "et le chat"),
            (3, "et le chat"), (4, "漢字")]
    df = spark.createDataFrame([(i, t, "zz", 7.0) for i, t in rows], "doc_id long, text string, lang string, score double")
    got = [(r["doc_id"], r["lang_pred"]) for r in L.identify(df, labelled).collect()]
    assert got == [(1, "und"), (1, "und"), (2, "und"), (None, "en"), (3, "fr"), (3, "fr"), (4, "en")]
    assert {r["lang_pred"] for r in L.identify(df, labelled.limit(0)).collect()} == {"und"}
    assert L.identify(df.limit(0), labelled).count() == 0


def test_every_label_is_learnt(spark):
    """20,000 copies of one text beside 50 others, and more than 32 labels."""
    rows = [("the cat and the dog of the house", "en")] * 20_000
    rows += [(f"le chat numéro {chr(97 + i % 26) * (i // 5 + 1)} et le chien", "fr") for i in range(50)]
    texts = L.training_texts(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", 1000)
    assert set(texts) == {"en", "fr"} and texts["en"] == rows[0][0] and texts["fr"].count("le chat") > 20
    many = [(chr(0x4E00 + 40 * i) + "".join(chr(0x4E00 + 40 * i + j) for j in range(30)), f"l{i:02d}") for i in range(40)]
    df = spark.createDataFrame(many, "text string, lang string")
    got = L.identify(df.select("text", F.col("lang").alias("want")), df).collect()
    assert all(r["lang_pred"] == r["want"] for r in got) and len(got) == 40


def test_a_large_alphabet_takes_little_memory():
    rnd = random.Random(6)
    text = "".join(chr(0x4E00 + int(rnd.paretovariate(0.6)) % 4000) for _ in range(10_000))
    models = L.Models({"en": "the cat and the dog", "zh": text})
    assert models.width > 500
    assert sum(a.nbytes for m in models.tables for a in (m.base, m.check, m.to)) < 10_000_000

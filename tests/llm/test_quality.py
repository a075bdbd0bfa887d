"""Operator 5 against a brute-force version."""

import random
import re
from collections import Counter

from skyfold.llm.quality import RULES, op5_quality_rules, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    cover = {p for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def corpus():
    rnd = random.Random(3)
    vocab = ["the", "Of", "é", "漢", "😀x", "#", "a|b", "...", "-", "\x85", "w" * 300] + [f"w{i}" for i in range(30)]
    texts = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "x " * 20_000, "the\n" * 70, "\n- a\n- a\n* b…\nc..."]
    for n in (5, 60, 300):
        texts += ["".join(rnd.choice(vocab[:rnd.choice([3, 41])]) + rnd.choice([" ", "  ", "\n", "\t", "\x0b"])
                          for _ in range(n)) for _ in range(15)]
    return texts


def test_counts_equal_brute_force(spark):
    texts = corpus()
    rows = [(None if i % 5 == 0 else i // 2, t, i, "clash", 5) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, i int, quality string, n_words int")
    got = quality_rules(df).orderBy("i").collect()
    assert len(got) == len(rows)
    for r in got:
        q = r["quality"]
        want = counts(texts[r["i"]])
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == want, r["i"]
        assert q["kept"] == (not q["failed"]) and ("length" in q["failed"]) == (want[0] < 50)
        assert r["n_words"] == 5 and r["text"] == texts[r["i"]]


def test_threshold_table_is_a_parameter(spark):
    df = spark.createDataFrame([("a b c",), ("#",)], "text string")
    rules = (("few", "n_words", 2, None), ("marks", "n_symbols", None, 0))
    assert [r["quality"]["failed"] for r in quality_rules(df, rules=rules).collect()] == [[], ["few", "marks"]]
    assert [r["quality"]["kept"] for r in quality_rules(df, rules=()).collect()] == [True, True]


def test_plan_is_one_projection(spark):
    plan = quality_rules(spark.createDataFrame([("a",)], "text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Join|Python|Arrow", plan)
    assert {m for _, m, *_ in RULES} <= set(quality_rules(spark.createDataFrame([("a",)], "text string"))
                                            .schema["quality"].dataType.names)


def test_clean_documents_are_kept(spark):
    path = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    for r in op5_quality_rules(spark, path).collect():
        n, chars, marks, dup, rep = counts(texts[r["doc_id"]])
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        if not r["base_failed"] and marks == 0 and dup == 0 and "!!" not in texts[r["doc_id"]]:
            assert r["kept"], r
    assert quality_rules(spark.createDataFrame([], "text string")).count() == 0

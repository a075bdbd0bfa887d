"""Language identification by cross-parsing entropy (operator 1).

Learning.  From the labelled rows a bounded, documented sample is taken: per
language the ``SAMPLE_ROWS`` distinct texts with the smallest hashes, in hash
order, up to ``sample_chars`` characters; every language with a text is learnt,
however many copies it has.  With many languages each has fewer characters, so
that all have ``TOTAL_CHARS`` at most.  The sample is broadcast, and every
worker builds one suffix automaton per language from it, once.

Prediction.  A text is cross-parsed against each automaton: starting at the
root, transitions are followed as long as they exist; where none does, a
phrase ends and the next one starts.  The number of phrases c of n characters
gives the cross entropy c * log2(m) / n for a training text of m characters;
the language with the smallest wins (ties: the smaller label).  The automata
are walked as double arrays, many texts in step; a text is parsed in segments of
``SEGMENT`` characters (a phrase does not run over a segment's end), so a very
long text is many short lanes and no part of it is skipped.

Characters are classed: letters in lower case, each letter of the training
texts a class of its own, all other letters one class that no automaton has,
and everything else a blank; blanks in a row count once.

Score: 1 - best / second best entropy, in 0..1 (1 if only one language is
known).

Defined results: null or letterless text gives ``und`` and score 0; with no
labelled row every text is ``und``; rows with null text or label are not learnt
from; repeated rows are predicted alike, row by row; an empty table gives an
empty result; id, label and other columns are never inputs of a prediction.
"""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skyfold.llm.byte_trie import place
from skyfold.llm.storage import stored

#: Characters of training text per language.
SAMPLE_CHARS = 40_000
#: Distinct texts per language that the sample takes at most.
SAMPLE_ROWS = 400
#: Characters of training text of all languages together, which bounds the
#: broadcast: with more than 32 labels, each has less.
TOTAL_CHARS = 32 * SAMPLE_CHARS
SEGMENT = 1024
#: Characters that walk the automata at a time.
LANES = 1 << 22

BLANK, UNSEEN = 0, 1


@functools.cache
def letter_table() -> np.ndarray:
    """True for every code point that is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


@dataclass
class Automaton:
    """Transitions as a double array: state s goes by symbol c to ``to[base[s] + c]``
    if ``check`` of that slot is s.  Its size follows the number of transitions
    (three a character at most), not the alphabet.  State 0 is the root."""

    base: np.ndarray
    check: np.ndarray
    to: np.ndarray

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next states; -1: none."""
        at = self.base[state] + symbol
        return np.where(self.check[at] == state, self.to[at], np.int32(-1))


def suffix_automaton(symbols: np.ndarray, width: int) -> Automaton:
    """The suffix automaton of ``symbols``, all below ``width``."""
    following, link, length, last = [{}], [-1], [0], 0
    for c in symbols.tolist():
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    kids = np.fromiter(map(len, following), np.int64, len(following))
    edges = np.array([(s, c, t) for s, f in enumerate(following) for c, t in sorted(f.items())], np.int64).reshape(-1, 3)
    base = place(kids, np.cumsum(kids) - kids, edges[:, 1], width)
    slots = base[edges[:, 0]] + edges[:, 1]
    size = int(base.max()) + width + 1
    out = Automaton(base.astype(np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32))
    out.check[slots], out.to[slots] = edges[:, 0], edges[:, 2]
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts in lower case, length of each)."""
    low = [t.lower() for t in texts]
    return (np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4"),
            np.fromiter(map(len, low), np.int64, len(low)))


class Models:
    """The automata of all languages over one alphabet."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        letters = letter_table()
        codes = {k: code_points([texts[k]])[0] for k in self.languages}
        known = np.unique(np.concatenate([c[letters[c]] for c in codes.values()])) if codes else np.zeros(0, np.int64)
        self.classes = np.where(letters, np.uint16(UNSEEN), np.uint16(BLANK)).astype(np.uint16)
        self.classes[known] = np.arange(2, 2 + len(known), dtype=np.uint16)
        self.width = 2 + len(known)
        self.size, self.tables = [], []
        for k in self.languages:
            symbols = self.symbols(codes[k], np.array([len(codes[k])]))[0]
            self.size.append(max(2, len(symbols)))
            self.tables.append(suffix_automaton(symbols, self.width))

    def symbols(self, code: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(classes with blanks in a row counted once, length of each text)."""
        kind = self.classes[code]
        end = np.cumsum(length)
        keep = np.ones(len(kind), dtype=bool)
        keep[1:] = (kind[1:] != BLANK) | (kind[:-1] != BLANK)
        first = (end - length)[length > 0]
        keep[first] = True
        total = np.r_[0, np.cumsum(keep)]
        return kind[keep], total[end] - total[end - length]

    def phrases(self, symbols: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of every text for every language, (texts, languages)."""
        out = np.zeros((len(length), len(self.languages)), dtype=np.int64)
        end = np.cumsum(length)
        lanes = -(-length // SEGMENT)
        owner = np.repeat(np.arange(len(length)), lanes)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = (end - length)[owner] + number * SEGMENT
        size = np.minimum(SEGMENT, end[owner] - start)
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
        for k, table in enumerate(self.tables):
            root = table.step(np.zeros(self.width, dtype=np.int32), np.arange(self.width))
            state = np.zeros(len(start), dtype=np.int32)
            count = np.ones(len(start), dtype=np.int64)
            for t, n in enumerate(active.tolist()):  # lanes longer than t
                c = symbols[start[:n] + t]
                to = table.step(state[:n], c)
                miss = np.flatnonzero(to < 0)
                count[miss] += 1
                again = root[c[miss]]
                # a character that no phrase can hold is one phrase; the next starts after it
                to[miss] = np.maximum(again, 0)
                state[:n] = to
            np.add.at(out[:, k], owner, count)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) of every text."""
        names, scores = [], np.zeros(len(texts))
        i = 0
        while i < len(texts):  # whole texts, about LANES characters at a time
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j] or "") <= LANES):
                chars += len(texts[j] or "")
                j += 1
            code, length = code_points([t or "" for t in texts[i:j]])
            total = np.r_[0, np.cumsum(letter_table()[code])]
            end = np.cumsum(length)
            letters = total[end] - total[end - length]
            symbols, length = self.symbols(code, length)
            entropy = self.phrases(symbols, length) * np.log2(np.array(self.size, dtype=np.float64))
            for r in range(j - i):
                if not letters[r] or not self.languages:
                    names.append("und")
                    continue
                e = entropy[r]
                best = int(np.argmin(e))
                names.append(self.languages[best])
                rest = np.delete(e, best)
                scores[i + r] = 1.0 if not len(rest) else max(0.0, 1 - e[best] / rest.min())
            i = j
        return names, scores


def training_texts(labelled: DataFrame, text_col: str, lang_col: str, sample_chars: int) -> dict[str, str]:
    """The bounded sample: at most ``sample_chars`` characters per language."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # copies are one text; the first few by hash are the sample, however many rows a text has
    marks = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    drawn = stored(marks.withColumn("n", nth).where(F.col("n") <= SAMPLE_ROWS).drop("n"), "langid-sample")
    n = drawn.agg(F.count_distinct("lang")).first()[0]
    if not n:
        return {}
    sample_chars = max(1, min(sample_chars, TOTAL_CHARS // n))
    some = rows.withColumn("h", F.xxhash64("text")).join(drawn, ["lang", "h"]).groupBy("lang", "h").agg(
        F.min(F.substring("text", 1, sample_chars)).alias("text"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        text = "\n".join(pdf.sort_values(["h", "text"])["text"])[:sample_chars]
        return pd.DataFrame({"lang": [pdf["lang"].iat[0]], "text": [text]})

    return {r["lang"]: r["text"] for r in some.groupBy("lang").applyInPandas(join, "lang string, text string").collect()}


def identify(docs: DataFrame, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
             sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """Columns of ``docs`` plus ``lang_pred`` and ``score``, learnt from ``labelled``."""
    texts = training_texts(labelled, text_col, lang_col, sample_chars)
    model = docs.sparkSession.sparkContext.broadcast(texts)
    docs = docs.drop("lang_pred", "score")

    def run(batches):
        models = _models(tuple(sorted(model.value.items())))
        for batch in batches:
            names, scores = models.predict(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, T.StructType([
        *docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


@functools.lru_cache(maxsize=1)
def _models(texts: tuple) -> Models:
    return Models(dict(texts))


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labelled = docs.where(~held_out(F.col("doc_id"))).select("text", "lang")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, labelled).select("doc_id", "held_out", "lang_pred", "score")

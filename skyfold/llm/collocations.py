"""Phrase collocations by double-array tries of Apriori-safe candidates (operator 11).

Texts are lower-cased (A-Z only) and split at ``.,;:!?`` and 0x0A-0x0D into
pieces, pieces at blanks and tabs into words.  Everything is per language.

Levels.  Pass 0 counts words.  Pass k (k = 1 .. ``max_words``) works on the
candidates of k words: they are dealt to double-array byte tries of at most
``SHARD_BYTES`` bytes of text each (``byte_trie``), and one trie at a time is
broadcast.  In every task numpy walks the states of all text positions together,
level by level, the accepting states are bincounted, and Spark sums the counts
of the shards of text: that is the exact f of every candidate.  The same walk
notes, behind each accepting state, the hash of the next word if it may be
frequent; those (state, hash) pairs with ``min_count`` or more occurrences are
the candidates of k + 1 words.  A phrase of f >= min_count has a first part
and a last word as frequent, so no phrase is lost; hashes that fall together
only add candidates, which the next bincount removes.  "May be frequent" is
one bit of a table of fixed size (``FREQUENT_BITS``).

Scores are exact in decimals.  A candidate is dropped if its words lie in a
longer candidate as frequent; since f falls with length, looking one word
further is enough.

Scale: work is one pass over the texts per level and trie shard; what is
shuffled are counts per task, not occurrences; candidates are bounded by total
words / ``min_count``.  Broadcast: one trie shard (bounded by ``SHARD_BYTES``)
and the bit table.  No text, list of words or list of candidates is collected.

Defined results: null and empty texts have no words; a null language is
``und``; a very long text is one document read in one piece, its words in one
task; repeated rows count each; an empty table gives an empty result; ties are
ordered by the contract's keys; only the language and text columns are read, so
others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyfold.llm.byte_trie import ByteTrie, build
from skyfold.llm.storage import stored
from skyfold.llm.words import groups_by_bytes, string_bytes, word_hashes

#: Bytes of candidates in one trie.  A trie has at most one state per byte, so
#: this bounds what is broadcast (three 32-bit arrays of a few slots a state).
SHARD_BYTES = 1 << 22
#: Bits of the table of hashes of frequent words.
FREQUENT_BITS = 1 << 22
#: Bytes of text whose positions advance together, and rows of counts that a
#: task holds before it adds them up.
GROUP_BYTES, HELD = 1 << 20, 1 << 20

BLANK, BREAK = 1, 2
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = BLANK
_CLASS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_COUNTS = pa.schema([("p", pa.int64()), ("h", pa.int64()), ("n", pa.int64())])


class Words:
    """The words of some documents in one buffer, each followed by a blank, or by
    a line feed if its piece ends."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        kind = _CLASS[raw]
        word = kind == 0
        start = word.copy()
        start[1:] &= ~word[:-1]
        new = np.zeros(len(raw) + 1, dtype=bool)  # a document begins here
        new[off[:-1]] = True
        start |= word & new[:-1]
        cuts = np.cumsum((kind == BREAK) + new[:-1].astype(np.int64))
        at = np.flatnonzero(start)
        self.doc = np.searchsorted(off, at, "right") - 1
        piece = cuts[at] if len(at) else at
        chars = np.flatnonzero(word)
        owner = np.cumsum(start)[chars] - 1
        lens = np.bincount(owner, minlength=len(at))
        self.first = np.concatenate([[0], np.cumsum(lens + 1)]).astype(np.int64)[:-1]
        self.end = self.first + lens
        self.buf = np.full(len(chars) + len(at), 0x20, dtype=np.uint8)
        self.buf[np.arange(len(chars)) + owner] = _LOWER[raw[chars]]
        self.last = np.ones(len(at), dtype=bool)  # the last word of its piece
        self.last[:-1] = piece[1:] != piece[:-1]
        self.buf[self.end[self.last]] = 0x0A
        # how many words of the piece follow each word
        ends = np.flatnonzero(self.last)
        self.follow = ends[np.searchsorted(ends, np.arange(len(at)))] - np.arange(len(at)) if len(at) else at

    def hashes(self) -> np.ndarray:
        return word_hashes(self.buf, self.first, self.end, 0).view(np.int64)

    def strings(self) -> pa.Array:
        """The words as a string array."""
        keep = np.ones(len(self.buf), dtype=bool)
        keep[self.end] = False
        off = np.concatenate([[0], np.cumsum(self.end - self.first)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(self.first), pa.py_buffer(off), pa.py_buffer(self.buf[keep]))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, Words]]:
    """(languages, code of each document's language, words) of bounded groups of documents."""
    for batch in batches:
        lang = batch.column("lang").dictionary_encode()
        code = np.asarray(lang.indices).astype(np.int64)
        raw, off = string_bytes(batch.column("text"))
        for i, j in groups_by_bytes(off, GROUP_BYTES):
            yield lang.dictionary, code[i:j], Words(raw[off[i]:off[j]], off[i:j + 1] - off[i])


class _Sums:
    """Adds up counts of equal keys, holding a bounded number of rows."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.keys, self.held, self.rows = schema, schema.names[:-1], [], 0

    def _summed(self) -> pa.Table:
        t = pa.concat_tables(self.held).group_by(self.keys, use_threads=False).aggregate([("n", "sum")])
        return t.rename_columns([*self.keys, "n"] if t.column_names[-1] == "n_sum" else ["n", *self.keys]).select(
            self.schema.names).cast(self.schema)

    def add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.held.append(table)
        self.rows += len(table)
        if self.rows > HELD:
            whole = self._summed()
            if len(whole) > HELD // 2:
                yield from whole.to_batches(max_chunksize=1 << 16)
                self.held, self.rows = [], 0
            else:
                self.held, self.rows = [whole], len(whole)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self._summed().to_batches(max_chunksize=1 << 16)


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, h, n): every word with its hash and its number of occurrences."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("h", pa.int64()), ("n", pa.int64())])

    def run(batches):
        sums = _Sums(schema)
        for langs, code, w in _groups(batches):
            if not len(w.first):
                continue
            words = w.strings().dictionary_encode()
            ids = np.asarray(words.indices).astype(np.int64)
            first = np.zeros(len(words.dictionary), dtype=np.int64)
            first[ids[::-1]] = np.arange(len(ids))[::-1]
            key, n = np.unique(code[w.doc] * len(first) + ids, return_counts=True)
            h = word_hashes(w.buf, w.first[first], w.end[first], 0).view(np.int64)
            ids = key % len(first)
            yield from sums.add(pa.table([
                langs.take(pa.array(key // len(first))), words.dictionary.take(pa.array(ids)).cast(pa.string()),
                pa.array(h[ids]), pa.array(n.astype(np.int64))], schema=schema))
        yield from sums.rest()

    parts = docs.mapInArrow(run, "lang string, word string, h bigint, n bigint")
    return parts.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def dealt(candidates: DataFrame) -> tuple[DataFrame, int]:
    """(candidates plus shard and number, shards): at most ``SHARD_BYTES`` in a
    shard; the number is the place in byte order."""
    key = F.concat(F.encode("lang", "utf-8"), F.lit(b"\n"), F.encode("phrase", "utf-8"))
    rows = candidates.withColumn("key", key)
    total = rows.agg(F.sum(F.length("key"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    while True:
        put = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
        size = put.groupBy("shard").agg(F.sum(F.length("key")).alias("b"), F.count("*").alias("c"))
        most = size.where("c > 1").agg(F.max("b")).first()[0] or 0
        if most <= SHARD_BYTES:
            break
        shards *= 2
    return put.withColumn("p", F.row_number().over(Window.partitionBy("shard").orderBy("key")).cast("long") - 1), shards


def tries(numbered: DataFrame) -> DataFrame:
    """(shard, base, check, accept): one trie per shard, built in its own task."""
    def make(t: pa.Table) -> pa.Table:
        keys = sorted(t.column("key").to_pylist())
        trie = build(keys)
        return pa.table({"shard": t.column("shard").slice(0, 1), **{
            n: pa.array([getattr(trie, n).tobytes()], pa.binary()) for n in ("base", "check", "accept")}})

    return numbered.select("shard", "key").groupBy("shard").applyInArrow(
        make, "shard int, base binary, check binary, accept binary")


def count_level(docs: DataFrame, trie: ByteTrie, k: int, frequent: np.ndarray | None) -> DataFrame:
    """(p, h, n): with a null h, the occurrences of the k-word candidate p; else
    those with a next word of hash h, where ``frequent`` has its bit."""
    shared = docs.sparkSession.sparkContext.broadcast((trie, frequent))

    def run(batches):
        trie, frequent = shared.value
        sums, total = _Sums(_COUNTS), np.zeros(int(trie.accept.max(initial=-1)) + 1, dtype=np.int64)
        for langs, code, w in _groups(batches):
            root = np.array([trie.state_of(x.encode() + b"\n") for x in langs.to_pylist()], dtype=np.int64)
            at = np.flatnonzero(w.follow >= k - 1)
            got = trie.accepted(w.buf, w.first[at], w.end[at + k - 1], root[code[w.doc[at]]].astype(np.int32))
            at, got = at[got >= 0], got[got >= 0]
            total += np.bincount(got, minlength=len(total))
            if frequent is not None:
                more = w.follow[at] >= k
                at, got = at[more] + k, got[more]
                h = word_hashes(w.buf, w.first[at], w.end[at], 0)
                may = frequent[(h % np.uint64(FREQUENT_BITS)).astype(np.int64)]
                yield from sums.add(pa.table([pa.array(got[may]), pa.array(h[may].view(np.int64)),
                                              pa.array(np.ones(int(may.sum()), dtype=np.int64))], schema=_COUNTS))
        seen = np.flatnonzero(total)
        yield from pa.table([pa.array(seen), pa.nulls(len(seen), pa.int64()), pa.array(total[seen])],
                            schema=_COUNTS).to_batches(max_chunksize=1 << 16)
        yield from sums.rest()

    return docs.mapInArrow(run, "p bigint, h bigint, n bigint").groupBy("p", "h").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, min_count: int, max_words: int) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of all phrases of 1 to ``max_words`` words with
    f >= ``min_count``, (lang, n) the number of words per language)."""
    words = stored(count_words(docs), "colloc-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    singles = stored(words.where(F.col("n") >= min_count).select("lang", F.col("word").alias("phrase"), "h"),
                     "colloc-singles")
    bits = np.zeros(FREQUENT_BITS, dtype=bool)
    cell = F.pmod("h", F.lit(FREQUENT_BITS))  # a power of two, so the sign of h does not matter
    bits[singles.select(cell.cast("int").alias("c")).distinct().toPandas()["c"].to_numpy(dtype=np.int64)] = True
    candidates, found = singles.select("lang", "phrase"), None
    for k in range(1, max_words + 1):
        numbered, shards = dealt(candidates)
        numbered = stored(numbered, "colloc-candidates")
        arrays = stored(tries(numbered), "colloc-tries")
        counts = None
        for s in range(shards):
            row = arrays.where(F.col("shard") == s).first()
            if row is None:
                continue
            trie = ByteTrie(*[np.frombuffer(row[n], dtype=np.int32) for n in ("base", "check", "accept")])
            part = count_level(docs, trie, k, bits if k < max_words else None).where(
                F.col("n") >= min_count).withColumn("shard", F.lit(s))
            counts = part if counts is None else counts.union(part)
        if counts is None:
            break
        counts = stored(counts, "colloc-counts")
        named = counts.join(numbered.select("shard", "p", "lang", "phrase"), ["shard", "p"])
        level = named.where("h is null").select("lang", F.lit(k).alias("words"), "phrase", F.col("n").alias("f"))
        found = level if found is None else found.union(level)
        if k < max_words:
            tail = singles.select("lang", F.col("phrase").alias("tail"), "h")
            longer = named.where("h is not null").join(tail, ["lang", "h"])
            candidates = stored(longer.select("lang", F.concat_ws(" ", "phrase", "tail").alias("phrase")),
                                "colloc-longer")
    if found is None:
        found = candidates.select("lang", F.lit(1).alias("words"), "phrase", F.lit(0).cast("long").alias("f")).limit(0)
    return found, totals


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 100,
                 max_words: int = 5, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).alias("text"))
    found, totals = frequent_phrases(rows, min_count, max_words)
    found = stored(found, "colloc-frequent")
    words = F.split("phrase", " ")
    longer = found.where("words > 1")
    inner = F.array(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1))
    within = longer.where("words > 2").select("lang", F.explode(inner).alias("w"), "f").groupBy(
        "lang", F.concat_ws(" ", "w").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = longer.join(within, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("f"))).select("lang", "phrase", F.col("f").alias("a"))
    cut = kept.join(totals, "lang").select(
        "lang", "phrase", "a", "n", words.alias("w"),
        F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k")).select(
        "lang", "phrase", "a", "n", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("head"),
        F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.size("w") - F.col("k"))).alias("tail"))
    head = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    score = F.expr("(cast(a as decimal(18,0)) * cast(n as decimal(17,0)) * 1000bd) div"
                   " (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    cuts = cut.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).withColumn("score", score)
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return lowest.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score").withColumn(
        "rank", place.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 collocations of ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


ORACLE_OP11 = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
pieces as (
  select d, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece,
         generate_subscripts(string_split_regex(t, '[.,;:!?\x0A-\x0D]'), 1) as nth
  from docs),
split as (
  select d, lang, nth, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, unnest(generate_series(1, len(w))) as i from split) s, generate_series(1, 5) g(k)
  where i + k - 1 <= len(w)),
counted as (select lang, k, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f) as n from counted where k = 1 group by lang),
frequent as (select lang, k, phrase, string_split(phrase, ' ') as w, f from counted where f >= 100),
cuts as (
  select c.lang, c.phrase, c.w, c.k, c.f as a, l.f as l, r.f as r, t.n, g.j,
         ((1000::hugeint * c.f * t.n) // (l.f::hugeint * r.f)) as score
  from frequent c, generate_series(1, 4) g(j), frequent l, frequent r, totals t
  where c.k >= 2 and g.j < c.k and t.lang = c.lang
    and l.lang = c.lang and l.phrase = array_to_string(c.w[1:g.j], ' ')
    and r.lang = c.lang and r.phrase = array_to_string(c.w[g.j + 1:c.k], ' ')),
lowest as (
  select *, row_number() over (partition by lang, phrase order by score, j) as nth from cuts),
kept as (
  select * from lowest c where nth = 1 and not exists (
    select 1 from frequent b where b.lang = c.lang and b.k > c.k and 100 * b.f >= 100 * c.a
      and position(' ' || c.phrase || ' ' in ' ' || b.phrase || ' ') > 0)),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
       score::bigint as score
from ranked where rank <= 2000
"""

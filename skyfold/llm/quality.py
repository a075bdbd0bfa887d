"""Quality rules (operator 5): a threshold table compiled into one projection.

``RULES`` lists (rule, measure, least, most).  ``quality_rules`` measures
every document with built-in array and string expressions, compares the
measures with the table in the same projection and returns one row per input
row.  There is no shuffle, no join and no user function; the work is linear
in the text (a sort per document for the repeated windows).

Defined results: a null text counts as empty; an empty text has no words, so
it fails the base rules; repeated rows are judged alike, row by row; an empty
table gives an empty result; columns of the input pass through, and the
measures are written to one struct column ``quality`` (an input column of that
name is replaced).  Measures that divide by a count of zero are zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.operators.sequence import materialize

#: Space and 0x09-0x0D separate words.
SPACE = r"[\x09-\x0D\x20]+"

# The characters that the symbol count is about.
SYMBOLS = "#*$%&|<>"

# Frequent words of the four languages of the corpus.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "as", "was", "are",
    "der", "die", "das", "und", "ist", "nicht", "ein", "mit", "zu", "von", "den", "im", "auf", "für",
    "le", "la", "les", "de", "et", "un", "une", "est", "que", "en", "dans", "pour", "du", "des", "qui",
    "el", "los", "las", "por", "del", "con", "una", "es", "se", "y", "no", "para",
)

#: (rule, measure, least, most); None leaves a side open.
RULES = (
    ("length", "n_words", 50, 1_000_000_000),
    ("word_length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("letters", "letter_word_ratio", 0.8, None),
    ("stop_words", "stop_word_ratio", 0.05, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.3),
    ("bullet_lines", "bullet_line_ratio", None, 0.9),
    ("ellipsis_lines", "ellipsis_line_ratio", None, 0.3),
    ("repeated_words", "repeat_word_ratio", None, 0.5),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _hashes(words: Column) -> Column:
    """A hash of every three-word window, in order."""
    return F.transform(
        F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))


def _twice(hashes: Column) -> Column:
    """The hashes that occur twice or more."""
    def neighbours(s: Column) -> Column:
        return F.array_distinct(F.filter(s, lambda x, k: x == F.get(s, k + 1)))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.array().cast("array<bigint>")).otherwise(
        _let(F.sort_array(hashes), neighbours))


def _repeat_words(words: Column, hashes: Column, twice: Column) -> Column:
    """Words covered by a three-word window whose sequence occurs twice or more.

    A window can only be repeated if its hash is.  The windows left (all of
    them where many hashes are) are sorted as text with their positions;
    neighbours that are equal are repeated; each repeated window adds the
    words that the next one does not cover."""
    every = F.sequence(F.lit(0), F.size(hashes) - 1)
    at = (F.when(F.size(twice) == 0, F.array().cast("array<int>"))
          .when(F.size(twice) <= 16, F.filter(every, lambda i: F.array_contains(twice, F.get(hashes, i))))
          .otherwise(every))
    windows = F.transform(at, lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")))

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, k: (x["w"] == F.get(s, k + 1)["w"]) | (x["w"] == F.get(s, k - 1)["w"]))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    return F.when(F.size(twice) == 0, F.lit(0).cast("long")).otherwise(
        _let(_let(F.sort_array(windows), repeated), covered))


def counts(text: Column) -> dict[str, Column]:
    """Count name to an expression over the columns ``_words``, ``_lines``,
    ``_hashes``, ``_twice`` and the text itself.  A stop word counts in lower
    case, capitalised or in upper case."""
    words, lines = F.col("_words"), F.col("_lines")
    forms = [f for w in STOP_WORDS for f in dict.fromkeys((w, w.capitalize(), w.upper()))]
    out = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words, F.col("_hashes"), F.col("_twice")),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*forms))),
        "n_lines": F.size(lines),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x09-\x0D\x20]*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x09-\x0D\x20]*$"))),
    }
    return {k: c.cast("long") for k, c in out.items()}


def ratios() -> dict[str, Column]:
    """Ratio name to an expression over the counts."""
    return {k: _ratio(F.col(a), F.col(b)) for k, a, b in (
        ("mean_word_chars", "word_chars", "n_words"), ("symbol_ratio", "n_symbols", "n_words"),
        ("letter_word_ratio", "n_letter_words", "n_words"), ("stop_word_ratio", "n_stop_words", "n_words"),
        ("repeat_word_ratio", "n_repeat_words", "n_words"), ("dup_line_ratio", "n_dup_lines", "n_lines"),
        ("bullet_line_ratio", "n_bullet_lines", "n_lines"), ("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines"))}


def compile_rules(rules=RULES) -> Column:
    """The names of the rules that the measures break."""
    measure = {**ratios(), **{k: F.col(k) for k in counts(F.lit(""))}}
    broken = []
    for rule, name, least, most in rules:
        bad = F.lit(False)
        if least is not None:
            bad = bad | (measure[name] < F.lit(least))
        if most is not None:
            bad = bad | (measure[name] > F.lit(most))
        broken.append(F.when(bad, F.lit(rule)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def quality_rules(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """Input columns plus ``quality``: a struct of all measures, the list
    ``failed`` of broken rules and the verdict ``kept``."""
    kept = [c for c in docs.columns if c != "quality"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    text = F.col("_text")
    # materialize: each array and count is computed once, not once per use
    rows = materialize(
        rows, _words=F.filter(F.split(text, SPACE), lambda w: w != ""),
        _lines=F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x09-\x0D\x20]")))
    rows = materialize(rows, _hashes=_hashes(F.col("_words")))
    rows = materialize(rows, _twice=_twice(F.col("_hashes")))
    measured = counts(text)
    rows = materialize(rows, **measured)
    return rows.select(
        "_row.*", F.struct(*measured, *[c.alias(k) for k, c in ratios().items()],
                           compile_rules(rules).alias("failed"),
                           (F.size(compile_rules(rules)) == 0).alias("kept")).alias("quality"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    q = quality_rules(docs)
    base = (F.col("quality.n_words") < 50) | (
        F.lit(100) * F.col("quality.n_repeat_words") > F.lit(50) * F.col("quality.n_words"))
    return q.select(
        "doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
        "quality.n_repeat_words", base.alias("base_failed"), (~base & F.col("quality.kept")).alias("kept"),
        F.array_join("quality.failed", ",").alias("failed"))


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_STOP = ", ".join(f"'{f}'" for w in STOP_WORDS for f in dict.fromkeys((w, w.capitalize(), w.upper())))

ORACLE_OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         {_WORDS.format("coalesce(text, '')")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
u AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT r, i FROM u QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter,
         len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis,
         len(l) AS n_lines
  FROM d LEFT JOIN cov USING (r)),
j AS (
  SELECT *, list_filter([
      CASE WHEN n_words < 50 OR n_words > 1000000000 THEN 'length' END,
      CASE WHEN n_words = 0 OR word_chars / n_words < 2 OR word_chars / n_words > 14 THEN 'word_length' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
      CASE WHEN n_words = 0 OR n_letter / n_words < 0.8 THEN 'letters' END,
      CASE WHEN n_words = 0 OR n_stop / n_words < 0.05 THEN 'stop_words' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.3 THEN 'duplicate_lines' END,
      CASE WHEN n_lines > 0 AND n_bullet / n_lines > 0.9 THEN 'bullet_lines' END,
      CASE WHEN n_lines > 0 AND n_ellipsis / n_lines > 0.3 THEN 'ellipsis_lines' END,
      CASE WHEN n_words > 0 AND n_repeat_words / n_words > 0.5 THEN 'repeated_words' END],
      lambda x: x IS NOT NULL) AS f
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       len(f) = 0 AND NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS kept,
       array_to_string(f, ',') AS failed
FROM j
"""

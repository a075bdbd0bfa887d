"""Secret scans with multipart credential linking (operator 2).

Base spans (strong evidence, always reported) come from three patterns:
``assign``, ``access`` and ``hex``.  Weak candidates are parts that alone mean
little: named identifiers (``weak_id``), unlabelled key material
(``weak_secret``) and hosts (``endpoint``).  They are reported only when
complementary parts co-occur: a Spark interval join links identifiers
(``access``, ``weak_id``) with secrets (``assign``, ``hex``, ``weak_secret``)
that lie at most ``scope`` code points apart in one document, and a second one
links endpoints with such pairs.

The interval joins cut a document into cells of ``scope`` code points; a part
is put in the cells it can reach, so the join is an equality on document and
cell with a range condition, and a document with very many parts is spread
over its cells.  Documents are identified by a 128-bit hash of id and text, so
repeated rows and null ids need no special care: parts are made distinct
first, and every row gets its result back.

Patterns run in Arrow tasks, each row by itself; the texts are not shuffled
unless ``redact`` is called.

Defined results: a null or empty text has no spans; repeated rows get equal
results; overlapping spans of different kinds are all reported, but a weak
candidate inside a base span is not; an empty table gives an empty result;
only the id and text columns are read by the scan.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.storage import stored

# Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = KINDS[:3]
#: Parts at most this many code points apart belong to one credential.
SCOPE = 200

# The patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A text without these bytes (letters lowered) has no match.
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

WEAK_ID = re.compile(
    r"""(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|account(?:[_-]?id)?|user(?:[_-]?name)?|login)"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{4,})""", re.IGNORECASE | re.ASCII)
WEAK_ID_HINTS = (b"access", b"client", b"account", b"user", b"login")
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/=_-])")
#: Bits per character from which unlabelled key material is a candidate.
ENTROPY = 3.5
ENDPOINT = re.compile(r"""[a-z][a-z0-9+]*://[^\s"'<>]+|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w.])""", re.ASCII)

_PARTS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * log2(c / n) for c in Counter(s).values())


def _key_material(s: str) -> bool:
    """Mixed letters and digits, with many different characters."""
    return any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and _entropy(s) >= ENTROPY


def base_spans(text: str, low: bytes) -> list[tuple[str, int, int]]:
    out = []
    if any(h in low for h in ASSIGN_HINTS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"akia" in low:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def weak_parts(text: str, low: bytes, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates that no base span overlaps - endpoints: that none covers, so that an
    endpoint which carries its credential stays; none if no link is possible."""
    ids = [s for s in base if s[0] == "access"]
    weak = [("weak_id", *m.span()) for m in WEAK_ID.finditer(text)] if any(h in low for h in WEAK_ID_HINTS) else []
    if not ids and not weak:
        return []
    weak += [("weak_secret", *m.span()) for m in WEAK_SECRET.finditer(text) if _key_material(m[0])]
    if not any(k == "weak_secret" for k, *_ in weak) and len(ids) == len(base):
        return []
    weak += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    out, i = [], 0
    for s in sorted(weak, key=lambda s: s[1]):
        while i < len(base) and base[i][2] <= s[1]:
            i += 1
        near = base[i:i + 4]
        if s[0] == "endpoint":
            hidden = any(b[1] <= s[1] and s[2] <= b[2] for b in near)
        else:
            hidden = any(b[1] < s[2] and s[1] < b[2] for b in near)
        if not hidden:
            out.append(s)
    return out


def document_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that identify a document's id and text."""
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("k1"),
            F.xxhash64(F.lit(1), F.col(text_col), F.col(id_col)).alias("k2")]


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k1, k2, base, weak): spans of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *document_key(id_col, text_col),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                base, weak = [], []
                for text in part.column("_text").to_pylist():
                    low = text.encode("utf-8", "surrogatepass").lower()
                    found = base_spans(text, low)
                    base.append([dict(zip(("kind", "start", "end"), s)) for s in found])
                    weak.append([dict(zip(("kind", "start", "end"), s)) for s in weak_parts(text, low, found)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "k1", "k2")] + [pa.array(base, _PARTS), pa.array(weak, _PARTS)],
                    ["doc_id", "k1", "k2", "base", "weak"])

    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, k1 bigint, k2 bigint, base {spans}, weak {spans}")


def interval_join(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Pairs of parts of one document at most ``scope`` code points apart.
    Both sides have k1, k2 and a struct; the result has ``l`` and ``r``."""
    def cells(side: DataFrame, name: str, reach: int) -> DataFrame:
        first = F.floor(F.greatest(F.col(f"{name}.start") - reach, F.lit(0)) / scope)
        last = F.floor((F.col(f"{name}.end") + reach) / scope)
        return side.select("k1", "k2", name, F.explode(F.sequence(first, last)).alias("cell"))

    both = cells(left, "l", 0).join(cells(right, "r", scope), ["k1", "k2", "cell"])
    near = (F.col("l.start") <= F.col("r.end") + scope) & (F.col("r.start") <= F.col("l.end") + scope)
    return both.where(near).select("k1", "k2", "l", "r").distinct()


def linked_parts(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(k1, k2, part): weak candidates whose complementary parts co-occur."""
    parts = scanned.where(F.size("weak") > 0).select(
        "k1", "k2", F.explode(F.concat("base", "weak")).alias("part")).distinct()
    kind = F.col("part.kind")
    ids = parts.where(kind.isin("access", "weak_id")).withColumnRenamed("part", "l")
    secrets = parts.where(kind.isin("assign", "hex", "weak_secret")).withColumnRenamed("part", "r")
    pairs = interval_join(ids, secrets, scope)
    hull = pairs.select("k1", "k2", F.struct(
        F.least("l.start", "r.start").alias("start"), F.greatest("l.end", "r.end").alias("end")).alias("r")).distinct()
    ends = parts.where(kind == "endpoint").withColumnRenamed("part", "l")
    found = pairs.select("k1", "k2", F.explode(F.array("l", "r")).alias("part")).union(
        interval_join(ends, hull, scope).select("k1", "k2", F.col("l").alias("part")))
    return found.where(~F.col("part.kind").isin(*BASE)).distinct()


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    rank = F.array(*[F.lit(k) for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, k1, k2, base, added): base spans and linked weak candidates of
    every row, as arrays of (kind, start, end)."""
    scanned = stored(_scan(docs, id_col, text_col), "secrets")
    added = linked_parts(scanned, scope).groupBy("k1", "k2").agg(F.collect_list("part").alias("added"))
    return scanned.drop("weak").join(added, ["k1", "k2"], "left").withColumn(
        "added", F.coalesce("added", F.array().cast(scanned.schema["base"].dataType)))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE,
           mark: str = "[SECRET]", kinds: tuple[str, ...] = KINDS[:5]) -> DataFrame:
    """``docs`` with every reported span of ``kinds`` replaced by ``mark``
    (spans that touch or overlap become one mark); other texts are unchanged."""
    spans = find_secrets(docs, id_col, text_col, scope).select("k1", "k2", F.filter(
        F.concat("base", "added"), lambda s: s["kind"].isin(*kinds)).alias("_spans"))
    spans = spans.where(F.size("_spans") > 0).dropDuplicates(["k1", "k2"])
    start = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"))))
    # fold: text so far and the end of the last span
    text = F.col("_text")
    done = F.aggregate(
        start, F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("any")),
        lambda a, s: F.when((s["s"] <= a["at"]) & a["any"], F.struct(
            a["out"].alias("out"), F.greatest(a["at"], s["e"]).alias("at"), F.lit(True).alias("any"))).otherwise(
            F.struct(F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"), (s["s"] - a["at"]).cast("int")),
                              F.lit(mark)).alias("out"), s["e"].alias("at"), F.lit(True).alias("any"))),
        lambda a: F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"))))
    # the row is one struct meanwhile, so that no column of it can clash
    columns = [f"`{c}`" for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("_row"), F.col(text_col).alias("_text"), *document_key(id_col, text_col))
    out = keyed.join(spans, ["k1", "k2"], "left").withColumn(
        "_text", F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(done))
    return out.select(*[F.col("_text").alias(c) if c == text_col else F.col(f"_row.{q}").alias(c)
                        for c, q in zip(docs.columns, columns)])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs)
    kinds = F.transform("base", lambda s: s["kind"])
    return found.select(
        "doc_id", *[(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"))

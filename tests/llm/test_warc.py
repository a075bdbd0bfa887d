"""Operator 8: audits against a direct comparison, and the defined cases."""

import hashlib
import random
from collections import defaultdict

import pytest

from skyfold.llm import warc as M

SCHEMA = "file string, offset long, payload binary, digest string, node long"


def direct(a, b):
    """Offsets of records that differ, compared as multisets."""
    sides = []
    for rows in (a, b):
        at = defaultdict(list)
        for f, o, p in rows:
            at[(f or "", -1 if o is None else o)].append(bytes(p or b""))
        sides.append({k: sorted(v) for k, v in at.items()})
    x, y = sides
    return {(k, "missing" if k not in y else "extra" if k not in x else "changed")
            for k in x.keys() | y.keys() if x.get(k) != y.get(k)}


def frames(spark, *sides):
    return [spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA) for rows in sides]


def check(spark, a, b):
    fa, fb = frames(spark, a, b)
    height = M.tree_height(max([r[1] or 0 for r in a + b], default=0))
    got = M.audit(M.merkle_tree(fa, height), M.merkle_tree(fb, height)).collect()
    assert {((r["file"], r["offset"]), r["status"]) for r in got} == direct(a, b) and len(got) == len(direct(a, b))
    return got


def records(rnd):
    out = []
    for f in ("one", "two", "", None):
        at = 0
        for _ in range(rnd.choice([1, 40, 150])):
            data = rnd.randbytes(rnd.choice([0, 1, 30, 400]))
            out.append((f, at, data))
            at += len(data) + 1
    return out + [("one", None, b"q"), ("two", 5, None), ("two", 5, b"x"), ("two", 5, b"x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_damage(spark, monkeypatch, seed):
    monkeypatch.setattr(M, "RANGE", 256)
    monkeypatch.setattr(M, "FANOUT", 4)
    rnd = random.Random(seed)
    a = records(rnd)
    b = list(a)
    for _ in range(9):
        k = rnd.randrange(len(b))
        f, o, p = b[k]
        b[k:k + 1] = rnd.choice([[], [(f, o, (p or b"") + b"!")], [b[k], b[k]], [(f, (o or 0) + 3, p)]])
    assert check(spark, a, b)
    assert check(spark, a, list(reversed(a))) == []


def test_empty_replicas(spark):
    a = [("f", 0, b"x"), ("f", 70_000, b"y" * 2000)]
    assert {r["status"] for r in check(spark, a, [])} == {"missing"}
    assert {r["status"] for r in check(spark, [], a)} == {"extra"}
    assert check(spark, [], []) == []


def test_descent_reads_differing_branches_only(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE", 64)
    monkeypatch.setattr(M, "FANOUT", 4)
    a = [("f", 16 * i, bytes([i % 251])) for i in range(400)]
    b = [r if r[1] != 16 * 77 else ("f", r[1], b"bad") for r in a]
    height = M.tree_height(16 * 400)
    ta, tb = (M.merkle_tree(f, height) for f in frames(spark, a, b))
    for k, (x, y) in enumerate(zip(ta.levels, tb.levels)):
        bad = M._differing(x, y, ["file", "node"]).collect()
        assert [r["node"] for r in bad] == [16 * 77 // (64 * 4 ** k)]
    assert ta.levels[-1].count() == 1


def test_record_bytes(spark):
    pages = spark.createDataFrame([(1, "http://é/", "<p>ü</p>"), (2, None, None)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in M.warc_records(pages).collect()}
    body = bytes(got[1]["payload"])
    assert body.startswith(b"WARC/1.1\r\n") and body.endswith("<p>ü</p>\r\n\r\n".encode()) and b"Content-Length: 9\r\n" in body
    assert (got[1]["offset"], got[2]["offset"]) == (0, len(body))
    assert hashlib.sha256(body).hexdigest()


def test_files_of_large_missing_and_repeated_page_numbers(spark):
    ids = [25_600_000, 256_000_000, 256_000_001, 7, 7, 7, None, None, None]
    pages = spark.createDataFrame([(i, f"u{k % 4}", "x" * k if i != 7 else "same") for k, i in enumerate(ids)],
                                  "page_id long, url string, html string")
    got = M.warc_records(pages).collect()
    where = {(r["file"], r["offset"]) for r in got if r["page_id"]}
    assert len(where) == 6  # no two numbered records at one place
    assert {r["file"] for r in got if (r["page_id"] or 0) > 7} == {"part-100000.warc", "part-1000000.warc"}
    alone = [r for r in got if r["page_id"] is None]
    assert len({r["file"] for r in alone}) == 3 and all(r["offset"] == 0 for r in alone)


def test_replicas_of_the_query(spark):
    """What the query finds, by page number."""
    ids = [41, 59 * 3 + 2, 54, 61 + 3, 100, None, 256_000_000 + 53 * 41]
    pages = spark.createDataFrame([(i, "u", "y" * 40) for i in ids], "page_id long, url string, html string")
    a, b = M.replicas(pages)
    height = M.tree_height(M.largest_offset(a) + 1)
    got = sorted((r["status"], r["length_a"], r["length_b"]) for r in M.audit(
        M.measured_tree(a, height), M.measured_tree(b, height)).collect())
    flips = sum(1 for i in ids if i is not None and i % 41 == 0)
    tails = sum(1 for i in ids if i is not None and i % 41 and i % 59 == 2)
    lost = sum(1 for i in ids if i is not None and i % 53 == 1)
    foreign = sum(1 for i in ids if i is not None and i % 61 == 3)
    assert [sum(s == k for s, *_ in got) for k in ("changed", "missing", "extra")] == [flips + tails, lost, foreign]
    assert flips and tails and lost and foreign
    assert sum(1 for s, x, y in got if s == "changed" and x - y == 10) == tails

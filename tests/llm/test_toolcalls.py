"""Operator 10: order, validation, canonical JSON and the defined cases."""

import json
import random

from skyfold.llm import toolcalls as C

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, json string"
RESULTS = "conv_id long, call_id string, turn long, content string, extra int"


def run(spark, calls, results=(), numbered=False):
    c = spark.createDataFrame([(*x, "clash") for x in calls], CALLS)
    r = spark.createDataFrame([(*x, 1) for x in results], RESULTS)
    rows = C.link_tool_calls(c, r, C.SCHEMAS).collect()
    if numbered:
        return {(x["conv_id"], x["call_id"], x["nth"]): x for x in rows}
    return {(x["conv_id"], x["call_id"]): x for x in rows if x["nth"] in (None, 1)}


def test_statuses_and_defined_cases(spark):
    good = '{"query": "é\\n\\"x\\"", "limit": 7}'
    calls = [(1, "a", 1, "search", good, []), (1, "b", 3, "search", good, ["a", "zz"]),
             (1, "c", 5, "search", None, ["b"]), (2, "a", 1, "nope", "{}", None), (2, "d", 1, "search", "[1]", []),
             (2, "e", 1, "search", '{"limit": 1.5, "query": 3, "more": null}', []), (None, "a", 1, "search", good, []),
             (3, None, 1, "search", good, []), (4, "x", 1, "search", good, ["y"]), (4, "y", 1, "search", good, ["x"]),
             (4, "z", 1, "search", good, ["y"]), (5, "r", 1, "translate", "{bad", []), (5, "r", 1, "translate", "{bad", []),
             (5, "t", 2, "translate", '{"target":"xx","text":"","formal":1}', []),
             (5, "u", 2, "search", '{"query":"q","limit":99}', []), (5, "v", 2, "search", '{"limit":1,"limit":2}', [])]
    results = [(1, "a", 2, "ok"), (1, "b", 4, None), (1, "q", 4, "orphan"), (1, "a", 9, "later"), (None, "a", 2, "n"),
               (4, "z", 2, "z")]
    got = run(spark, calls, results)
    status = {k: r["status"] for k, r in got.items()}
    assert status == {(1, "a"): "ok", (1, "b"): "ok", (1, "c"): "invalid_arguments", (1, "q"): "orphan_result",
                      (2, "a"): "invalid_arguments", (2, "d"): "invalid_arguments", (2, "e"): "invalid_arguments",
                      (None, "a"): "no_identifier", (3, None): "no_identifier", (4, "x"): "cycle", (4, "y"): "cycle",
                      (4, "z"): "cycle", (5, "r"): "invalid_arguments", (5, "t"): "invalid_arguments",
                      (5, "u"): "invalid_arguments", (5, "v"): "invalid_arguments"}
    assert [got[1, x]["depth"] for x in "abc"] == [0, 1, 2] and got[4, "z"]["depth"] is None
    assert got[1, "q"]["depth"] is None and got[2, "d"]["depth"] == 0
    assert got[1, "b"]["missing_dependencies"] == ["zz"]
    assert (got[1, "a"]["n_calls"], got[1, "a"]["n_results"], got[5, "r"]["n_calls"]) == (1, 1, 2)
    assert got[1, "a"]["json"] == ('{"arguments":{"limit":7,"query":"é\\n\\"x\\""},"id":"a","name":"search",'
                                   '"result":"ok"}')
    errors = {k: r["errors"] for k, r in got.items()}
    assert errors[1, "c"] == errors[5, "r"] == errors[5, "v"] == ["invalid_json"]
    assert errors[2, "a"] == ["unknown_tool"] and errors[2, "d"] == ["not_object"]
    assert errors[2, "e"] == ["type:limit", "type:query", "unknown:more"]
    assert errors[5, "t"] == ["type:formal", "value:target"] and errors[5, "u"] == ["range:limit"]


def test_canonical_json_is_sorted_and_equal_for_equal_values(spark):
    rnd = random.Random(1)
    value = lambda d: rnd.choice([1, "a\t\"", None, True, {}, []]) if d == 0 else {
        rnd.choice("abcdefgh") * rnd.randint(1, 3): value(d - 1) for _ in range(4)}
    values = [value(rnd.randint(1, 3)) for _ in range(40)]
    calls = []
    for i, v in enumerate(values):
        calls.append((i, "a", 1, "search", json.dumps(v, indent=2), []))
        calls.append((i, "b", 1, "search", json.dumps(v, separators=(" ,", ": ")), []))
    got = run(spark, calls)
    for i, v in enumerate(values):
        a, b = (json.loads(got[i, x]["json"])["arguments"] for x in "ab")
        assert a == b == v
        text = json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert f'"arguments":{text},' in got[i, "a"]["json"] and f'"arguments":{text},' in got[i, "b"]["json"]


def test_depth_of_random_graphs(spark):
    rnd = random.Random(4)
    calls, want = [], {}
    for conv in range(8):
        n = rnd.randint(1, 9)
        order = rnd.sample(range(n), n)
        deps = {order[i]: {order[j] for j in range(i) if rnd.random() < 0.4} for i in range(n)}
        if conv >= 6 and n > 1:
            deps[order[0]].add(order[-1])
        depth = {}
        while True:
            new = {k: 1 + max((depth[p] for p in d), default=-1) for k, d in deps.items()
                   if k not in depth and all(p in depth for p in d)}
            if not new:
                break
            depth |= new
        calls += [(conv, str(k), 1, "search", "{}", [str(p) for p in d] * 2) for k, d in deps.items()]
        want |= {(conv, str(k)): depth.get(k) for k in deps}
    assert {k: r["depth"] for k, r in run(spark, calls).items()} == want


def test_empty_tables(spark):
    assert run(spark, []) == {}
    assert {r["status"] for r in run(spark, [], [(1, "a", 1, "x")]).values()} == {"orphan_result"}


def test_reused_identifiers(spark, monkeypatch):
    """``call_0`` in every turn: every call keeps its arguments, result and place."""
    monkeypatch.setattr(C, "CHUNK_TURNS", 4)
    good = '{"query":"q%d","limit":%d}'
    calls = [(1, "call_0", 2 * t, "search", good % (t, t), ["call_0"] if t > 1 else []) for t in range(1, 8)]
    calls += [(1, "end", 99, "search", good % (0, 9), ["call_0", "late"]), (1, "late", 200, "search", good % (0, 9), [])]
    results = [(1, "call_0", 2 * t + 1, f"r{t}") for t in range(1, 7)]
    calls += [(None, "call_0", t, "search", good % (t, t), []) for t in (1, 2)] + [(1, None, 1, "search", "{}", [])]
    c = spark.createDataFrame([(*x, "clash") for x in calls + calls[:1]], CALLS)
    r = spark.createDataFrame([(*x, 1) for x in results], RESULTS)
    rows = C.link_tool_calls(c, r, C.SCHEMAS).collect()
    got = {x["nth"]: x for x in rows if x["call_id"] == "call_0" and x["conv_id"] == 1}
    assert sorted(got) == list(range(1, 8))
    for t in range(1, 8):
        assert (got[t]["turn"], got[t]["depth"], got[t]["n_calls"]) == (2 * t, t - 1, 2 if t == 1 else 1)
        assert got[t]["status"] == ("ok" if t < 7 else "missing_result")
        value = json.loads(got[t]["json"])
        assert value["arguments"] == {"query": f"q{t}", "limit": t} and value["result"] == (f"r{t}" if t < 7 else None)
    other = {x["call_id"]: x for x in rows if x["call_id"] in ("end", "late") and x["conv_id"] == 1}
    assert other["end"]["depth"] == 7 and other["end"]["missing_dependencies"] == [] and other["late"]["depth"] == 0
    alone = [x for x in rows if x["status"] == "no_identifier"]
    assert len(alone) == 3 and sorted(x["turn"] for x in alone) == [1, 1, 2]


def test_long_chains_and_cycles_take_few_rounds(spark, monkeypatch):
    """A chain of 500 calls, one with a merge in the middle, a long cycle, and a long argument."""
    written = []
    stored = C.stored
    monkeypatch.setattr(C, "stored", lambda df, name, *a: written.append(name) or stored(df, name, *a))
    calls = [(1, f"c{i}", i, "search", "{}", [f"c{i - 1}"] if i else []) for i in range(500)]
    calls += [(2, f"c{i}", i, "search", "{}", ([f"c{i - 1}"] if i else []) + (["c3"] if i == 60 else [])) for i in range(100)]
    calls += [(3, f"c{i}", i, "search", "{}", [f"c{(i + 1) % 30}"]) for i in range(30)]
    calls += [(3, "behind", 40, "search", "{}", ["c7"])]
    calls += [(4, "x", 1, "search", json.dumps({"query": "q" * 500_000, "limit": 1}), [])]
    got = run(spark, calls)
    assert all(got[1, f"c{i}"]["depth"] == i for i in range(500))
    assert all(got[2, f"c{i}"]["depth"] == i for i in range(100))
    assert all(got[3, f"c{i}"]["depth"] is None and got[3, f"c{i}"]["status"] == "cycle" for i in range(30))
    assert got[3, "behind"]["status"] == "cycle"
    assert got[4, "x"]["errors"] == [] and len(got[4, "x"]["json"]) > 500_000
    assert len(written) < 25

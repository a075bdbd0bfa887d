"""Chat formatting: linking tool calls (operator 10).

``link_tool_calls`` joins tool calls and results by conversation and call
identifier, orders the calls of a conversation by their dependencies,
validates arguments against schemas and serialises each linked pair as
canonical JSON.  Everything is built-in DataFrame functions.

* An identifier may be used again in a later turn: its calls are numbered by
  turn, so are its results, and the n-th call is linked with the n-th result by a
  hash join on (conversation, identifier, number).  Rows that are equal in every
  field are one, and counted.  Numbers are running sums over chunks of turns, so
  a hot identifier is many tasks.
* A dependency names an identifier; meant is its last call in an earlier turn,
  else its first call.  ``depth`` is the length of the longest dependency chain
  before a call.  Calls with one dependency find the head of their chain by
  pointer doubling, in rounds as the logarithm of its length; what is left are
  calls with several dependencies, settled round by round as soon as all calls
  before them are.  Rounds are written to the shared folder; a conversation is
  never gathered in one task.  (depth, turn, call_id) is the topological order;
  calls on a cycle, or behind one, have no depth.
* Arguments are parsed once into a variant; schemas compile into one
  expression.  Canonical JSON has no blanks, sorted keys at every level and
  shortest numbers.

Defined results: calls or results without a conversation or call identifier
are not linked and have status ``no_identifier``, one row each; a call without result
``missing_result``; a result without call ``orphan_result``; arguments that are
null, not JSON or have a key twice ``invalid_json``; a dependency on an unknown
call is listed in ``missing_dependencies`` and does not delay the call; empty
tables give an empty result; very long arguments are one value, parsed whole;
columns other than the named ones are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.storage import stored
from skyfold.operators.sequence import materialize, previous_values, running_sum
from skyfold.session import shared_path

KEY = ["conv_id", "call_id"]
#: Turns of an identifier that are numbered together.
CHUNK_TURNS = 4096


@dataclass(frozen=True)
class Field:
    """A field of a tool's arguments: ``kind`` is string, integer, number or
    boolean; ``least`` and ``most`` bound numbers; ``among`` lists the values allowed."""

    name: str
    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None
    among: tuple[str, ...] = ()


#: Types of a variant's schema text that each kind allows.
_TYPES = {"string": "^STRING$", "integer": "^BIGINT$|^DECIMAL\\(\\d+,0\\)$",
          "number": "^BIGINT$|^DOUBLE$|^DECIMAL", "boolean": "^BOOLEAN$"}


def _field_errors(value: Column, f: Field) -> list[Column]:
    """Errors of one field; ``value`` is the arguments' variant."""
    path = f"$['{f.name}']"
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    absent = kind.isNull() | (kind == "VOID")
    right = kind.rlike(_TYPES[f.kind])
    out = [F.when(absent, F.lit(f"missing:{f.name}"))] if f.required else []
    out.append(F.when(~absent & ~right, F.lit(f"type:{f.name}")))
    number = F.try_variant_get(value, path, "double")
    if f.least is not None:
        out.append(F.when(right & (number < f.least), F.lit(f"range:{f.name}")))
    if f.most is not None:
        out.append(F.when(right & (number > f.most), F.lit(f"range:{f.name}")))
    if f.among:
        out.append(F.when(right & ~F.try_variant_get(value, path, "string").isin(*f.among), F.lit(f"value:{f.name}")))
    return out


def argument_errors(name: Column, arguments: Column, value: Column, schemas: dict[str, list[Field]]) -> Column:
    """Array of errors, sorted: ``invalid_json``, ``not_object``,
    ``unknown_tool``, or missing, type, range, value and unknown with the field."""
    out = F.array(F.lit("unknown_tool"))
    for tool, fields in schemas.items():
        known = F.array(*[F.lit(f.name) for f in fields]) if fields else F.array().cast("array<string>")
        extra = F.transform(F.array_except(F.json_object_keys(arguments), known), lambda k: F.concat(F.lit("unknown:"), k))
        errors = F.array_compact(F.array(*[e for f in fields for e in _field_errors(value, f)], F.lit(None).cast("string")))
        out = F.when(name == tool, F.array_sort(F.array_distinct(F.concat(errors, extra)))).otherwise(out)
    return (F.when(value.isNull(), F.array(F.lit("invalid_json")))
            .when(~F.schema_of_variant(value).startswith("OBJECT"), F.array(F.lit("not_object"))).otherwise(out))


def chain_heads(single: DataFrame) -> DataFrame:
    """(conv_id, node, head, dist) by pointer doubling over ``single`` (conv_id,
    node, head): where the chain of only predecessors begins and how far back;
    head is null on and behind cycles."""
    jump = stored(single.withColumn("dist", F.lit(1).cast("bigint")), "chain")
    rounds = max(1, jump.count()).bit_length() + 1
    for k in range(rounds):
        ahead = jump.select("conv_id", F.col("node").alias("head"), F.col("head").alias("far"), F.col("dist").alias("more"))
        both = stored(jump.join(ahead, ["conv_id", "head"], "left"), "chain")
        open_ = F.col("far").isNotNull()
        if both.where(open_).isEmpty():
            break
        last = F.lit(k == rounds - 1)  # longer than all nodes: it goes round
        jump = both.select("conv_id", "node", F.when(open_ & last, F.lit(None)).otherwise(
            F.coalesce("far", "head")).alias("head"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"))
    return jump.select("conv_id", "node", "head", "dist")


def topological_depth(edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) for the calls that wait on ``edges`` (conv_id,
    before, after); depth is null on and behind cycles."""
    spark = edges.sparkSession
    edges = stored(edges.select("conv_id", "before", "after").distinct(), "edges")
    count = stored(edges.groupBy("conv_id", "after").agg(F.count("*").alias("n"), F.min("before").alias("one")), "waits")
    heads = stored(chain_heads(count.where("n = 1").select("conv_id", F.col("after").alias("node"), F.col("one").alias("head"))),
                   "heads")
    merges = count.where("n > 1").select("conv_id", "after")
    # a merge point waits for the heads of the chains that lead to it; heads that are none are done
    lead = heads.select("conv_id", F.col("node").alias("before"), "head", "dist", F.lit(True).alias("chained"))
    left = edges.join(merges, ["conv_id", "after"], "left_semi").join(lead, ["conv_id", "before"], "left").select(
        "conv_id", "after", F.when(F.col("chained"), F.col("head")).otherwise(F.col("before")).alias("head"),
        (F.coalesce("dist", F.lit(0)) + 1).alias("w"))
    waits = merges.select("conv_id", F.col("after").alias("head"), F.lit(True).alias("waits"))
    left = stored(left.join(waits, ["conv_id", "head"], "left").select(
        "conv_id", "after", "head", "w", F.when(F.col("head").isNotNull() & F.col("waits").isNull(), F.col("w")).alias("known")),
        "merges")
    path, k = shared_path(spark, f"depths-{uuid.uuid4().hex}"), 0
    done = left.select("conv_id", "after", F.col("known").alias("depth")).limit(0)
    done.write.parquet(f"{path}/round=-1")
    while not left.isEmpty():
        ready = left.groupBy("conv_id", "after").agg(
            F.max("known").alias("depth"), F.count_if(F.col("known").isNull()).alias("open")).where("open = 0").drop("open")
        ready.write.parquet(f"{path}/round={k}")
        ready = spark.read.schema(done.schema).parquet(f"{path}/round={k}")
        if ready.isEmpty():
            break  # only cycles and what they lead to
        settled = ready.select("conv_id", F.col("after").alias("head"), "depth")
        left = stored(left.join(ready, ["conv_id", "after"], "left_anti").join(settled, ["conv_id", "head"], "left").select(
            "conv_id", "after", "head", "w", F.coalesce("known", F.col("w") + F.col("depth")).alias("known")), "merges")
        k += 1
    depths = spark.read.schema(done.schema).parquet(path)
    found = merges.join(depths, ["conv_id", "after"], "left").select("conv_id", F.col("after").alias("call_id"), "depth")
    at = found.select("conv_id", F.col("call_id").alias("head"), F.col("depth").alias("base"), F.lit(True).alias("merge"))
    chained = heads.join(at, ["conv_id", "head"], "left").select(
        "conv_id", F.col("node").alias("call_id"),
        F.when(F.col("head").isNotNull() & F.col("merge").isNull(), F.col("dist")).otherwise(
            F.col("base") + F.col("dist")).alias("depth"))
    return found.union(chained)


def numbered(rows: DataFrame, fields: list[str], count: str) -> DataFrame:
    """Distinct rows of KEY and ``fields`` (the first is the turn) with ``count``
    and ``nth``: their place among the rows of their identifier.  Rows without an
    identifier have no place."""
    alike = rows.groupBy(*KEY, *fields).agg(F.count("*").alias(count))
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    placed = running_sum(alike.where(known), KEY, fields, F.lit(1).cast("bigint"), "nth",
                         chunk=F.floor(F.col(fields[0]) / CHUNK_TURNS))
    return placed.union(alike.where(~known).withColumn("nth", F.lit(None).cast("bigint")))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, list[Field]]) -> DataFrame:
    """One row per call or unlinked result: conv_id, call_id, nth, turn, depth, status,
    errors, missing_dependencies, n_calls, n_results and the canonical ``json``.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), depends_on
    (array of call ids); ``results``: conv_id, call_id, turn, content."""
    asked = stored(numbered(calls.select(*KEY, "turn", "name", "arguments", "depends_on"),
                            ["turn", "name", "arguments", "depends_on"], "n_calls"), "calls")
    given = numbered(results.select(*KEY, "turn", "content"), ["turn", "content"], "n_results")
    one = asked.select(*KEY, "nth", F.struct("turn", "name", "arguments", "depends_on").alias("call"), "n_calls")
    two = given.select(*KEY, "nth", F.struct("turn", "content").alias("result"), "n_results")
    key = [*KEY, "nth"]
    linked = one.where("nth is not null").join(two.where("nth is not null").hint("shuffle_hash"), key, "full_outer")
    both = linked.unionByName(one.where("nth is null"), allowMissingColumns=True).unionByName(
        two.where("nth is null"), allowMissingColumns=True).withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_calls", "n_results")})

    known = asked.where("nth is not null")
    me = F.struct("call_id", "nth")
    wanted = known.select("conv_id", me.alias("after"), "turn", F.explode(F.array_distinct("depends_on")).alias("call_id")
                          ).where("call_id is not null")
    there = known.select(*KEY).distinct()
    # as of the call's turn: asks and calls of an identifier in one sequence, asks first in a turn
    line = known.select(*KEY, "turn", F.lit(1).alias("kind"), "nth").unionByName(
        wanted.join(there, KEY, "left_semi").withColumn("kind", F.lit(0)), allowMissingColumns=True)
    at = previous_values(line, KEY, ["turn", "kind", "nth"], ["nth"], "at_",
                         chunk=F.floor(F.col("turn") / CHUNK_TURNS), ignore_nulls=True)
    edges = at.where("kind = 0").select("conv_id", F.struct(
        "call_id", F.coalesce("at_nth", F.lit(1).cast("bigint")).alias("nth")).alias("before"), "after")
    depth = topological_depth(edges).select("conv_id", "call_id.*", "depth", F.lit(True).alias("linked"))
    missing = wanted.join(there, KEY, "left_anti").groupBy("conv_id", "after").agg(
        F.array_sort(F.collect_set("call_id")).alias("missing_dependencies")).select(
        "conv_id", "after.*", "missing_dependencies")

    rows = both.join(depth, key, "left").join(missing, key, "left")
    rows = materialize(rows, value=F.try_parse_json(F.col("call.arguments")))
    rows = materialize(rows, errors=F.when(F.col("call").isNull(), F.array().cast("array<string>")).otherwise(
        argument_errors(F.col("call.name"), F.col("call.arguments"), F.col("value"), schemas)))
    status = (F.when(F.col("nth").isNull(), "no_identifier")
              .when(F.col("call").isNull(), "orphan_result")
              .when(F.col("linked") & F.col("depth").isNull(), "cycle")
              .when(F.size("errors") > 0, "invalid_arguments")
              .when(F.col("result").isNull(), "missing_result").otherwise("ok"))
    json = F.to_json(F.struct(  # keys in alphabetical order
        F.col("value").alias("arguments"), F.col("call_id").alias("id"), F.col("call.name").alias("name"),
        F.col("result.content").alias("result")), {"ignoreNullFields": "false"})
    return rows.select(
        *key, F.coalesce("call.turn", "result.turn").alias("turn"),
        F.when(F.col("call").isNotNull() & F.col("linked").isNull(), F.lit(0)).otherwise(F.col("depth")).cast("int").alias("depth"),
        status.alias("status"), F.col("errors"),
        F.coalesce("missing_dependencies", F.array().cast("array<string>")).alias("missing_dependencies"),
        "n_calls", "n_results", json.alias("json"))


#: Tools of the query below.
SCHEMAS = {
    "search": [Field("query", "string"), Field("limit", "integer", least=1, most=50)],
    "translate": [Field("text", "string"), Field("target", "string", among=("en", "de", "fr", "es")),
                  Field("formal", "boolean", required=False)],
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a conversation table stands for: every assistant
    turn calls a tool with its text (by the parity of its place), the user turn
    after it is the result, and a call depends on the one two turns before it."""
    call_id = lambda turn: F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), turn)
    n = F.length("text")
    text = F.to_json(F.struct(F.col("text").alias("t")))
    quoted = F.expr("substring(j, 6, length(j) - 6)")  # the text as a JSON string
    rows = turns.where(F.col("text").isNotNull()).withColumn("j", text)
    search = F.concat(F.lit('{"query": '), quoted, F.when(n % 7 == 0, F.lit("")).when(
        n % 5 == 0, F.lit(', "limit": "ten"')).otherwise(F.concat(F.lit(', "limit": '), (n % 60).cast("string"))), F.lit("}"))
    translate = F.concat(F.lit('{ "text" : '), quoted, F.lit(',"target":"'), F.when(n % 4 == 0, "it").otherwise("de"),
                         F.lit('"'), F.when(n % 3 == 0, F.lit(', "formal": true, "x": 1')).otherwise(F.lit("")), F.lit("}"))
    searches = F.col("turn") % 4 == 1
    calls = rows.where(F.col("role") == "assistant").select(
        "conv_id", call_id(F.col("turn")).alias("call_id"), "turn",
        F.when(searches, "search").otherwise("translate").alias("name"),
        F.when(searches, search).otherwise(translate).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(call_id(F.col("turn") - 2))).otherwise(
            F.array().cast("array<string>")).alias("depends_on"))
    results = rows.where(F.col("role") == "user").select(
        "conv_id", call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def op10_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked calls of every conversation of ``conversations``."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    out = link_tool_calls(*conversation_calls(turns), SCHEMAS)
    return out.withColumns({c: F.array_join(c, ",") for c in ("errors", "missing_dependencies")})


ORACLE_OP10 = r"""
WITH m AS (SELECT conv_id, turn, role, text, length(text) AS n, to_json(text)::VARCHAR AS j
           FROM conversations WHERE text IS NOT NULL),
c0 AS (
  SELECT conv_id, 'call_' || conv_id || '_' || turn AS call_id, turn, n, j,
         CASE WHEN turn % 4 = 1 THEN 'search' ELSE 'translate' END AS name,
         CASE WHEN turn >= 2 THEN 'call_' || conv_id || '_' || (turn - 2) END AS before
  FROM m WHERE role = 'assistant'),
c AS (SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, j) AS nth
      FROM (SELECT *, count(*) AS n_calls FROM c0 GROUP BY ALL)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY content) AS nth
  FROM (SELECT conv_id, 'call_' || conv_id || '_' || (turn - 1) AS call_id, turn AS rturn, j AS content, count(*) AS n_results
        FROM m WHERE role = 'user' GROUP BY ALL)),
d AS (
  WITH RECURSIVE last AS (SELECT conv_id, call_id, max(nth) AS nth FROM c GROUP BY ALL),
  w(conv_id, call_id, nth, depth) AS (
    SELECT conv_id, call_id, nth, 0 FROM c
    WHERE before IS NULL OR (conv_id, before) NOT IN (SELECT (conv_id, call_id) FROM c)
    UNION ALL
    SELECT c.conv_id, c.call_id, c.nth, w.depth + 1
    FROM c JOIN w ON c.conv_id = w.conv_id AND c.before = w.call_id
    JOIN last l ON l.conv_id = w.conv_id AND l.call_id = w.call_id AND l.nth = w.nth)
  SELECT * FROM w),
x AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.nth, r.nth) AS nth,
         coalesce(c.turn, r.rturn) AS turn, d.depth, c.name, c.n, c.j, r.content,
         coalesce(c.n_calls, 0) AS n_calls, coalesce(r.n_results, 0) AS n_results,
         CASE WHEN c.before IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM c p WHERE p.conv_id = c.conv_id AND p.call_id = c.before) THEN c.before ELSE '' END AS miss,
         CASE WHEN c.name IS NULL THEN ''
              WHEN c.name = 'search' THEN
                CASE WHEN n % 7 = 0 THEN 'missing:limit' WHEN n % 5 = 0 THEN 'type:limit'
                     WHEN n % 60 < 1 OR n % 60 > 50 THEN 'range:limit' ELSE '' END
              ELSE concat_ws(',', CASE WHEN n % 3 = 0 THEN 'unknown:x' END, CASE WHEN n % 4 = 0 THEN 'value:target' END)
         END AS errors,
         CASE WHEN c.name = 'search' THEN
                '{' || CASE WHEN n % 7 = 0 THEN '' WHEN n % 5 = 0 THEN '"limit":"ten",' ELSE '"limit":' || (n % 60) || ',' END
                || '"query":' || j || '}'
              WHEN c.name = 'translate' THEN
                '{' || CASE WHEN n % 3 = 0 THEN '"formal":true,' ELSE '' END
                || '"target":"' || CASE WHEN n % 4 = 0 THEN 'it' ELSE 'de' END || '","text":' || j
                || CASE WHEN n % 3 = 0 THEN ',"x":1' ELSE '' END || '}'
              ELSE 'null' END AS args
  FROM c FULL JOIN r ON r.conv_id = c.conv_id AND r.call_id = c.call_id AND r.nth = c.nth
  LEFT JOIN d ON d.conv_id = c.conv_id AND d.call_id = c.call_id AND d.nth = c.nth)
SELECT conv_id, call_id, nth, turn, depth::INTEGER AS depth,
       CASE WHEN name IS NULL THEN 'orphan_result' WHEN errors <> '' THEN 'invalid_arguments'
            WHEN content IS NULL THEN 'missing_result' ELSE 'ok' END AS status,
       errors, miss AS missing_dependencies, n_calls, n_results,
       '{"arguments":' || args || ',"id":"' || call_id || '","name":' || coalesce('"' || name || '"', 'null')
       || ',"result":' || coalesce(content, 'null') || '}' AS json
FROM x
"""

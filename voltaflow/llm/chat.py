"""Chat formatting with tool-call linking.

Input is a table of messages: ``conv_id``, ``seq`` (arrival), ``kind`` (call,
result or anything else), ``call_id``, ``name`` (of the tool), ``payload``
(arguments as JSON, or content) and ``after`` (identifiers of calls that must
come first). Output is one row per message, never one per conversation, so a
conversation of any length is spread over the tasks.

* Calls and results are hash-joined by (conversation, identifier). The side that
  may repeat an identifier is never gathered: per identifier only minima and
  counts are kept, from partially aggregated groups.
* Calls are ordered topologically by level, which is one more than the largest
  level of the calls they come after. Runs of calls with one dependency each are
  contracted by pointer doubling (a run of n takes log2 n rounds); then each round
  takes away the calls whose dependencies are all placed, so there are as many rounds
  as the longest chain of calls with several; what is left is in a cycle or behind one. Sorting by
  ``level, seq, call_id`` with results behind their call is the conversation's
  order.
* Arguments are checked against the tool's JSON schema, and every message is
  serialised as canonical JSON: sorted keys, no spaces, shortest numbers.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, cut
from voltaflow.session import scratch_dir

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
_KEY = ["conv_id", "call_id"]


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        return (isinstance(value, (int, float)) and not isinstance(value, bool)
                and (kind == "number" or float(value).is_integer()))
    return isinstance(value, _TYPES[kind])


def problem(value, schema: dict, path: str = "$") -> str | None:
    """The first violation of a schema (type, enum, required, properties,
    additionalProperties, items, lengths and bounds), or None."""
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{path}: not of type {kinds}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{path}: not one of the allowed values"
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if len(value) < schema.get(low, 0) or len(value) > schema.get(high, math.inf):
            return f"{path}: length {len(value)} is out of bounds"
    if _is(value, "number") and not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
        return f"{path}: out of bounds"
    if isinstance(value, list) and "items" in schema:
        return next((p for k, v in enumerate(value) if (p := problem(v, schema["items"], f"{path}[{k}]"))), None)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{path}.{name}: missing"
        for name, v in value.items():
            if name in known:
                if p := problem(v, known[name], f"{path}.{name}"):
                    return p
            elif schema.get("additionalProperties", True) is False:
                return f"{path}.{name}: not allowed"
    return None


def _plain(value):
    """Keys sorted by UTF-16 units; whole floats as integers."""
    if isinstance(value, dict):
        return {k: _plain(value[k]) for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, float) and value.is_integer() and abs(value) < 2 ** 53:
        return int(value)
    return value


def canonical(value) -> str:
    return json.dumps(_plain(value), separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _pairs(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a key occurs twice")
    return out


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


def message(kind: str | None, call_id: str | None, name: str | None, payload: str | None,
            schemas: dict[str, dict]) -> tuple[str, str | None]:
    """Canonical JSON of a message, and what is wrong with a call."""
    if kind == "result":
        return canonical({"role": "tool", "tool_call_id": call_id, "content": payload}), None
    if kind != "call":
        return canonical({"role": kind, "content": payload}), None
    arguments, wrong = payload, None
    try:
        value = json.loads(payload or "", object_pairs_hook=_pairs, parse_constant=_refuse)
        arguments = canonical(value)
        wrong = f"no tool {name}" if name not in schemas else problem(value, schemas[name])
    except (ValueError, RecursionError, OverflowError) as e:
        wrong = f"not JSON: {type(e).__name__}"
    return canonical({"role": "assistant", "tool_calls": [
        {"id": call_id, "type": "function", "function": {"name": name, "arguments": arguments}}]}), wrong


def _heads(single: DataFrame) -> DataFrame:
    """``conv_id, call_id, head, steps`` of calls with one dependency each: the first
    call up the chain that has none or several, and how many steps it is away. Every
    round doubles the steps, so a chain of n calls takes log2(n) rounds; calls in
    a cycle of such calls, or behind one, never get out of it and have no row."""
    up = cut(single.select(*_KEY, F.col("dep").alias("head"), F.lit(1).cast("long").alias("steps")))
    n = up.count()
    for _ in range(n.bit_length() + 1):
        on = up.select("conv_id", F.col("call_id").alias("head"), F.col("head").alias("_next"), F.col("steps").alias("_more"))
        far = up.join(on, ["conv_id", "head"], "left")
        if far.where("_next is not null").isEmpty():
            return up
        up = cut(far.select(*_KEY, F.coalesce("_next", "head").alias("head"),
                            (F.col("steps") + F.coalesce("_more", F.lit(0))).alias("steps")))
    return up.join(up.select("conv_id", F.col("call_id").alias("head")), ["conv_id", "head"], "left_anti").select(*_KEY, "head", "steps")


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of the calls ``(conv_id, call_id, after)``,
    whose keys are unique; calls in a cycle or behind one have no row.

    Runs of calls with a single dependency are contracted first (``_heads``); the
    rounds then go over calls with several, so there are as many as the longest chain
    of these. Each round writes what it has placed to one table.
    """
    spark = calls.sparkSession
    calls = calls.select(*_KEY, "after")
    edges = cut(calls.select(*_KEY, F.explode(F.array_distinct("after")).alias("dep"))
                .join(calls.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"]))
    single = cut(edges.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min("dep").alias("dep")).where("n = 1").drop("n"))
    heads = cut(_heads(single))
    above = heads.select("conv_id", F.col("call_id").alias("dep"), "head", "steps")
    # a dependency counts as its head, so many steps further up; behind a cycle it stays itself, which is never placed
    several = (edges.join(single.select(*_KEY), _KEY, "left_anti").join(above, ["conv_id", "dep"], "left")
               .select(*_KEY, F.coalesce("head", "dep").alias("dep"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"))
               .groupBy(*_KEY, "dep").agg(F.max("steps").alias("steps")))
    several = cut(several)
    folder = scratch_dir(spark, "levels")
    roots = calls.select(*_KEY).join(edges.select(*_KEY).distinct(), _KEY, "left_anti").withColumn("level", F.lit(0).cast("long"))
    schema = roots.schema
    reached = cut(spark.createDataFrame([], schema))  # largest level so far of calls that still wait
    placed, n = roots, 0
    while True:
        placed.write.parquet(f"{folder}/round={n}")
        placed = spark.read.schema(schema).parquet(f"{folder}/round={n}")
        if placed.isEmpty():
            break
        done = placed.select("conv_id", F.col("call_id").alias("dep"), "level")
        lifted = several.join(done, ["conv_id", "dep"]).select(*_KEY, (F.col("level") + F.col("steps")).alias("level"))
        several = cut(several.join(done, ["conv_id", "dep"], "left_anti"))
        reached = cut(reached.unionByName(lifted).groupBy(*_KEY).agg(F.max("level").alias("level")))
        waiting = several.select(*_KEY).distinct()
        placed, reached, n = reached.join(waiting, _KEY, "left_anti"), reached.join(waiting, _KEY, "left_semi"), n + 1
    out = spark.read.schema(f"{ddl_of(schema)}, round int").parquet(folder).drop("round")
    top = out.select("conv_id", F.col("call_id").alias("head"), "level")
    below = heads.join(top, ["conv_id", "head"]).select(*_KEY, (F.col("level") + F.col("steps")).alias("level"))
    return out.unionByName(below).withColumn("level", F.col("level").cast("int"))


def ddl_of(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message: ``conv_id, seq, kind, call_id, level, status, error,
    message`` (canonical JSON).

    Status of a call: ``no_id``, ``duplicate_call`` (not the first of its
    identifier; equal rows count as one call), ``cycle``, ``missing_dependency``,
    ``invalid`` (see ``error``), ``unanswered`` or ``ok``. Of a result: ``no_id``,
    ``orphan``, ``before_call``, ``extra_result`` (not the first) or ``ok``. Of
    other messages: ``plain``. Null keys never link; a null payload is invalid
    for a call and null content else. Other columns are not read.
    """
    bounded_batches()

    @F.pandas_udf("struct<message: string, error: string>")
    def serialised(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            rows = zip(*(c.astype(object).where(c.notna(), None) for c in columns))
            yield pd.DataFrame([message(*r, schemas) for r in rows], columns=["message", "error"])

    rows = messages.select("conv_id", "seq", "kind", "call_id", "name", "payload",
                           F.coalesce("after", F.array().cast("array<string>")).alias("after"))
    order = F.struct("seq", F.xxhash64("name", "payload").alias("hash"), "after")
    linked = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls = cut(rows.where(linked & (F.col("kind") == "call")).groupBy(*_KEY).agg(F.min(order).alias("first"))
                .select(*_KEY, F.col("first.seq").alias("call_seq"), F.col("first.hash").alias("call_hash"),
                        F.col("first.after").alias("call_after")))
    answers = (rows.where(linked & (F.col("kind") == "result")).join(calls.select(*_KEY, "call_seq"), _KEY)
               .where(F.coalesce(F.col("seq") >= F.col("call_seq"), F.lit(True))).groupBy(*_KEY)
               .agg(F.min(F.struct("seq", F.xxhash64("name", "payload").alias("hash"))).alias("answer")))
    after = calls.select(*_KEY, F.explode("call_after").alias("dep"))
    missing = (after.join(calls.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_anti")
               .select(*_KEY).distinct().withColumn("missing", F.lit(True)))
    known = (calls.drop("call_after").join(levels(calls.withColumnRenamed("call_after", "after")), _KEY, "left")
             .join(missing, _KEY, "left").join(answers, _KEY, "left").withColumn("known", F.lit(True)))
    hash_ = F.xxhash64("name", "payload")
    of_call = (F.when(~linked, "no_id")
               .when(~(F.col("seq").eqNullSafe(F.col("call_seq")) & (hash_ == F.col("call_hash"))), "duplicate_call")
               .when(F.col("level").isNull(), "cycle").when(F.col("missing"), "missing_dependency")
               .when(F.col("s.error").isNotNull(), "invalid").when(F.col("answer").isNull(), "unanswered").otherwise("ok"))
    of_result = (F.when(~linked, "no_id").when(F.col("known").isNull(), "orphan")
                 .when(F.col("seq") < F.col("call_seq"), "before_call")
                 .when(~(F.col("seq").eqNullSafe(F.col("answer.seq")) & (hash_ == F.col("answer.hash"))), "extra_result")
                 .otherwise("ok"))
    status = F.when(F.col("kind") == "call", of_call).when(F.col("kind") == "result", of_result).otherwise("plain")
    return (rows.drop("after").withColumn("s", serialised("kind", "call_id", "name", "payload")).join(known, _KEY, "left")
            .select("conv_id", "seq", "kind", "call_id", "level", status.alias("status"), F.col("s.error").alias("error"),
                    F.col("s.message").alias("message")))


#: Tools of the messages that ``from_turns`` derives.
TOOLS = {
    "ask": {"type": "object", "required": ["text", "words"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1},
        "turn": {"type": "integer", "minimum": 0}}},
    "follow_up": {"type": "object", "required": ["text", "words", "turn"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 3},
        "turn": {"type": "integer", "minimum": 1}}},
}


def from_turns(turns: DataFrame) -> DataFrame:
    """Messages derived from ``(conv_id, turn, role, text)``: a user turn is a
    call (its arguments hold text, word count and turn, keys unsorted), the turn
    of an assistant is the result of the call one turn before, and other roles
    are plain. A call comes after the call at half its turn, if that was a user's.
    A null text is an empty one in a call and null content else; turns that occur
    twice give messages of one identifier, a null or negative turn is after nothing."""
    call, result = F.col("role") == "user", F.col("role") == "assistant"
    turn = F.col("turn")
    ident = lambda t: F.concat_ws("-", F.lit("call"), t.cast("string"))
    half = F.floor(turn / 2)
    calls = turns.where(call & (turn > 0)).select("conv_id", half.alias("turn")).distinct()
    mine = turns.where(call).select("conv_id", "turn").distinct()
    parents = calls.join(mine, ["conv_id", "turn"], "left_semi").withColumnRenamed("turn", "half").withColumn("parent", F.lit(True))
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != ""))
    payload = F.to_json(F.struct(words.alias("words"), "turn", F.coalesce("text", F.lit("")).alias("text")))
    rows = turns.select("conv_id", "turn", "role", "text", half.alias("half")).join(parents, ["conv_id", "half"], "left")
    return rows.select(
        "conv_id", turn.alias("seq"), F.when(call, "call").when(result, "result").otherwise(F.col("role")).alias("kind"),
        F.when(call & turn.isNotNull(), ident(turn)).when(result & turn.isNotNull(), ident(turn - 1)).alias("call_id"),
        F.when(call, F.when(turn > 0, "follow_up").otherwise("ask")).alias("name"),
        F.when(call, payload).otherwise(F.col("text")).alias("payload"),
        F.when(call & F.col("parent") & (F.col("half") < turn), F.array(ident(F.col("half")))).alias("after"))

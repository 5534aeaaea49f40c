"""Chat formatting with linked tool calls: one row per message, call and result, in an order that respects the links.

What messages hold, as JSON objects in their text:

calls    ``{"content": ..., "tool_calls": [{"id", "name", "arguments"}, ...]}``, arguments an object or JSON text of one
results  ``{"tool_call_id": ..., "content": ...}``
tools    ``{"tools": [{"name", "parameters": {"required": [...], "properties": {key: {"type": ...}}}}, ...]}``

Any other text is a plain message.  Results are hash-joined with calls by conversation and identifier, one row per key on
the call's side, so a common identifier never multiplies rows.  Order is topological: a message or call stands at its
turn, a result at its turn or directly behind its call, whichever is later; ``at``, ``step``, ``turn`` and ``place`` sort a
conversation, and need no window over it, so a conversation of any size is many small rows.  Arguments are checked against
the tool's schema (required keys, JSON types).  Canonical JSON has sorted keys and no spaces.

Results: null text and null role are kept as nulls; a repeated identifier links to its first call (by turn, then place);
later calls with it are ``repeated``; a result without a call is an ``orphan``, a call without a result is ``open``;
repeated rows and ties stay as they are; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALLS = "array<struct<id:string,name:string,arguments:variant>>"
TOOLS = "array<struct<name:string,parameters:struct<required:array<string>,properties:map<string,struct<type:string>>>>>"
ENVELOPE = f"struct<content:variant,tool_call_id:string,tool_calls:{CALLS},tools:{TOOLS}>"

#: JSON types by the start of their variant type's name (fixed values).
_TYPES = (("string", "STRING"), ("integer", "BIGINT"), ("number", "BIGINT"), ("number", "DECIMAL"), ("number", "DOUBLE"),
          ("boolean", "BOOLEAN"), ("object", "OBJECT"), ("array", "ARRAY"), ("null", "VOID"))


def _plain(value: Column) -> Column:
    """A variant as text: strings without quotes, everything else as canonical JSON."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(F.schema_of_variant(value) == "STRING", text).otherwise(F.to_json(value))


def _object(value: Column) -> Column:
    """Arguments as a variant; JSON text of an object is read as that object."""
    inner = F.when(F.schema_of_variant(value) == "STRING", F.try_parse_json(F.try_variant_get(value, "$", "string")))
    return F.coalesce(inner, value)


def _is(kind: Column, wanted: Column) -> Column:
    found = F.lit(False)
    for name, start in _TYPES:
        found = found | ((wanted == name) & kind.startswith(start))
    return found


def _faults(arguments: Column, required: Column, properties: Column) -> Column:
    """Sorted texts: what the arguments lack, and keys whose value is of another type."""
    given = F.from_json(arguments, "map<string,variant>")
    keys = F.coalesce(F.map_keys(given), F.array().cast("array<string>"))
    missing = F.transform(F.array_except(F.coalesce(required, F.array().cast("array<string>")), keys), lambda k: F.concat(F.lit("missing "), k))
    known = F.coalesce(F.map_entries(properties), F.array().cast("array<struct<key:string,value:struct<type:string>>>"))
    wanted = F.filter(known, lambda p: F.array_contains(keys, p["key"]) & p["value"]["type"].isNotNull())
    wrong = F.filter(wanted, lambda p: ~F.coalesce(_is(F.schema_of_variant(F.element_at(given, p["key"])), p["value"]["type"]), F.lit(False)))
    return F.sort_array(F.concat(missing, F.transform(wrong, lambda p: F.concat(F.lit("type "), p["key"]))))


def events(messages: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages, calls, results and tool declarations as rows (kind, place within the message, ...)."""
    rows = messages.select(F.col(id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).cast("string").alias("text"))
    is_object = F.coalesce(F.ltrim("text").startswith("{"), F.lit(False)) & F.try_parse_json("text").isNotNull()
    rows = rows.withColumn("e", F.when(is_object, F.from_json("text", ENVELOPE)))
    calls = F.coalesce(F.col("e.tool_calls"), F.array().cast(CALLS))
    none = F.lit(None).cast("string")

    def event(kind: str, place: Column, call_id: Column = none, name: Column = none, body: Column = none, tool: Column | None = None) -> Column:
        tool = F.lit(None).cast(TOOLS[6:-1]) if tool is None else tool
        return F.struct(F.lit(kind).alias("kind"), place.cast("int").alias("place"), call_id.alias("call_id"), name.alias("name"), body.alias("body"), tool.alias("tool"))

    content = _plain(F.col("e.content"))
    special = F.col("e").isNotNull() & (F.col("e.tool_call_id").isNotNull() | (F.size(calls) > 0) | F.col("e.tools").isNotNull())
    said = F.when(~special, F.array(event("message", F.lit(0), body=F.col("text")))).when(F.col("e.tool_call_id").isNull() & F.col("e.content").isNotNull(), F.array(event("message", F.lit(0), body=content)))
    result = F.when(F.col("e.tool_call_id").isNotNull(), F.array(event("result", F.lit(0), call_id=F.col("e.tool_call_id"), body=content)))
    made = F.transform(calls, lambda c, k: event("call", k + 1, c["id"], c["name"], F.to_json(_object(c["arguments"]))))
    tools = F.transform(F.coalesce(F.col("e.tools"), F.array().cast(TOOLS)), lambda t, k: event("tool", k + 1, name=t["name"], tool=t))
    empty = F.array().cast("array<struct<kind:string,place:int,call_id:string,name:string,body:string,tool:" + TOOLS[6:-1] + ">>")
    every = F.concat(F.coalesce(said, empty), F.coalesce(result, empty), made, tools)
    return rows.select("conv_id", "turn", "role", F.explode(every).alias("v")).select("conv_id", "turn", "role", "v.*")


def formatted(messages: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, at, step, turn, place, role, kind, call_id, name, status, faults, json): see the module's text."""
    every = events(messages, id, turn, role, text)
    calls = every.where("kind = 'call' AND call_id IS NOT NULL")
    first = calls.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "place", "name")).alias("first"))
    answered = every.where("kind = 'result'").groupBy("conv_id", "call_id").agg(F.min("turn").alias("answer_turn"))
    tools = every.where("kind = 'tool' AND name IS NOT NULL").groupBy("conv_id", "name").agg(F.min_by(F.struct("tool.parameters"), F.struct("turn", "place")).alias("schema"))

    rows = every.where("kind <> 'tool'")
    linked = rows.where("kind <> 'message'").join(first, ["conv_id", "call_id"], "left").join(answered, ["conv_id", "call_id"], "left").join(tools, ["conv_id", "name"], "left")
    own = (F.col("first.turn") == F.col("turn")) & (F.col("first.place") == F.col("place"))
    status = (
        F.when((F.col("kind") == "result") & F.col("first").isNull(), "orphan")
        .when(F.col("kind") == "result", "linked")
        .when(F.col("call_id").isNull(), "unnamed")
        .when(~own, "repeated")
        .when(F.col("answer_turn").isNull(), "open")
        .otherwise("linked")
    )
    checked = _faults(F.col("body"), F.col("schema.parameters.required"), F.col("schema.parameters.properties"))
    faults = F.when(F.col("kind") != "call", None).when(~F.coalesce(F.col("body").startswith("{"), F.lit(False)), F.array(F.lit("no object"))).when(F.col("schema").isNull(), F.array(F.lit("no schema"))).otherwise(checked)
    late = (F.col("kind") == "result") & F.col("first").isNotNull() & (F.col("first.turn") >= F.col("turn"))
    linked = linked.select(
        "conv_id", F.when(late, F.col("first.turn")).otherwise(F.col("turn")).alias("at"),
        F.when(late, F.col("first.place") * 2 + 1).otherwise(F.col("place") * 2).alias("step"),
        "turn", "place", "role", "kind", "call_id", F.when(F.col("kind") == "result", F.col("first.name")).otherwise(F.col("name")).alias("name"),
        status.alias("status"), F.array_join(faults, "; ").alias("faults"), "body",
    )
    none = F.lit(None).cast("string")
    plain = rows.where("kind = 'message'").select("conv_id", F.col("turn").alias("at"), F.lit(0).alias("step"), "turn", "place", "role", "kind", none.alias("call_id"), none.alias("name"), none.alias("status"), none.alias("faults"), "body")
    return plain.unionByName(linked).withColumn("json", canonical()).drop("body")


def canonical() -> Column:
    """The row as JSON with sorted keys: arguments as the object they are, everything else as text."""
    arguments = F.when((F.col("kind") == "call") & F.col("body").isNotNull(), F.try_parse_json("body"))
    content = F.when(F.col("kind") != "call", F.col("body"))
    return F.to_json(F.struct(arguments.alias("arguments"), content.alias("content"), F.col("kind"), F.col("name"), F.col("role"), F.col("call_id").alias("tool_call_id"), F.col("turn")))

"""Chat formatting: link tool calls with results, order them, check arguments, write canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import discard, stored

#: Argument schemas by tool, in JSON Schema's terms: type, properties, required, items, enum, additionalProperties.
SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False, "properties": {
        "query": {"type": "string"}, "limit": {"type": "integer"},
        "options": {"type": "object", "required": ["order"], "properties": {"order": {"type": "string", "enum": ["new", "old"]}, "fields": {"type": "array", "items": {"type": "string"}}}},
    }},
    "count": {"type": "object", "required": ["text"], "additionalProperties": False, "properties": {"text": {"type": "string"}, "unit": {"type": "string"}}},
    "quote": {"type": "object", "required": ["text", "width"], "properties": {"text": {"type": "string"}, "width": {"type": "integer"}}},
}

_TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$", "object": "^OBJECT.*", "array": "^ARRAY.*", "null": "^VOID$"}
_NONE = "array<string>"


def _code(kind: str, path: str) -> Column:
    return F.array(F.lit(f"{kind}:{path}" if path else f"{kind}"))


def _check(value: Column, schema: dict, path: str) -> Column:
    """Codes of what is wrong with a variant that is there: ``type``, ``enum``, ``missing``, ``unknown`` and the path.

    A JSON null is a value of type "null". Members of objects and items of arrays are checked
    by their own schemas (array items share one path, ``name[]``); a value of the wrong type is not looked into.
    """
    kind = F.schema_of_variant(value)
    none = F.lit(None).cast(_NONE)
    parts = []
    if "enum" in schema:
        allowed = [F.to_json(F.lit(x)) if isinstance(x, dict | list) else F.lit(str(x).lower() if isinstance(x, bool) else str(x)) for x in schema["enum"]]
        parts.append(F.when(~F.coalesce(F.try_variant_get(value, "$", "string").isin(*allowed), F.lit(False)), _code("enum", path)))
    members = schema.get("properties", {})
    under = f"{path}." if path else ""
    for name, inner in members.items():
        part = F.try_variant_get(value, f"$['{name}']", "variant")
        missing = _code("missing", under + name) if name in schema.get("required", ()) else none
        parts.append(F.when(part.isNull(), missing).otherwise(_check(part, inner, under + name)))
    parts += [F.when(F.try_variant_get(value, f"$['{name}']", "variant").isNull(), _code("missing", under + name)) for name in schema.get("required", ()) if name not in members]
    if schema.get("additionalProperties") is False:
        names = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        strange = F.filter(names, lambda k: ~k.isin(*members)) if members else names
        parts.append(F.transform(strange, lambda k: F.concat(F.lit(f"unknown:{under}"), k)))
    if "items" in schema:
        items = F.try_variant_get(value, "$", "array<variant>")
        parts.append(F.array_distinct(F.flatten(F.transform(items, lambda x: _check(x, schema["items"], f"{path}[]")))))
    found = [F.coalesce(x, F.array().cast(_NONE)) for x in parts]
    inside = F.concat(*found) if found else F.array().cast(_NONE)
    wanted = schema.get("type")
    if wanted is None:
        return inside
    kinds = [wanted] if isinstance(wanted, str) else list(wanted)
    right = F.coalesce(kind.rlike("|".join(_TYPES[k] for k in kinds)), F.lit(False))
    return F.when(right, inside).otherwise(_code("type", path))


def _errors(schemas: dict) -> Column:
    """Sorted codes of what is wrong with the arguments ``v`` (a variant) of the tool ``name``."""
    known = F.lit(None).cast(_NONE)
    for name in sorted(schemas, reverse=True):
        known = F.when(F.col("name") == name, _check(F.col("v"), schemas[name], "")).otherwise(known)
    shape = F.when(F.col("v").isNull() | ~F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)), F.array(F.lit("not_an_object")))
    return F.array_sort(F.coalesce(shape, known, F.array(F.lit("unknown_tool"))))


def _depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth): the longest chain of calls that a call builds on; -1 in or above a cycle.

    Calls with one parent form chains, which pointer doubling shortens: after k rounds a pointer
    spans 2**k steps, so a chain of n calls takes log2(n) rounds of one equi-join each; pointers still
    set when 2**k exceeds the number of calls are in cycles. What is left is a graph of the calls with
    several parents alone; its rounds (one join and one grouped count each) settle all calls whose
    parents are settled, as many rounds as such calls follow one another.
    """
    total = calls.count()
    known = calls.select(F.col("call_id").alias("parent"))
    edges = stored(calls.select("call_id", F.explode(F.array_distinct("after")).alias("parent")).join(known, "parent", "left_semi"), "call-edges")
    counts = edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("only"))
    ptr = calls.select("call_id").join(counts, "call_id", "left")
    single = F.col("n") == 1
    ptr = stored(ptr.select("call_id", F.coalesce("n", F.lit(0)).alias("n"), F.when(single, F.col("only")).alias("ptr"), F.when(single, F.col("only")).otherwise(F.col("call_id")).alias("top"), F.when(single, 1).otherwise(0).cast("long").alias("steps")), "call-pointers")
    span = 1
    while ptr.where("ptr IS NOT NULL").limit(1).count() and span <= total:
        moving, still = ptr.where("ptr IS NOT NULL"), ptr.where("ptr IS NULL")
        up = ptr.select(F.col("call_id").alias("ptr"), F.col("ptr").alias("_next"), F.col("top").alias("_top"), F.col("steps").alias("_more"))
        step = moving.join(up, "ptr").select("call_id", "n", F.col("_next").alias("ptr"), F.col("_top").alias("top"), (F.col("steps") + F.col("_more")).alias("steps"))
        old, ptr, span = ptr, stored(still.unionByName(step), "call-pointers"), span * 2
        discard(old)
    ended = ptr.where("ptr IS NULL")  # a pointer still set is in or above a cycle
    several = ended.where("n > 1").select("call_id", F.col("n").alias("parents"))
    settled = stored(ended.where("n = 0").select("call_id", F.lit(0).cast("long").alias("depth")), "call-depths")
    if several.limit(1).count():
        over = edges.join(several, "call_id").join(ended.select(F.col("call_id").alias("parent"), "top", (F.col("steps") + 1).alias("far")), "parent")
        over = stored(over.select("call_id", "parents", "top", "far"), "call-edges")
        while True:
            open_ = over.join(settled.select("call_id"), "call_id", "left_anti")
            reached = open_.join(settled.select(F.col("call_id").alias("top"), "depth"), "top")
            new = stored(reached.groupBy("call_id", "parents").agg(F.count(F.lit(1)).alias("met"), F.max(F.col("depth") + F.col("far")).alias("depth")).where("met = parents").select("call_id", "depth"), "call-depths")
            if not new.limit(1).count():
                discard(new)
                break
            old, settled = settled, stored(settled.unionByName(new), "call-depths")
            discard(old)
            discard(new)
        discard(over)
    depths = settled.select(F.col("call_id").alias("top"), "depth")
    out = ptr.join(depths, "top", "left").select("call_id", F.when(F.col("ptr").isNull() & F.col("depth").isNotNull(), F.col("depth") + F.col("steps")).otherwise(-1).alias("depth"))
    out = stored(out, "call-depths")
    for used in (ptr, settled, edges):
        discard(used)
    return out


def _firsts(df: DataFrame, *order: str) -> DataFrame:
    """Of rows that repeat a call_id the first, with ``n_repeats``; a grouped minimum, so copies meet on the map side."""
    rest = [c for c in df.columns if c != "call_id"]
    least = df.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("x"), (F.count(F.lit(1)) - 1).alias("n_repeats"))
    return least.select("call_id", *[F.col(f"x.{c}").alias(c) for c in rest], "n_repeats")


def _positions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``position``: from 1 within a conversation, in topological order.

    Rows are sorted by range over all keys, numbered within their partition, and moved by the rows
    of the conversation in partitions before: one row per conversation and partition is summed, so a
    conversation of any size is spread over many tasks.
    """
    keys = [F.when(F.col("is_call"), 0).otherwise(1), F.when(F.col("depth") < 0, 1).otherwise(0), F.col("depth"), F.col("turn"), F.col("call_id"), F.col("result_turn"), F.col("name"), F.col("arguments")]
    ranged = stored(rows.repartitionByRange(F.col("conv_id"), *keys).withColumn("_p", F.spark_partition_id()), "call-order")
    per = ranged.groupBy("conv_id", "_p").agg(F.count(F.lit(1)).alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = per.select(F.col("conv_id").alias("_c"), F.col("_p").alias("_q"), ahead.alias("_before"))
    local = F.row_number().over(Window.partitionBy("_p", "conv_id").orderBy(*keys))
    counted = ranged.withColumn("_local", local)
    met = counted.join(before, (F.col("_p") == F.col("_q")) & F.col("conv_id").eqNullSafe(F.col("_c")))
    return met.withColumn("position", (F.col("_local") + F.col("_before")).cast("long")).drop("_p", "_q", "_c", "_local", "_before")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict | None = None) -> DataFrame:
    """One row per call, and one per result without a call.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (ids of the calls it
    builds on: an array, or one id, or null). ``results``: conv_id, turn, call_id, content. Other columns are ignored.

    Calls and results meet by a hash join on the identifier. Of calls or results that repeat
    an identifier the one of the earliest (conv_id, turn, text) counts and ``n_repeats`` tells
    how many more there were; a null identifier links with nothing and gives a row per call.
    Calls are ordered topologically: ``depth`` is the length of the longest chain of ``after`` links
    (-1 for calls in or above a cycle, which come last), ``position`` counts from 1 within a conversation by
    depth, turn and identifier. An id in ``after`` that names no call counts for nothing. ``status`` is the
    first that holds of: orphan_result, cycle, invalid, no_result, ok. ``message`` is canonical
    JSON: keys in order of code points, no white space, null members left out. Empty tables give no rows.
    """
    after = F.col("after") if calls.schema["after"].dataType.typeName() == "array" else F.when(F.col("after").isNotNull(), F.array("after"))
    base = calls.select("conv_id", "turn", "call_id", "name", "arguments", F.filter(F.coalesce(after, F.array().cast("array<string>")), lambda x: x.isNotNull()).alias("after"))
    named = stored(_firsts(base, "conv_id", "turn", "name", "arguments"), "calls")
    nameless = base.where("call_id IS NULL").withColumn("n_repeats", F.lit(0).cast("long"))
    answers = _firsts(results.select("conv_id", "turn", "call_id", "content"), "conv_id", "turn", "content")
    answers = answers.select("call_id", F.col("conv_id").alias("r_conv"), F.col("turn").alias("result_turn"), "content", F.col("n_repeats").alias("r_repeats"))
    placed = named.join(_depths(named), "call_id").unionByName(nameless.withColumn("depth", F.lit(0).cast("long")))
    met = placed.withColumn("_call", F.lit(True)).hint("shuffle_hash").join(answers, "call_id", "full_outer")
    met = _positions(met.withColumns({"is_call": F.coalesce("_call", F.lit(False)), "conv_id": F.coalesce("conv_id", "r_conv")}).drop("_call", "r_conv", "after"))
    met = met.withColumn("v", F.expr("try_parse_json(arguments)")).withColumn("errors", F.when(F.col("is_call"), _errors(schemas or SCHEMAS)))
    answered = F.col("result_turn").isNotNull() | F.col("content").isNotNull()
    status = F.when(~F.col("is_call"), "orphan_result").when(F.col("depth") < 0, "cycle").when(F.size("errors") > 0, "invalid").when(~answered, "no_result").otherwise("ok")
    body = F.to_json(F.struct(F.col("v").alias("arguments"), "call_id", "content", "name"))
    return met.select(
        "conv_id",
        "turn",
        "call_id",
        "name",
        "result_turn",
        "depth",
        "position",
        status.alias("status"),
        F.coalesce(F.array_join("errors", ","), F.lit("")).alias("errors"),
        (F.coalesce("n_repeats", F.lit(0)) + F.coalesce("r_repeats", F.lit(0))).cast("long").alias("n_repeats"),
        body.alias("message"),
    )


def call_id(conv: Column, turn: Column) -> Column:
    return F.concat(F.lit("call_"), F.substring(F.md5(F.concat_ws(":", conv.cast("string"), turn.cast("string"))), 1, 12))


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read from plain turns: a user's turn calls a tool, the assistant's answers the turn before.

    The tool follows from the turn's length (a share asks for a tool without a schema), and
    arguments are JSON built from the whole text; some lengths leave out a required member, ask for
    an order that is not in the schema, or add a member that it does not know. A call builds on the
    call two turns before; one length in five builds on those four and six turns before instead.
    """
    n = F.length(F.coalesce("text", F.lit("")))
    asked = conversations.where("role = 'user'")
    name = F.when(n % 13 == 0, "shell").when(n % 3 == 0, "search").when(n % 3 == 1, "count").otherwise("quote")
    options = F.struct(F.array(F.lit("title"), F.lit("body")).alias("fields"), F.when(n % 4 == 0, "any").when(n % 4 == 1, "old").otherwise("new").alias("order"))
    arguments = (
        F.when(n % 11 == 0, F.to_json(F.struct(n.alias("limit"))))
        .when(n % 3 == 0, F.to_json(F.struct((n % 10 + 1).alias("limit"), options.alias("options"), F.col("text").alias("query"))))
        .when(n % 3 == 1, F.to_json(F.struct(F.col("text").alias("text"), F.lit("word").alias("unit"))))
        .when(n % 7 == 0, F.to_json(F.struct(F.col("text").alias("text"), F.lit("wide").alias("width"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("text"), F.lit(40).alias("width"))))
    )
    at = lambda back: call_id(F.col("conv_id"), F.col("turn") - back)
    after = F.when(n % 5 == 0, F.array(at(4), at(6))).otherwise(F.array(at(2)))
    calls = asked.select("conv_id", "turn", at(0).alias("call_id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    results = conversations.where("role = 'assistant'").select("conv_id", "turn", at(1).alias("call_id"), F.coalesce("text", F.lit("")).alias("content"))
    return calls, results


def _sql_missing(field: str) -> str:
    return f"CASE WHEN json_extract(arguments, '$.{field}') IS NULL THEN ['missing:{field}'] ELSE [] END"


#: The query on ``conversations`` in DuckDB's SQL; the checks are those of ``SCHEMAS`` that its calls can fail.
SQL = f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, role, coalesce(text, '') AS x, length(coalesce(text, '')) AS n,
       'call_' || substr(md5(conv_id || ':' || turn), 1, 12) AS cid, 'call_' || substr(md5(conv_id || ':' || (turn - 1)), 1, 12) AS prior FROM conversations),
c AS (SELECT *, CASE WHEN n % 13 = 0 THEN 'shell' WHEN n % 3 = 0 THEN 'search' WHEN n % 3 = 1 THEN 'count' ELSE 'quote' END AS name,
       CASE WHEN n % 11 = 0 THEN json_object('limit', n)
            WHEN n % 3 = 0 THEN json_object('limit', n % 10 + 1, 'options', json_object('fields', ['title', 'body'], 'order', CASE n % 4 WHEN 0 THEN 'any' WHEN 1 THEN 'old' ELSE 'new' END), 'query', x)
            WHEN n % 3 = 1 THEN json_object('text', x, 'unit', 'word')
            WHEN n % 7 = 0 THEN json_object('text', x, 'width', 'wide')
            ELSE json_object('text', x, 'width', 40) END AS arguments
      FROM t WHERE role = 'user'),
e AS (SELECT cid, unnest(CASE WHEN n % 5 = 0 THEN [turn - 4, turn - 6] ELSE [turn - 2] END) AS up, conv_id FROM c),
p AS MATERIALIZED (SELECT e.cid, c.cid AS parent FROM e JOIN c ON c.conv_id = e.conv_id AND c.turn = e.up),
d AS (SELECT cid, 0::BIGINT AS depth FROM c WHERE cid NOT IN (SELECT cid FROM p)
      UNION SELECT p.cid, d.depth + 1 FROM p JOIN d ON p.parent = d.cid),
deep AS (SELECT cid, max(depth) AS depth FROM d GROUP BY 1),
r AS (SELECT conv_id, turn, prior AS cid, x AS content FROM t WHERE role = 'assistant'),
m AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, c.turn, coalesce(c.cid, r.cid) AS call_id, c.name, r.turn AS result_turn, deep.depth, c.arguments, r.content,
       list_sort(CASE c.name WHEN 'search' THEN list_concat(list_concat({_sql_missing("query")}, {_sql_missing("limit")}), CASE WHEN json_extract_string(arguments, '$.options.order') = 'any' THEN ['enum:options.order'] ELSE [] END)
            WHEN 'count' THEN list_concat({_sql_missing("text")}, CASE WHEN json_extract(arguments, '$.limit') IS NOT NULL THEN ['unknown:limit'] ELSE [] END)
            WHEN 'quote' THEN list_concat({_sql_missing("text")}, CASE WHEN json_extract(arguments, '$.width') IS NULL THEN ['missing:width'] WHEN json_type(arguments, '$.width') = 'VARCHAR' THEN ['type:width'] ELSE [] END)
            WHEN 'shell' THEN ['unknown_tool'] END) AS errors
      FROM c JOIN deep USING (cid) FULL JOIN r USING (cid))
SELECT conv_id, turn, call_id, name, result_turn, depth,
       row_number() OVER (PARTITION BY conv_id ORDER BY name IS NULL, depth, turn, call_id, result_turn) AS position,
       CASE WHEN name IS NULL THEN 'orphan_result' WHEN len(errors) > 0 THEN 'invalid' WHEN result_turn IS NULL THEN 'no_result' ELSE 'ok' END AS status,
       coalesce(array_to_string(errors, ','), '') AS errors, 0::BIGINT AS n_repeats,
       '{{' || concat_ws(',', '"arguments":' || arguments::VARCHAR, '"call_id":' || to_json(call_id)::VARCHAR, '"content":' || to_json(content)::VARCHAR, '"name":' || to_json(name)::VARCHAR) || '}}' AS message
FROM m
"""

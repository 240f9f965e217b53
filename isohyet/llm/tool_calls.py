"""Tool calls of conversations: linked to their results, ordered, validated, and written as canonical JSON.

Calls and results meet in an equi-join on conversation and identifier. A call may name the call it
builds on; its depth (topological order) is found by doubling the reach of those references, so a
chain of n calls takes log2 n joins, and references that run in a circle never reach a start and are
reported. Arguments are parsed as JSON variants, held against the tool's parameters (present when
required, and of the declared type) and written back with keys in order and no spare white space.

Everything is DataFrame functions: joins on near-unique identifiers and projections. The parameters
of a tool are few and belong to its declaration; no rows of a conversation, tool or result are ever
gathered, so a conversation or a tool that holds a third of all rows only makes a join key that
adaptive execution splits.

Edge cases: calls or results without a conversation or an identifier are kept as unlinked rows;
repeated calls and results with one identifier count once (the smallest by content) and are reported
when they differ; results without a call are kept; a null, blank or malformed argument text is
reported and written as null; unknown tools are reported; empty tables give empty results; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common as C

#: JSON types of a parameter, and the variant types that satisfy them.
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL", "FLOAT"], "boolean": ["BOOLEAN"],
         "array": ["ARRAY"], "object": ["OBJECT"], "null": ["VOID"]}

RESULT = ["conv_id", "call_id", "kind", "depth", "linked", "valid", "errors", "json"]


def _one_each(df: DataFrame, content: list[str]) -> DataFrame:
    """One row for each identifier, and whether its rows differ."""
    named = df.where("conv_id is not null and call_id is not null")
    s = F.struct(*content)
    return named.groupBy("conv_id", "call_id").agg(F.min(s).alias("m"), (F.min(s) != F.max(s)).alias("differs")) \
        .select("conv_id", "call_id", *[F.col("m")[c].alias(c) for c in content], "differs")


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth: 0 for a call that builds on none; null when the references run in a circle.

    A reference to a call that does not exist counts as none.
    """
    spark = calls.sparkSession
    ids = calls.select("conv_id", "call_id", "parent_id")
    known = ids.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("known"))
    step = ids.join(known, ["conv_id", "parent_id"], "left").select(
        "conv_id", "call_id", F.when(F.col("known"), F.col("parent_id")).alias("up"), F.when(F.col("known"), 1).otherwise(0).cast("long").alias("far"))
    step, path = C.written(step, "call-depths")
    total = step.count()
    reach = 1
    while True:
        going = step.where("up is not null")
        if reach > total or going.isEmpty():  # after so many steps only circles are left
            break
        above = step.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("far").alias("far2"))
        step, new = C.written(step.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("up2").alias("up"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far")), "call-depths")
        C.drop_written(spark, path)
        path = new
        reach *= 2
    return step.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("far")).alias("depth"))


def _type_fits(value: Column, kind: Column) -> Column:
    """Whether a variant's type is the declared one."""
    have = F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)
    out = F.lit(False)
    for name, fits in TYPES.items():
        out = F.when(kind == name, have.isin(fits)).otherwise(out)
    return out


def _small(df: DataFrame) -> DataFrame:
    """Sent to all tasks when its rows are few enough to be sure of its size; joined by key otherwise."""
    size = df.agg(F.sum(F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns])) + 64)).first()[0]
    return F.broadcast(df) if (size or 0) <= C.BROADCAST_BYTES else df


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, call_id, errors (sorted array), arguments_json of calls (conv_id, call_id, name, arguments).

    schemas: name, param, type, required; a tool without parameters has one row with a null param.
    """
    spark = calls.sparkSession
    d = calls.select("conv_id", "call_id", "name", F.try_parse_json("arguments").alias("v"))
    parsed = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    params = _small(schemas.where("name is not null and param is not null").select("name", F.col("param").alias("key"), "type", "required").distinct())
    tools = _small(schemas.where("name is not null").select("name").distinct())
    given = spark.sql("SELECT conv_id, call_id, name, t.key, t.value FROM {d}, LATERAL variant_explode({d}.v) AS t", d=d.where(parsed))
    wrong = given.join(params, ["name", "key"], "left").select("conv_id", "call_id", "name", F.when(
        F.col("type").isNull(), F.concat(F.lit("unknown:"), "key")).when(~_type_fits(F.col("value"), F.col("type")), F.concat(F.lit("type:"), "key")).alias("error"))
    needed = d.where(parsed).select("conv_id", "call_id", "name").join(params.where("required"), "name").select("conv_id", "call_id", "key")
    missing = needed.join(given.select("conv_id", "call_id", "key"), ["conv_id", "call_id", "key"], "left_anti") \
        .select("conv_id", "call_id", F.concat(F.lit("missing:"), "key").alias("error"))
    strange = d.join(tools, "name", "left_anti").select("conv_id", "call_id", F.lit("tool").alias("error"))
    unread = d.where(~parsed).select("conv_id", "call_id", F.lit("arguments").alias("error"))
    listed = wrong.join(tools, "name", "left_semi").where("error is not null").select("conv_id", "call_id", "error") \
        .unionByName(missing).unionByName(strange).unionByName(unread)
    errors = listed.groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set("error")).alias("errors"))  # a call's own few errors
    return d.join(errors, ["conv_id", "call_id"], "left").select(
        "conv_id", "call_id", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"),
        F.when(parsed, F.to_json("v")).alias("arguments_json"))


def _object(**fields: Column) -> Column:
    """Canonical JSON of an object; the values are JSON texts or null."""
    parts = [F.concat(F.lit(f'"{k}":'), F.coalesce(fields[k], F.lit("null"))) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _string(c: Column | str) -> Column:
    """JSON text of a string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.regexp_replace(F.to_json(F.array(c)), r"(?s)^\[|\]$", ""))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row a call with its result, and one for each result or call that cannot be linked; columns ``RESULT``.

    calls: conv_id, call_id, parent_id, name, arguments (JSON text); results: conv_id, call_id, content.
    """
    c = _one_each(calls, ["name", "parent_id", "arguments"])
    r = _one_each(results, ["content"]).select("conv_id", "call_id", "content", F.col("differs").alias("results_differ"), F.lit(True).alias("answered"))
    key = ["conv_id", "call_id"]
    both = c.withColumn("called", F.lit(True)).join(r, key, "full")
    both = both.join(depths(c), key, "left").join(validate(c, schemas), key, "left")
    more = F.array_compact(F.array(
        F.when(F.col("differs"), F.lit("repeated call")), F.when(F.col("results_differ"), F.lit("repeated result")),
        F.when(F.col("called") & F.col("depth").isNull(), F.lit("circle"))))
    errors = F.concat_ws(",", F.array_sort(F.concat(F.coalesce("errors", F.array().cast("array<string>")), more)))
    linked = F.coalesce(F.col("called") & F.col("answered"), F.lit(False))
    kind = F.when(F.col("called"), F.lit("call")).otherwise(F.lit("result"))
    doc = _object(arguments=F.col("arguments_json"), id=_string("call_id"), name=_string("name"), parent=_string("parent_id"),
                  result=_string("content"), type=_string(kind))
    out = both.select(*key, kind.alias("kind"), "depth", linked.alias("linked"), F.when(F.col("called"), errors == "").alias("valid"), errors.alias("errors"), doc.alias("json"))

    def loose(df: DataFrame, kind: str, **fields: Column) -> DataFrame:
        return df.where("conv_id is null or call_id is null").select(
            *key, F.lit(kind).alias("kind"), F.lit(None).cast("long").alias("depth"), F.lit(False).alias("linked"), F.lit(None).cast("boolean").alias("valid"),
            F.lit("no identifier").alias("errors"), _object(id=_string("call_id"), type=_string(F.lit(kind)), **fields).alias("json"))

    none = F.lit(None).cast("string")
    return out.unionByName(loose(calls, "call", arguments=none, name=_string("name"), parent=_string("parent_id"), result=none)) \
        .unionByName(loose(results, "result", arguments=none, name=none, parent=none, result=_string("content")))


#: The tool that the turns of the conversations table stand for.
REPLY_TOOL = [("reply", "prompt", "string", True), ("reply", "turn", "integer", True), ("reply", "words", "integer", False),
              ("reply", "question", "boolean", False)]


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a conversation table (conv_id, turn, role, text).

    A user turn calls ``reply`` and builds on the user turn two before; an assistant turn is the
    result of the call one turn before it.
    """
    name = lambda c: F.concat(F.lit("c"), c.cast("string"))
    turn = F.col("turn").cast("long")
    words = F.size(F.array_remove(F.split(F.translate("text", "\t\n\x0b\x0c\r", "     "), " "), "")).cast("long")
    args = F.to_json(F.struct(turn.alias("turn"), F.col("text").alias("prompt"), F.when(F.col("text").isNotNull(), words).alias("words"),
                              F.col("text").endswith("?").alias("question")))
    calls = turns.where("role = 'user'").select("conv_id", name(turn).alias("call_id"), name(turn - 2).alias("parent_id"), F.lit("reply").alias("name"), args.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", name(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = C.table(spark, sf_dir, "conversations")
    calls, results = turns_as_calls(turns)
    schemas = spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("name", "param", "type", "required"), row)]) for row in REPLY_TOOL])))
    linked = link(calls, results, schemas)
    other = turns.where("role is null or role not in ('user', 'assistant')")
    text = _object(content=_string("text"), role=_string("role"), type=_string(F.lit("text")))
    return linked.unionByName(other.select(
        "conv_id", F.concat(F.lit("c"), F.col("turn").cast("string")).alias("call_id"), F.lit("text").alias("kind"), F.lit(None).cast("long").alias("depth"),
        F.lit(False).alias("linked"), F.lit(None).cast("boolean").alias("valid"), F.lit("").alias("errors"), text.alias("json")))


SQL = r"""
WITH RECURSIVE u AS (
  SELECT conv_id, turn, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE role = 'user'
), chain AS (
  SELECT conv_id, turn, 0::BIGINT AS depth FROM u a WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 2)
  UNION ALL
  SELECT u.conv_id, u.turn, depth + 1 FROM chain JOIN u ON u.conv_id = chain.conv_id AND u.turn = chain.turn + 2
), r AS (
  SELECT conv_id, turn - 1 AS turn, text AS content, 1 AS answered FROM conversations WHERE role = 'assistant'
), both_ AS (
  SELECT coalesce(u.conv_id, r.conv_id) AS conv_id, 'c' || coalesce(u.turn, r.turn) AS call_id, u.turn AS called, depth, answered, text, words, content
  FROM u JOIN chain USING (conv_id, turn) FULL JOIN r ON r.conv_id = u.conv_id AND r.turn = u.turn
)
SELECT conv_id, call_id, CASE WHEN called IS NULL THEN 'result' ELSE 'call' END AS kind, depth,
       called IS NOT NULL AND answered IS NOT NULL AS linked, CASE WHEN called IS NOT NULL THEN true END AS valid, '' AS errors,
       '{"arguments":' || CASE WHEN called IS NULL THEN 'null' ELSE '{"prompt":' || to_json(text)::VARCHAR || ',"question":' || ends_with(text, '?')::VARCHAR
         || ',"turn":' || called || ',"words":' || words || '}' END
       || ',"id":"' || call_id || '","name":' || CASE WHEN called IS NULL THEN 'null' ELSE '"reply"' END
       || ',"parent":' || CASE WHEN called IS NULL THEN 'null' ELSE '"c' || (called - 2) || '"' END
       || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"type":"' || CASE WHEN called IS NULL THEN 'result' ELSE 'call' END || '"}' AS json
FROM both_
UNION ALL
SELECT conv_id, 'c' || turn, 'text', NULL, false, NULL, '', '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || ',"type":"text"}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""

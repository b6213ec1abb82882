"""Chat formatting: tool calls linked to their results.

Calls and results are hash-joined by conversation and call identifier; calls
are put into topological levels by peeling off, round by round, those whose
dependencies have all been placed; arguments are checked against the tools'
schemas; every linked call is written as canonical JSON (sorted keys, no
white space). DataFrame functions only.

One row is returned for each call, and for each result without a call.
Defined cases: calls that repeat an identifier are numbered by turn, one row
each (``n_calls`` counts an identifier's calls, ``n_results`` the results of
one call); a result or
a dependency goes to the last of them at or before its own turn (the first,
if there's none), and results of calls of one turn go to them one by one; of
more results than calls the first by turn is taken, and the others are
returned beside it or as rows of their own; a call or result with a null
conversation or identifier is a row of its own, links with nothing (status
``no_id``) and comes last; a dependency that is no call of the conversation is listed as
missing and doesn't hold the call back; calls on a dependency cycle, or
behind one, have no level and come last (status ``cyclic``); arguments that
are null or no JSON object are invalid and kept as text; empty tables give
empty results; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.llm.common import materialise
from qaspark.operators.order import reindex, running_sums

KEY = ["conv_id", "call_id"]
# A call: the identifier and the number of its occurrence.
NODE = [*KEY, "_occ"]


def _first_of_each(df: DataFrame, cols: list[str], count: str) -> DataFrame:
    """One row per key: the first by turn (a partial aggregate), and how many."""
    row = F.struct("turn", *cols)
    return df.groupBy(*KEY).agg(F.min(row).alias("_r"), F.count(F.lit(1)).alias(count)).select(*KEY, count, "_r.*")


def _numbered(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """``df`` with a row's number within its key, ranked over ranges."""
    seq = reindex(df, [*keys, *order], "_seq")
    low = seq.groupBy(*keys).agg(F.min("_seq").alias("_low"))
    return seq.join(low, keys).withColumn(name, F.col("_seq") - F.col("_low") + 1).drop("_seq", "_low")


def _last_at(asks: DataFrame, repeated: DataFrame) -> DataFrame:
    """``asks`` (with ``turn``) and ``_at``: how many of the repeated calls
    of its key lie at or before its turn."""
    calls = repeated.select(*KEY, F.col("call_turn").alias("turn"), F.lit(1).alias("_call"))
    both = asks.withColumn("_call", F.lit(0)).unionByName(calls, allowMissingColumns=True)
    sums = running_sums(both, [*KEY, "turn", 1 - F.col("_call")], {"_sum": "_call"})
    low = sums.groupBy(*KEY).agg(F.min(F.col("_sum") - F.col("_call")).alias("_low"))
    return sums.where("_call = 0").join(low, KEY).select(*asks.columns, (F.col("_sum") - F.col("_low")).alias("_at"))


def _every_result(results: DataFrame, first: DataFrame, repeated: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """The result of each occurrence, and the results beyond (none if no
    identifier has more than one)."""
    hot = first.where("n_results > 1").select(*KEY)
    if repeated is not None:
        hot = hot.unionByName(first.where("n_results = 1").join(repeated.select(*KEY).distinct(), KEY, "left_semi").select(*KEY))
    hot = materialise(hot, "repeated")
    one = first.withColumn("_occ", F.lit(1).cast("long"))
    if hot.isEmpty():
        return one, None
    each = results.join(hot, KEY).select(*KEY, "turn", "content")
    if repeated is None:
        each = each.withColumns({"_at": F.lit(1).cast("long"), "_size": F.lit(1).cast("long")})
    else:
        turns = repeated.groupBy(*KEY, "call_turn").agg(F.count(F.lit(1)).alias("_size"), F.max("_occ").alias("_at")).drop("call_turn")
        least = turns.groupBy(*KEY).agg(F.min("_at").alias("_least"))
        at = F.greatest("_at", F.coalesce("_least", F.lit(1)))
        each = _last_at(each, repeated).join(least, KEY, "left").withColumn("_at", at).drop("_least")
        each = each.join(turns, [*KEY, "_at"], "left").withColumn("_size", F.coalesce("_size", F.lit(1)))
    each = _numbered(each, [*KEY, "_at"], ["turn", F.xxhash64("content")], "_k")
    each = each.withColumn("_occ", F.col("_at") - F.col("_size") + F.least("_k", "_size"))
    each = materialise(each.select(*NODE, F.col("turn").alias("result_turn"), "content", (F.col("_k") > F.col("_size")).alias("_beyond")), "results")
    each = each.join(each.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_results")), NODE)
    taken = each.where("not _beyond").drop("_beyond")
    return one.join(hot, KEY, "left_anti").unionByName(taken), each.where("_beyond").drop("_beyond")


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """``conv_id, call_id, _occ, level`` of the calls that can be ordered;
    ``edges`` has ``conv_id, call_id, _occ, parent, parent_occ``. The number
    of rounds is the length of the longest chain of dependencies."""
    edges = materialise(edges.distinct(), "edges")
    placed = calls.select(*NODE).join(edges.select(*NODE).distinct(), NODE, "left_anti").withColumn("level", F.lit(0).cast("long"))
    placed = materialise(placed, "levels")
    done, level = placed, 0
    while not edges.isEmpty():
        ready = placed.select("conv_id", F.col("call_id").alias("parent"), F.col("_occ").alias("parent_occ"))
        rest = materialise(edges.join(ready, ["conv_id", "parent", "parent_occ"], "left_anti"), "edges")
        level += 1
        freed = edges.select(*NODE).distinct().join(rest.select(*NODE).distinct(), NODE, "left_anti")
        placed = materialise(freed.withColumn("level", F.lit(level).cast("long")), "levels")
        if placed.isEmpty():
            break
        done, edges = done.unionByName(placed), rest
    return done


def problems(arguments: Column, parsed: Column, tool: Column, schemas: dict) -> Column:
    """Sorted problems of a call's arguments under its tool's schema:
    ``{tool: {parameter: (type, required)}}`` with types of Spark's variant
    (``STRING``, ``BIGINT``, ``BOOLEAN``, ``DOUBLE``, ``ARRAY``, ``OBJECT``)."""
    found = F.schema_of_variant(parsed)
    keys = F.map_keys(F.from_json(arguments, "map<string,string>"))
    checks = []
    for name, schema in schemas.items():
        mine = tool == name
        for param, (kind, required) in schema.items():
            value = F.try_variant_get(parsed, f"$.{param}", "variant")
            actual = F.schema_of_variant(value)
            if required:
                checks.append(F.when(mine & (value.isNull() | (actual == "VOID")), F.lit(f"missing:{param}")))
            wrong = value.isNotNull() & (actual != "VOID") & ~actual.startswith(kind)
            checks.append(F.when(mine & wrong, F.lit(f"type:{param}")))
        unknown = F.array_except(keys, F.array(*[F.lit(p) for p in schema]))
        checks.append(F.when(mine & (F.size(unknown) > 0), F.concat(F.lit("unknown:"), F.array_join(F.array_sort(unknown), ","))))
    listed = F.array_sort(F.filter(F.array(*checks), lambda x: x.isNotNull()))
    return (
        F.when(parsed.isNull() | ~found.startswith("OBJECT"), F.array(F.lit("arguments")))
        .when(tool.isNull() | ~tool.isin(list(schemas)), F.array(F.lit("tool")))
        .otherwise(listed)
    )


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict, more: str = "array") -> DataFrame:
    """``conv_id, call_id, position, level, status, n_calls, n_results,
    problems, json`` from ``calls`` (``conv_id, turn, call_id, tool,
    arguments, depends_on``) and ``results`` (``conv_id, turn, call_id,
    content``). ``position`` counts a conversation's rows from 1 in
    topological order, then by turn; orphan results come after the calls.
    Results beyond the first of a call are listed by turn in one more column
    ``more_results``; with ``more="rows"`` they are rows like orphans."""
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    of_call, one, none = ["tool", "arguments", "depends_on"], F.lit(1).cast("long"), F.lit(0).cast("long")
    first = _first_of_each(calls.where(has_id), of_call, "n_calls").withColumnRenamed("turn", "call_turn")
    first = materialise(first, "calls")
    named = first.withColumn("_occ", one)
    often, repeated = first.where("n_calls > 1").select(*KEY, "n_calls"), None
    if not often.isEmpty():
        each = calls.where(has_id).join(often, KEY).select(*KEY, "n_calls", F.col("turn").alias("call_turn"), *of_call)
        repeated = materialise(_numbered(each, KEY, ["call_turn", F.xxhash64(*of_call)], "_occ"), "repeated")
        named = named.where("n_calls = 1").unionByName(repeated)
    r = _first_of_each(results.where(has_id), ["content"], "n_results").withColumnRenamed("turn", "result_turn")
    r, beyond = _every_result(results.where(has_id), materialise(r, "results"), repeated)

    wanted = named.select(*NODE, F.col("call_turn").alias("turn"), F.explode(F.array_distinct("depends_on")).alias("parent")).where("parent is not null")
    there = first.select("conv_id", F.col("call_id").alias("parent"), "n_calls")
    edges = wanted.join(there, ["conv_id", "parent"])
    missing = wanted.join(there, ["conv_id", "parent"], "left_anti").groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_missing"))
    single = edges.where("n_calls = 1").select(*NODE, "parent", one.alias("parent_occ"))
    if repeated is not None:
        asks = edges.where("n_calls > 1").select("conv_id", F.col("parent").alias("call_id"), "turn", F.col("call_id").alias("_child"), "_occ")
        asked = _last_at(asks, repeated).select(
            "conv_id", F.col("_child").alias("call_id"), "_occ", F.col("call_id").alias("parent"), F.greatest("_at", one).alias("parent_occ")
        )
        single = single.unionByName(asked)
    placed = levels(named, single)

    both = named.join(r, NODE, "full")
    if beyond is not None and more == "rows":
        both = both.unionByName(beyond, allowMissingColumns=True)
    both = both.join(placed, NODE, "left").join(missing, NODE, "left")
    both = both.withColumn("level", F.when(F.col("n_calls") > 0, F.col("level")))
    listed = "array<struct<turn:bigint,content:string>>"
    if beyond is not None and more == "array":
        item = F.struct(F.col("result_turn").cast("long").alias("turn"), "content")
        lists = beyond.groupBy(*NODE).agg(F.array_sort(F.collect_list(item)).cast(listed).alias("more_results"))
        both = both.join(lists, NODE, "left")
    else:
        both = both.withColumn("more_results", F.lit(None).cast(listed))
    # rows without an identifier take part in no join
    lone = calls.where(~has_id).select(*KEY, F.col("turn").alias("call_turn"), *of_call, one.alias("n_calls"))
    lost = results.where(~has_id).select(*KEY, F.col("turn").alias("result_turn"), "content", one.alias("n_results"))
    both = both.unionByName(lone, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)
    both = both.withColumns({"n_calls": F.coalesce("n_calls", none), "n_results": F.coalesce("n_results", none)})
    parsed = F.try_parse_json("arguments")
    status = (
        F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "no_id")
        .when(F.col("n_calls") == 0, "orphan")
        .when(F.col("level").isNull(), "cyclic")
        .when(F.col("n_results") == 0, "unanswered")
        .otherwise("linked")
    )
    both = both.withColumn("status", status).withColumn("_parsed", parsed)
    found = F.concat(
        problems(F.col("arguments"), F.col("_parsed"), F.col("tool"), schemas),
        F.when(F.col("n_missing") > 0, F.array(F.lit("dependency"))).otherwise(F.array().cast("array<string>")),
    )
    both = both.withColumn("problems", F.when(F.col("n_calls") > 0, found).otherwise(F.array().cast("array<string>")))
    # keys in code point order; a null field is left out
    plain = F.schema_of_variant("_parsed").startswith("OBJECT")
    line = F.to_json(
        F.struct(
            F.when(plain, F.col("_parsed")).alias("arguments"),
            F.when(~F.coalesce(plain, F.lit(False)), F.col("arguments")).alias("arguments_text"),
            F.col("call_id"),
            F.when(F.size("depends_on") > 0, F.array_sort("depends_on")).alias("depends_on"),
            F.col("content").alias("result"),
            F.col("status"),
            F.col("tool"),
        )
    )
    both = both.withColumn("json", line).withColumn("_turn", F.coalesce("call_turn", "result_turn"))
    both = both.select(
        *NODE, "level", "status", "n_calls", "n_results", "problems", "json", "more_results", "_turn",
        F.when(F.col("level").isNotNull(), F.col("level")).when(F.col("n_calls") > 0, 1 << 60).otherwise(1 << 61).alias("_place"),
        F.xxhash64("json").alias("_tie"),
    )
    # a hot conversation is ordered over many ranges, not in one window
    ranked = reindex(both, ["conv_id", "_place", "_turn", "call_id", "_occ", "_tie"], "_seq")
    starts = ranked.groupBy("conv_id").agg(F.min("_seq").alias("_start")).withColumnRenamed("conv_id", "_c")
    out = ranked.join(starts, ranked.conv_id.eqNullSafe(starts._c))
    return out.select(
        *KEY, (F.col("_seq") - F.col("_start") + 1).alias("position"), "level", "status", "n_calls", "n_results",
        F.array_join("problems", ";").alias("problems"), "json", *["more_results"] * (more == "array"),
    )


# Tools of the conversations table's derived calls.
SCHEMAS = {
    "search": {"query": ("STRING", True), "limit": ("BIGINT", False)},
    "translate": {"text": ("STRING", True), "to": ("STRING", True)},
    "count": {"text": ("STRING", True), "unique": ("BOOLEAN", False)},
}


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read from a conversations table: every user turn
    calls a tool with its text, every assistant turn answers the call of the
    turn before, and a call builds on the one two turns earlier within the
    same eight turns."""
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn, text = F.col("turn"), F.coalesce(F.col("text"), F.lit(""))
    quoted = F.expr("regexp_extract(to_json(named_struct('x', coalesce(text, ''))), '(?s)^\\\\{\"x\":(.*)\\\\}$', 1)")
    kind = turn % 3
    arguments = (
        F.when(kind == 0, F.concat(F.lit('{ "query" : '), quoted, F.lit(', "limit" : '), (turn + 1).cast("string"), F.lit(" }")))
        .when(kind == 1, F.concat(F.lit('{"to":"en" , "text":'), quoted, F.lit("}")))
        .otherwise(
            F.concat(F.lit('{"unique":'), F.when(F.col("conv_id") % 5 == 0, '"yes"').otherwise("true"), F.lit(', "text": '), quoted, F.lit("}"))
        )
    )
    tool = F.when(kind == 0, "search").when(kind == 1, "translate").otherwise("count")
    calls = conversations.where("role = 'user'").select(
        "conv_id", "turn", name(turn).alias("call_id"), tool.alias("tool"), arguments.alias("arguments"),
        F.when(turn % 8 >= 2, F.array(name(turn - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    results = conversations.where("role = 'assistant'").select("conv_id", "turn", name(turn - 1).alias("call_id"), text.alias("content"))
    return calls, results


CHAT_SQL = r"""
WITH RECURSIVE u AS (SELECT conv_id, min(turn) AS turn, 'c' || conv_id || '-' || turn AS call_id, count(*) AS n_calls,
    min(coalesce(text, '')) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id, turn),
a AS (SELECT conv_id, min(turn) AS rturn, 'c' || conv_id || '-' || (turn - 1) AS call_id, count(*) AS n_results,
    min(coalesce(text, '')) AS content FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
e AS (SELECT x.conv_id, x.call_id, y.call_id AS parent FROM u x JOIN u y ON x.conv_id = y.conv_id AND y.turn = x.turn - 2 AND x.turn % 8 >= 2),
l AS (SELECT conv_id, call_id, 0::BIGINT AS level FROM u WHERE call_id NOT IN (SELECT call_id FROM e)
    UNION ALL SELECT e.conv_id, e.call_id, l.level + 1 FROM l JOIN e ON e.conv_id = l.conv_id AND e.parent = l.call_id),
f AS (SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.call_id, a.call_id) AS call_id, u.turn, a.rturn, u.text, a.content,
    coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results, l.level,
    CASE WHEN u.call_id IS NULL THEN 'orphan' WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
    u.turn % 8 >= 2 AND e.parent IS NULL AS lost FROM u FULL JOIN a ON u.conv_id = a.conv_id AND u.call_id = a.call_id
    LEFT JOIN l ON l.conv_id = u.conv_id AND l.call_id = u.call_id LEFT JOIN e ON e.conv_id = u.conv_id AND e.call_id = u.call_id),
j AS (SELECT *, CASE turn % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'translate' WHEN 2 THEN 'count' END AS tool,
    CASE turn % 3 WHEN 0 THEN '{"limit":' || (turn + 1) || ',"query":' || CAST(to_json(text) AS VARCHAR) || '}'
        WHEN 1 THEN '{"text":' || CAST(to_json(text) AS VARCHAR) || ',"to":"en"}'
        WHEN 2 THEN '{"text":' || CAST(to_json(text) AS VARCHAR) || ',"unique":' || CASE WHEN conv_id % 5 = 0 THEN '"yes"' ELSE 'true' END || '}' END AS args FROM f)
SELECT conv_id, call_id, row_number() OVER (PARTITION BY conv_id ORDER BY level NULLS LAST, coalesce(turn, rturn), call_id) AS position, level, status,
    n_calls, n_results, concat_ws(';', CASE WHEN turn % 3 = 2 AND conv_id % 5 = 0 THEN 'type:unique' END, CASE WHEN lost THEN 'dependency' END) AS problems,
    '{' || CASE WHEN args IS NOT NULL THEN '"arguments":' || args || ',' ELSE '' END || '"call_id":"' || call_id || '",' ||
    CASE WHEN turn % 8 >= 2 THEN '"depends_on":["c' || conv_id || '-' || (turn - 2) || '"],' ELSE '' END ||
    CASE WHEN content IS NOT NULL THEN '"result":' || CAST(to_json(content) AS VARCHAR) || ',' ELSE '' END ||
    '"status":"' || status || '"' || CASE WHEN tool IS NOT NULL THEN ',"tool":"' || tool || '"' ELSE '' END || '}' AS json FROM j
"""

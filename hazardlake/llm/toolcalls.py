"""Tool calls linked to their results, ordered, checked and written as canonical JSON.

Calls and results meet in a hash join on conversation and identifier. A call stands one level above
the deepest call it refers to; levels are settled in rounds of joins that shorten chains to half each time, so
conversations of any length are spread over tasks and never gathered. Arguments are checked against the schema of their
tool by expressions built from it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_dir
from .common import prepare, written

# JSON kinds and the types Spark gives to their values.
KINDS = {"string": r"^STRING$", "integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
         "boolean": r"^BOOLEAN$", "object": r"^OBJECT", "array": r"^ARRAY", "null": r"^VOID$"}


def _spec(given) -> dict:
    """A member's description: (kind, required), or a mapping of kind, required, items (the kind of an
    array's entries), one_of (the values allowed) and members (those of an object)."""
    return dict(zip(("kind", "required"), given)) if isinstance(given, tuple) else given


def _member_errors(value: Column, keys: Column, members: dict, above: str = "") -> Column:
    """What is wrong with the members of a JSON object, in the order of their description, unknown ones last."""
    none = F.array().cast("array<string>")

    def told(condition, text):
        return F.when(condition, F.array(F.lit(text))).otherwise(none)

    found = []
    for key, spec in ((k, _spec(v)) for k, v in members.items()):
        name, kind = above + key, spec["kind"]
        member = F.try_variant_get(value, f"$['{key}']", "variant")
        wrong = member.isNull() | ~F.rlike(F.schema_of_variant(member), F.lit(KINDS[kind]))
        inner = [none]
        if "items" in spec:
            entries = F.try_variant_get(value, f"$['{key}']", "array<variant>")
            odd = F.exists(entries, lambda v: v.isNull() | ~F.rlike(F.schema_of_variant(v), F.lit(KINDS[spec["items"]])))
            inner.append(told(odd, f"{name}: items of {spec['items']} expected"))
        if "one_of" in spec:
            listed = F.to_json(member).isin([json.dumps(v, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
                                             for v in spec["one_of"]])
            inner.append(told(~listed, f"{name}: not one of {', '.join(map(str, spec['one_of']))}"))
        if "members" in spec:
            inner.append(_member_errors(member, F.json_object_keys(F.to_json(member)), spec["members"], f"{name}."))
        missing = told(F.lit(True), f"{name}: missing") if spec.get("required") else none
        found.append(F.when(~F.array_contains(keys, key), missing)
                     .when(wrong, F.array(F.lit(f"{name}: {kind} expected"))).otherwise(F.concat(*inner)))
    known = F.array(*map(F.lit, members)).cast("array<string>")
    unknown = F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(F.lit(above), k, F.lit(": unknown")))
    return F.concat(*found, unknown)


def argument_errors(name: Column, arguments: Column, parsed: Column, schemas: dict) -> Column:
    """What is wrong with the arguments of a call, a JSON text that is also given as a parsed variant.

    `schemas` is {tool: {argument: description}}, see `_spec`; its size is that of the tools' description, not
    of the data. Unknown tools, missing and unknown members, wrong kinds and values not listed are told, in
    objects of any depth that is described.
    """
    not_object = parsed.isNull() | ~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    by_tool = F.when(name.isNull() | ~name.isin(list(schemas)), F.array(F.lit("unknown tool"))) \
        .when(not_object, F.array(F.lit("arguments are not a JSON object")))
    for tool, members in schemas.items():
        by_tool = by_tool.when(name == tool, _member_errors(parsed, F.json_object_keys(arguments), members))
    return by_tool


def _without_implied(links: DataFrame, keys: list[str]) -> DataFrame:
    """Links (conv_id, call_id, earlier) without those that change no level: a call that refers to its latest
    reference and to one of that call's own references is above the second anyway."""
    latest = links.groupBy(*keys).agg(F.max(F.struct("place", "earlier")).alias("latest")).select(
        *keys, F.col("latest.earlier").alias("via"))
    again = links.select("conv_id", F.col("call_id").alias("via"), "earlier").filter("via != earlier")
    return links.drop("place").join(latest, keys).join(
        again.hint("shuffle_hash"), ["conv_id", "via", "earlier"], "left_anti").select(*keys, "earlier")


def call_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 for calls that refer to none, else one above the highest level
    they refer to; null for calls in or behind a circle. References to calls that do not exist do
    not count. `calls` has conv_id, call_id, turn, after (array of ids), unique by the first two.

    Each round settles the calls all of whose references are settled. A call with one open reference takes over
    that of the call it refers to, if that has one only, too: chains get twice as short a round, so a chain
    of any length takes a logarithmic number of rounds, also one in which each call refers to several or all
    of the calls before it. Where paths fork and join again, a round settles one level at least.
    """
    keys = ["conv_id", "call_id"]
    ids = written(calls.select(*keys, "turn", F.coalesce("after", F.array().cast("array<string>")).alias("after")), "call-ids")
    named = ids.select("conv_id", "call_id", F.explode(F.array_distinct("after")).alias("earlier"))
    known = ids.select("conv_id", F.col("call_id").alias("earlier"), F.struct(
        F.col("turn").isNotNull(), "turn").alias("place"))
    links = written(named.join(known.hint("shuffle_hash"), ["conv_id", "earlier"]), "call-links")
    # A link says: the call is at least `above` levels above the earlier one; `least` is what is known so far.
    links = written(_without_implied(links, keys).withColumn("above", F.lit(1).cast("long")), "call-links")
    nodes = ids.select(*keys, F.lit(0).cast("long").alias("least"))
    done = scratch_dir(calls.sparkSession, "call-levels")
    settled, schema = None, "conv_id bigint, call_id string, level bigint"
    while True:
        if settled is not None:
            links = links.join(settled.select("conv_id", F.col("call_id").alias("earlier"), "level").hint("shuffle_hash"),
                               ["conv_id", "earlier"], "left")
        else:
            links = links.withColumn("level", F.lit(None).cast("long"))
        links = written(links, "call-links")
        state = links.groupBy(*keys).agg(
            F.max(F.col("level") + F.col("above")).alias("found"), F.count_if(F.col("level").isNull()).alias("n_open"),
            F.max(F.when(F.col("level").isNull(), F.struct("earlier", "above"))).alias("sole"))
        nodes = written(nodes.join(state, keys, "left").select(
            *keys, F.greatest("least", F.coalesce("found", F.lit(0))).alias("least"),
            F.coalesce("n_open", F.lit(0)).alias("n_open"), "sole"), "call-state")
        settled = written(nodes.filter("n_open = 0").select(*keys, F.col("least").alias("level")), "call-settled")
        settled.write.mode("append").parquet(done)
        if settled.isEmpty():
            break
        single = nodes.filter("n_open = 1").select(*keys, "least", "sole.earlier", "sole.above")
        via = single.select("conv_id", F.col("call_id").alias("earlier"), F.col("least").alias("via_least"),
                            F.col("earlier").alias("via_earlier"), F.col("above").alias("via_above"))
        # What is behind a circle grows without end; no path is longer than the bound.
        bound = F.lit(1 << 50)
        jumped = written(single.join(via.hint("shuffle_hash"), ["conv_id", "earlier"], "left").select(
            *keys, F.least(F.greatest("least", F.coalesce(F.col("via_least") + F.col("above"), F.lit(0))), bound).alias("least"),
            F.coalesce("via_earlier", "earlier").alias("earlier"),
            F.least(F.col("above") + F.coalesce("via_above", F.lit(0)), bound).alias("above")), "call-jumps")
        several = nodes.filter("n_open > 1").select(*keys, "least")
        still = links.filter("level is null").join(several.select(*keys), keys, "left_semi")
        links = still.select(*keys, "earlier", "above").unionByName(jumped.select(*keys, "earlier", "above"))
        nodes = several.unionByName(jumped.select(*keys, "least"))
    every = calls.sparkSession.read.schema(schema).parquet(done)
    return ids.select(*keys).join(every, keys, "left").select(*keys, F.col("level").cast("int").alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per call, and one per result that no call asked for.

    `calls`: conv_id, turn, call_id, name, arguments (JSON text), after (ids of calls whose results
    it uses). `results`: conv_id, turn, call_id, content. Returned: conv_id, call_id, level, turn,
    result_turn, n_results, status, errors, json. Ascending (level, turn, call_id) is a
    topological order of a conversation: a call comes after all it refers to.

    Status: `ok`; `invalid` with `errors`; `no result`; `circular`, which has no level; `orphan` for
    a result without a call; the first that holds of orphan, circular, invalid, no result.
    A repeated identifier within a conversation is one call, the earliest (then by its fields),
    and the earliest result is linked; `n_results` counts them all. Null identifiers name
    nothing: such calls have no result, and each such row, repeated or not, stands for itself. Null
    and broken arguments are invalid; null content is JSON null. `json` is canonical: keys sorted, no
    white space. Empty tables give no rows; other columns are ignored.
    """
    spark = prepare(calls.sparkSession)
    calls = calls.select(*[F.col(c).cast(t).alias(c) for c, t in (
        ("conv_id", "bigint"), ("turn", "bigint"), ("call_id", "string"), ("name", "string"),
        ("arguments", "string"), ("after", "array<string>"))])
    results = results.select(*[F.col(c).cast(t).alias(c) for c, t in (
        ("conv_id", "bigint"), ("turn", "bigint"), ("call_id", "string"), ("content", "string"))])
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    keys = ["conv_id", "call_id"]
    best = F.min(F.struct("turn", "name", "arguments", "after")).alias("call")
    fields = ["conv_id", "call_id", "call.turn", "call.name", "call.arguments", "call.after"]
    unique = written(calls.filter(named).groupBy(*keys).agg(best).select(*fields), "calls")
    first = results.filter(named).groupBy(*keys).agg(
        F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("n_results"))
    level = call_levels(unique)
    linked = unique.withColumn("called", F.lit(True)).join(level, keys, "left") \
        .join(first.hint("shuffle_hash"), keys, "full_outer")
    nothing = F.lit(None)
    loose = calls.filter(~named).withColumns({
        "called": F.lit(True), "level": F.lit(0), "n_results": F.lit(0).cast("bigint"),
        "result": nothing.cast("struct<turn:bigint,content:string>")})
    stray = results.filter(~named).select(
        *keys, F.struct("turn", "content").alias("result"), F.lit(1).cast("bigint").alias("n_results"))
    every = linked.unionByName(loose).unionByName(stray, allowMissingColumns=True)
    parsed = F.col("parsed")
    errors = F.when(F.col("called"), argument_errors(F.col("name"), F.col("arguments"), parsed, schemas)) \
        .otherwise(F.array().cast("array<string>"))
    n = F.coalesce("n_results", F.lit(0).cast("bigint"))
    judged = every.withColumn("parsed", F.try_parse_json("arguments")).withColumns({"errors": errors, "n_results": n})
    status = F.when(F.col("called").isNull(), "orphan").when(F.col("level").isNull(), "circular") \
        .when(F.size("errors") > 0, "invalid").when(F.col("n_results") == 0, "no result").otherwise("ok")

    def bare(c):  # a JSON string, or null
        listed = F.to_json(F.array(c))
        return F.substring(listed, F.lit(2), F.char_length(listed) - 2)

    canonical = F.coalesce(F.to_json(parsed), bare(F.col("arguments")))  # a variant's keys are sorted
    line = F.concat(
        F.lit('{"arguments":'), canonical, F.lit(',"id":'), bare(F.col("call_id")),
        F.lit(',"name":'), bare(F.col("name")), F.lit(',"result":'), bare(F.col("result.content")), F.lit("}"))
    return judged.select(
        "conv_id", "call_id", "level", "turn", F.col("result.turn").alias("result_turn"), "n_results",
        status.alias("status"), F.array_join("errors", "; ").alias("errors"), line.alias("json"))


SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", False),
               "order": {"kind": "string", "one_of": ["new", "old"]}},
    "score": {"value": ("number", True), "strict": ("boolean", True)},
    "store": {"tags": {"kind": "array", "required": True, "items": "string"},
              "entry": {"kind": "object", "required": True, "members": {"a": ("string", True), "z": ("integer", True)}}},
}
EARLIER = 3  # how many calls before it a stand-in call refers to


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that stand in for those of real conversations, from every row and whole text.

    Each assistant turn makes one call; the tool follows from the turn, the arguments hold the turn's
    text, now and then with a flaw. It uses the results of the EARLIER assistant turns before it. Each other
    turn but the first holds the result of the call of the turn before it. Null texts are empty; rows without
    conv_id or turn give calls without an identifier. Repeated rows are repeated calls. Other columns are ignored.
    """
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    assistant = F.coalesce(F.col("role") == "assistant", F.lit(False))
    text = F.coalesce("text", F.lit(""))
    n = F.char_length(text).cast("bigint")

    def call_id(t):
        return F.concat(F.lit("call-"), conv, F.lit("-"), t)

    kind = F.pmod(turn + conv, F.lit(6))
    search = F.to_json(F.struct(
        text.alias("query"), (n % 50).alias("limit"), F.when(n % 13 == 0, "odd").otherwise("new").alias("order"),
        F.when(n % 11 == 0, 2).alias("page")))
    score = F.concat(F.lit('{"value": '), n, F.lit('.5, "strict": '),
                     F.when(n % 7 == 0, F.lit('"yes"')).otherwise(F.lit("true")), F.lit("}"))
    entry = F.when(n % 4 == 0, F.to_json(F.struct(F.lit("1").alias("z"), text.alias("a")))).otherwise(
        F.to_json(F.struct(F.lit(1).alias("z"), text.alias("a"))))
    store = F.concat(F.lit('{"tags": ["b", '), F.when(n % 3 == 0, F.lit("1")).otherwise(F.lit('"a"')),
                     F.lit('], "entry": '), entry, F.lit("}"))
    arguments = F.when(kind < 2, search).when(kind < 4, score).when(kind == 4, store).otherwise(
        F.when(n % 5 == 0, F.lit("{broken")).otherwise(F.lit("{}")))
    name = F.when(kind < 2, "search").when(kind < 4, "score").when(kind == 4, "store").otherwise(
        F.when(n % 2 == 0, "store").otherwise("lookup"))
    calls = conversations.filter(assistant).select(
        conv.alias("conv_id"), turn.alias("turn"), call_id(turn).alias("call_id"), name.alias("name"),
        arguments.alias("arguments"), F.array(*[call_id(turn - 2 * i) for i in range(1, EARLIER + 1)]).alias("after"))
    results = conversations.filter(~assistant & (turn > 0)).select(
        conv.alias("conv_id"), turn.alias("turn"), call_id(turn - 1).alias("call_id"), text.alias("content"))
    return calls, results

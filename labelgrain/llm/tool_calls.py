"""Tool-call linking: calls and results joined by identifier, ordered, checked and written as canonical JSON.

Everything is DataFrame expressions. A conversation is never gathered: each call
is a row with its depth in the order, so one conversation may hold any share of
all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.llm.storage import stored

#: Of each tool the fields of its arguments: JSON type, and whether the field must be there.
Schemas = dict[str, dict[str, tuple[str, bool]]]

#: JSON types, and how Spark names the values they allow.
TYPES = {
    "string": r"STRING",
    "integer": r"BIGINT",
    "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\)",
    "boolean": r"BOOLEAN",
    "array": r"ARRAY<.*>",
    "object": r"OBJECT<.*>",
    "null": r"VOID",
}


def problems(tool: F.Column, arguments: F.Column, schemas: Schemas) -> F.Column:
    """What is wrong with arguments, in order: an array of texts, empty if nothing is."""
    value = F.try_parse_json(arguments)
    kind = F.schema_of_variant(value)
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    found = F.array(F.when(tool.isNull(), F.lit("no tool")).otherwise(F.concat(F.lit("unknown tool "), tool)))
    for name, fields in schemas.items():
        checks = []
        for field, (json_type, required) in sorted(fields.items()):
            there = F.array_contains(keys, field)
            own = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
            fits = F.coalesce(own.rlike(f"(?s)^({TYPES[json_type]})$"), F.lit(json_type == "null"))
            if required:
                checks.append(F.when(~there, F.lit(f"missing {field}")))
            checks.append(F.when(there & ~fits, F.lit(f"{field} is no {json_type}")))
        extra = F.transform(F.array_sort(F.array_except(keys, F.array(*(F.lit(f) for f in sorted(fields))).cast("array<string>"))), lambda k: F.concat(F.lit("unknown "), k))
        listed = F.concat(F.filter(F.array(*checks).cast("array<string>"), lambda c: c.isNotNull()), extra)
        own = F.when(value.isNull(), F.array(F.lit("no JSON"))).when(~kind.startswith("OBJECT"), F.array(F.lit("no object"))).otherwise(listed)
        found = F.when(tool == name, own).otherwise(found)
    return found


def depths(calls: DataFrame) -> DataFrame:
    """``call_id``, ``depth``: how many calls come before each; null if its chain never ends.

    ``calls`` has distinct ``call_id`` and ``after``, the call it waits for. An
    ``after`` that is no call counts as none. Each round doubles the steps a
    pointer covers; a chain that has not ended after as many rounds as there are
    calls to the logarithm runs in a circle.
    """
    known = calls.select(F.col("call_id").alias("known"))
    start = calls.join(known, F.col("after") == F.col("known"), "left").select(
        "call_id", F.col("known").alias("to"), F.when(F.col("known").isNull(), 0).otherwise(1).cast("bigint").alias("depth")
    )
    state = stored(start)
    for _ in range(max(1, int(state.count()).bit_length()) + 1):
        if state.where("to is not null").isEmpty():
            break
        ahead = state.select(F.col("call_id").alias("id"), F.col("to").alias("next"), F.col("depth").alias("more"))
        moved = state.where("to is not null").join(ahead, F.col("to") == F.col("id")).select("call_id", F.col("next").alias("to"), (F.col("depth") + F.col("more")).alias("depth"))
        state = stored(state.where("to is null").unionByName(moved))
    return state.select("call_id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call, with its result, checks and canonical JSON.

    ``calls``: ``conv_id``, ``turn``, ``call_id``, ``tool``, ``arguments`` (JSON),
    ``after`` (the identifier of the call it waits for, or null). ``results``:
    ``call_id``, ``turn``, ``content``. Result: ``conv_id``, ``turn``,
    ``call_id``, ``depth``, ``status``, ``problems`` and ``line``. Sorted by
    ``depth``, every call comes after the one it waits for.

    ``status`` is the first that holds of ``no id``, ``repeated id``, ``circular``, ``invalid``
    (see ``problems``), ``no result`` and ``ok``. Of calls that repeat an
    identifier the one of the smallest conversation and turn counts, nulls first; the others
    are ``repeated id``, each with a row, without depth and result. Of
    results that repeat one the earliest counts, smallest content first in a tie. A result
    without its call is left out. A null identifier links to nothing, and such
    calls give a row each. Lines have sorted keys, no white space and explicit
    nulls; arguments that are no JSON are written as text. Empty tables give an
    empty result; other columns are not looked at.
    """
    columns = ["conv_id", "turn", "tool", "arguments", "after"]
    answers = results.where("call_id is not null").groupBy("call_id").agg(F.min(F.struct("turn", "content")).alias("result"))
    # rows alike are counted before calls of one identifier meet, which may be many
    alike = calls.where("call_id is not null").groupBy("call_id", *columns).agg(F.count("*").alias("times"))
    chosen = stored(alike.groupBy("call_id").agg(F.min(F.struct(*columns)).alias("call"), F.sum("times").alias("times")))
    named = chosen.select("call_id", "call.*")
    placed = named.join(depths(named.select("call_id", "after")), "call_id").join(answers, "call_id", "left")
    several = chosen.where("times > 1").select("call_id", "call")
    other = alike.join(several, "call_id").withColumn("times", F.col("times") - F.col("call").eqNullSafe(F.struct(*columns)).cast("int"))
    other = other.where("times > 0").select("call_id", *columns, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("again"))
    nameless = calls.where("call_id is null").select("call_id", *columns)
    both = placed.unionByName(nameless, allowMissingColumns=True).unionByName(other, allowMissingColumns=True)
    checked = both.withColumn("found", problems(F.col("tool"), F.col("arguments"), schemas))
    status = (
        F.when(F.col("call_id").isNull(), "no id").when(F.col("again").isNotNull(), "repeated id").when(F.col("depth").isNull(), "circular").when(F.size("found") > 0, "invalid")
        .when(F.col("result").isNull(), "no result").otherwise("ok")
    )
    arguments = F.coalesce(F.to_json(F.try_parse_json("arguments")), text_json(F.col("arguments")), F.lit("null"))
    parts = [
        ('{"after":', text_json(F.col("after"))),
        (',"arguments":', arguments),
        (',"id":', text_json(F.col("call_id"))),
        (',"result":', text_json(F.col("result.content"))),
        (',"tool":', text_json(F.col("tool"))),
    ]
    line = reduce(F.concat, [x for name, value in parts for x in (F.lit(name), F.coalesce(value, F.lit("null")))] + [F.lit("}")])
    return checked.select("conv_id", "turn", "call_id", "depth", status.alias("status"), F.array_join("found", "; ").alias("problems"), line.alias("line"))


def text_json(text: F.Column) -> F.Column:
    """A text as a JSON string; null for null."""
    whole = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - F.lit(6)))


#: The tools that turns of a conversation stand for.
TURN_SCHEMAS: Schemas = {
    "instruct": {"text": ("string", True)},
    "reply": {"prompt": ("string", True), "words": ("integer", True)},
}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that turns stand for.

    A system turn calls ``instruct`` and a user turn ``reply``, named by
    conversation and turn; it waits for the turn before it if that calls, and
    else for the one before that. An assistant turn is the result of the turn
    before it. A turn whose conversation or number is null is a call without an
    identifier, or no result; repeated turns are repeated calls; turns of other roles are neither.
    """
    def name(turn: F.Column) -> F.Column:
        return F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    turns = conversations
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    prompt = F.to_json(F.struct(F.col("text").alias("prompt"), words.alias("words")))
    instruct = F.to_json(F.struct("text"))
    is_call = F.col("role").isin("system", "user")
    heads = turns.where(is_call).select(F.col("conv_id").alias("c"), (F.col("turn") + 1).alias("t")).distinct()
    callers = turns.where(is_call).join(heads, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    before = F.when(F.col("c").isNotNull(), F.col("turn") - 1).otherwise(F.col("turn") - 2)
    calls = callers.select(
        "conv_id",
        "turn",
        name(F.col("turn")).alias("call_id"),
        F.when(F.col("role") == "user", "reply").otherwise("instruct").alias("tool"),
        F.when(F.col("role") == "user", prompt).otherwise(instruct).alias("arguments"),
        F.when(before >= 0, name(before)).alias("after"),
    )
    results = turns.where("role = 'assistant' and conv_id is not null and turn is not null").select(name(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results

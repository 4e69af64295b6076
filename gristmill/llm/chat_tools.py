"""Chat formatting with linked tool calls, in DataFrame functions alone.

Calls meet their results in a hash join on (conversation, call id), arguments are
validated against the tools' schemas, calls are ordered so that none precedes a call
it depends on, and every call becomes one line of canonical JSON: keys sorted, no
blanks, numbers in their shortest form.

The order of a conversation is by (``order_position``, ``order_level``, ``call_id``).
A call keeps its own position unless something it depends on stands at or after it; then
it moves to that position, one level further down.  Only such calls take part in the
rounds, so a recorded conversation costs one, however long it is.

Defined results: of several calls under one id the smallest by (position, name,
arguments, dependencies) is taken, of several results the first by (position, content), and
every other one that differs is ``repeated``, a row of its own; a call without
a result is ``no_result``, a result without a call ``no_call``; null ids link with
nothing (``no_id``); arguments that are no JSON object are ``invalid``, null ones are an
empty object; a tool without schema is ``unknown_tool``; a dependency that no call has
is ``unknown_dependency``; calls on a cycle, or after one, are ``cycle``.  Empty tables
give empty results; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import broadcast_below, pick
from gristmill.scratch import materialize

#: JSON schema type to the start of the name that Spark gives such a value.
TYPES = {
    "string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",),
    "array": ("ARRAY",), "object": ("OBJECT",), "null": ("VOID",),
}
#: More tools than this are joined by a shuffle instead of a broadcast.
BROADCAST_TOOLS = 10_000


def canonical(value: Column) -> Column:
    """JSON text with sorted keys and no blanks; NULL where the text is no JSON."""
    return F.to_json(F.try_parse_json(value))


def tool_schemas(schemas: DataFrame) -> DataFrame:
    """Long-form schemas (name, parameter, type, required) to one row per tool."""
    own = pick(schemas, "name", "parameter", "type", "required").dropna(subset=["name", "parameter"])
    own = own.groupBy("name", "parameter").agg(F.min("type").alias("type"), F.max(F.coalesce("required", F.lit(False))).alias("required"))
    return own.groupBy("name").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("parameter", "type")))).alias("types"),
        F.sort_array(F.collect_list(F.when(F.col("required"), F.col("parameter")))).alias("required"),
    ).withColumnRenamed("name", "tool")


def argument_errors(arguments: Column, types: Column, required: Column) -> Column:
    """Sorted messages on missing, unexpected and wrongly typed arguments (a map from name to variant)."""
    names = F.map_keys(arguments)

    def fits(name: Column) -> Column:
        found, wanted = F.schema_of_variant(F.element_at(arguments, name)), F.element_at(types, name)
        any_of = [((wanted == kind) & F.lit(False) if not starts else (wanted == kind) & found.rlike("^(" + "|".join(starts) + ")")) for kind, starts in TYPES.items()]
        out = F.lit(False)
        for condition in any_of:
            out = out | F.coalesce(condition, F.lit(False))
        return out | wanted.isNull()

    missing = F.transform(F.filter(required, lambda p: ~F.array_contains(names, p)), lambda p: F.concat(F.lit("missing "), p))
    unexpected = F.transform(F.filter(names, lambda p: ~F.map_contains_key(types, p)), lambda p: F.concat(F.lit("unexpected "), p))
    wrong = F.transform(F.filter(names, lambda p: F.map_contains_key(types, p) & ~fits(p)), lambda p: F.concat(F.lit("type of "), p))
    return F.sort_array(F.concat(missing, unexpected, wrong))


def ordered(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, order_position, order_level, cyclic) of calls (conv_id, call_id, position, depends_on)."""
    edges = calls.select("conv_id", "call_id", F.explode(F.array_distinct("depends_on")).alias("dependency")).where("dependency IS NOT NULL")
    known = calls.select("conv_id", F.col("call_id").alias("dependency"), F.col("position").alias("of_dependency"))
    edges = materialize(edges.join(known, ["conv_id", "dependency"]).join(
        calls.select("conv_id", "call_id", "position"), ["conv_id", "call_id"]
    ), "chat-edges")
    place = F.struct(F.col("order_position"), F.col("order_level"))
    # calls that move, with their place; all others stay at (position, 0)
    moved = edges.where("of_dependency >= position").groupBy("conv_id", "call_id").agg(
        F.max(F.struct(F.col("of_dependency").alias("order_position"), F.lit(1).cast("long").alias("order_level"))).alias("place")
    ).select("conv_id", "call_id", "place.*", F.lit(False).alias("cyclic"))
    moved = materialize(moved, "chat-moved")
    if moved.isEmpty():
        return calls.select("conv_id", "call_id", F.col("position").alias("order_position"), F.lit(0).cast("long").alias("order_level"), F.lit(False).alias("cyclic"))
    sizes = materialize(calls.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_calls")).join(moved.select("conv_id").distinct(), "conv_id"), "chat-sizes")
    while True:
        before = moved.select("conv_id", F.col("call_id").alias("dependency"), place.alias("after"), F.col("cyclic").alias("after_cycle"))
        own = moved.select("conv_id", "call_id", place.alias("own"), F.col("cyclic").alias("own_cycle"))
        pushed = edges.join(before, ["conv_id", "dependency"]).groupBy("conv_id", "call_id").agg(
            F.max("after").alias("after"), F.max("after_cycle").alias("after_cycle"), F.max("position").alias("position")
        ).join(own, ["conv_id", "call_id"], "left").join(sizes, "conv_id")
        own_place = F.coalesce("own", F.struct(F.col("position").alias("order_position"), F.lit(0).cast("long").alias("order_level")))
        cyclic = F.coalesce("own_cycle", F.lit(False)) | F.col("after_cycle") | (F.col("after.order_level") >= F.col("n_calls"))
        changed = pushed.where(((F.col("after") >= own_place) | F.col("after_cycle")) & ~F.coalesce("own_cycle", F.lit(False))).select(
            "conv_id", "call_id", F.greatest(F.col("after.order_position"), own_place["order_position"]).alias("order_position"),
            F.when(F.col("after") >= own_place, F.col("after.order_level") + 1).otherwise(own_place["order_level"]).alias("order_level"), cyclic.alias("cyclic"),
        )
        changed = materialize(changed, "chat-changed")
        if changed.isEmpty():
            break
        moved = materialize(moved.join(changed, ["conv_id", "call_id"], "left_anti").unionByName(changed), "chat-moved")
    still = calls.select("conv_id", "call_id", "position").join(moved, ["conv_id", "call_id"], "left")
    return still.select(
        "conv_id", "call_id", F.coalesce("order_position", "position").alias("order_position"),
        F.coalesce("order_level", F.lit(0).cast("long")).alias("order_level"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
    )


def _others(rows: DataFrame, kept: DataFrame, value: str) -> DataFrame:
    """Different rows under one id that are not the one taken; only ids with several rows are joined."""
    several = kept.where("n > 1").select("conv_id", "call_id", F.col(value).alias("taken"))
    return rows.join(several, ["conv_id", "call_id"]).where(~F.col(value).eqNullSafe(F.col("taken"))).drop("taken").distinct()


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, order_position, order_level, status, errors, message) for every call and every result without one.

    ``calls``: conv_id, call_id, position, name, arguments (JSON text), depends_on (array of call ids); ``results``:
    conv_id, call_id, position, content; ``schemas``: name, parameter, type, required.
    """
    keys = ["conv_id", "call_id"]
    calls = pick(calls, *keys, "position", "name", "arguments", "depends_on").withColumns({
        "position": F.coalesce(F.col("position").cast("long"), F.lit(0).cast("long")),
        "depends_on": F.coalesce(F.filter("depends_on", lambda d: d.isNotNull()), F.array().cast("array<string>")),
    })
    results = pick(results, *keys, "position", "content")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    loose = calls.where(~named)
    one_call, one_result = F.struct("position", "name", "arguments", "depends_on"), F.struct("position", "content")
    all_calls, all_results = calls.where(named).select(*keys, one_call.alias("c")), results.where(named).select(*keys, one_result.alias("result"))
    smallest = materialize(all_calls.groupBy(*keys).agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n")), "chat-calls")
    first = materialize(all_results.groupBy(*keys).agg(F.min("result").alias("result"), F.count(F.lit(1)).alias("n")), "chat-results")
    calls = smallest.select(*keys, "c.*")
    again = _others(all_calls, smallest, "c").select(*keys, "c.*", F.lit(True).alias("__call"), F.lit(True).alias("again")).unionByName(
        _others(all_results, first, "result").withColumn("again", F.lit(True)), allowMissingColumns=True
    )
    first = first.drop("n")
    places = ordered(calls)
    known = calls.select("conv_id", F.col("call_id").alias("dependency"))
    wanted = calls.select(*keys, F.explode("depends_on").alias("dependency"))
    unknown = wanted.join(known, ["conv_id", "dependency"], "left_anti").select(*keys).distinct().withColumn("unknown", F.lit(True))
    linked = (
        calls.withColumn("__call", F.lit(True)).join(first.hint("shuffle_hash"), keys, "full")
        .join(places, keys, "left").join(unknown, keys, "left")
        .unionByName(loose.withColumn("__call", F.lit(True)), allowMissingColumns=True)
        .unionByName(results.where(~named).select(*keys, one_result.alias("result")), allowMissingColumns=True)
        .unionByName(again, allowMissingColumns=True)
    )
    linked = linked.join(broadcast_below(tool_schemas(schemas), BROADCAST_TOOLS), F.col("name") == F.col("tool"), "left")
    linked = linked.withColumn("parsed", F.try_parse_json(F.coalesce("arguments", F.lit("{}"))))
    is_object = F.coalesce(F.schema_of_variant("parsed").startswith("OBJECT"), F.lit(False))
    linked = linked.withColumn("given", F.when(is_object, F.from_json(F.to_json("parsed"), "map<string,variant>")))
    errors = F.when(F.col("given").isNull(), F.array(F.lit("arguments are no JSON object"))).when(
        F.col("tool").isNull(), F.array().cast("array<string>")
    ).otherwise(argument_errors(F.col("given"), F.col("types"), F.col("required")))
    linked = linked.withColumn("errors", F.when(F.col("__call") & F.col("again").isNull(), errors).otherwise(F.array().cast("array<string>")))
    status = (
        F.when(~named, "no_id").when(F.col("again"), "repeated").when(F.col("__call").isNull(), "no_call").when(F.col("cyclic"), "cycle")
        .when(F.col("unknown"), "unknown_dependency").when(F.col("tool").isNull(), "unknown_tool").when(F.size("errors") > 0, "invalid")
        .when(F.col("result").isNull(), "no_result").otherwise("ok")
    )
    # fields in the order of their names; the arguments are JSON already and stay so
    line = F.to_json(F.struct(
        F.when(F.col("__call") & F.col("given").isNotNull(), F.col("parsed")).alias("arguments"), F.array_sort("depends_on").alias("depends_on"),
        F.col("call_id").alias("id"), F.col("name"), F.col("result.content").alias("result"),
    ), {"ignoreNullFields": "true"})
    return linked.select(
        *keys, F.coalesce("order_position", "position", F.col("result.position").cast("long")).alias("order_position"),
        F.coalesce("order_level", F.lit(0).cast("long")).alias("order_level"), status.alias("status"), "errors", line.alias("message"),
    )


def plain_messages(turns: DataFrame) -> DataFrame:
    """Turns that are neither call nor result as lines of canonical JSON, in the columns of ``link_calls``."""
    own = pick(turns, "conv_id", "position", "role", "content")
    return own.select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), F.col("position").cast("long").alias("order_position"),
        F.lit(0).cast("long").alias("order_level"), F.lit("message").alias("status"), F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct("content", "role"), {"ignoreNullFields": "true"}).alias("message"),
    )

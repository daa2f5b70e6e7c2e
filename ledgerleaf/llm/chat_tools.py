"""Tool-call linking for chat data, DataFrame functions only.

Calls and results meet in hash joins by (conv_id, call_id); results are combined per identifier before they are
shuffled. A call may name the call it builds on (parent_id): depths come from pointer doubling, in which every call
jumps over as many ancestors as it knows, so a chain of n calls takes log2(n) joins. ``position`` is a topological order of
each conversation: how many of its rows come before by (depth, turn, call_id). It is counted over ranges of the sorted
rows, so a conversation with a third of all rows is no single window. Arguments are parsed once to a variant, whose fields stand in sorted order: types are
checked against the tool's schema on it and the canonical JSON is written from it.

Defined cases (column ``status``): ``linked``, ``no_result``, ``cycle`` (its ancestors never end: depth null) and
``repeated`` (not the first row of its identifier, by turn and then arguments: keeps its own row, gets no result); of
results, ``orphan_result`` (no call has its identifier, or that is null) and ``further_result`` (a later one than the
call's; one equal to it is only counted). A parent that is no call makes a root with ``parent_missing``. Arguments that
are null or no JSON object, or repeat a key of one object, are one error and are written as null, as are those with a number
that can't be written again exactly: more than 38 digits or, with an exponent, more than 15 or a value beyond the normal
doubles. Numbers without an exponent lose their last zeros (1.10 is 1.1 and 1.0 is 1, an integer), those with one are
written as doubles (1e2 is 100.0). Rows with a null identifier never link; those of a null
conversation have no position. Rows with depth null come last; rows of one depth, turn and call_id share a position.
Empty tables give an empty result. Only the named columns are read, so extra columns don't matter.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, save

#: tool -> field -> (type, required); types: string, integer, number, boolean, array, object
Schemas = dict[str, dict[str, tuple[str, bool]]]
_TYPES = {"string": "STRING$", "integer": r"(BIGINT|DECIMAL\(\d+,0\))$", "number": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$", "boolean": "BOOLEAN$", "array": "ARRAY<.*", "object": "OBJECT<.*"}
KEY = ["conv_id", "call_id"]


def exact(arguments: Column) -> Column:
    """Whether the numbers of a JSON text are held exactly once parsed."""
    bare = F.regexp_replace(F.regexp_replace(arguments, r"(?s)\\.", ""), '"[^"]*"', "")  # without strings
    numbers = F.regexp_extract_all(bare, F.lit(r"-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?"), 0)

    def inexact(x: Column) -> Column:
        mantissa, size = F.regexp_replace(x, "[eE].*", ""), F.abs(x.try_cast("double"))
        digits = F.length(F.translate(mantissa, "-.", ""))
        return F.when(x.rlike("[eE]"), (digits > 15) | (size == float("inf")) | (mantissa.rlike("[1-9]") & (size < 2.0**-1022))).otherwise(digits > 38)

    return ~F.exists(numbers, inexact)


def argument_errors(arguments: Column, value: Column, name: Column, schemas: Schemas) -> Column:
    """Messages, in the order of the schema; empty if the arguments are valid."""
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    found = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, fields in schemas.items():
        checks = []
        for field, (kind, required) in fields.items():
            has = F.array_contains(F.json_object_keys(arguments), field)
            fits = F.coalesce(F.schema_of_variant(F.try_variant_get(value, "$[%s]" % json.dumps(field), "variant")).rlike(f"^{_TYPES[kind]}"), F.lit(False))
            checks.append(F.when(~has, f"{field}: missing" if required else None).when(~fits, f"{field}: not {kind}"))
        unknown = F.transform(F.array_sort(F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, fields)))), lambda x: F.concat(x, F.lit(": unknown")))
        found = F.when(name == tool, F.concat(F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"), unknown)).otherwise(found)
    return F.when(is_object & exact(arguments), found).when(is_object, F.array(F.lit("arguments: number not exact"))).otherwise(F.array(F.lit("arguments: not an object")))


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, parent_id) with unique keys -> (conv_id, call_id, depth, parent_missing); depth null: on or behind a cycle."""
    known = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("_is"))
    at = calls.join(known, ["conv_id", "parent_id"], "left").select(
        *KEY,
        F.when(F.col("_is"), F.col("parent_id")).alias("up"),
        F.col("_is").isNotNull().cast("long").alias("depth"),
        (F.col("parent_id").isNotNull() & F.col("_is").isNull()).alias("parent_missing"),
    )
    at, open_ = save(at, "call-depths"), None
    while True:
        left = at.where("up IS NOT NULL").count()
        if left in (0, open_):
            break
        open_ = left
        above = at.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        done = at.where("up IS NULL")
        moved = at.where("up IS NOT NULL").join(above, ["conv_id", "up"]).select(*KEY, F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), "parent_missing")
        before, at = at, save(done.unionByName(moved), "call-depths")
        discard(before)
    return at.select(*KEY, F.when(F.col("up").isNull(), F.col("depth")).alias("depth"), "parent_missing")


def positions(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, turn, call_id) -> the same once each, with position: rows of the conversation that come before."""
    order = [F.col("conv_id"), F.col("depth").asc_nulls_last(), F.col("turn"), F.col("call_id")]
    groups = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id", "depth", "turn", "call_id").agg(F.count(F.lit(1)).alias("n"))
    ranged = groups.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    ranged = save(ranged, "call-order")
    inside = F.sum("n").over(W.partitionBy("part", "conv_id").orderBy("at")) - F.col("n")
    base = ranged.groupBy("conv_id", "part").agg(F.sum("n").alias("sum"))
    base = base.withColumn("base", F.sum("sum").over(W.partitionBy("conv_id").orderBy("part")) - F.col("sum")).drop("sum")
    return ranged.withColumn("inside", inside).join(base, ["conv_id", "part"]).select("conv_id", "depth", "turn", "call_id", (F.col("base") + F.col("inside")).alias("position"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """calls (conv_id, call_id, parent_id, turn, name, arguments) and results (conv_id, call_id, turn, content) -> one row per call, and per result that no call shows.

    Returns conv_id, call_id, turn, position, name, depth, status, parent_missing, n_results, valid, errors and json, the
    canonical message: sorted keys, no spaces, nulls kept. Of several results the one with the smallest turn, then
    content, is the call's.
    """
    calls = calls.select(*KEY, "parent_id", F.col("turn").cast("long").alias("turn"), "name", "arguments")
    results = results.select(*KEY, F.col("turn").cast("long").alias("turn"), "content")
    order = F.struct(F.col("turn"), F.coalesce("arguments", F.lit("")), F.coalesce("parent_id", F.lit("")), F.coalesce("name", F.lit("")))
    named = calls.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    first = named.groupBy(*KEY).agg(F.min(order).alias("_first"), F.min_by("parent_id", order).alias("parent_id"))
    first = save(first, "calls")
    place = F.struct("turn", F.coalesce("content", F.lit("")))
    found = results.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_results"), F.min_by("content", place).alias("result"), F.min(place).alias("_place"))
    facts = first.select(*KEY, "_first").join(depths(first.select(*KEY, "parent_id")).hint("shuffle_hash"), KEY).join(found.drop("_place").hint("shuffle_hash"), KEY, "left")
    all_calls = calls.withColumns({"_own": order, "_value": F.try_parse_json("arguments")})
    linked = all_calls.join(facts.hint("shuffle_hash"), KEY, "left").withColumns({"_head": F.col("_own") == F.col("_first")})
    again = F.col("_first").isNotNull() & ~F.col("_head")
    status = F.when(again, "repeated").when(F.col("_first").isNotNull() & F.col("depth").isNull(), "cycle").when(F.col("n_results") > 0, "linked").otherwise("no_result")
    errors = argument_errors(F.col("arguments"), F.col("_value"), F.col("name"), schemas)
    value = F.when(F.schema_of_variant("_value").startswith("OBJECT<") & exact(F.col("arguments")), F.col("_value"))
    out = linked.withColumns(
        {
            "status": status,
            "n_results": F.when(again, F.lit(0)).otherwise(F.coalesce("n_results", F.lit(0))).cast("long"),
            "result": F.when(~again, F.col("result")),
            "parent_missing": F.coalesce("parent_missing", F.lit(False)),
            "errors": errors,
            "_value": value,
        }
    ).select(*KEY, "turn", "name", "depth", "status", "parent_missing", "n_results", "errors", "_value", "result")
    shape = lambda df, status, error: df.select(
        *KEY, "turn", F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("depth"), F.lit(status).alias("status"), F.lit(False).alias("parent_missing"),
        F.lit(0).cast("long").alias("n_results"), F.array(F.lit(error)).alias("errors"), F.parse_json(F.lit("null")).alias("_value"), F.col("content").alias("result"),
    )
    known = first.select(*KEY)
    orphans = shape(results.join(known.hint("shuffle_hash"), KEY, "left_anti"), "orphan_result", "result: no call")
    several = found.where("n_results > 1").join(known, KEY).select(*KEY, "_place")
    further = shape(results.join(several.hint("shuffle_hash"), KEY).where(place > F.col("_place")), "further_result", "result: not the first")
    every = out.unionByName(orphans).unionByName(further)
    placed = positions(every.select("conv_id", "depth", "turn", "call_id"))
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("depth", "turn", "call_id")]
    met = every.alias("e").join(placed.alias("p").hint("shuffle_hash"), [F.col("e.conv_id") == F.col("p.conv_id"), *same], "left").select("e.*", "p.position")
    message = F.struct(F.when(F.schema_of_variant("_value").startswith("OBJECT<"), F.col("_value")).alias("arguments"), "call_id", "conv_id", "depth", "name", F.col("result"), "status", "turn")
    return met.select(*KEY, "turn", "position", "name", "depth", "status", "parent_missing", "n_results", (F.size("errors") == 0).alias("valid"), "errors", F.to_json(message, {"ignoreNullFields": "false"}).alias("json"))

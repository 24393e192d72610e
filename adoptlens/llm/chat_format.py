"""Operator 1, chat formatting, in DataFrame functions alone: tool calls and their results.

Calls and results are joined by identifier (conversation and call). A call may name the call
it follows; depths along these names give a topological order, found by pointer jumping, so
the rounds grow with the logarithm of the longest chain and no conversation is gathered.
Arguments are checked against the tool's schema and the pair is written as canonical JSON
(sorted keys, no spaces).

Null conversation or call ids count as equal to each other, like a value of their own.
``link_every`` keeps each distinct call and result, and marks shared identifiers and results
without a call as errors. ``link_calls`` settles identifiers: of several calls (results) with
one the one with the smallest arguments (content) counts, a null call id is the empty one, and
a result without a call is left out. A call without a result has a null content; a call that
follows an unknown call has depth 0; calls in a circle have a null depth and the
error ``circle``; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptlens.llm.tables import stored

#: Tool name -> argument -> (type as ``schema_of_variant`` names it, required).
Schemas = dict[str, dict[str, tuple[str, bool]]]


def _errors(schemas: Schemas) -> Column:
    """What is wrong with ``parsed`` arguments of tool ``name``; null if nothing."""
    found = F.when(F.col("parsed").isNull(), F.lit("not JSON"))
    for tool, arguments in sorted(schemas.items()):
        of_tool = F.col("name") == tool
        for argument, (kind, required) in sorted(arguments.items()):
            value = F.try_variant_get("parsed", f"$.{argument}", "variant")
            if required:
                found = found.when(of_tool & value.isNull(), F.lit(f"{argument} is missing"))
            found = found.when(of_tool & value.isNotNull() & (F.schema_of_variant(value) != kind), F.lit(f"{argument} is not {kind}"))
    known = F.col("name").isin(sorted(schemas))
    return found.when(~F.coalesce(known, F.lit(False)), F.lit("unknown tool"))


def _depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) from (conv_id, call_id, after)."""
    known = calls.select(F.col("conv_id").alias("conv_above"), F.col("call_id").alias("above"), F.lit(True).alias("there"))
    state = calls.join(known, F.col("conv_id").eqNullSafe(F.col("conv_above")) & (F.col("after") == F.col("above")), "left")
    state = stored(state.select("conv_id", "call_id", F.when(F.col("there"), F.col("after")).alias("up"), F.when(F.col("there"), 1).otherwise(0).alias("depth")), "call-depths")
    open_, total, reach = state.where("up is not null").count(), state.count(), 1
    while open_ and reach <= total:  # a chain that is longer than all calls is a circle
        above = state.select(F.col("conv_id").alias("conv_above"), F.col("call_id").alias("above"), F.col("up").alias("next"), F.col("depth").alias("more"))
        jump = F.col("conv_id").eqNullSafe(F.col("conv_above")) & (F.col("up") == F.col("above"))
        state = state.join(above, jump, "left").select("conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        state = stored(state, "call-depths")
        open_, reach = state.where("up is not null").count(), reach * 2
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def _written(linked: DataFrame, schemas: Schemas, shared: Column | None = None) -> DataFrame:
    """Rows of calls with their results as they are returned; ``shared``: an error that goes before others."""
    linked = linked.withColumn("parsed", F.try_parse_json("arguments"))
    error = F.coalesce(F.when(F.col("depth").isNull(), F.lit("circle")), _errors(schemas))
    error = error if shared is None else F.coalesce(shared, error)
    call = F.to_json(F.struct(F.col("call_id").alias("id"), F.col("name")), {"ignoreNullFields": "false"})
    arguments = F.coalesce(F.to_json("parsed"), F.to_json(F.struct(F.col("arguments").alias("raw")), {"ignoreNullFields": "false"}))
    content = F.to_json(F.struct("content"), {"ignoreNullFields": "false"})
    message = F.concat(F.lit('{"arguments":'), arguments, F.lit(","), F.substr(content, F.lit(2), F.length(content) - 2), F.lit(","), F.substr(call, F.lit(2)))
    return linked.select("conv_id", "call_id", "name", F.col("depth").cast("long").alias("depth"), error.alias("error"), F.coalesce("has_result", F.lit(False)).alias("has_result"), message.alias("message"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call: depth, error, whether it has a result, and the canonical JSON.

    ``calls``: conv_id, call_id, name, arguments (JSON text), after (call_id or null).
    ``results``: conv_id, call_id, content. Reading calls by depth, then by id, is a
    topological order.
    """
    calls = calls.groupBy("conv_id", F.coalesce("call_id", F.lit("")).alias("call_id")).agg(F.min(F.struct("arguments", "name", "after")).alias("c")).select("conv_id", "call_id", "c.*")
    results = results.groupBy(F.col("conv_id").alias("conv"), F.coalesce("call_id", F.lit("")).alias("of")).agg(F.min("content").alias("content")).withColumn("has_result", F.lit(True))
    calls = stored(calls, "calls")
    depths = _depths(calls.select("conv_id", "call_id", "after")).select(F.col("conv_id").alias("conv_of"), F.col("call_id").alias("id_of"), "depth")
    # repeated identifiers are gone, so no key has more than one row on either side
    linked = calls.join(results.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("call_id") == F.col("of")), "left")
    linked = linked.join(depths, F.col("conv_id").eqNullSafe(F.col("conv_of")) & (F.col("call_id") == F.col("id_of")), "left")
    return _written(linked, schemas)


def link_every(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """As ``link_calls``, with every distinct call and result; only rows equal throughout are settled.

    Each call has a row, with its identifier's smallest content. Each further result has a row
    without a name, arguments or depth. Where several calls or results share an identifier,
    all their rows have the error ``repeated id``, and they share the depth of the call with the
    smallest arguments; results of unknown calls have ``result without a call``.
    """
    ids = ["conv_id", "call_id"]
    calls = stored(calls.select(*ids, "name", "arguments", "after").distinct(), "calls")
    results = stored(results.select(*ids, "content").distinct(), "results")
    called = calls.groupBy(*ids).agg(F.min(F.struct("arguments", "name", "after")).alias("c"), F.count("*").alias("n_calls"))
    called = stored(called.select(*ids, "c.after", "n_calls"), "called")
    answered = results.groupBy(F.col("conv_id").alias("conv"), F.col("call_id").alias("of")).agg(F.min("content").alias("least"), F.count("*").alias("n_results"))
    depths = _depths(called.select(*ids, "after")).select(F.col("conv_id").alias("conv_of"), F.col("call_id").alias("id_of"), "depth")
    known = called.join(depths, F.col("conv_id").eqNullSafe(F.col("conv_of")) & F.col("call_id").eqNullSafe(F.col("id_of")), "left").drop("after", "conv_of", "id_of")
    known = known.join(answered, F.col("conv_id").eqNullSafe(F.col("conv")) & F.col("call_id").eqNullSafe(F.col("of")), "full")
    # one row per identifier of calls or results
    by_id = stored(known.select(
        F.when(F.col("n_calls").isNull(), F.col("conv")).otherwise(F.col("conv_id")).alias("conv"), F.when(F.col("n_calls").isNull(), F.col("of")).otherwise(F.col("call_id")).alias("of"),
        "depth", "n_calls", "n_results", "least"), "identifiers")
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & F.col("call_id").eqNullSafe(F.col("of"))
    shared = F.when(F.col("n_calls").isNull(), F.lit("result without a call")).when((F.col("n_calls") > 1) | (F.col("n_results") > 1), F.lit("repeated id"))
    linked = calls.join(by_id.hint("shuffle_hash"), same).withColumns({"content": F.col("least"), "has_result": F.col("n_results").isNotNull()})
    further = results.join(by_id.hint("shuffle_hash"), same).where(F.col("n_calls").isNull() | ~F.col("content").eqNullSafe(F.col("least")))
    none = F.lit(None).cast("string")
    further = further.withColumns({"name": none, "arguments": none, "depth": F.lit(None).cast("int"), "has_result": F.lit(True)})
    columns = ["conv_id", "call_id", "name", "arguments", "content", "depth", "has_result", "n_calls", "n_results"]
    return _written(linked.select(*columns).unionByName(further.select(*columns)), schemas, shared)

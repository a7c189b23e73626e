"""Where a call's arguments came from, what steps depend on, and the event view of a trace."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.operators.mentions import first_mentions


def argument_sources(arguments: DataFrame, results: DataFrame, requests: DataFrame, defaults: DataFrame, fallback: str = "generated") -> DataFrame:
    """conv_id, step, name, value, source, source_endpoint, evidence.

    ``arguments``: conv_id, step, turn (of the call), endpoint_id, name, value. ``results``: conv_id, step, endpoint_id, ord, path, value.
    ``requests``: conv_id, turn, text (a user's; only those of turns before the call count). ``defaults``: endpoint_id, name, default.
    The latest earlier result with the value wins, its first path first: an as-of lookup, which is one
    window over (conversation, value) and never pairs arguments with results.
    """
    if "turn" not in arguments.columns:  # all messages come before
        arguments = arguments.withColumn("turn", F.lit(1 << 62))
    a = arguments.withColumn("value", F.trim("value")).where("value is not null")
    shown = results.withColumn("value", F.trim("value")).groupBy("conv_id", "value", "step").agg(F.min_by(F.struct("endpoint_id", "path"), "ord").alias("seen"))
    both = a.select("conv_id", "value", "step", "turn", F.lit(0).alias("kind"), "endpoint_id", "name", F.lit(None).cast(shown.schema["seen"].dataType).alias("seen")).union(
        shown.select("conv_id", "value", "step", F.lit(None).cast("long"), F.lit(1), F.lit(None).cast("string"), F.lit(None).cast("string"), "seen")
    )  # an argument sorts before the result of its own step
    w = Window.partitionBy("conv_id", "value").orderBy("step", "kind").rowsBetween(Window.unboundedPreceding, -1)
    a = both.withColumn("seen", F.last("seen", ignorenulls=True).over(w)).where("kind = 0").drop("kind")
    a = a.withColumn("seen", F.when(F.col("value") != "", F.col("seen")))
    said = first_mentions(a.where("seen is null and value <> ''").select("conv_id", "value"), requests).select("conv_id", "needle", F.col("turn").alias("said"))
    a = a.withColumn("needle", F.lower("value")).join(said, ["conv_id", "needle"], "left").withColumn("said", F.coalesce(F.col("said") < F.col("turn"), F.lit(False)))
    a = a.join(defaults.where("coalesce(default, '') <> ''"), ["endpoint_id", "name"], "left")
    source = F.when(F.col("seen").isNotNull(), "previous_tool_result").when(F.col("said"), "user_request").when(F.col("default") == F.col("value"), "tool_default").otherwise(fallback)
    evidence = (
        F.when(F.col("seen").isNotNull(), F.concat(F.lit("matched "), F.col("seen.path"), F.lit(" from "), F.col("seen.endpoint_id")))
        .when(F.col("said"), "value appeared in a prior user message")
        .when(F.col("default") == F.col("value"), F.concat(F.lit("default value for parameter "), F.col("name")))
        .otherwise("filled from the sampled schema and generator policy")
    )
    return a.select("conv_id", "step", "name", "value", source.alias("source"), F.col("seen.endpoint_id").alias("source_endpoint"), evidence.alias("evidence"))


def dependencies(sources: DataFrame) -> DataFrame:
    """conv_id, step, depends_on: distinct source endpoints of a step, in the order of its arguments' names."""
    x = F.array_sort(F.collect_list(F.struct("name", "source_endpoint")))
    g = sources.where("source_endpoint is not null").groupBy("conv_id", "step").agg(x.alias("x"))
    return g.select("conv_id", "step", F.array_join(F.array_distinct(F.transform("x", lambda s: s["source_endpoint"])), ",").alias("depends_on"))


def events(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_id, ord, kind, endpoint_id, relation, status: calls in order with the graph's relation to the one before.

    A call after another that no edge explains has the status warn; each conversation ends with a judge event.
    """
    w = Window.partitionBy("conv_id").orderBy("step")
    c = calls.select("conv_id", "step", "endpoint_id", F.lag("endpoint_id").over(w).alias("before"))
    e = edges.select(F.col("source").alias("before"), F.col("target").alias("endpoint_id"), "edge_type")
    c = c.join(e, ["before", "endpoint_id"], "left")
    status = F.when(F.col("before").isNull() | F.col("edge_type").isNotNull(), "ok").otherwise("warn")
    relation = F.when(F.col("before").isNull(), "start").otherwise(F.coalesce("edge_type", F.lit("none")))
    call = c.select("conv_id", F.col("step").alias("ord"), F.lit("tool_call").alias("kind"), "endpoint_id", relation.alias("relation"), status.alias("status"))
    tail = calls.groupBy("conv_id").agg((F.max("step") + 1).alias("ord")).select("conv_id", "ord", F.lit("judge"), F.lit(""), F.lit("end"), F.lit("ok"))
    return call.union(tail)


def filter_conversations(calls: DataFrame, text: str, tools: list[str], every: bool) -> DataFrame:
    """conv_id of conversations with the text in one of their endpoints and any, or all, of the tools."""
    wanted = F.array(*map(F.lit, tools)).cast("array<string>")
    c = calls.groupBy("conv_id").agg(F.collect_set("tool").alias("tools"), F.bool_or(F.lower("endpoint_id").contains(text.lower())).alias("hit"))
    match = F.lit(True) if not tools else F.size(F.array_except(wanted, "tools")) == 0 if every else F.arrays_overlap(wanted, "tools")
    return c.where(F.col("hit") & match).select("conv_id")


def tool_options(calls: DataFrame) -> DataFrame:
    """endpoint_id, n, rank: the choices of a filter, commonest first."""
    n = calls.groupBy("endpoint_id").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "endpoint_id")).cast("long"))  # a row an endpoint

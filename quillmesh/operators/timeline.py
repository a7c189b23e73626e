"""The event view of whole conversations: messages, calls with their responses, judge and repair, and the figures over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import labels

#: Where an event stands within its turn: the text of a message, then its calls; judge and repair come last.
TEXT, CALL, JUDGE, REPAIR = 0, 1, 1 << 20, (1 << 20) + 1


def responses(messages: DataFrame, calls: DataFrame) -> DataFrame:
    """The calls (conv_id, turn, idx, ...) with ``response``: of the tool messages that follow, the one at the call's own index, else the first."""
    turn = Window.partitionBy("conv_id").orderBy("turn")
    tools = messages.where("role = 'tool'").select("conv_id", "turn", "content", F.row_number().over(turn).alias("nth"))
    marks = tools.select("conv_id", "turn", F.lit(1).alias("tool")).union(calls.select("conv_id", "turn", F.lit(0)).distinct())
    before = marks.withColumn("before", F.sum("tool").over(turn)).where("tool = 0").select("conv_id", "turn", "before")
    at = lambda name: tools.select("conv_id", F.col("nth").alias(f"{name}_nth"), F.col("content").alias(name))
    c = calls.join(before, ["conv_id", "turn"]).withColumn("own_nth", F.col("before") + F.col("idx") + 1).withColumn("first_nth", F.col("before") + 1)
    c = c.join(at("own"), ["conv_id", "own_nth"], "left").join(at("first"), ["conv_id", "first_nth"], "left")
    return c.select(*calls.columns, F.coalesce("own", "first").alias("response"))


def grounded(calls: DataFrame, shown: DataFrame) -> DataFrame:
    """The calls with ``grounded``: which of their values (array) stood in a tool message (``shown``: conv_id, turn, value) before them, in their order."""
    first = shown.groupBy("conv_id", "value").agg(F.min("turn").alias("since"))
    one = calls.select("conv_id", "turn", "idx", F.posexplode("values").alias("pos", "value")).join(first, ["conv_id", "value"]).where("since < turn")
    found = one.groupBy("conv_id", "turn", "idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("grounded"))
    return calls.join(found, ["conv_id", "turn", "idx"], "left").withColumn("grounded", F.coalesce("grounded", F.array().cast("array<string>")))


def with_steps(calls: DataFrame, steps: DataFrame) -> DataFrame:
    """The calls with ``goal`` of the recorded step (conv_id, ord from 0, endpoint_id, goal) at their own place, else of the first step of their endpoint."""
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "idx")) - 1
    by_place = steps.select("conv_id", F.col("ord").alias("nth"), F.col("goal").alias("by_place"))
    by_name = steps.groupBy("conv_id", "endpoint_id").agg(F.min_by("goal", "ord").alias("by_name"))
    c = calls.withColumn("nth", nth.cast("long")).join(by_place, ["conv_id", "nth"], "left").join(by_name, ["conv_id", "endpoint_id"], "left")
    return c.select(*calls.columns, F.coalesce("by_place", "by_name").alias("goal"))


def timeline(messages: DataFrame, calls: DataFrame, shown: DataFrame, edges: DataFrame, steps: DataFrame, scores: DataFrame) -> DataFrame:
    """conv_id, ord, turn, kind, status, label, subtitle, endpoint_id, response, grounded, goal: all events of each conversation in order.

    ``messages``: conv_id, turn, role, content. ``calls``: conv_id, turn, idx, endpoint_id, values. ``edges``: source,
    target, edge_type. ``scores``: conv_id, overall, correctness, repairs. A conversation's events stay together in windows, as one dialogue has few.
    """
    none = lambda kind="string": F.lit(None).cast(kind)
    text = F.col("content")
    order = Window.partitionBy("conv_id").orderBy("turn", "idx")
    # In this order what a step reads twice, for the keys of its calls, is no result of joins.
    c = with_steps(responses(messages, grounded(calls, shown)), steps).withColumn("before", F.lag("endpoint_id").over(order))
    e = edges.select(F.col("source").alias("before"), F.col("target").alias("endpoint_id"), "edge_type")
    c = c.join(e, ["before", "endpoint_id"], "left")
    started = F.col("before").isNull()
    how = F.when(F.col("edge_type").isNotNull(), F.concat("edge_type", F.lit(" from "), labels.short_endpoint(F.col("before")))).when(started, "first tool call in trace").otherwise("no graph edge from previous tool")
    call = c.select(
        "conv_id", "turn", (F.lit(CALL) + F.col("idx")).alias("slot"), F.lit("tool_call").alias("kind"), F.when(started | F.col("edge_type").isNotNull(), "ok").otherwise("warn").alias("status"),
        F.concat(F.lit("function_call: "), labels.short_endpoint(F.col("endpoint_id"))).alias("label"), how.alias("subtitle"), "endpoint_id", "response", F.array_join("grounded", ",").alias("grounded"), "goal",
    )
    # A tool message belongs to the last call before it.
    last = messages.where("role = 'tool'").select("conv_id", "turn", "content", F.lit(1 << 19).alias("idx"), none().alias("endpoint_id"), F.lit(True).alias("tool")).union(calls.select("conv_id", "turn", none(), "idx", "endpoint_id", F.lit(False)))
    last = last.withColumn("endpoint_id", F.last("endpoint_id", ignorenulls=True).over(order)).where("tool")
    said = lambda rows, kind, status, label, endpoint, answer: rows.select("conv_id", "turn", F.lit(TEXT).alias("slot"), F.lit(kind).alias("kind"), F.lit(status).alias("status"), F.lit(label).alias("label"), labels.truncate(F.coalesce(text, F.lit("")), 88).alias("subtitle"), endpoint, answer, none().alias("grounded"), none().alias("goal"))
    user = said(messages.where("role = 'user'"), "user", "info", "user message", none(), none())
    assistant = said(messages.where("role = 'assistant' and coalesce(content, '') <> ''"), "assistant", "ok", "assistant response", none(), none())
    response = said(last, "tool_response", "ok", "function_response", F.col("endpoint_id"), text)
    end = messages.groupBy("conv_id").agg(F.max("turn").alias("turn")).join(scores, "conv_id", "left").withColumn("overall", F.coalesce("overall", F.lit(0.0))).withColumn("correctness", F.coalesce("correctness", F.lit(0.0)))
    verdict = F.when(F.col("overall") >= 4.5, "ok").when(F.col("overall") >= 3.5, "warn").otherwise("error")
    figures = F.concat(F.lit("overall "), labels.fixed(F.col("overall"), 2), F.lit(" | correctness "), labels.fixed(F.col("correctness"), 2))
    judge = end.select("conv_id", "turn", F.lit(JUDGE), F.lit("judge"), verdict, F.lit("judge scores"), figures, none(), none(), none(), none())
    times = F.concat(F.col("repairs").cast("string"), F.lit(" repair attempt"), F.when(F.col("repairs") == 1, "").otherwise("s"), F.lit(" recorded"))
    repair = end.where("repairs > 0").select("conv_id", "turn", F.lit(REPAIR), F.lit("repair"), F.lit("warn"), F.lit("repair attempts"), times, none(), none(), none(), none())
    every = call.union(user).union(assistant).union(response).union(judge).union(repair)
    ord_ = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "slot")).cast("long")
    return every.select("conv_id", ord_.alias("ord"), "turn", "kind", "status", "label", "subtitle", "endpoint_id", "response", "grounded", "goal")


def trace_counts(events: DataFrame) -> DataFrame:
    """conv_id, events, tool_calls, warnings."""
    return events.groupBy("conv_id").agg(F.count("*").alias("events"), F.count_if(F.col("kind") == "tool_call").alias("tool_calls"), F.count_if(F.col("status") == "warn").alias("warnings"))


def needs_review(score: Column, repairs: Column) -> Column:
    return (F.coalesce(score, F.lit(0.0)) < 4.5) | (F.coalesce(repairs, F.lit(0)) > 0)


def dashboard_metrics(conversations: DataFrame) -> DataFrame:
    """total_conversations, total_tool_calls, mean_score (of scores over 0), review_count: ``conversations`` has num_tool_calls, overall, repairs."""
    mean = F.coalesce(F.avg(F.when(F.col("overall") > 0, F.col("overall"))), F.lit(0.0))
    return conversations.agg(F.count("*").alias("total_conversations"), F.coalesce(F.sum("num_tool_calls"), F.lit(0)).alias("total_tool_calls"), F.round(mean, 4).alias("mean_score"), F.count_if(needs_review(F.col("overall"), F.col("repairs"))).alias("review_count"))


def conversation_summary(conversations: DataFrame) -> DataFrame:
    """total, multi_step_share (of 3 calls and 2 tools at least), avg_score (of those that have one), repaired, avg_turns, avg_tool_calls, avg_distinct_tools."""
    many = F.count_if((F.col("num_tool_calls") >= 3) & (F.col("num_distinct_tools") >= 2))
    avg = lambda c: F.round(F.avg(c), 4).alias(f"avg_{c.removeprefix('num_')}")
    return conversations.agg(F.count("*").alias("total"), F.round(100 * many / F.count("*"), 2).alias("multi_step_share"), F.round(F.avg("overall"), 4).alias("avg_score"), F.count_if(F.col("repairs") > 0).alias("repaired"), avg("num_turns"), avg("num_tool_calls"), avg("num_distinct_tools"))


def search(conversations: DataFrame, needle: str, tools: list[str], every: bool = False) -> DataFrame:
    """conv_id of conversations with the text anywhere in their id, pattern, tools or domains, and any, or all, of the tools."""
    hay = F.lower(F.concat_ws(" ", F.col("conv_id").cast("string"), "pattern", "tools_used", "domains"))
    wanted = F.array(*map(F.lit, tools)).cast("array<string>")
    match = F.lit(True) if not tools else F.size(F.array_except(wanted, "tools_used")) == 0 if every else F.arrays_overlap(wanted, "tools_used")
    return conversations.where(hay.contains(needle.strip().lower()) & match).select("conv_id")

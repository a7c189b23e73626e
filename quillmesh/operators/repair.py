"""Structural repair of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROLES = ["user", "assistant", "tool", "system"]


def valid(messages: DataFrame) -> DataFrame:
    """Without unknown roles, empty user turns, and assistant turns that neither say nor call anything."""
    calls = F.col("calls") if "calls" in messages.columns else F.lit(0)
    silent = (F.col("role") == "assistant") & F.col("text").isNull() & (F.coalesce(calls, F.lit(0)) == 0)
    return messages.where(F.col("role").isin(ROLES) & ~silent & ~((F.col("role") == "user") & (F.coalesce("text", F.lit("")) == "")))


def merged(messages: DataFrame) -> DataFrame:
    """Runs of one role become one turn, texts joined by line feeds; tool results stay apart.

    Runs are islands: a turn begins one where the role differs from the turn before. For messages
    that all have text and no calls, which need no fold.
    """
    w = Window.partitionBy("conv_id").orderBy("turn")
    new = F.when(F.coalesce(F.lag("role").over(w), F.lit("")) != F.col("role"), 1).otherwise((F.col("role") == "tool").cast("int"))
    m = messages.withColumn("_new", new).withColumn("island", F.sum("_new").over(w))
    g = m.groupBy("conv_id", "island").agg(F.min("turn").alias("turn"), F.first("role").alias("role"), F.count("*").alias("parts"), F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    return g.select("conv_id", "turn", "role", "parts", F.array_join(F.transform("x", lambda x: x["text"]), "\n").alias("text"))


def folded(messages: DataFrame) -> DataFrame:
    """The full rule, where turns may have calls: (conv_id, turn, role, text, calls); needs valid messages.

    A turn after one of its own role is kept if it is a tool's, or an assistant's text after calls; else the
    texts are joined if both have one, with the newer calls if any; else it is dropped. Each
    decision rests on the last kept turn: a fold in turn order, as a higher-order aggregate over one conversation.
    """
    turn = F.struct("turn", "role", "text", F.coalesce("calls", F.lit(0)).cast("long").alias("calls"))
    kept = "array<struct<turn:bigint,role:string,text:string,calls:bigint>>"
    step = """(kept, m) -> CASE
        WHEN size(kept) = 0 OR element_at(kept, -1).role <> m.role OR m.role = 'tool'
          OR (m.role = 'assistant' AND element_at(kept, -1).calls > 0 AND coalesce(m.text, '') <> '') THEN concat(kept, array(m))
        WHEN coalesce(m.text, '') <> '' AND coalesce(element_at(kept, -1).text, '') <> '' THEN concat(slice(kept, 1, size(kept) - 1),
          array(named_struct('turn', element_at(kept, -1).turn, 'role', m.role, 'text', concat(element_at(kept, -1).text, '\\n', m.text), 'calls', if(m.calls > 0, m.calls, element_at(kept, -1).calls))))
        ELSE kept END"""
    g = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    g = g.select("conv_id", F.explode(F.expr(f"aggregate(cast(turns AS {kept}), cast(array() AS {kept}), {step})")).alias("m"))
    return g.select("conv_id", "m.turn", "m.role", "m.text", "m.calls")


def recounted(messages: DataFrame, calls: DataFrame) -> DataFrame:
    """conv_id, num_turns, num_tool_calls, num_distinct_tools, tools_used (in call order)."""
    turns = messages.groupBy("conv_id").agg(F.count("*").alias("num_turns"))
    used = calls.groupBy("conv_id").agg(F.count("*").alias("num_tool_calls"), F.countDistinct(F.split("endpoint_id", "/").getItem(0)).alias("num_distinct_tools"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "endpoint_id"))), lambda x: x["endpoint_id"]), ",").alias("tools_used"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return turns.join(used, "conv_id", "left").select("conv_id", "num_turns", zero("num_tool_calls"), zero("num_distinct_tools"), F.coalesce("tools_used", F.lit("")).alias("tools_used"))


def kept_steps(steps: DataFrame, calls: DataFrame) -> DataFrame:
    """Trace steps whose endpoint the conversation still calls."""
    return steps.join(calls.select("conv_id", "endpoint_id").distinct(), ["conv_id", "endpoint_id"], "left_semi")


def best_attempt(attempts: DataFrame, least: float) -> DataFrame:
    """conv_id, attempt, overall: the first attempt that passes, else the best (the earlier of equals)."""
    passing = F.min(F.when(F.col("overall") >= least, F.struct("attempt", "overall")))
    best = F.max_by(F.struct("attempt", "overall"), F.struct("overall", -F.col("attempt")))
    g = attempts.groupBy("conv_id").agg(F.coalesce(passing, best).alias("x"))
    return g.select("conv_id", "x.attempt", "x.overall", (F.col("x.overall") >= least).alias("passes"))

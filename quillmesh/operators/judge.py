"""Rule-based scores of conversations, and transcripts.

``calls``: conv_id, step, endpoint_id, k (an id argument, as text, or null), structural (1 for a malformed call).
``results``: conv_id, step, ids (array of ids that a result shows). ``messages``: conv_id, turn, role, text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import text

DONE = "done|completed|confirmed|reference"


def ungrounded(calls: DataFrame, results: DataFrame) -> DataFrame:
    """conv_id, ungrounded: calls whose id argument no earlier result has shown, once any result has shown ids.

    An id is known from the first step that shows it: a join on (conversation, id), not a growing set.
    """
    shown = results.select("conv_id", "step", F.explode("ids").alias("k")).groupBy("conv_id", "k").agg(F.min("step").alias("shown"))
    any_shown = shown.groupBy("conv_id").agg(F.min("shown").alias("from_step"))
    c = calls.where("k is not null").join(any_shown, "conv_id").where("from_step < step").join(shown, ["conv_id", "k"], "left")
    return c.where("shown is null or shown >= step").groupBy("conv_id").agg(F.count("*").alias("ungrounded"))


def scores(calls: DataFrame, results: DataFrame, messages: DataFrame) -> DataFrame:
    """conv_id, tool_correctness, naturalness, task_completion, overall; a row for each conversation with messages."""
    n = calls.groupBy("conv_id").agg(F.count("*").alias("calls"), F.sum("structural").alias("structural"))
    r = results.groupBy("conv_id").agg(F.count("*").alias("results"))
    spoken = (F.col("role") == "assistant") & (F.trim("text") != "")
    m = messages.groupBy("conv_id").agg(
        F.count("*").alias("messages"), F.count_if(F.col("role") == "user").alias("users"),
        F.bool_or((F.col("role") == "assistant") & F.col("text").contains("?")).alias("asks"),
        F.max_by("text", F.when(spoken, F.col("turn"))).alias("last"), F.count_if(spoken).alias("spoken"),
    )
    j = m.join(n, "conv_id", "left").join(r, "conv_id", "left").join(ungrounded(calls, results), "conv_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    clamp = lambda x: F.round(F.greatest(F.lit(1.0), F.least(F.lit(5.0), x)), 2)
    flag = lambda x: x.cast("int")
    tool = 5.0 - 2.0 * flag(zero("calls") == 0) - flag(zero("results") < zero("calls")) - F.least(F.lit(2.0), 0.75 * zero("ungrounded")) - F.least(F.lit(1.0), 0.5 * zero("structural"))
    natural = 4.0 + 0.5 * flag(F.coalesce("asks", F.lit(False)) & (F.col("users") >= 2)) - flag(F.col("messages") < 4)
    ends = F.col("spoken") > 0
    complete = F.when(ends & (zero("calls") > 0), 5.0).otherwise(3.0) - 0.5 * flag(ends & ~F.coalesce(F.lower("last").rlike(DONE), F.lit(False)))
    s = j.select("conv_id", clamp(tool).alias("tool_correctness"), clamp(natural).alias("naturalness"), clamp(complete).alias("task_completion"))
    return s.withColumn("overall", overall())


def overall():
    return F.round((F.col("tool_correctness") + F.col("naturalness") + F.col("task_completion")) / 3, 2)


def quality_gate(scored: DataFrame, least: float = 3.5) -> DataFrame:
    """One row: how many pass (the bound included) and the means of scored rows."""
    return scored.agg(F.count("*").alias("scored"), F.count_if(F.col("overall") >= least).alias("passing"), *(F.round(F.avg(c), 2).alias(f"avg_{c}") for c in ("overall", "tool_correctness", "naturalness", "task_completion")))


def feedback(scored: DataFrame, least: float = 4.0) -> DataFrame:
    """conv_id, feedback: the dimensions under ``least``, joined."""
    low = F.array(*(F.when(F.col(c) < least, F.concat(F.lit(f"{c}: "), F.format_number(c, 2))) for c in ("tool_correctness", "naturalness", "task_completion")))
    return scored.select("conv_id", F.array_join(F.filter(low, lambda x: x.isNotNull()), "; ").alias("feedback"))


def transcript(messages: DataFrame, most: int = 300) -> DataFrame:
    """conv_id, lines, transcript: the turns in order, each shortened. One conversation's turns are gathered, as one text is the result."""
    named = F.when(F.col("role") == "user", "USER: ").when(F.col("role") == "assistant", "ASSISTANT: ").when(F.col("role") == "tool", "TOOL RESULT: ")
    shown = messages.where(F.col("role").isin("user", "assistant", "tool") & ((F.col("role") != "assistant") | (F.col("text") != "")))
    lines = shown.select("conv_id", F.struct("turn", F.concat(named, text.shorten(F.col("text"), most)).alias("line")).alias("x"))
    return lines.groupBy("conv_id").agg(F.count("*").alias("lines"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), "\n").alias("transcript"))


def history(messages: DataFrame, last: int = 8) -> DataFrame:
    """Each conversation's last turns, and always its first user turn: it takes the place of the oldest if it is not among them."""
    w = Window.partitionBy("conv_id")
    first = F.min(F.when(F.col("role") == "user", F.col("turn"))).over(w)
    back = F.row_number().over(w.orderBy(F.desc("turn")))
    inside = F.max(F.when((F.col("turn") == F.col("first_user")) & (F.col("back") <= last), 1).otherwise(0)).over(w)
    m = messages.withColumn("first_user", first).withColumn("back", back)
    m = m.withColumn("keep", F.lit(last) - F.when(F.col("first_user").isNotNull() & (inside == 0), 1).otherwise(0))
    return m.where((F.col("back") <= F.col("keep")) | (F.col("turn") == F.col("first_user"))).select(*messages.columns)

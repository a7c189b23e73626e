"""How varied a set of tool-call traces is: pairs, entropy, domain coverage, patterns.

``calls`` has conv_id, step, endpoint_id, tool, endpoint, category. Counts within a conversation come
first, so a long conversation never expands into all its pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import classify
from quillmesh.plans.runtime import parts_for, written


def tool_pairs(calls: DataFrame) -> DataFrame:
    """first, second, n: how often two calls of a conversation are of these endpoints, in either order; an endpoint pairs with itself if called twice."""
    n = written(calls.groupBy("conv_id", "endpoint_id").agg(F.count("*").alias("n")))  # both sides of the join would else count in one task
    n = n.repartition(parts_for(n), "conv_id")
    a, b = n.alias("a"), n.alias("b")
    pairs = a.join(b, F.col("a.conv_id") == F.col("b.conv_id")).where("a.endpoint_id <= b.endpoint_id")
    times = F.when(F.col("a.endpoint_id") == F.col("b.endpoint_id"), (F.col("a.n") * (F.col("a.n") - 1) / 2).cast("long")).otherwise(F.col("a.n") * F.col("b.n"))
    return pairs.select(F.col("a.endpoint_id").alias("first"), F.col("b.endpoint_id").alias("second"), times.alias("n")).where("n > 0").groupBy("first", "second").agg(F.sum("n").alias("n"))


def domain_counts(calls: DataFrame) -> DataFrame:
    return calls.select("conv_id", "category").distinct().groupBy("category").agg(F.count("*").alias("conversations"))


def conversations(calls: DataFrame) -> DataFrame:
    """conv_id, num_calls, num_distinct_tools, pattern, domains."""
    has = lambda *words: F.bool_or(F.lower("endpoint").rlike("|".join(words)))
    return calls.groupBy("conv_id").agg(
        F.count("*").alias("num_calls"), F.countDistinct("tool").alias("num_distinct_tools"), F.countDistinct("category").alias("domains"),
        classify.chain_pattern(F.count("*"), has("create", "add", "book"), has("get", "list", "search"), has("update", "modify"), has("delete", "remove", "cancel")).alias("pattern"),
    )


def patterns(calls: DataFrame) -> DataFrame:
    return conversations(calls).groupBy("pattern").agg(F.count("*").alias("conversations"))


def metrics(calls: DataFrame) -> DataFrame:
    """One row: entropy of the pairs, variation over used domains, counts."""
    pairs = tool_pairs(calls)
    total = pairs.agg(F.sum("n").alias("total"))
    p = F.col("n") / F.col("total")
    entropy = pairs.join(F.broadcast(total)).agg(F.round(-F.sum(p * F.log2(p)), 4).alias("tool_pair_entropy"), F.count("*").alias("unique_pairs"))
    domains = domain_counts(calls).agg(F.round(F.stddev_pop("conversations") / F.avg("conversations"), 4).alias("domain_cv"), F.count("*").alias("domains"))
    return entropy.join(domains).join(summary(calls).select("conversations", "multi_step_multi_tool"))


def summary(calls: DataFrame) -> DataFrame:
    c = conversations(calls)
    both = (F.col("num_calls") >= 3) & (F.col("num_distinct_tools") >= 2)
    return c.agg(F.count("*").alias("conversations"), F.count_if(both).alias("multi_step_multi_tool"), F.round(100 * F.count_if(both) / F.count("*"), 2).alias("multi_step_share"), F.round(F.avg("num_calls"), 4).alias("avg_calls"), F.round(F.avg("num_distinct_tools"), 4).alias("avg_tools"), F.max("num_calls").alias("max_calls"))


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """metric, run_a, run_b, change: two one-row results side by side."""
    def long(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.explode(F.map_from_arrays(F.array(*(F.lit(c) for c in df.columns)), F.array(*(F.col(c).cast("double") for c in df.columns)))).alias("metric", name))

    return long(a, "run_a").join(long(b, "run_b"), "metric").withColumn("change", F.round(F.col("run_b") - F.col("run_a"), 4))

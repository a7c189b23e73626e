"""Coverage steering: what to avoid and prefer, from what was generated so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.operators import diversity


def overused_pairs(pairs: DataFrame, top: int = 5, share: float = 0.7) -> DataFrame:
    """The ``top`` commonest pairs that reach ``share`` of the commonest one's count, and 2."""
    most = pairs.agg(F.max("n").alias("most"))
    best = pairs.orderBy(F.desc("n"), "first", "second").limit(top)
    return best.join(F.broadcast(most)).where(F.col("n") >= F.greatest(F.lit(2.0), F.col("most") * share)).select("first", "second", "n")


def underused_domains(available: DataFrame, counts: DataFrame, fallback: int = 3) -> DataFrame:
    """category, n: those under half of the mean over all available ones; if none is, the least used."""
    a = available.select("category").distinct().join(counts, "category", "left").select("category", F.coalesce("conversations", F.lit(0)).alias("n"))
    mean = a.agg(F.avg("n").alias("mean"))
    low = a.join(F.broadcast(mean)).withColumn("low", F.col("n") < F.col("mean") * 0.5)
    some = low.agg(F.max("low").alias("some"))
    ranked = low.join(F.broadcast(some)).where("low or not some").orderBy("n", "category")
    rank = F.row_number().over(Window.orderBy("n", "category"))  # as many rows as there are domains
    return ranked.withColumn("rank", rank).where(F.col("low") | (F.col("rank") <= fallback)).select("category", "n")


def complexity_hint(patterns: DataFrame) -> DataFrame:
    """multi_step_ratio, hint."""
    many = F.sum(F.when(F.col("pattern").isin("multi_step", "search_and_act"), F.col("conversations")).otherwise(0)) / F.sum("conversations")
    return patterns.agg(many.alias("r")).select(F.round("r", 4).alias("multi_step_ratio"), F.when(F.col("r") < 0.5, "Prefer multi-step scenarios").when(F.col("r") > 0.7, "Allow simpler single-step scenarios").otherwise("").alias("hint"))


def rationale(total: DataFrame, counts: DataFrame, top: int = 3) -> DataFrame:
    """One sentence on what was generated: ``total`` (total) conversations and the most used domains."""
    best = counts.orderBy(F.desc("conversations"), "category").limit(top)
    named = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("conversations")).alias("n"), "category"))), lambda x: F.concat(x["category"], F.lit("("), (-x["n"]).cast("string"), F.lit(")")))
    return best.agg(F.array_join(named, ", ").alias("named")).join(total).select(F.concat(F.col("total").cast("string"), F.lit(" conversations generated so far. Most used domains: "), "named").alias("rationale"))


def running_domains(calls: DataFrame, day: str = "day") -> DataFrame:
    """day, category, before: conversations that used the category on earlier days, the day itself left out.

    ``calls`` needs a column ``day``. Daily counts come first, so the window runs over days times categories, not calls.
    """
    daily = calls.select(day, "conv_id", "category").distinct().groupBy(day, "category").agg(F.count("*").alias("n"))
    grid = daily.select(day).distinct().join(F.broadcast(daily.select("category").distinct()))
    w = Window.partitionBy("category").orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    full = grid.join(daily, [day, "category"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return full.select(day, "category", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))


def summary(calls: DataFrame, top: int = 10) -> DataFrame:
    """kind, label, n: domains, patterns and the commonest pairs in one table."""
    d = diversity.domain_counts(calls).select(F.lit("domain").alias("kind"), F.col("category").alias("label"), F.col("conversations").alias("n"))
    p = diversity.patterns(calls).select(F.lit("pattern"), "pattern", "conversations")
    t = diversity.tool_pairs(calls).orderBy(F.desc("n"), "first", "second").limit(top).select(F.lit("pair"), F.concat_ws(" + ", "first", "second"), "n")
    return d.union(p).union(t)

"""What a conversation already knows when a call is made: endpoints by name, values by name, and names that must not be shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
IDS = ["id", "item_id", "resource_id"]


def is_id(name: Column) -> Column:
    return F.lower(name).endswith("_id") | F.lower(name).isin(IDS)


def visible_parameters(required: Column) -> Column:
    """Required parameters worth asking a user for: no ids, three at most."""
    return F.slice(F.filter(required, lambda p: ~is_id(p)), 1, 3)


def supplied_parameters(required: Column) -> Column:
    """Required parameters that a user can give on request: four at most, ids included."""
    return F.slice(required, 1, 4)


def resolved(calls: DataFrame, endpoints: DataFrame) -> DataFrame:
    """The calls with ``resolved`` (the registry's id, whatever the case; an unknown name stays), ``result`` (null, or an error as JSON) and ``status``."""
    ids = endpoints.select("endpoint_id").distinct()
    exact = ids.select(F.col("endpoint_id").alias("endpoint"), F.col("endpoint_id").alias("exact"))
    folded = ids.groupBy(F.lower("endpoint_id").alias("folded")).agg(F.min("endpoint_id").alias("near"))
    c = calls.join(exact, "endpoint", "left").withColumn("folded", F.lower("endpoint")).join(folded, "folded", "left")
    known = F.coalesce("exact", "near")
    error = F.when(known.isNull(), F.to_json(F.struct(F.concat(F.lit("Unknown endpoint: "), F.col("endpoint")).alias("error"))))
    c = c.select(*calls.columns, F.coalesce(known, "endpoint").alias("resolved"), error.alias("result"))
    return c.withColumn("status", F.when(F.get_json_object("result", "$.error").isNotNull(), "error").otherwise("ok"))


def remembered(results: DataFrame) -> DataFrame:
    """conv_id, step, key, value: what a result leaves behind. ``results``: conv_id, step, ord, entity, key, value.

    An id is remembered as the last one and as its entity's; a confirmation as the booking's too; a name as its entity's.
    """
    key = F.lower("key")
    names = F.when(key == "id", F.array(F.lit("last_id"), F.concat("entity", F.lit("_id")))).when(key == "confirmation_id", F.array(F.lit("confirmation_id"), F.lit("booking_id"))).when(key.endswith("_id"), F.array(key)).when(key == "name", F.array(F.concat("entity", F.lit("_name"))))
    kept = results.select("conv_id", "step", "ord", F.explode(names).alias("key"), "value")
    return kept.groupBy("conv_id", "step", "key").agg(F.max_by("value", "ord").alias("value"))


def grounded_values(parameters: DataFrame, memory: DataFrame, parts: int | None = None) -> DataFrame:
    """``parameters`` (conv_id, step, name) with ``value``: of the same name, else for ids the last id, as last remembered before the step.

    An as-of lookup: one window over (conversation, key), in which parameters and what is remembered are merged by step.
    ``parts``: over how many tasks they are dealt, where Spark's own number would give a task too many rows.
    """
    name = F.lower("name")
    one = lambda rank, key: F.struct(F.lit(rank).alias("rank"), key.alias("key"))
    keys = F.when(is_id(F.col("name")), F.array(one(0, name), one(1, F.lit("last_id")))).otherwise(F.array(one(0, name)))
    ask = parameters.select("conv_id", "step", "name", F.inline(keys)).select("conv_id", "key", "step", F.lit(0).alias("kind"), "name", "rank", F.lit(None).cast("string").alias("value"))
    know = memory.select("conv_id", "key", "step", F.lit(1), F.lit(None).cast("string"), F.lit(None).cast("int"), "value")
    before = Window.partitionBy("conv_id", "key").orderBy("step", "kind").rowsBetween(Window.unboundedPreceding, -1)
    both = ask.union(know)
    both = both.repartition(parts, "conv_id", "key") if parts else both
    found = both.withColumn("value", F.last("value", ignorenulls=True).over(before)).where("kind = 0")
    return found.groupBy("conv_id", "step", "name").agg(F.min_by("value", F.when(F.col("value").isNotNull(), F.col("rank"))).alias("value"))


def merged(arguments: Column, result: Column) -> Column:
    """Two maps as one; the result's keys win."""
    return F.map_concat(F.map_filter(arguments, lambda k, v: ~F.map_contains_key(result, k)), result)


def leaks(messages: DataFrame, used: DataFrame) -> DataFrame:
    """conv_id, turn, name: identifiers of a conversation's own tools (``used``: conv_id, endpoint_id) that stand in what it shows."""
    tool, name = F.split_part("endpoint_id", F.lit("/"), F.lit(1)), F.split_part("endpoint_id", F.lit("/"), F.lit(2))
    forbidden = used.select("conv_id", F.explode(F.array_distinct(F.transform(F.array(F.col("endpoint_id"), tool, name, F.replace(name, F.lit("_"), F.lit(" "))), F.lower))).alias("name")).where("name <> ''").distinct()
    shown = messages.where("role in ('user', 'assistant')").select("conv_id", "turn", F.lower("text").alias("text"))
    return shown.join(forbidden, "conv_id").where(F.col("text").contains(F.col("name"))).select("conv_id", "turn", "name")

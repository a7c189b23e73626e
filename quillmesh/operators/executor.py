"""Deterministic tool results: what a call would return, as JSON and as columns.

Choices are hashes of the call's key; times are a parameter. An id is the entity's prefix and four hex digits of md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions import classify
from quillmesh.operators.sampler import uniform

def choice(values: list, *parts: Column | str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(uniform(*parts) * len(values)) + 1).cast("int"))


def number(low: int, high: int, *parts: Column | str) -> Column:
    """A whole number from low to high, both included."""
    return (F.lit(low) + F.floor(uniform(*parts) * (high - low + 1))).cast("long")


def entity_id(kind: Column, seed: Column) -> Column:
    return F.concat(classify.entity_prefix(kind), F.lit("_"), F.substring(F.md5(F.concat_ws(":", kind, seed)), 1, 4))


def execute(calls: DataFrame, now: str = "2026-06-01T00:00:00") -> DataFrame:
    """The calls (call_id, endpoint_id, endpoint_name, description, arguments as map<string,string>) with operation, entity, result_id, status, result (JSON).

    A result never depends on other calls: ids given as arguments are echoed, which is what a session's memory would do.
    """
    name, args = F.col("endpoint_name"), F.col("arguments")
    key = F.concat_ws(":", F.col("call_id").cast("string"), "endpoint_id")
    c = calls.withColumn("operation", classify.operation(name)).withColumn("entity", classify.entity_type(name, F.col("description"))).withColumn("key", key)
    given = F.coalesce(args["id"], F.element_at(args, F.concat("entity", F.lit("_id"))), args["item_id"], args["resource_id"])
    fresh = entity_id(F.col("entity"), F.col("key"))
    named = F.concat(F.initcap("entity"), F.lit(" no. "), number(1, 40, "key", F.lit("name")).cast("string"))
    count = number(2, 5, "key", F.lit("count"))
    at = F.lit(now)
    hits = F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda i: F.struct(entity_id(F.col("entity"), F.concat_ws(":", "key", i.cast("string"))).alias("id"), F.round(0.5 + uniform("key", F.lit("score"), i) / 2, 2).alias("score")))
    weather = F.struct(number(-10, 40, "key", F.lit("t")).alias("temperature"), choice(["clear", "overcast", "wet"], "key", F.lit("c")).alias("condition"), number(20, 90, "key", F.lit("h")).alias("humidity"))
    others = F.map_filter(args, lambda k, v: k != "id")
    shown = {
        "search": F.struct(hits.alias("results"), number(2, 50, "key", F.lit("total")).alias("total_count"), F.lit(1).alias("page")),
        "get": F.struct(F.coalesce(given, fresh).alias("id"), named.alias("name"), F.concat_ws(" ", F.lit("Detailed"), "entity", F.lit("information")).alias("description"), at.alias("created_at")),
        "create": F.struct(fresh.alias("entity_id"), entity_id(F.lit("booking"), F.col("key")).alias("confirmation_id"), F.lit("confirmed").alias("status"), at.alias("created_at"), args.alias("arguments")),
        "update": F.struct(F.coalesce(given, F.lit("unknown")).alias("id"), F.lit("updated").alias("status"), at.alias("updated_at"), others.alias("changes")),
        "delete": F.struct(F.coalesce(given, F.lit("unknown")).alias("id"), F.lit("deleted").alias("status"), at.alias("deleted_at")),
    }
    plain = F.to_json(F.struct(F.lit("success").alias("status"), name.alias("endpoint"), args.alias("data")))
    cases = [((F.col("operation") == "get") & (F.col("entity") == "weather"), F.to_json(weather))]
    result = classify.first_match([*cases, *((F.col("operation") == k, F.to_json(v)) for k, v in shown.items())], plain)
    status = classify.first_match([(F.col("operation") == k, F.lit(s)) for k, s in (("create", "confirmed"), ("update", "updated"), ("delete", "deleted"), ("search", "ok"), ("get", "ok"))], F.lit("success"))
    shown_id = F.when(F.col("operation") == "search", hits[0]["id"]).when(F.col("operation") == "create", fresh).when(F.col("operation") == "get", F.coalesce(given, fresh)).when(F.col("operation").isin("update", "delete"), F.coalesce(given, F.lit("unknown")))
    return c.select("call_id", "endpoint_id", "operation", "entity", shown_id.alias("result_id"), F.when(F.col("operation") == "search", count).otherwise(1).cast("long").alias("results"), status.alias("status"), result.alias("result"))


def sessions(executed: DataFrame, *keys: str) -> DataFrame:
    """Keys, entity, ids, operations: what a session has seen, entity by entity."""
    return executed.groupBy(*keys, "entity").agg(F.countDistinct("result_id").alias("ids"), F.count("*").alias("operations"), F.array_join(F.array_sort(F.collect_set("operation")), ",").alias("operation_types"))

"""Registries of endpoints: normal form, duplicates, statistics, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import classify


def normalised(endpoints: DataFrame) -> DataFrame:
    """Endpoints with the normal method and parameter type, verb and noun."""
    name = F.col("endpoint_name")
    return endpoints.select(
        "endpoint_id", "tool_name", "endpoint_name", "category", "description",
        classify.http_method(F.col("raw_method")).alias("method"), classify.parameter_type(F.col("raw_type")).alias("parameter_type"),
        classify.verb(name).alias("verb"), classify.noun(name).alias("noun"), classify.operation(name).alias("operation"),
        classify.entity_name(name).alias("entity_name"), classify.entity_type(name, F.col("description")).alias("entity_type"),
    )


def unique_names(rows: DataFrame, group: str, name: str, order: Column) -> DataFrame:
    """``unique_name``: the first of a name in its group keeps it; later ones get _dup and how many distinct names stood before them."""
    by = Window.partitionBy(group).orderBy(order)
    first = F.row_number().over(Window.partitionBy(group, name).orderBy(order)) == 1
    rows = rows.withColumn("_first", first)
    seen = F.sum(F.col("_first").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("unique_name", F.when(F.col("_first"), F.col(name)).otherwise(F.concat(F.col(name), F.lit("_dup"), seen.cast("string")))).drop("_first")


def merged_parameters(parameters: DataFrame) -> DataFrame:
    """One row for each (endpoint_id, name): required before optional, then the first place."""
    by = Window.partitionBy("endpoint_id", "name").orderBy(F.desc("required"), "pos")
    return parameters.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def statistics(raw: DataFrame, endpoints: DataFrame) -> DataFrame:
    """One row: tools and categories of the raw rows, distinct endpoints, parameters an endpoint."""
    a = raw.agg(F.countDistinct("tool_name").alias("total_tools"), F.countDistinct("category").alias("total_categories"))
    b = endpoints.agg(F.count("*").alias("total_endpoints"), F.sum(F.size("params")).cast("long").alias("total_params"), F.round(F.avg(F.size("params")), 2).alias("avg_params"), F.count_if(F.size("required") > 0).alias("with_required"))
    return a.join(b)


def by_category(endpoints: DataFrame) -> DataFrame:
    return endpoints.groupBy("category").agg(F.count("*").alias("endpoints"), F.countDistinct("tool_name").alias("tools"))


def search(endpoints: DataFrame, words: list[str], limit: int = 20) -> DataFrame:
    """Endpoints that a word hits: 2 for the name, 1 for the description, 1 for the tool; the best first, ties by id."""
    score = F.lit(0)
    for word in (w.lower() for w in words):
        for c, weight in (("endpoint_name", 2), ("description", 1), ("tool_name", 1)):
            score += F.when(F.lower(c).contains(word), weight).otherwise(0)
    return endpoints.select("endpoint_id", score.cast("long").alias("score")).where("score > 0").orderBy(F.desc("score"), "endpoint_id").limit(limit)

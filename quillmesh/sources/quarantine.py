"""Tool files with what was dropped from them: every record that is not used has a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a dropped record that are kept to look at.
SHOWN = 80


def is_tool(body: Column) -> Column:
    """The text is an object with a list of APIs."""
    return F.coalesce(F.ltrim(body).startswith("{") & F.try_parse_json(body).isNotNull() & F.ltrim(F.get_json_object(body, "$.api_list")).startswith("["), F.lit(False))


def file_fault(body: Column) -> Column:
    """Why a file can't be used, or null."""
    apis = F.from_json(F.get_json_object(body, "$.api_list"), "array<string>")
    return (
        F.when(F.trim(F.coalesce(body, F.lit(""))) == "", "empty")
        .when(F.try_parse_json(body).isNull(), "not_json")
        .when(~F.ltrim(body).startswith("{"), "not_an_object")
        .when(~is_tool(body), "no_api_list")
        .when(~F.exists(apis, lambda a: api_fault(a).isNull()), "no_valid_api")
    )


def api_fault(api: Column) -> Column:
    """Why an API of a file can't be used, or null."""
    return F.when(~F.coalesce(F.ltrim(api).startswith("{"), F.lit(False)), "api_not_an_object").when(F.trim(F.coalesce(F.get_json_object(api, "$.name"), F.lit(""))) == "", "api_without_name")


def split(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of ``files`` (path, body): good has path, pos, api (JSON); bad has path, pos (null for the whole file), reason and the record's beginning.

    Both are read from one projection of the files, each its own filter; nothing is dropped without a row in one of them.
    """
    judged = files.select("path", "body", file_fault(F.col("body")).alias("fault"))
    whole = judged.where("fault is not null").select("path", F.lit(None).cast("int").alias("pos"), F.col("fault").alias("reason"), F.left("body", F.lit(SHOWN)).alias("shown"))
    listed = F.when(is_tool(F.col("body")), F.from_json(F.get_json_object("body", "$.api_list"), "array<string>"))
    apis = judged.select("path", F.col("fault").alias("whole"), F.posexplode(listed).alias("pos", "api")).withColumn("reason", api_fault(F.col("api")))
    bad = whole.union(apis.where("reason is not null").select("path", "pos", "reason", F.left("api", F.lit(SHOWN))))
    return apis.where("reason is null and whole is null").select("path", "pos", "api"), bad


def json_document(spark: SparkSession, path: str, schema: str, default: str = "{}") -> DataFrame:
    """A document as one row; a missing or broken file gives the default."""
    try:
        texts = spark.read.option("wholetext", True).text(path)
        texts.schema  # noqa: B018  resolves the path
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        texts = spark.createDataFrame([(None,)], "value string")
    body = F.when(F.try_parse_json("value").isNotNull(), F.col("value")).otherwise(default)
    return texts.select(F.from_json(body, schema).alias("x")).select("x.*")


def first_seen(rows: DataFrame, order: str, most_categories: int | None = None, most_rows: int | None = None) -> DataFrame:
    """``rows`` (category, tool_name, ``order``, ...) with first: where their tool was first seen; tools are files in this order, rows in theirs.

    Of categories the first ``most_categories`` by first sight stay, then the first ``most_rows`` rows. The counts of groups
    meet, not their rows: a semi-join keeps the categories and a top-k finds the last row that stays.
    """
    if most_categories is not None:
        seen = rows.groupBy("category").agg(F.min(order).alias("first")).orderBy("first").limit(most_categories)
        rows = rows.join(F.broadcast(seen.select("category")), "category", "left_semi")
    if most_rows is not None:
        rows = rows.orderBy(order).limit(most_rows)
    first = rows.groupBy("category", "tool_name").agg(F.min(order).alias("first"))
    return rows.join(first, ["category", "tool_name"])


def union_with_defaults(parts: dict[str, tuple[DataFrame, int | None, list[str]]], defaults: dict[str, object]) -> DataFrame:
    """part and the columns of all parts: the first rows of each by its order, columns that a part lacks, or nulls, filled by ``defaults``."""
    out = None
    for name, (df, most, order) in parts.items():
        some = (df.orderBy(*order).limit(most) if most else df).select(F.lit(name).alias("part"), *df.columns)
        out = some if out is None else out.unionByName(some, allowMissingColumns=True)
    return out.select(*(F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in out.columns))

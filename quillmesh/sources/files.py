"""Tool files, JSON lines and documents as DataFrames, and results back to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARAMETER = "struct<name:string,type:string,description:string,default:string,enum:array<string>>"


def parameter_list(raw: Column) -> Column:
    """A JSON list of parameters, or a JSON object of them by name, as array<struct>; anything else is empty.

    In an object a value may be a specification or just a type.
    """
    text = F.trim(raw)
    listed = F.from_json(text, f"array<{PARAMETER}>")
    spec = lambda v: F.from_json(v, PARAMETER)
    named = F.transform(
        F.map_entries(F.from_json(text, "map<string,string>")),
        lambda e: F.struct(
            e["key"].alias("name"),
            F.when(e["value"].startswith("{"), spec(e["value"])["type"]).otherwise(e["value"]).alias("type"),
            spec(e["value"])["description"].alias("description"), spec(e["value"])["default"].alias("default"), spec(e["value"])["enum"].alias("enum"),
        ),
    )
    found = F.when(text.startswith("["), listed).when(text.startswith("{"), named)
    return F.filter(F.coalesce(found, F.array().cast(f"array<{PARAMETER}>")), lambda p: F.coalesce(F.trim(p["name"]), F.lit("")) != "")


def tool_files(spark: SparkSession, path: str, categories: list[str] | None = None, most: int = 0) -> DataFrame:
    """path, category, tool_name, api (JSON), pos: an API a row of all tool files below a folder.

    The folder above a file names its category; files right in the root are Uncategorized and pass any category filter. Files
    that are no JSON, and tools without APIs, give nothing. ``most`` keeps the first files by path (0: all).
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    root = F.lit(path.rstrip("/").rsplit("/", 1)[-1])
    parts = F.split(F.col("path"), "/")
    depth = F.size(parts) - F.array_position(F.reverse(parts), root)
    inner = F.slice(parts, depth + 2, F.size(parts))
    files = files.withColumn("inner", inner).where(~F.exists("inner", lambda p: p.startswith(".")))
    files = files.withColumn("category", F.when(F.size("inner") == 1, "Uncategorized").otherwise(F.url_decode(F.element_at("inner", 1))))
    if categories:
        files = files.where(F.col("category").isin(categories) | (F.size("inner") == 1))
    if most:
        files = files.orderBy("path").limit(most)
    get = lambda p: F.nullif(F.trim(F.get_json_object("body", p)), F.lit(""))
    stem = F.regexp_replace(F.url_decode(F.element_at("inner", -1)), r"\.json$", "")
    apis = F.from_json(F.get_json_object("body", "$.api_list"), "array<string>")
    rows = files.select("path", "category", F.coalesce(get("$.tool_name"), get("$.title"), stem).alias("tool_name"), F.posexplode(apis).alias("pos", "api"))
    return rows.where(F.coalesce(F.trim(F.get_json_object("api", "$.name")), F.lit("")) != "")


def api_columns(rows: DataFrame) -> DataFrame:
    """The APIs of ``tool_files`` as endpoints: names, raw method, description, required and optional parameters, response schema."""
    get = lambda p: F.get_json_object("api", p)
    schema = F.coalesce(F.nullif(get("$.response_schema"), F.lit("{}")), get("$.response"))
    clean = lambda c, required: F.transform(c, lambda p: F.struct(F.trim(p["name"]).alias("name"), p["type"].alias("raw_type"), F.coalesce(p["description"], F.lit("")).alias("description"), (F.nullif(p["default"], F.lit("")) if required else p["default"]).alias("default"), p["enum"].alias("enum"), F.lit(required).alias("required")))
    return rows.select(
        "path", "category", F.trim("tool_name").alias("tool_name"), F.trim(get("$.name")).alias("endpoint_name"), "pos", F.coalesce(get("$.description"), F.lit("")).alias("description"), get("$.method").alias("raw_method"),
        clean(parameter_list(get("$.required_parameters")), True).alias("required"), clean(parameter_list(get("$.optional_parameters")), False).alias("optional"),
        F.when(F.trim(schema).startswith("{"), schema).alias("response_schema"),
    )


def json_lines(spark: SparkSession, path: str, schema: StructType | str, most: int = 0) -> DataFrame:
    """Records of a JSON lines path; blank lines are skipped; a missing path is empty."""
    try:
        rows = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return rows.limit(most) if most else rows


def count_records(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where(F.trim("value") != "").count()


def json_document(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_json_lines(rows: DataFrame, path: str, *order: str) -> None:
    """Records in the order of the columns over all files, which are sorted ranges, not one task's work."""
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").json(path)


def write_tools(endpoints: DataFrame, path: str, overwrite: bool = False) -> None:
    """Endpoints as JSON, in a folder for each category and tool; existing output stays unless ``overwrite``."""
    endpoints.withColumn("tool", F.col("tool_name")).write.mode("overwrite" if overwrite else "ignore").partitionBy("category", "tool").json(path)


def write_diagram(edges: DataFrame, path: str, most: int = 120) -> None:
    """The first edges as a Mermaid chart in Markdown."""
    from quillmesh.functions.text import diagram_label

    top = edges.orderBy("source", "target").limit(most)
    line = F.concat(F.lit("  "), diagram_label(F.col("source")), F.lit(" -->|"), F.col("edge_type"), F.lit("| "), diagram_label(F.col("target")))
    head = edges.sparkSession.createDataFrame([("```mermaid\ngraph LR",)], "value string")
    head.union(top.select(line.alias("value"))).union(head.select(F.lit("```"))).coalesce(1).write.mode("overwrite").text(path)


def bundle(**parts: DataFrame) -> DataFrame:
    """One row of JSON text for each named part, for a dashboard: (part, records)."""
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("part"), F.to_json(F.struct(*df.columns)).alias("record"))
        out = one if out is None else out.union(one)
    return out

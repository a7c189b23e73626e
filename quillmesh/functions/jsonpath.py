"""JSON documents of any depth as rows of (path, value), and reading JSON out of prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.plans.runtime import written

CHILD = "array<struct<name string, raw string, kind string>>"


def _unsure(raw: Column) -> Column:
    """Whether a value's text doesn't tell its type: a string may look like an object, an array or a boolean."""
    return F.substring(raw, 1, 1).isin("{", "[") | raw.isin("true", "false")


def _kind(raw: Column, value: Column) -> Column:
    """OBJECT, ARRAY, BOOLEAN or else of a value; its type is asked only where its text could be one of these."""
    return F.when(_unsure(raw), F.substring_index(F.schema_of_variant(value), "<", 1)).otherwise("else")


def _opened(level: DataFrame) -> DataFrame:
    """``level`` with ``children``: the members of an object or the elements of an array of ``raw``, in the document's order, nulls left out.

    Values are read a second time, with their types, only where the text of one of them leaves its type open.
    """
    names, doc = level.columns, F.col("raw")
    is_object = F.ltrim(doc).startswith("{")
    # The texts are a column of their own, which is evaluated once.
    read = level.withColumn("members", F.when(is_object, F.map_entries(F.from_json(doc, "map<string,string>")))).withColumn("elements", F.when(~is_object, F.from_json(doc, "array<string>")))
    member = lambda x, kind: F.struct(F.concat(F.lit("."), x["key"]).alias("name"), x["value"].alias("raw"), kind.alias("kind"))
    element = lambda raw, kind, i: F.struct(F.concat(F.lit("["), i.cast("string"), F.lit("]")).alias("name"), raw.alias("raw"), kind.alias("kind"))
    sure = F.lit("else")
    typed = F.zip_with("members", F.map_entries(F.from_json(doc, "map<string,variant>")), lambda x, y: member(x, _kind(x["value"], y["value"])))
    named = F.when(F.exists("members", lambda x: _unsure(x["value"])), typed).otherwise(F.transform("members", lambda x: member(x, sure)))
    both = F.zip_with("elements", F.from_json(doc, "array<variant>"), lambda x, y: F.struct(x.alias("raw"), _kind(x, y).alias("kind")))
    placed = F.when(F.exists("elements", _unsure), F.transform(both, lambda x, i: element(x["raw"], x["kind"], i))).otherwise(F.transform("elements", lambda x, i: element(x, sure, i)))
    return read.withColumn("children", F.when(is_object, named).otherwise(placed)).select(*names, "children")


def flatten(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """The key columns with ord, path and value: a row for each string, number or boolean of the document, in its order (``ord``: places from the root down).

    A level of all documents at a time is opened, by expressions alone, and what it has to be opened further is written to the
    shared folder; so nesting has no bound, and a level costs what lies in it. Text that is no JSON, or names a key twice in one
    object, gives no rows; what follows a document is ignored. Nulls are left out; booleans are True and False.
    """
    names = list(keys)
    # A document's own expression may be large: each step is a column of its own, and rows are left out only once they are written, as
    # Spark would else push the condition down to the source and repeat the whole expression in it for each mention.
    raw, whole = F.col("raw"), F.col("whole")
    kind = F.substring_index(F.schema_of_variant(whole), "<", 1)
    plain = F.when(F.col("kind") == "BOOLEAN", F.initcap(F.trim(raw))).when(~F.col("kind").isin("OBJECT", "ARRAY", "VOID"), F.variant_get(whole, "$", "string"))
    # Documents are few bytes for the work they make, so they are dealt over tasks by their keys, not by splits of what they came from.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = df.select(*names, F.col(column).alias("raw")).repartition(parts, *names).withColumn("whole", F.try_parse_json(raw)).withColumn("kind", kind)
    now = written(top.select(*names, F.array().cast("array<int>").alias("ord"), F.lit("$").alias("path"), F.coalesce(plain, raw).alias("raw"), "kind"))
    now = now.where("kind <> 'VOID'")
    leaves = lambda level: level.where(~F.col("kind").isin("OBJECT", "ARRAY")).select(*names, "ord", "path", F.when(F.col("kind") == "BOOLEAN", F.initcap("raw")).otherwise(F.col("raw")).alias("value"))
    out = leaves(now)
    while not (inner := now.where(F.col("kind").isin("OBJECT", "ARRAY"))).isEmpty():
        rows = _opened(inner).select(*names, "ord", "path", F.posexplode("children").alias("at", "x")).where("x.raw is not null")
        now = written(rows.select(*names, F.array_append("ord", F.col("at")).alias("ord"), F.concat("path", "x.name").alias("path"), F.col("x.raw").alias("raw"), F.col("x.kind").alias("kind")))
        out = out.union(leaves(now))
    return out


def script_text(value: Column) -> Column:
    """A leaf as a browser prints it: whole numbers without a fraction, booleans in lower case."""
    return F.when(value.isin("True", "False"), F.lower(value)).when(value.rlike(r"^-?[0-9]+\.0$"), F.regexp_replace(value, r"\.0$", "")).otherwise(value)


def content_text(text: Column, body: Column) -> Column:
    """What a message says: its text, else its JSON content, written tightly."""
    return F.coalesce(text, F.to_json(F.try_parse_json(body)), body, F.lit(""))


def last_key(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, r"\."), -1))


def is_reference(path: Column) -> Column:
    """Of an output: ids and the status."""
    key = last_key(path)
    return key.isin("id", "confirmation_id", "status") | key.endswith("_id")


def is_id(path: Column) -> Column:
    key = last_key(path)
    return (key == "id") | key.endswith("_id")


def first_reference(flat: DataFrame, *keys: str) -> DataFrame:
    """One reference for each document: confirmation_id, then booking_id, then id, then any other id, the earliest of its kind."""
    key = last_key(F.col("path"))
    rank = F.when(key == "confirmation_id", 0).when(key == "booking_id", 1).when(key == "id", 2).otherwise(3)
    return flat.where(is_id(F.col("path"))).groupBy(*keys).agg(F.min_by("value", F.struct(rank.alias("rank"), F.col("ord").alias("ord"))).alias("reference"))


def outermost_object(prose: Column) -> Column:
    """From the first opening brace to the last closing one, code fences aside; null if there is none."""
    found = F.regexp_extract(prose, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)


def tool_call(prose: Column) -> Column:
    """struct(endpoint, arguments) if the prose holds a call: action tool_call, an endpoint, arguments an object; else null."""
    body = outermost_object(prose)
    get = lambda p: F.get_json_object(body, p)
    args = F.coalesce(get("$.arguments"), F.lit("{}"))
    ok = (get("$.action") == "tool_call") & (F.coalesce(F.trim(get("$.endpoint")), F.lit("")) != "") & args.startswith("{")
    return F.when(ok, F.struct(F.trim(get("$.endpoint")).alias("endpoint"), args.alias("arguments")))


def judge_score(doc: Column, name: str) -> Column:
    """A score given as a number or as an object with one; 3 if missing, kept within 1 and 5."""
    one = F.coalesce(F.get_json_object(doc, f"$.{name}.score").try_cast("double"), F.get_json_object(doc, f"$.{name}").try_cast("double"), F.lit(3.0))
    return F.greatest(F.lit(1.0), F.least(F.lit(5.0), one))


def canonical(value: Column) -> Column:
    return F.trim(F.coalesce(value, F.lit("")))

"""Short forms for display, and what status lines and error texts hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions.classify import first_match
from quillmesh.functions.text import shorten


def short_endpoint(endpoint: Column) -> Column:
    return F.coalesce(F.try_element_at(F.split(endpoint, "/"), F.lit(2)), endpoint)


def truncate(text: Column, most: int) -> Column:
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.left(text, F.lit(most - 3)), F.lit("...")))


def fixed(number: Column, digits: int) -> Column:
    """With a fixed number of decimals; 0 where it is no number."""
    return F.when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), "0").otherwise(F.format_string(f"%.{digits}f", number))


def conversation_id(label: Column) -> Column:
    found = F.regexp_extract(label, r"\bconv_\d{4}\b", 0)
    return F.when(found != "", found)


def stage(raw: Column, detail: Column) -> Column:
    """The kind of step that a status line tells of. The beginnings that the lines have."""
    s, d = F.lower(F.trim(raw)), F.lower(F.trim(detail))
    turn = first_match([(d.startswith("tool call"), F.lit("tool_call")), (d.startswith("executing"), F.lit("execute")), (d.startswith("result"), F.lit("result")), (d.startswith("assistant summary"), F.lit("summary")), (d.startswith("assistant text"), F.lit("assistant_text"))], F.lit("assistant"))
    offline = first_match([(d.startswith("building args"), F.lit("args")), (d.startswith("executing"), F.lit("execute")), (d.startswith("result"), F.lit("result"))], F.lit("offline_step"))
    named = F.when(s == "", "status").otherwise(F.replace(s, F.lit(" "), F.lit("_")))
    return first_match([(s.startswith("turn"), turn), (s.startswith("offline step"), offline), ((s == "offline") & d.startswith("planning"), F.lit("planner")), (s == "chain ready", F.lit("chain"))], named)


def status(label: Column) -> Column:
    """conv_id (null if it has none), stage, detail of a line whose parts stand between bars."""
    parts = F.transform(F.split(label, r"\|"), lambda x: F.trim(x))
    own = conversation_id(F.element_at(parts, 1))
    at = F.when(own.isNotNull(), 2).otherwise(1)
    raw = F.coalesce(F.try_element_at(parts, at), F.lit("status"))
    detail = F.array_join(F.slice(parts, at + 1, F.size(parts)), " | ")
    return F.struct(own.alias("conv_id"), stage(raw, detail).alias("stage"), detail.alias("detail"))


def retry_after(error: Column) -> Column:
    """Seconds to wait, one more than the text says and 120 at most; 0 where it says nothing."""
    found = F.regexp_extract(error, r"(?i)retry in ([0-9]+(?:\.[0-9]+)?)s", 1)
    return F.when(found == "", 0.0).otherwise(F.least(found.try_cast("double") + 1, F.lit(120.0)))


def compact(value: Column, most: int) -> Column:
    """Of a text that may be JSON: the JSON without white space between its parts, cut to ``most`` characters; other text cut alike."""
    return shorten(F.coalesce(F.to_json(F.try_parse_json(value)), value), most)


def canonical(value: Column) -> Column:
    """One text for equal values: trimmed, and JSON objects with their keys in order; null is empty."""
    return F.coalesce(F.to_json(F.try_parse_json(value)), F.trim(value), F.lit(""))

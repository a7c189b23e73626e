"""The standard tables as this domain's relations.

``calls``: tool calls, from ``events``; ``messages``: turns, from ``conversations``; ``endpoints``: a tool
registry, from ``part``; ``traces``: long call traces, from ``orders``, ``lineitem`` and ``part``.
Each has a twin in SQL, a common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.functions import classify
from quillmesh.functions.classify import first_match
from quillmesh.plans.runtime import parts_for

#: event type: (tool, endpoint, category)
EVENTS = {
    "click": ("catalog_api", "search_items", "Commerce"),
    "view": ("catalog_api", "get_item_details", "Commerce"),
    "signup": ("account_api", "create_account", "Productivity"),
    "purchase": ("order_api", "book_order", "Travel"),
    "error": ("order_api", "cancel_order", "Travel"),
}
#: part type: (verb, description)
PARTS = {
    "ECONOMY": ("search", "Search for a"),
    "LARGE": ("get", "Get details of a"),
    "MEDIUM": ("create", "Create an order for a"),
    "PROMO": ("update", "Update the user of a"),
    "SMALL": ("delete", "Delete a"),
    "STANDARD": ("track", ""),
}
CATEGORIES = ["Travel", "Commerce", "Food", "Productivity", "Finance"]
RAW_TYPES = ["str", " INT ", "Float", "list", "json", "date", "Bool"]
RAW_METHODS = ["get", "POST", " put ", "options", "Delete"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, values: dict, at: int) -> Column:
    return first_match([(key == k, F.lit(v[at])) for k, v in values.items()], F.lit(None).cast("string"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, step, endpoint_id, tool, endpoint, category, k, value, args."""
    e = table(spark, sf_dir, "events").withColumn("conv_id", F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")))
    tool, endpoint = (_pick(F.col("event_type"), EVENTS, i) for i in (0, 1))
    return e.select(
        "conv_id",
        F.row_number().over(Window.partitionBy("conv_id").orderBy("ts", "event_id")).cast("long").alias("step"),
        classify.endpoint_id(tool, endpoint).alias("endpoint_id"),
        tool.alias("tool"),
        endpoint.alias("endpoint"),
        _pick(F.col("event_type"), EVENTS, 2).alias("category"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "value",
        F.col("props").alias("args"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, role, text."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def raw_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a part: tool_name, endpoint_name, category, description, raw_type, raw_method, params, required, p_partkey; names repeat."""
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    stem = F.split("p_name", " ").getItem(1)
    many = F.when(stem.endswith("y"), F.concat(F.regexp_replace(stem, "y$", ""), F.lit("ies"))).otherwise(F.concat(stem, F.lit("s")))
    v = _pick(F.col("p_type"), PARTS, 0)
    said = _pick(F.col("p_type"), PARTS, 1)
    lists = {
        "search": ([], ["query", "limit", "max_price"]),
        "get": (["_id"], ["currency"]),
        "create": (["_type"], ["quantity", "name"]),
        "update": (["_id"], ["quantity", "name"]),
        "delete": (["_id"], []),
        "track": ([], ["price", "currency"]),
    }
    array = lambda k, i: F.array(*(F.concat(stem, F.lit(x)) if x.startswith("_") else F.lit(x) for x in lists[k][i])).cast("array<string>")
    required, optional = (first_match([(v == k, array(k, i)) for k in lists], F.array().cast("array<string>")) for i in (0, 1))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("brand_"), brand.cast("string"), F.lit("_api")).alias("tool_name"),
        F.concat_ws("_", v, many).alias("endpoint_name"),
        F.element_at(F.array(*map(F.lit, CATEGORIES)), brand % 5 + 1).alias("category"),
        F.when(said == "", "").otherwise(F.concat_ws(" ", said, F.concat(stem, F.lit(".")))).alias("description"),
        F.element_at(F.array(*map(F.lit, RAW_TYPES)), F.col("p_size") % 7 + 1).alias("raw_type"),
        F.element_at(F.array(*map(F.lit, RAW_METHODS)), F.col("p_size") % 5 + 1).alias("raw_method"),
        required.alias("required"),
        F.concat(required, optional).alias("params"),
        "p_partkey",
    )


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry: one row for each endpoint id, of the first part that has it, in normal form."""
    raw = raw_endpoints(spark, sf_dir).withColumn("endpoint_id", classify.endpoint_id(F.col("tool_name"), F.col("endpoint_name")))
    one = raw.groupBy("endpoint_id").agg(F.min_by(F.struct(*(c for c in raw.columns if c != "endpoint_id")), "p_partkey").alias("r"))
    return one.select("endpoint_id", "r.*").drop("p_partkey")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id (an order), step, endpoint_id, tool, endpoint, category: a call for each line of an order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    parts = raw_endpoints(spark, sf_dir).select("p_partkey", "tool_name", "endpoint_name", "category")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    # What follows on conversations needs no shuffle, so its sorts and tables of groups are all in these tasks; both sides are dealt alike, else Spark deals them anew.
    parts_ = parts_for(lines)
    lines, orders = lines.repartition(parts_, "l_orderkey"), orders.repartition(parts_, "o_orderkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left_semi").join(parts, lines.l_partkey == parts.p_partkey)
    return joined.select(F.col("l_orderkey").alias("conv_id"), F.row_number().over(order).cast("long").alias("step"), classify.endpoint_id(F.col("tool_name"), F.col("endpoint_name")).alias("endpoint_id"), F.col("tool_name").alias("tool"), F.col("endpoint_name").alias("endpoint"), "category")


def _case(key: str, values: dict, at: int) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v[at]}'" for k, v in values.items()) + " END"


_LISTS = {"search": ("[]::VARCHAR[]", "['query','limit','max_price']"), "get": ("[stem||'_id']", "['currency']"), "create": ("[stem||'_type']", "['quantity','name']"), "update": ("[stem||'_id']", "['quantity','name']"), "delete": ("[stem||'_id']", "[]::VARCHAR[]"), "track": ("[]::VARCHAR[]", "['price','currency']")}
SQL = {
    "calls": f"""calls AS (SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS conv_id,
        row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS step,
        {_case("event_type", EVENTS, 0)} || '/' || {_case("event_type", EVENTS, 1)} AS endpoint_id,
        {_case("event_type", EVENTS, 0)} AS tool, {_case("event_type", EVENTS, 1)} AS endpoint, {_case("event_type", EVENTS, 2)} AS category,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, props AS args FROM events)""",
    "raw_endpoints": f"""bare AS (SELECT *, split_part(p_name, ' ', 2) AS stem, CAST(regexp_extract(p_brand, '[0-9]+') AS INT) AS brand, {_case("p_type", PARTS, 0)} AS verb, {_case("p_type", PARTS, 1)} AS said FROM part),
      raw_endpoints AS (SELECT 'brand_' || brand || '_api' AS tool_name,
        verb || '_' || CASE WHEN stem LIKE '%y' THEN regexp_replace(stem, 'y$', 'ies') ELSE stem || 's' END AS endpoint_name,
        ({CATEGORIES})[brand % 5 + 1] AS category, CASE WHEN said = '' THEN '' ELSE said || ' ' || stem || '.' END AS description,
        ({RAW_TYPES})[p_size % 7 + 1] AS raw_type, ({RAW_METHODS})[p_size % 5 + 1] AS raw_method,
        CASE verb {" ".join(f"WHEN '{k}' THEN {a}" for k, (a, _) in _LISTS.items())} END AS required,
        CASE verb {" ".join(f"WHEN '{k}' THEN list_concat({a}, {b})" for k, (a, b) in _LISTS.items())} END AS params, p_partkey FROM bare)""",
    "endpoints": """endpoints AS (SELECT tool_name || '/' || endpoint_name AS endpoint_id, tool_name, endpoint_name, category, description, raw_type, raw_method, required, params
        FROM raw_endpoints QUALIFY row_number() OVER (PARTITION BY tool_name, endpoint_name ORDER BY p_partkey) = 1)""",
    "traces": """traces AS (SELECT l_orderkey AS conv_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS step,
        tool_name || '/' || endpoint_name AS endpoint_id, tool_name AS tool, endpoint_name AS endpoint, category
        FROM lineitem JOIN raw_endpoints ON l_partkey = p_partkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders))""",
    "messages": "messages AS (SELECT conv_id, turn, role, text FROM conversations)",
}
NEEDS = {"endpoints": ["raw_endpoints"], "traces": ["raw_endpoints"]}


def sql(body: str, *names: str) -> str:
    """The query with the common table expressions it needs before it; ``body`` may go on with its own after a comma."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*NEEDS.get(n, []), n) if x not in order]
    return f"WITH {', '.join(SQL[n] for n in order)}{'' if body.lstrip().startswith(',') else ' '}{body}"

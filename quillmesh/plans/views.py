"""Queries over whole conversations: their event view, figures, grounding and short forms, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillmesh.functions import labels
from quillmesh.operators import grounding, timeline
from quillmesh.plans import adapters
from quillmesh.plans.adapters import sql, table
from quillmesh.plans.catalogue import query
from quillmesh.plans.runtime import parts_for, written

#: Conversations of the calls: a request, messages of two calls each (every second one with a text), a response to nine calls of ten, scores and repairs.
_TALK = """, pairs_ AS (SELECT *, (step + 1) // 2 AS m, (step - 1) % 2 AS idx FROM calls),
 talk AS (SELECT conv_id, 0::BIGINT AS turn, 'user' AS role, 'Take ' || sum(k)::BIGINT AS content FROM calls GROUP BY conv_id
  UNION ALL SELECT conv_id, 3 * m - 2, 'assistant', CASE WHEN m % 2 = 0 THEN 'Working on ' || min(k) || repeat(' and on', 15) END FROM pairs_ GROUP BY conv_id, m
  UNION ALL SELECT conv_id, 3 * m - 1 + idx, 'tool', args FROM pairs_ WHERE k % 10 < 9),
 tool_calls AS (SELECT conv_id, 3 * m - 2 AS turn, idx, endpoint_id, k::VARCHAR AS value, step FROM pairs_),
 scores AS (SELECT conv_id, round(1 + (sum(k) % 41) / 10.0, 1)::DOUBLE AS overall, round(1 + (sum(k) % 37) / 10.0, 1)::DOUBLE AS correctness, count(*) % 3 AS repairs FROM calls GROUP BY conv_id),
 talks AS (SELECT s.*, num_turns, num_tool_calls, num_distinct_tools FROM scores s JOIN (SELECT conv_id, count(*) AS num_tool_calls, count(DISTINCT tool) AS num_distinct_tools FROM calls GROUP BY conv_id) USING (conv_id) JOIN (SELECT conv_id, count(*) AS num_turns FROM talk GROUP BY conv_id) USING (conv_id))"""
_EDGES = """, edges_ AS (SELECT DISTINCT a.endpoint_id AS source, b.endpoint_id AS target, CASE WHEN a.tool = b.tool THEN 'same_tool' ELSE 'same_category' END AS edge_type FROM (SELECT DISTINCT endpoint_id, tool, category FROM calls) a JOIN (SELECT DISTINCT endpoint_id, tool, category FROM calls) b ON a.category = b.category AND a.endpoint_id <> b.endpoint_id)"""
_CUT = "CASE WHEN length({0}) <= 88 THEN {0} ELSE left({0}, 85) || '...' END"
_TIMELINE = (
    _TALK + _EDGES + f""", tools_ AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth FROM talk WHERE role = 'tool'),
 answered AS (SELECT c.*, (SELECT count(*) FROM tools_ t WHERE t.conv_id = c.conv_id AND t.turn < c.turn) AS before FROM tool_calls c),
 since AS (SELECT conv_id, json_extract_string(content, '$.k') AS value, min(turn) AS since FROM tools_ GROUP BY ALL),
 seen AS (SELECT a.*, coalesce(o.content, f.content) AS response, CASE WHEN since < a.turn THEN a.value ELSE '' END AS grounded, lag(a.endpoint_id) OVER (PARTITION BY a.conv_id ORDER BY a.turn, a.idx) AS previous,
   CASE WHEN a.step <= 3 THEN 'goal ' || a.step ELSE (SELECT 'goal ' || min(z.step) FROM calls z WHERE z.conv_id = a.conv_id AND z.step <= 3 AND z.endpoint_id = a.endpoint_id) END AS goal
   FROM answered a LEFT JOIN tools_ o ON o.conv_id = a.conv_id AND o.nth = before + idx + 1 LEFT JOIN tools_ f ON f.conv_id = a.conv_id AND f.nth = before + 1 LEFT JOIN since s ON s.conv_id = a.conv_id AND s.value = a.value),
 every AS (
  SELECT conv_id, turn, 1 + idx AS slot, 'tool_call' AS kind, CASE WHEN previous IS NULL OR edge_type IS NOT NULL THEN 'ok' ELSE 'warn' END AS status, 'function_call: ' || split_part(endpoint_id, '/', 2) AS label,
   CASE WHEN edge_type IS NOT NULL THEN edge_type || ' from ' || split_part(previous, '/', 2) WHEN previous IS NULL THEN 'first tool call in trace' ELSE 'no graph edge from previous tool' END AS subtitle, endpoint_id, response, grounded, goal FROM seen LEFT JOIN edges_ ON source = previous AND target = endpoint_id
  UNION ALL SELECT conv_id, turn, 0, 'user', 'info', 'user message', {_CUT.format("content")}, NULL, NULL, NULL, NULL FROM talk WHERE role = 'user'
  UNION ALL SELECT conv_id, turn, 0, 'assistant', 'ok', 'assistant response', {_CUT.format("content")}, NULL, NULL, NULL, NULL FROM talk WHERE role = 'assistant' AND coalesce(content, '') <> ''
  UNION ALL SELECT conv_id, turn, 0, 'tool_response', 'ok', 'function_response', {_CUT.format("content")}, (SELECT arg_max(c.endpoint_id, c.turn * 10 + c.idx) FROM tool_calls c WHERE c.conv_id = t.conv_id AND c.turn < t.turn), content, NULL, NULL FROM talk t WHERE role = 'tool'
  UNION ALL SELECT conv_id, (SELECT max(turn) FROM talk t WHERE t.conv_id = s.conv_id), 1000000, 'judge', CASE WHEN overall >= 4.5 THEN 'ok' WHEN overall >= 3.5 THEN 'warn' ELSE 'error' END, 'judge scores', 'overall ' || printf('%.2f', overall) || ' | correctness ' || printf('%.2f', correctness), NULL, NULL, NULL, NULL FROM scores s
  UNION ALL SELECT conv_id, (SELECT max(turn) FROM talk t WHERE t.conv_id = s.conv_id), 1000001, 'repair', 'warn', 'repair attempts', repairs || ' repair attempt' || CASE WHEN repairs = 1 THEN '' ELSE 's' END || ' recorded', NULL, NULL, NULL, NULL FROM scores s WHERE repairs > 0),
 events_ AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, slot) AS ord, turn, kind, status, label, subtitle, endpoint_id, response, grounded, goal FROM every) """
)


def _talk(c):
    """(messages, calls, values shown by tools, recorded steps, scores, conversations) of the calls."""
    c = c.withColumn("m", F.floor((F.col("step") + 1) / 2).cast("long")).withColumn("idx", ((F.col("step") - 1) % 2).cast("int"))
    request = c.groupBy("conv_id").agg(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("Take "), F.sum("k").cast("string")).alias("content"))
    said = c.groupBy("conv_id", "m").agg(F.min("k").alias("k")).select("conv_id", 3 * F.col("m") - 2, F.lit("assistant"), F.when(F.col("m") % 2 == 0, F.concat(F.lit("Working on "), F.col("k").cast("string"), F.repeat(F.lit(" and on"), F.lit(15)))))
    tools = c.where(F.col("k") % 10 < 9).select("conv_id", (3 * F.col("m") - 1 + F.col("idx")).alias("turn"), F.lit("tool").alias("role"), F.col("args").alias("content"))
    calls = c.select("conv_id", (3 * F.col("m") - 2).alias("turn"), "idx", "endpoint_id", F.array(F.col("k").cast("string")).alias("values"))
    shown = tools.select("conv_id", "turn", F.get_json_object("content", "$.k").alias("value"))
    steps = c.where("step <= 3").select("conv_id", (F.col("step") - 1).alias("ord"), "endpoint_id", F.concat(F.lit("goal "), F.col("step").cast("string")).alias("goal"))
    messages = request.union(said).union(tools)
    score = lambda n: F.round(1 + (F.sum("k") % n) / 10, 1)
    figures = c.groupBy("conv_id").agg(score(41).alias("overall"), score(37).alias("correctness"), (F.count("*") % 3).alias("repairs"), F.count("*").alias("num_tool_calls"), F.countDistinct("tool").alias("num_distinct_tools"), F.collect_set("endpoint_id").alias("tools_used"), F.collect_set("category").alias("domains"))
    talks = figures.join(messages.groupBy("conv_id").agg(F.count("*").alias("num_turns")), "conv_id")
    return messages, calls, shown, steps, figures.select("conv_id", "overall", "correctness", "repairs"), talks


def _edges(c):
    n = c.select("endpoint_id", "tool", "category").distinct()
    a, b = n.alias("a"), n.alias("b")
    return a.join(b, F.col("a.category") == F.col("b.category")).where("a.endpoint_id <> b.endpoint_id").select(F.col("a.endpoint_id").alias("source"), F.col("b.endpoint_id").alias("target"), F.when(F.col("a.tool") == F.col("b.tool"), "same_tool").otherwise("same_category").alias("edge_type"))


def _timeline(spark, d):
    c = written(adapters.calls(spark, d))  # its shuffle and sort are made once, not for every relation of the talk
    messages, calls, shown, steps, scores, _ = _talk(c)
    return timeline.timeline(messages, calls, shown, F.broadcast(_edges(c)), steps, scores)  # as many edges as pairs of event types


@query(sql(_TIMELINE + "SELECT * FROM events_", "calls"))
def trace_timeline(spark, d):
    return _timeline(spark, d)


@query(sql(_TIMELINE + "SELECT conv_id, count(*) AS events, count(*) FILTER (kind = 'tool_call') AS tool_calls, count(*) FILTER (status = 'warn') AS warnings FROM events_ GROUP BY conv_id", "calls"))
def trace_counts(spark, d):
    return timeline.trace_counts(_timeline(spark, d))


@query(sql(_TALK + "SELECT count(*) AS total_conversations, sum(num_tool_calls)::BIGINT AS total_tool_calls, round(avg(overall) FILTER (overall > 0), 4) AS mean_score, count(*) FILTER (overall < 4.5 OR repairs > 0) AS review_count FROM talks", "calls"))
def dashboard_metrics(spark, d):
    return timeline.dashboard_metrics(_talk(adapters.calls(spark, d))[-1])


@query(sql(_TALK + "SELECT count(*) AS total, round(100.0 * count(*) FILTER (num_tool_calls >= 3 AND num_distinct_tools >= 2) / count(*), 2) AS multi_step_share, round(avg(overall), 4) AS avg_score, count(*) FILTER (repairs > 0) AS repaired, round(avg(num_turns), 4) AS avg_turns, round(avg(num_tool_calls), 4) AS avg_tool_calls, round(avg(num_distinct_tools), 4) AS avg_distinct_tools FROM talks", "calls"))
def conversation_summary(spark, d):
    return timeline.conversation_summary(_talk(adapters.calls(spark, d))[-1])


@query(sql(_TALK + "SELECT conv_id FROM calls JOIN talks USING (conv_id) GROUP BY conv_id HAVING (contains(conv_id, '-1') OR contains(lower(string_agg(endpoint_id || ' ' || category, ' ')), 'produ-1')) AND (bool_or(endpoint_id = 'order_api/book_order') OR bool_or(endpoint_id = 'account_api/create_account'))", "calls"))
def conversation_search(spark, d):
    talks = _talk(adapters.calls(spark, d))[-1].withColumn("pattern", F.lit("multi_step"))
    return timeline.search(talks, " -1 ", ["order_api/book_order", "account_api/create_account"])


@query(
    sql(
        """, names AS (SELECT DISTINCT endpoint_id FROM calls), asked AS (SELECT conv_id, step, CASE WHEN k % 7 = 0 THEN 'lost_api/' || k WHEN k % 3 = 0 THEN upper(endpoint_id) ELSE endpoint_id END AS endpoint FROM calls)
 SELECT conv_id, step, endpoint, coalesce(endpoint_id, endpoint) AS resolved, CASE WHEN endpoint_id IS NULL THEN '{"error":"Unknown endpoint: ' || endpoint || '"}' END AS result, CASE WHEN endpoint_id IS NULL THEN 'error' ELSE 'ok' END AS status FROM asked LEFT JOIN names ON lower(endpoint) = endpoint_id""",
        "calls",
    )
)
def resolved_calls(spark, d):
    c = adapters.calls(spark, d)
    asked = F.when(F.col("k") % 7 == 0, F.concat(F.lit("lost_api/"), F.col("k").cast("string"))).when(F.col("k") % 3 == 0, F.upper("endpoint_id")).otherwise(F.col("endpoint_id"))
    return grounding.resolved(c.select("conv_id", "step", asked.alias("endpoint")), c)


_NAME = "CASE k % 5 WHEN 0 THEN 'Order_ID' WHEN 1 THEN 'item_id' WHEN 2 THEN 'booking_id' WHEN 3 THEN 'order_name' ELSE 'size' END"


@query(
    sql(
        f""", m AS (SELECT conv_id, step, unnest(CASE k % 4 WHEN 0 THEN ['last_id', 'order_id'] WHEN 1 THEN ['confirmation_id', 'booking_id'] WHEN 2 THEN ['user_id'] ELSE ['order_name'] END) AS key, k::VARCHAR AS value FROM calls),
 p AS (SELECT conv_id, step, {_NAME} AS name FROM calls), f AS (SELECT p.conv_id, p.step, name, arg_max(value, m.step) FILTER (key = lower(name)) AS own, arg_max(value, m.step) FILTER (key = 'last_id') AS last FROM p LEFT JOIN m ON m.conv_id = p.conv_id AND m.step < p.step GROUP BY ALL)
 SELECT conv_id, step, name, CASE WHEN own IS NOT NULL THEN own WHEN lower(name) LIKE '%\\_id' ESCAPE '\\' THEN last END AS value FROM f""",
        "calls",
    )
)
def grounded_values(spark, d):
    c = adapters.calls(spark, d)
    pick = lambda key, n, names: F.element_at(F.array(*map(F.lit, names)), (key % n + 1).cast("int"))
    results = c.select("conv_id", "step", F.lit(0).alias("ord"), F.lit("order").alias("entity"), pick(F.col("k"), 4, ["id", "confirmation_id", "user_id", "name"]).alias("key"), F.col("k").cast("string").alias("value"))
    names = c.select("conv_id", "step", pick(F.col("k"), 5, ["Order_ID", "item_id", "booking_id", "order_name", "size"]).alias("name"))
    return grounding.grounded_values(names, grounding.remembered(results), parts_for(table(spark, d, "events")))


@query(sql("SELECT endpoint_id, coalesce(array_to_string(list_filter(required, lambda p: NOT (lower(p) LIKE '%\\_id' ESCAPE '\\' OR lower(p) IN ('id', 'item_id', 'resource_id')))[:3], ','), '') AS visible, coalesce(array_to_string(required[:4], ','), '') AS supplied FROM endpoints", "endpoints"))
def asked_parameters(spark, d):
    return adapters.endpoints(spark, d).select("endpoint_id", F.array_join(grounding.visible_parameters(F.col("required")), ",").alias("visible"), F.array_join(grounding.supplied_parameters(F.col("required")), ",").alias("supplied"))


@query(
    sql(
        """, shown AS (SELECT conv_id, 0 AS turn, 'user' AS role, 'Please ' || CASE WHEN sum(k) % 3 = 0 THEN 'book order' WHEN sum(k) % 3 = 1 THEN 'CATALOG_API' ELSE 'help' END || ' now' AS text FROM calls GROUP BY conv_id),
 f AS (SELECT DISTINCT conv_id, unnest([endpoint_id, tool, endpoint, replace(endpoint, '_', ' ')]) AS name FROM calls) SELECT conv_id, turn, name FROM shown JOIN f USING (conv_id) WHERE contains(lower(text), name)""",
        "calls",
    )
)
def leaked_names(spark, d):
    c = adapters.calls(spark, d)
    what = F.element_at(F.array(F.lit("book order"), F.lit("CATALOG_API"), F.lit("help")), (F.sum("k") % 3 + 1).cast("int"))
    shown = c.groupBy("conv_id").agg(F.concat(F.lit("Please "), what, F.lit(" now")).alias("text")).select("conv_id", F.lit(0).alias("turn"), F.lit("user").alias("role"), "text")
    return grounding.leaks(shown, c.select("conv_id", "endpoint_id"))


@query(sql("SELECT category, endpoints, tools, rank FROM (SELECT category, count(*) AS endpoints, count(DISTINCT tool_name) AS tools, row_number() OVER (ORDER BY count(*) DESC, category) AS rank FROM endpoints GROUP BY category) WHERE rank <= 15", "endpoints"))
def top_categories(spark, d):
    n = adapters.endpoints(spark, d).groupBy("category").agg(F.count("*").alias("endpoints"), F.countDistinct("tool_name").alias("tools"))
    top = n.orderBy(F.desc("endpoints"), "category").limit(15)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("endpoints"), "category")).cast("long"))


@query(
    r"""WITH l AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'conv_0042 | turn 3 | executing ' || event_type WHEN 1 THEN 'conv_0007 | Offline Step 2 | building args' WHEN 2 THEN 'Chain ready' WHEN 3 THEN 'conv_0100 | turn 1 | tool call | ' || event_type WHEN 4 THEN 'offline | planning ' || event_type ELSE 'conv_12 | Judge Done | x' END AS line,
  CASE event_id % 3 WHEN 0 THEN 'quota; Retry in ' || (event_id % 200) || '.5s please' WHEN 1 THEN 'retry in 7s' ELSE 'no hint' END AS error FROM events)
 SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'conv_0042' WHEN 1 THEN 'conv_0007' WHEN 3 THEN 'conv_0100' END AS conv_id, CASE event_id % 6 WHEN 0 THEN 'execute' WHEN 1 THEN 'args' WHEN 2 THEN 'chain' WHEN 3 THEN 'tool_call' WHEN 4 THEN 'planner' ELSE 'conv_12' END AS stage,
  CASE event_id % 6 WHEN 0 THEN 'executing ' || event_type WHEN 1 THEN 'building args' WHEN 2 THEN '' WHEN 3 THEN 'tool call | ' || event_type WHEN 4 THEN 'planning ' || event_type ELSE 'Judge Done | x' END AS detail,
  CASE event_id % 3 WHEN 0 THEN least(120.0, event_id % 200 + 1.5) WHEN 1 THEN 8.0 ELSE 0.0 END::DOUBLE AS wait FROM l JOIN events USING (event_id)"""
)
def status_lines(spark, d):
    """Status lines of several kinds, made of each event's type, read back; and the waiting time that an error names."""
    e, n, t = table(spark, d, "events"), F.col("event_id"), F.col("event_type")
    line = (
        F.when(n % 6 == 0, F.concat(F.lit("conv_0042 | turn 3 | executing "), t)).when(n % 6 == 1, "conv_0007 | Offline Step 2 | building args").when(n % 6 == 2, "Chain ready")
        .when(n % 6 == 3, F.concat(F.lit("conv_0100 | turn 1 | tool call | "), t)).when(n % 6 == 4, F.concat(F.lit("offline | planning "), t)).otherwise("conv_12 | Judge Done | x")
    )
    error = F.when(n % 3 == 0, F.concat(F.lit("quota; Retry in "), (n % 200).cast("string"), F.lit(".5s please"))).when(n % 3 == 1, "retry in 7s").otherwise("no hint")
    return e.select("event_id", labels.status(line).alias("s"), labels.retry_after(error).alias("wait")).select("event_id", "s.*", "wait")


@query(
    """SELECT event_id, event_type AS short, CASE WHEN length('call of ' || event_type) <= 12 THEN 'call of ' || event_type ELSE left('call of ' || event_type, 9) || '...' END AS cut, printf('%.2f', value) AS number,
 '{"a":' || json_extract_string(props, '$.k') || ',"b":"x y"}' AS canonical, CASE WHEN length('{"a":' || json_extract_string(props, '$.k') || ',"b":"x y"}') <= 14 THEN '{"a":' || json_extract_string(props, '$.k') || ',"b":"x y"}' ELSE rtrim(left('{"a":' || json_extract_string(props, '$.k') || ',"b":"x y"}', 11)) || '...' END AS compact FROM events"""
)
def short_forms(spark, d):
    """Endpoints, labels, numbers and JSON as they are displayed."""
    e = table(spark, d, "events")
    doc = F.concat(F.lit('{ "b" : "x y", "a" : '), F.get_json_object("props", "$.k"), F.lit(" }"))
    return e.select("event_id", labels.short_endpoint(F.concat(F.lit("tool/"), "event_type")).alias("short"), labels.truncate(F.concat(F.lit("call of "), "event_type"), 12).alias("cut"), labels.fixed(F.col("value"), 2).alias("number"), labels.canonical(doc).alias("canonical"), labels.compact(doc, 14).alias("compact"))


@query(sql(", a AS (SELECT conv_id, step, k FROM calls) SELECT conv_id, step, CASE WHEN k % 2 = 0 THEN 'id=' || k || ',note=kept,status=ok' ELSE 'id=done,note=kept,status=ok' END AS merged FROM a", "calls"))
def merged_arguments(spark, d):
    """A call's arguments in its result: keys that the result has are its own."""
    k = F.col("k").cast("string")
    arguments = F.create_map(F.lit("id"), k, F.lit("note"), F.lit("kept"))
    result = F.when(F.col("k") % 2 == 0, F.create_map(F.lit("status"), F.lit("ok"))).otherwise(F.create_map(F.lit("status"), F.lit("ok"), F.lit("id"), F.lit("done")))
    pairs = F.array_sort(F.map_entries(grounding.merged(arguments, result)))
    return adapters.calls(spark, d).select("conv_id", "step", F.array_join(F.transform(pairs, lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("merged"))

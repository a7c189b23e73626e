"""Queries over files, streams and what a run reports: dropped records, published lines, bundles, progress, steering state, and the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quillmesh.functions import replies
from quillmesh.operators import diversity, graph, memory, progress, sampler, steering
from quillmesh.plans import adapters
from quillmesh.plans.adapters import sql, table
from quillmesh.plans.catalogue import _CONV, _DOMAINS, _GRAPH, _PAIRS, _chain_ids, _walk_sql, _with, query
from quillmesh.plans.runtime import shared_folder, written
from quillmesh.sources import committed, quarantine
from quillmesh.streaming import steering_state

_BODY = """CASE WHEN p_partkey % 7 = 0 THEN '{"tool_name": "t' WHEN p_partkey % 11 = 0 THEN '[1, 2]' WHEN p_partkey % 13 = 0 THEN '{"tool_name": "x"}' WHEN p_partkey % 17 = 0 THEN '   '
 ELSE '{"tool_name": "' || p_brand || '", "api_list": [{"name": "' || CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE p_name END || '"}, {"name": " "}, "text", {"method": "GET"}]}' END"""


@query(
    f"""WITH f AS (SELECT p_partkey, {_BODY} AS body FROM part),
 a AS (SELECT p_partkey, unnest(json_extract(body, '$.api_list[*]')) AS api FROM f WHERE json_valid(body)),
 x AS (SELECT p_partkey, CASE WHEN json_type(api) <> 'OBJECT' THEN 'api_not_an_object' WHEN trim(coalesce(json_extract_string(api, '$.name'), '')) = '' THEN 'api_without_name' END AS reason FROM a),
 w AS (SELECT p_partkey, CASE WHEN trim(body) = '' THEN 'empty' WHEN NOT json_valid(body) THEN 'not_json' WHEN json_type(body) <> 'OBJECT' THEN 'not_an_object' WHEN coalesce(json_type(body, '$.api_list'), '') <> 'ARRAY' THEN 'no_api_list'
   WHEN p_partkey NOT IN (SELECT p_partkey FROM x WHERE reason IS NULL) THEN 'no_valid_api' END AS reason FROM f)
 SELECT reason, count(*) AS n FROM (SELECT reason FROM x WHERE reason IS NOT NULL UNION ALL SELECT reason FROM w WHERE reason IS NOT NULL UNION ALL SELECT 'good' FROM x JOIN w USING (p_partkey) WHERE x.reason IS NULL AND w.reason IS NULL) GROUP BY reason"""
)
def quarantined_files(spark, d):
    """A tool file a part, many of them broken: how many APIs are good, and how many records were dropped for each reason."""
    files = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("path"), F.expr(_BODY).alias("body"))
    good, bad = quarantine.split(files)
    return bad.select("reason").union(good.select(F.lit("good"))).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    sql(
        """, c AS (SELECT category FROM raw_endpoints GROUP BY category ORDER BY min(p_partkey) LIMIT 3), k AS (SELECT p_partkey, category, tool_name FROM raw_endpoints WHERE category IN (SELECT category FROM c) ORDER BY p_partkey LIMIT 500)
 SELECT p_partkey, category, tool_name, min(p_partkey) OVER (PARTITION BY category, tool_name) AS first FROM k""",
        "raw_endpoints",
    )
)
def first_seen_tools(spark, d):
    rows = adapters.raw_endpoints(spark, d).select("p_partkey", "category", "tool_name")
    return quarantine.first_seen(rows, "p_partkey", 3, 500).select("p_partkey", "category", "tool_name", "first")


@query(
    """WITH a AS (SELECT 'samples' AS part, conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 10), b AS (SELECT 'run' AS part, event_id, event_type, value FROM events ORDER BY event_id LIMIT 250), c AS (SELECT 'all' AS part, r_regionkey AS event_id, r_name AS role FROM region),
 u AS (SELECT * FROM a UNION ALL BY NAME SELECT * FROM b UNION ALL BY NAME SELECT * FROM c)
 SELECT part, coalesce(conv_id, -1) AS conv_id, coalesce(turn, 0) AS turn, coalesce(role, '') AS role, event_id, coalesce(event_type, 'none') AS event_type, value FROM u"""
)
def bundle_rows(spark, d):
    parts = {
        "samples": (table(spark, d, "conversations").select("conv_id", "turn", "role"), 10, ["conv_id", "turn"]),
        "run": (table(spark, d, "events").select("event_id", "event_type", "value"), 250, ["event_id"]),
        "all": (table(spark, d, "region").select(F.col("r_regionkey").alias("event_id"), F.col("r_name").alias("role")), None, []),
    }
    return quarantine.union_with_defaults(parts, {"conv_id": -1, "turn": 0, "role": "", "event_type": "none"})


@query(
    """WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), l AS (SELECT * FROM p WHERE value > 50), u AS (SELECT DISTINCT user_id FROM l), n AS (SELECT (SELECT count(*) FROM events) AS e, (SELECT count(*) FROM p) AS p, (SELECT count(*) FROM l) AS l, (SELECT count(*) FROM u) AS u)
 SELECT 0 AS place, 'purchases' AS stage, e AS rows_in, p AS rows_out FROM n UNION ALL SELECT 1, 'large', p, l FROM n UNION ALL SELECT 2, 'users', l, u FROM n"""
)
def observed_stages(spark, d):
    stages = {"purchases": lambda x: x.where("event_type = 'purchase'"), "large": lambda x: x.where("value > 50"), "users": lambda x: x.select("user_id").distinct()}
    return progress.staged(table(spark, d, "events"), stages)[1]


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 2 = 1")
def published_lines(spark, d):
    """Orders published twice: what is read is the second result, whole."""
    at, orders = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}", table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    committed.write(orders.where("o_orderkey % 2 = 0"), at, "o_orderkey")
    committed.write(orders.where("o_orderkey % 2 = 1"), at, "o_orderkey")
    return committed.read(spark, at, orders.schema)


@query(sql(_with(_PAIRS, _DOMAINS, _CONV) + "SELECT 'domain' AS kind, category AS label, conversations AS n FROM domains UNION ALL SELECT 'pattern', pattern, count(*) FROM conversations_ GROUP BY pattern UNION ALL SELECT 'pair', first || ' + ' || second, n FROM pairs UNION ALL SELECT 'conversations', '', count(*) FROM conversations_", "calls"))
def steering_counters(spark, d):
    """All counters as keyed state holds them after a stream of the conversations, taken in two runs from one checkpoint."""
    shared = shared_folder(spark)
    rows = written(steering_state.records(adapters.calls(spark, d)))
    half = F.xxhash64("conv_id", F.lit("half")) % 2 == 0  # not the hash that shards are dealt by: every shard goes on from its state
    path, at = steering_state.stored(rows.where(half), shared), f"{shared}/steering-{uuid.uuid4().hex}"
    steering_state.steered(spark, path, rows.schema, at)
    rows.where(~half).write.mode("append").parquet(path)
    steering_state.steered(spark, path, rows.schema, at)
    return steering_state.counters(spark, at)


@query(
    sql(
        """SELECT conv_id, step, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'Please use budget and reference as you see fit.' ELSE 'Whatever looks best is fine. Please go ahead.' END WHEN step < 3 THEN 'Yes, please go ahead with that.' ELSE 'Thanks, that covers what I needed.' END AS reply,
  CASE WHEN step >= 3 THEN 'Done, that is taken care of. Your reference is ' || CASE WHEN k % 4 = 0 THEN 'the returned result' ELSE 'r' || k END || '.' ELSE 'I found the details I needed and will use reference ' || CASE WHEN k % 4 = 0 THEN 'the returned result' ELSE 'r' || k END || ' to continue.' END AS summary,
  step >= 3 AS over, CASE WHEN k % 8 = 0 THEN 'none' ELSE array_to_string(list_transform(range(1, least(k % 8, 5) + 1), lambda x: 'p' || x), ',') || CASE WHEN k % 8 > 5 THEN '+' || (k % 8 - 5) ELSE '' END END AS keys FROM calls""",
        "calls",
    )
)
def call_replies(spark, d):
    c = adapters.calls(spark, d)
    k, made, expected = F.col("k"), F.col("step"), F.lit(3)
    said = F.when(k % 3 == 0, F.lit("Which one?")).otherwise("Noted.")
    missing = F.when(k % 2 == 0, F.array(F.lit("max_price"), F.lit("item_id"))).otherwise(F.array().cast("array<string>"))
    reference = F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("r"), k.cast("string")))
    names = F.filter(F.transform(F.sequence(F.lit(1), F.lit(7)), lambda i: F.when(i <= k % 8, F.concat(F.lit("p"), i.cast("string")))), lambda x: x.isNotNull())
    return c.select("conv_id", "step", replies.user_reply(said, missing, made, expected).alias("reply"), replies.tool_summary(reference, made, expected).alias("summary"), replies.is_over(made, expected).alias("over"), replies.listed(names, 5).alias("keys"))


@query(sql(", r AS (SELECT *, row_number() OVER (ORDER BY category, tool_name, endpoint_name) <= 80 AS shown FROM endpoints) SELECT category, count(*) AS endpoints, count(*) FILTER (shown) AS shown, count(*) FILTER (NOT shown) AS omitted FROM r GROUP BY category", "endpoints"))
def diagram_counts(spark, d):
    return graph.diagram_counts(adapters.endpoints(spark, d), 80)


@query(
    sql(
        _with(_DOMAINS) + """SELECT (SELECT count(DISTINCT conv_id) FROM calls) || ' conversations generated so far. Most used domains: ' || (SELECT string_agg(category || '(' || conversations || ')', ', ' ORDER BY conversations DESC, category) FROM (SELECT * FROM domains ORDER BY conversations DESC, category LIMIT 3)) AS rationale""",
        "calls",
    )
)
def steering_rationale(spark, d):
    c = adapters.calls(spark, d)
    return steering.rationale(c.select("conv_id").distinct().agg(F.count("*").alias("total")), diversity.domain_counts(c))


_LEFT_OUT = "(SELECT endpoint_id FROM endpoints ORDER BY endpoint_id LIMIT 40)"


@query(sql(_GRAPH + _walk_sql(2, 1, 5).replace("FROM edges)", f"FROM edges WHERE source NOT IN {_LEFT_OUT} AND target NOT IN {_LEFT_OUT})").replace("AS spot FROM endpoints)", f"AS spot FROM endpoints WHERE endpoint_id NOT IN {_LEFT_OUT})") + "SELECT chain_id, attempt, path, steps, pattern FROM chains", "endpoints"))
def excluding_chains(spark, d):
    """Walks that keep away from the first 40 endpoints by id."""
    e = written(adapters.endpoints(spark, d))
    excluded = [r.endpoint_id for r in e.orderBy("endpoint_id").limit(40).collect()]
    c = sampler.described_walks(_chain_ids(spark, d), e, graph.edges(graph.relations(e)), 1, 5, 2, excluded=excluded)
    return c.select("chain_id", "attempt", F.array_join("path", " > ").alias("path"), "steps", "pattern")


@query()
def memory_cells(spark, d):
    """The nearest by a cell index of half of the vectors, to which the other half was added; a test holds it against ``memory_topk``."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    index = memory.Cells(v.where("vec_id % 2 = 0"), cells=max(4, int(v.count() ** 0.5)))
    index.add(v.where("vec_id % 2 = 1"))
    return index.search(v.where("vec_id % 20 = 0"), 5, probes=max(3, int(0.75 * len(index.centres))))

"""Queries over the standard tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.functions import classify, jsonpath, text
from quillmesh.operators import conversation, diversity, executor, graph, judge, memory, registry, repair, sampler, steering, traces
from quillmesh.plans import adapters, workflow
from quillmesh.plans.adapters import sql, table
from quillmesh.plans.runtime import shared_folder, written
from quillmesh.streaming import coverage

FOUND: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        FOUND[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(FOUND)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# Diversity -----------------------------------------------------------------

_CONV = """conv AS (SELECT conv_id, count(*) AS num_calls, count(DISTINCT tool) AS num_distinct_tools, count(DISTINCT category) AS domains,
  bool_or(regexp_matches(lower(endpoint), 'create|add|book')) AS c, bool_or(regexp_matches(lower(endpoint), 'get|list|search')) AS r,
  bool_or(regexp_matches(lower(endpoint), 'update|modify')) AS u, bool_or(regexp_matches(lower(endpoint), 'delete|remove|cancel')) AS d FROM {source} GROUP BY conv_id),
 conversations_ AS (SELECT conv_id, num_calls, num_distinct_tools, domains, CASE WHEN num_calls = 1 THEN 'single_step' WHEN c::INT + r::INT + u::INT + d::INT >= 3 THEN 'crud_cycle'
  WHEN r AND (c OR u OR d) THEN 'search_and_act' ELSE 'multi_step' END AS pattern FROM conv)"""
_PAIRS = "pairs AS (SELECT least(a.endpoint_id, b.endpoint_id) AS first, greatest(a.endpoint_id, b.endpoint_id) AS second, count(*) AS n FROM {source} a JOIN {source} b ON a.conv_id = b.conv_id AND a.step < b.step GROUP BY 1, 2)"
_DOMAINS = "domains AS (SELECT category, count(DISTINCT conv_id) AS conversations FROM {source} GROUP BY category)"


def _with(*parts: str, source: str = "calls") -> str:
    return ", " + ", ".join(p.format(source=source) for p in parts) + " "


_METRICS = """SELECT (SELECT round(-sum(n / t * log2(n / t)), 4) FROM pairs, (SELECT sum(n) AS t FROM pairs)) AS tool_pair_entropy, (SELECT count(*) FROM pairs) AS unique_pairs,
  (SELECT round(stddev_pop(conversations) / avg(conversations), 4) FROM domains) AS domain_cv, (SELECT count(*) FROM domains) AS domains,
  (SELECT count(*) FROM conversations_) AS conversations, (SELECT count(*) FROM conversations_ WHERE num_calls >= 3 AND num_distinct_tools >= 2) AS multi_step_multi_tool"""


@query(sql(_with(_PAIRS, _DOMAINS, _CONV) + _METRICS, "calls"))
def diversity_metrics(spark, d):
    return diversity.metrics(adapters.calls(spark, d))


@query(sql(_with(_PAIRS, _DOMAINS, _CONV, source="traces") + _METRICS, "traces"))
def diversity_metrics_traces(spark, d):
    return diversity.metrics(adapters.traces(spark, d))


@query(sql(_with(_PAIRS) + "SELECT * FROM pairs", "calls"))
def tool_pair_counts(spark, d):
    return diversity.tool_pairs(adapters.calls(spark, d))


@query(sql(_with(_PAIRS, source="traces") + "SELECT * FROM pairs", "traces"))
def tool_pair_counts_traces(spark, d):
    return diversity.tool_pairs(adapters.traces(spark, d))


@query(sql(_with(_CONV) + "SELECT pattern, count(*) AS conversations FROM conversations_ GROUP BY pattern", "calls"))
def pattern_distribution(spark, d):
    return diversity.patterns(adapters.calls(spark, d))


@query(sql(_with(_DOMAINS, source="traces") + "SELECT * FROM domains", "traces"))
def domain_coverage(spark, d):
    return diversity.domain_counts(adapters.traces(spark, d))


_SUMMARY = """SELECT count(*) AS conversations, count(*) FILTER (num_calls >= 3 AND num_distinct_tools >= 2) AS multi_step_multi_tool,
 round(100.0 * count(*) FILTER (num_calls >= 3 AND num_distinct_tools >= 2) / count(*), 2) AS multi_step_share, round(avg(num_calls), 4) AS avg_calls, round(avg(num_distinct_tools), 4) AS avg_tools, max(num_calls) AS max_calls FROM conversations_"""


@query(sql(_with(_CONV) + _SUMMARY, "calls"))
def generation_summary(spark, d):
    return diversity.summary(adapters.calls(spark, d))


@query(
    sql(
        """, days AS (SELECT CASE WHEN conv_id LIKE '%-0_' OR conv_id LIKE '%-1_' THEN 'a' ELSE 'b' END AS arm, * FROM calls),
  conv AS (SELECT arm, conv_id, count(*) AS n, count(DISTINCT tool) AS t FROM days GROUP BY ALL),
  s AS (SELECT arm, count(*)::DOUBLE AS conversations, (count(*) FILTER (n >= 3 AND t >= 2))::DOUBLE AS multi_step_multi_tool, round(100.0 * count(*) FILTER (n >= 3 AND t >= 2) / count(*), 2) AS multi_step_share,
    round(avg(n), 4) AS avg_calls, round(avg(t), 4) AS avg_tools, max(n)::DOUBLE AS max_calls FROM conv GROUP BY arm),
  l AS (UNPIVOT s ON conversations, multi_step_multi_tool, multi_step_share, avg_calls, avg_tools, max_calls INTO NAME metric VALUE v)
 SELECT x.metric, x.v AS run_a, y.v AS run_b, round(y.v - x.v, 4) AS change FROM l x JOIN l y ON x.metric = y.metric AND x.arm = 'a' AND y.arm = 'b'""",
        "calls",
    )
)
def experiment_comparison(spark, d):
    c = adapters.calls(spark, d)
    first = F.col("conv_id").rlike("-[01].$")
    return diversity.compare(diversity.summary(c.where(first)), diversity.summary(c.where(~first)))


# Registry ------------------------------------------------------------------

@query(sql("SELECT endpoint_id, tool_name, endpoint_name, category, description, coalesce(array_to_string(required, ','), '') AS required_names, coalesce(array_to_string(params, ','), '') AS param_names FROM endpoints", "endpoints"))
def registry_endpoints(spark, d):
    return adapters.endpoints(spark, d).select("endpoint_id", "tool_name", "endpoint_name", "category", "description", F.array_join("required", ",").alias("required_names"), F.array_join("params", ",").alias("param_names"))


def _sql_cases(groups: dict[str, list[str]], template: str, otherwise: str) -> str:
    return "CASE " + " ".join("WHEN " + template.format("|".join(w)) + f" THEN '{k}'" for k, w in groups.items()) + f" ELSE {otherwise} END"


_SINGULAR = "CASE WHEN {0} LIKE '%ies' THEN regexp_replace({0}, 'ies$', 'y') WHEN {0} LIKE '%s' AND {0} NOT LIKE '%ss' THEN regexp_replace({0}, 's$', '') ELSE {0} END"
_VERB = _sql_cases(classify.VERBS, "regexp_matches(lower(endpoint_name), '^({})')", "NULL")
_NOUN = _SINGULAR.format(f"regexp_replace(lower(endpoint_name), '^({'|'.join(classify.NOUN_PREFIXES)})_', '')")
_ENTITY = "CASE " + " ".join(f"WHEN contains(lower(endpoint_name) || ' ' || lower(description), '{e}') THEN '{e}'" for e in classify.ENTITIES) + " ELSE 'item' END"
_OPERATION = _sql_cases(classify.OPERATIONS, "regexp_matches(lower(endpoint_name), '{}')", "'generic'")


@query(
    sql(
        f"""SELECT endpoint_id, CASE WHEN upper(trim(raw_method)) IN ('GET','POST','PUT','DELETE','PATCH') THEN upper(trim(raw_method)) ELSE 'GET' END AS method,
  CASE {" ".join(f"WHEN lower(trim(raw_type)) IN ({', '.join(repr(w) for w in ws)}) THEN '{k}'" for k, ws in classify.PARAMETER_TYPES.items())} ELSE 'unknown' END AS parameter_type,
  {_VERB} AS verb, {_NOUN} AS noun, {_OPERATION} AS operation, {_ENTITY} AS entity_type,
  {_SINGULAR.format(f"regexp_replace(lower(endpoint_name), '^({'|'.join(classify.ENTITY_PREFIXES)})_', '')")} AS entity_name FROM endpoints""",
        "endpoints",
    )
)
def endpoint_classes(spark, d):
    return registry.normalised(adapters.endpoints(spark, d)).select("endpoint_id", "method", "parameter_type", "verb", "noun", "operation", "entity_type", "entity_name")


@query(
    sql(
        """SELECT (SELECT count(DISTINCT tool_name) FROM raw_endpoints) AS total_tools, (SELECT count(DISTINCT category) FROM raw_endpoints) AS total_categories, count(*) AS total_endpoints,
  sum(len(params))::BIGINT AS total_params, round(avg(len(params)), 2) AS avg_params, count(*) FILTER (len(required) > 0) AS with_required FROM endpoints""",
        "endpoints",
    )
)
def registry_stats(spark, d):
    return registry.statistics(adapters.raw_endpoints(spark, d), adapters.endpoints(spark, d))


@query(sql("SELECT category, count(*) AS endpoints, count(DISTINCT tool_name) AS tools FROM endpoints GROUP BY category", "endpoints"))
def registry_categories(spark, d):
    return registry.by_category(adapters.endpoints(spark, d))


@query(
    sql(
        """SELECT endpoint_id, score FROM (SELECT endpoint_id, (2 * contains(lower(endpoint_name), 'gear')::INT + contains(lower(description), 'gear')::INT + contains(lower(tool_name), 'gear')::INT
  + 2 * contains(lower(endpoint_name), 'search')::INT + contains(lower(description), 'search')::INT + contains(lower(tool_name), 'search')::INT)::BIGINT AS score FROM endpoints)
  WHERE score > 0 ORDER BY score DESC, endpoint_id LIMIT 20""",
        "endpoints",
    )
)
def registry_search(spark, d):
    return registry.search(adapters.endpoints(spark, d), ["gear", "search"])


@query(
    sql(
        """, x AS (SELECT *, row_number() OVER (PARTITION BY tool_name, endpoint_name ORDER BY p_partkey) = 1 AS f FROM raw_endpoints),
  y AS (SELECT *, sum(f::INT) OVER (PARTITION BY tool_name ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM x)
  SELECT p_partkey, tool_name, CASE WHEN f THEN endpoint_name ELSE endpoint_name || '_dup' || seen::BIGINT END AS unique_name FROM y""",
        "raw_endpoints",
    )
)
def duplicate_names(spark, d):
    return registry.unique_names(adapters.raw_endpoints(spark, d), "tool_name", "endpoint_name", F.col("p_partkey")).select("p_partkey", "tool_name", "unique_name")


# Graph ---------------------------------------------------------------------

_IO = """(list_has_any([a.noun || '_id', a.noun || 'id', a.noun || '_name', 'id', 'item_id', 'resource_id'], b.params) OR (len(list_intersect(a.params, b.params)) >= 2 AND coalesce(a.verb IN ('search', 'get'), false)))"""
_GRAPH = f""", n AS (SELECT endpoint_id AS id, tool_name, category, {_VERB} AS verb, {_NOUN} AS noun, list_transform(params, lambda p: lower(p)) AS params FROM endpoints),
 size AS (SELECT category, count(*) AS size FROM n GROUP BY category),
 tool AS (SELECT a.id AS source, b.id AS target, true AS near, {_IO} AS io, (contains(a.noun, b.noun) OR contains(b.noun, a.noun)) AND a.verb IS NOT NULL AND b.verb IS NOT NULL
   AND (a.verb || '>' || b.verb) IN ({", ".join(f"'{x}>{y}'" for x, y in graph.SEQUENCES)}) AS complement FROM n a JOIN n b ON a.tool_name = b.tool_name AND a.id <> b.id),
 other AS (SELECT a.id AS source, b.id AS target, a.category, {_IO} AS io, len(list_intersect(a.params, b.params)) + 2 * (a.noun = b.noun)::INT + 5 * {_IO}::INT AS score
   FROM n a JOIN n b ON a.category = b.category AND a.tool_name <> b.tool_name),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) AS rank FROM other JOIN size USING (category)),
 both_ AS (SELECT source, target, near, io, complement FROM tool UNION ALL SELECT source, target, false, io, false FROM ranked WHERE size <= 80 OR rank <= 30),
 relations AS (SELECT source, target, CASE WHEN near THEN 'same_tool' ELSE 'same_category' END AS edge_type FROM both_ UNION ALL SELECT source, target, 'complementary' FROM both_ WHERE complement UNION ALL SELECT source, target, 'io_chain' FROM both_ WHERE io),
 weighted AS (SELECT *, CASE edge_type WHEN 'same_tool' THEN 0.3 WHEN 'same_category' THEN 0.5 WHEN 'complementary' THEN 0.8 ELSE 1.0 END::DOUBLE AS weight,
   CASE edge_type WHEN 'io_chain' THEN 4 WHEN 'complementary' THEN 3 WHEN 'same_category' THEN 2 ELSE 1 END AS priority FROM relations),
 edges AS (SELECT source, target, arg_max(edge_type, priority) AS edge_type, string_agg(DISTINCT edge_type, ',' ORDER BY edge_type) AS edge_types, max(weight) AS weight FROM weighted GROUP BY source, target) """


_SIZE = " size AS (SELECT category, count(*) AS size FROM n GROUP BY category),\n"
_RANKED = " ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) AS rank FROM other JOIN size USING (category)),\n"
#: The graph with all pairs of a category, for the chains.
_WHOLE_GRAPH = _GRAPH.replace(_SIZE, "").replace(_RANKED, "").replace("FROM ranked WHERE size <= 80 OR rank <= 30", "FROM other")


def _edges(spark, d, mesh: int | None = 80):
    e = adapters.endpoints(spark, d)
    return e, graph.edges(graph.relations(e, mesh))


@query(sql(_GRAPH + "SELECT edge_type, count(*) AS matches FROM relations GROUP BY edge_type", "endpoints"))
def edge_matches(spark, d):
    return graph.relations(adapters.endpoints(spark, d)).groupBy("edge_type").agg(F.count("*").alias("matches"))


@query(sql(_GRAPH + "SELECT * FROM edges", "endpoints"))
def tool_graph(spark, d):
    return _edges(spark, d)[1]


@query(sql(_GRAPH + "SELECT edge_type, count(*) AS edges FROM edges GROUP BY edge_type", "endpoints"))
def edge_type_histogram(spark, d):
    return graph.histogram(_edges(spark, d)[1])


@query(sql(_GRAPH + "SELECT (SELECT count(*) FROM n) AS nodes, (SELECT count(*) FROM edges) AS edges, round(2.0 * (SELECT count(*) FROM edges) / (SELECT count(*) FROM n), 2) AS avg_degree", "endpoints"))
def graph_stats(spark, d):
    return graph.degree_statistics(*_edges(spark, d))


@query(
    sql(
        _GRAPH + """, links AS (SELECT source, target FROM edges UNION SELECT target, source FROM edges), reach AS (SELECT id, id AS label FROM n UNION SELECT l.target, r.label FROM reach r JOIN links l ON l.source = r.id WHERE r.label < l.target),
 label AS (SELECT id, min(label) AS component FROM reach GROUP BY id)
 SELECT component, min(category) AS component_category, count(*) AS members FROM label JOIN n USING (id) GROUP BY component""",
        "endpoints",
    ).replace("WITH ", "WITH RECURSIVE ", 1)
)
def graph_components(spark, d):
    e, edge = _edges(spark, d)
    ids = e.select(F.col("endpoint_id").alias("id"), "category")
    return graph.components(ids, edge).join(ids, "id").groupBy("component").agg(F.min("category").alias("component_category"), F.count("*").alias("members"))


@query(
    sql(
        "SELECT category, endpoint_id, rank FROM (SELECT category, endpoint_id, row_number() OVER (ORDER BY category, tool_name, endpoint_name) AS rank FROM endpoints) WHERE rank <= 80",
        "endpoints",
    )
)
def endpoint_diagram(spark, d):
    top = adapters.endpoints(spark, d).orderBy("category", "tool_name", "endpoint_name").limit(80)
    return top.select("category", "endpoint_id", F.row_number().over(Window.orderBy("category", "tool_name", "endpoint_name")).cast("long").alias("rank"))


@query(sql(_GRAPH + "SELECT source, target, edge_type FROM edges ORDER BY CASE edge_type WHEN 'io_chain' THEN 0 WHEN 'complementary' THEN 1 WHEN 'same_tool' THEN 2 ELSE 3 END, source, target LIMIT 120", "endpoints"))
def edge_diagram(spark, d):
    order = classify.first_match([(F.col("edge_type") == k, F.lit(i)) for i, k in enumerate(("io_chain", "complementary", "same_tool"))], F.lit(3))
    return _edges(spark, d)[1].orderBy(order, "source", "target").limit(120).select("source", "target", "edge_type")


# Sampling ------------------------------------------------------------------

_U = "(('0x' || substr(md5({}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _walk_sql(attempts: int, least: int, most: int) -> str:
    u = lambda what: _U.format(f"'42:' || chain_id || ':' || attempt || ':{what}'")
    out = f""", multiplied AS (SELECT source, target, weight * CASE edge_type WHEN 'io_chain' THEN 3.0 WHEN 'complementary' THEN 2.0 WHEN 'same_tool' THEN 1.0 ELSE 0.5 END::DOUBLE AS w FROM edges),
 nodes_ AS (SELECT endpoint_id, row_number() OVER (ORDER BY endpoint_id) - 1 AS spot FROM endpoints), total AS (SELECT count(*) AS total FROM nodes_),
 start AS (SELECT o_orderkey AS chain_id, attempt FROM orders, range(1, {attempts + 1}) t(attempt)),
 w1 AS (SELECT chain_id, attempt, {least} + floor({u("length")} * {most - least + 1}) AS goal, [endpoint_id] AS path FROM start, total, nodes_ WHERE spot = floor({u("start")} * total)::BIGINT)"""
    for k in range(2, most + 1):
        out += f""", c{k} AS (SELECT chain_id, attempt, target, sum(w) OVER (PARTITION BY chain_id, attempt ORDER BY target) AS cum, sum(w) OVER (PARTITION BY chain_id, attempt) AS whole, {u(k)} AS r
   FROM w{k - 1} JOIN multiplied ON source = path[-1] WHERE goal >= {k} AND len(path) = {k - 1} AND NOT list_contains(path, target)),
 p{k} AS (SELECT chain_id, attempt, coalesce(min(target) FILTER (round(r * whole, 9) <= round(cum, 9)), max(target)) AS next FROM c{k} GROUP BY chain_id, attempt),
 w{k} AS (SELECT w.chain_id, w.attempt, goal, CASE WHEN next IS NULL THEN path ELSE list_append(path, next) END AS path FROM w{k - 1} w LEFT JOIN p{k} p ON w.chain_id = p.chain_id AND w.attempt = p.attempt)"""
    return (
        out
        + f""", steps AS (SELECT chain_id, attempt, unnest(path) AS endpoint_id FROM w{most}),
 described AS (SELECT chain_id, attempt, count(*) AS steps, count(DISTINCT tool_name) AS tools, string_agg(DISTINCT category, ',' ORDER BY category) AS domains,
   bool_or(regexp_matches(endpoint_name, 'create|add|book')) AS c, bool_or(regexp_matches(endpoint_name, 'get|list|search')) AS r, bool_or(regexp_matches(endpoint_name, 'update|modify')) AS u, bool_or(regexp_matches(endpoint_name, 'delete|remove|cancel')) AS d
   FROM steps JOIN endpoints USING (endpoint_id) GROUP BY ALL),
 chains AS (SELECT w.chain_id, w.attempt, array_to_string(path, ' > ') AS path, steps, tools, domains, CASE WHEN steps = 1 THEN 'single_step' WHEN c::INT + r::INT + u::INT + d::INT >= 3 THEN 'crud_cycle' WHEN r AND (c OR u OR d) THEN 'search_and_act' ELSE 'multi_step' END AS pattern
   FROM w{most} w JOIN described USING (chain_id, attempt)) """
    )


def _chains(spark, d, attempts: int = 2, least: int = 1, most: int = 5):
    e, edge = _edges(spark, d, mesh=None)
    return e, sampler.described_walks(_chain_ids(spark, d), e, edge, least, most, attempts)


def _chain_ids(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("chain_id"))


def _retried(spark, d, tiers, attempts: int):
    e = written(adapters.endpoints(spark, d))
    return sampler.retried(_chain_ids(spark, d), e, written(graph.edges(graph.relations(e, mesh=None))), tiers, 1, 5, attempts)


@query(sql(_WHOLE_GRAPH + _walk_sql(50, 1, 5) + "SELECT * FROM chains WHERE steps >= 2 AND tools >= 2 QUALIFY row_number() OVER (PARTITION BY chain_id ORDER BY attempt) = 1", "endpoints"))
def sample_chains(spark, d):
    ok = _retried(spark, d, [sampler.Limits(2, 5, 2)], 50)
    return ok.select("chain_id", "attempt", F.array_join("path", " > ").alias("path"), "steps", "tools", F.array_join("domains", ",").alias("domains"), "pattern")


@query(
    sql(
        _WHOLE_GRAPH + _walk_sql(100, 1, 5) + """, t AS (SELECT *, CASE WHEN steps >= 3 AND tools >= 2 AND contains(domains, 'Travel') THEN 0 WHEN steps >= 3 AND tools >= 2 THEN 1 WHEN contains(domains, 'Travel') THEN 2 ELSE 3 END AS tier FROM chains)
  SELECT chain_id, tier, attempt, steps, pattern FROM t QUALIFY row_number() OVER (PARTITION BY chain_id ORDER BY tier, attempt) = 1""",
        "endpoints",
    )
)
def relaxed_chains(spark, d):
    tiers = [sampler.Limits(3, 5, 2, ["Travel"]), sampler.Limits(3, 5, 2), sampler.Limits(1, 5, 1, ["Travel"]), sampler.Limits(1, 5, 1)]
    return _retried(spark, d, tiers, 100).select("chain_id", "tier", "attempt", "steps", "pattern")


@query(
    sql(
        _WHOLE_GRAPH + _walk_sql(2, 1, 5) + """SELECT reason, count(*) AS chains FROM (SELECT unnest(list_filter([CASE WHEN steps < 2 THEN 'min_steps' END, CASE WHEN tools < 2 THEN 'min_distinct_tools' END, CASE WHEN NOT contains(domains, 'Food') THEN 'required_domains' END, CASE WHEN pattern NOT IN ('search_and_act', 'multi_step') THEN 'pattern' END], lambda x: x IS NOT NULL)) AS reason FROM chains) GROUP BY reason""",
        "endpoints",
    )
)
def constraint_violations(spark, d):
    _, c = _chains(spark, d)
    broken = sampler.violations(2, 5, 2, ["Food"], None, ["search_and_act", "multi_step"])
    return c.select(F.explode(broken).alias("reason")).groupBy("reason").agg(F.count("*").alias("chains"))


@query("SELECT o_orderkey AS chain_id, row_number() OVER (ORDER BY o_orderkey) <= floor(0.55 * (SELECT count(*) FROM orders)) AS forced FROM orders")
def multi_step_quota(spark, d):
    c = table(spark, d, "orders").select(F.col("o_orderkey").alias("chain_id"))
    return sampler.quota(c, 0.55, c.count())


@query(
    sql(
        _GRAPH + _walk_sql(100, 1, 5) + """, flags AS (SELECT o_orderkey AS chain_id, row_number() OVER (ORDER BY o_orderkey) <= floor(0.55 * (SELECT count(*) FROM orders)) AS forced FROM orders),
 t AS (SELECT *, CASE WHEN forced THEN CASE WHEN steps >= 3 AND tools >= 2 AND contains(domains, 'Food') THEN 0 WHEN steps >= 3 AND tools >= 2 THEN 1 WHEN contains(domains, 'Food') THEN 2 ELSE 3 END WHEN contains(domains, 'Food') THEN 0 ELSE 1 END AS tier FROM chains JOIN flags USING (chain_id))
  SELECT chain_id, forced, tier, attempt, steps, pattern FROM t QUALIFY row_number() OVER (PARTITION BY chain_id ORDER BY tier, attempt) = 1""",
        "endpoints",
    )
)
def quota_chains(spark, d):
    """Quota, preferred domain and retries in one run."""
    e, ids = written(adapters.endpoints(spark, d)), _chain_ids(spark, d)
    found = workflow.with_quota(ids, e, written(graph.edges(graph.relations(e))), 0.55, ids.count(), domains=["Food"])
    return found.select("chain_id", "forced", "tier", "attempt", "steps", "pattern")


# Judging and repair --------------------------------------------------------

_JUDGED = """, results AS (SELECT conv_id, step, CASE WHEN k % 2 = 0 THEN k::VARCHAR END AS id FROM calls WHERE k % 10 < 9),
 mapped AS (SELECT CAST(conv_id AS VARCHAR) AS conv_id, turn, role, CASE WHEN turn = 1 THEN text || '?' ELSE text END AS text FROM conversations),
 c AS (SELECT (hash_id)::VARCHAR AS conv_id, step, k::VARCHAR AS k, (k % 17 = 0)::INT AS structural FROM (SELECT split_part(conv_id, '-', 1) AS hash_id, row_number() OVER (PARTITION BY split_part(conv_id, '-', 1) ORDER BY conv_id, step) AS step, k FROM calls)),
 r AS (SELECT conv_id, step, CASE WHEN k::BIGINT % 2 = 0 THEN k END AS id FROM c WHERE k::BIGINT % 10 < 9),
 shown AS (SELECT conv_id, id AS k, min(step) AS shown FROM r WHERE id IS NOT NULL GROUP BY ALL), since AS (SELECT conv_id, min(shown) AS from_step FROM shown GROUP BY conv_id),
 bad AS (SELECT c.conv_id, count(*) AS ungrounded FROM c JOIN since USING (conv_id) LEFT JOIN shown USING (conv_id, k) WHERE from_step < c.step AND (shown IS NULL OR shown >= c.step) GROUP BY c.conv_id),
 m AS (SELECT conv_id, count(*) AS messages, count(*) FILTER (role = 'user') AS users, bool_or(role = 'assistant' AND contains(text, '?')) AS asks, arg_max(text, turn) FILTER (role = 'assistant' AND trim(text) <> '') AS last FROM mapped GROUP BY conv_id),
 j AS (SELECT m.*, coalesce(nc, 0) AS nc, coalesce(st, 0) AS st, coalesce(nr, 0) AS nr, coalesce(ungrounded, 0) AS ug FROM m LEFT JOIN (SELECT conv_id, count(*) AS nc, sum(structural) AS st FROM c GROUP BY conv_id) USING (conv_id) LEFT JOIN (SELECT conv_id, count(*) AS nr FROM r GROUP BY conv_id) USING (conv_id) LEFT JOIN bad USING (conv_id)),
 s AS (SELECT conv_id, round(greatest(1, least(5, 5.0 - 2.0 * (nc = 0)::INT - (nr < nc)::INT - least(2.0, 0.75 * ug) - least(1.0, 0.5 * st))), 2)::DOUBLE AS tool_correctness,
  round(greatest(1, least(5, 4.0 + 0.5 * (asks AND users >= 2)::INT - (messages < 4)::INT)), 2)::DOUBLE AS naturalness,
  round(greatest(1, least(5, CASE WHEN last IS NOT NULL AND nc > 0 THEN 5.0 ELSE 3.0 END - 0.5 * (last IS NOT NULL AND NOT regexp_matches(lower(last), 'done|completed|confirmed|reference'))::INT)), 2)::DOUBLE AS task_completion FROM j),
 scored AS (SELECT *, round((tool_correctness + naturalness + task_completion) / 3, 2) AS overall FROM s) """


def _scored(spark, d):
    """Users' calls judged with the conversation of the same number; calls show the even ids, nine of ten have a result."""
    c = adapters.calls(spark, d).withColumn("user", F.split("conv_id", "-").getItem(0))
    step = F.row_number().over(Window.partitionBy("user").orderBy("conv_id", "step"))
    c = c.select(F.col("user").alias("conv_id"), step.alias("step"), F.col("k").alias("n"))
    calls = c.select("conv_id", "step", F.col("n").cast("string").alias("k"), (F.col("n") % 17 == 0).cast("int").alias("structural"))
    results = c.where(F.col("n") % 10 < 9).select("conv_id", "step", F.when(F.col("n") % 2 == 0, F.array(F.col("n").cast("string"))).otherwise(F.array().cast("array<string>")).alias("ids"))
    m = adapters.messages(spark, d).select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", F.when(F.col("turn") == 1, F.concat("text", F.lit("?"))).otherwise(F.col("text")).alias("text"))
    return judge.scores(calls, results, m)


@query(sql(_JUDGED + "SELECT * FROM scored", "calls"))
def heuristic_judge(spark, d):
    return _scored(spark, d)


@query(sql(_JUDGED + "SELECT count(*) AS scored, count(*) FILTER (overall >= 3.5) AS passing, round(avg(overall), 2) AS avg_overall, round(avg(tool_correctness), 2) AS avg_tool_correctness, round(avg(naturalness), 2) AS avg_naturalness, round(avg(task_completion), 2) AS avg_task_completion FROM scored", "calls"))
def quality_gate(spark, d):
    return judge.quality_gate(_scored(spark, d))


@query(sql(_JUDGED + "SELECT conv_id, array_to_string(list_filter([CASE WHEN tool_correctness < 4 THEN 'tool_correctness: ' || printf('%.2f', tool_correctness) END, CASE WHEN naturalness < 4 THEN 'naturalness: ' || printf('%.2f', naturalness) END, CASE WHEN task_completion < 4 THEN 'task_completion: ' || printf('%.2f', task_completion) END], lambda x: x IS NOT NULL), '; ') AS feedback FROM scored", "calls"))
def judge_feedback(spark, d):
    return judge.feedback(_scored(spark, d))


_SHORT = "CASE WHEN length({0}) <= {1} THEN {0} ELSE rtrim(left({0}, {1} - 3)) || '...' END"
_FLAT = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query(
    f"""WITH m AS (SELECT conv_id, turn, role, {_FLAT} AS t, text FROM conversations WHERE role IN ('user', 'assistant', 'tool') AND (role <> 'assistant' OR text <> ''))
 SELECT conv_id, count(*) AS lines, string_agg(CASE role WHEN 'user' THEN 'USER: ' WHEN 'assistant' THEN 'ASSISTANT: ' ELSE 'TOOL RESULT: ' END || {_SHORT.format("t", 300)}, chr(10) ORDER BY turn) AS transcript FROM m GROUP BY conv_id"""
)
def transcript(spark, d):
    return judge.transcript(adapters.messages(spark, d))


@query(
    """WITH m AS (SELECT *, min(turn) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS fu, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations),
 k AS (SELECT *, 4 - (fu IS NOT NULL AND max((turn = fu AND back <= 4)::INT) OVER (PARTITION BY conv_id) = 0)::INT AS keep FROM m)
 SELECT conv_id, turn, role, text FROM k WHERE back <= keep OR turn = fu"""
)
def history_window(spark, d):
    return judge.history(adapters.messages(spark, d), 4)


def _repeated_roles(spark, d):
    """All messages, and after every third one more of the same role."""
    m = adapters.messages(spark, d)
    more = m.where("turn % 3 = 1").select("conv_id", 2 * F.col("turn") + 1, "role", F.concat(F.lit("again "), F.col("turn").cast("string")))
    return m.select("conv_id", (2 * F.col("turn")).alias("turn"), "role", "text").union(more)


@query(
    """WITH talk_ AS (SELECT conv_id, 2 * turn AS turn, role, text FROM conversations UNION ALL SELECT conv_id, 2 * turn + 1, role, 'again ' || turn FROM conversations WHERE turn % 3 = 1), m AS (SELECT * FROM talk_ WHERE role IN ('user', 'assistant', 'tool', 'system') AND NOT (role = 'user' AND coalesce(text, '') = '')),
 x AS (SELECT *, CASE WHEN coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') <> role OR role = 'tool' THEN 1 ELSE 0 END AS new FROM m),
 y AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM x)
 SELECT conv_id, min(turn) AS turn, min(role) AS role, count(*) AS parts, string_agg(text, chr(10) ORDER BY turn) AS text FROM y GROUP BY conv_id, island"""
)
def structural_repair(spark, d):
    return repair.merged(repair.valid(_repeated_roles(spark, d)))


@query(
    """WITH talk_ AS (SELECT conv_id, 2 * turn AS turn, role, text FROM conversations UNION ALL SELECT conv_id, 2 * turn + 1, role, 'again ' || turn FROM conversations WHERE turn % 3 = 1), m AS (SELECT * FROM talk_ WHERE role IN ('user', 'assistant', 'tool', 'system') AND NOT (role = 'user' AND coalesce(text, '') = '')),
 x AS (SELECT *, CASE WHEN coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') <> role OR role = 'tool' THEN 1 ELSE 0 END AS new FROM m),
 y AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM x)
 SELECT conv_id, min(turn) AS turn, min(role) AS role, string_agg(text, chr(10) ORDER BY turn) AS text, 0::BIGINT AS calls FROM y GROUP BY conv_id, island"""
)
def structural_repair_fold(spark, d):
    """The full rule as a fold; without calls it does as the islands do, which the oracle states."""
    return repair.folded(repair.valid(_repeated_roles(spark, d).withColumn("calls", F.lit(0))))


@query(
    sql(
        """SELECT conv_id, count(*) AS num_turns, count(*) FILTER (step % 2 = 1) AS num_tool_calls, count(DISTINCT tool) FILTER (step % 2 = 1) AS num_distinct_tools, coalesce(string_agg(endpoint_id, ',' ORDER BY step) FILTER (step % 2 = 1), '') AS tools_used FROM calls GROUP BY conv_id""",
        "calls",
    )
)
def repair_recount(spark, d):
    c = adapters.calls(spark, d)
    return repair.recounted(c, c.where("step % 2 = 1"))


@query(sql("SELECT conv_id, step, endpoint_id FROM calls c WHERE EXISTS (SELECT 1 FROM calls k WHERE k.conv_id = c.conv_id AND k.endpoint_id = c.endpoint_id AND k.step % 2 = 1)", "calls"))
def repair_kept_steps(spark, d):
    c = adapters.calls(spark, d)
    return repair.kept_steps(c.select("conv_id", "step", "endpoint_id"), c.where("step % 2 = 1"))


@query(
    sql(
        """, a AS (SELECT conv_id, step - 1 AS attempt, 1 + k % 5 + (k % 7) / 10.0 AS overall FROM calls)
  SELECT conv_id, attempt, overall::DOUBLE AS overall, overall >= 4.0 AS passes FROM a QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY (overall >= 4.0) DESC, CASE WHEN overall >= 4.0 THEN 0 ELSE -overall END, attempt) = 1""",
        "calls",
    )
)
def repair_loop(spark, d):
    a = adapters.calls(spark, d).select("conv_id", (F.col("step") - 1).alias("attempt"), (1 + F.col("k") % 5 + F.round((F.col("k") % 7) / 10, 1)).alias("overall"))
    return repair.best_attempt(a.withColumn("overall", F.round("overall", 1)), 4.0)


# Traces --------------------------------------------------------------------

_SOURCES = """, prior AS (SELECT a.conv_id, a.step, a.k, arg_max(b.endpoint_id, b.step) AS source_endpoint FROM calls a JOIN calls b ON a.conv_id = b.conv_id AND a.k = b.k AND b.step < a.step GROUP BY ALL),
 asks AS (SELECT conv_id, 0 AS turn, 'Take ' || sum(k)::BIGINT AS text FROM calls GROUP BY conv_id UNION ALL SELECT conv_id, 2 * step + 1, 'Not ' || (k + 1) || ' BUT A' || k || 'b' FROM calls WHERE step % 2 = 0),
 asked AS (SELECT DISTINCT c.conv_id, c.step FROM calls c JOIN asks a ON a.conv_id = c.conv_id AND a.turn < 2 * c.step AND contains(lower(a.text), c.k::VARCHAR)),
 sources AS (SELECT c.conv_id, c.step, 'k' AS name, c.k::VARCHAR AS value, CASE WHEN p.source_endpoint IS NOT NULL THEN 'previous_tool_result' WHEN u.step IS NOT NULL THEN 'user_request' WHEN c.k = 7 THEN 'tool_default' ELSE 'generated' END AS source, p.source_endpoint,
  CASE WHEN p.source_endpoint IS NOT NULL THEN 'matched $.k from ' || p.source_endpoint WHEN u.step IS NOT NULL THEN 'value appeared in a prior user message' WHEN c.k = 7 THEN 'default value for parameter k' ELSE 'filled from the sampled schema and generator policy' END AS evidence
  FROM calls c LEFT JOIN prior p ON c.conv_id = p.conv_id AND c.step = p.step LEFT JOIN asked u ON u.conv_id = c.conv_id AND u.step = c.step) """


def _sources(spark, d):
    """Calls lie at even turns; a user's first message is before all, others follow every second call, and count for later calls alone."""
    c = adapters.calls(spark, d)
    value = F.col("k").cast("string").alias("value")
    args = c.select("conv_id", "step", (2 * F.col("step")).alias("turn"), "endpoint_id", F.lit("k").alias("name"), value)
    results = jsonpath.flatten(c, "args", "conv_id", "step", "endpoint_id")
    requests = c.groupBy("conv_id").agg(F.concat(F.lit("Take "), F.sum("k").cast("string")).alias("text")).select("conv_id", F.lit(0).cast("long").alias("turn"), "text")
    later = c.where("step % 2 = 0").select("conv_id", (2 * F.col("step") + 1).alias("turn"), F.concat(F.lit("Not "), (F.col("k") + 1).cast("string"), F.lit(" BUT A"), F.col("k").cast("string"), F.lit("b")).alias("text"))
    defaults = c.select("endpoint_id").distinct().select("endpoint_id", F.lit("k").alias("name"), F.lit("7").alias("default"))
    return traces.argument_sources(args, results, requests.union(later), defaults)


@query(sql(_SOURCES + "SELECT * FROM sources", "calls"))
def argument_sources(spark, d):
    return _sources(spark, d)


@query(sql(_SOURCES + "SELECT conv_id, step, source_endpoint AS depends_on FROM sources WHERE source_endpoint IS NOT NULL", "calls"))
def step_dependencies(spark, d):
    return traces.dependencies(_sources(spark, d))


@query(
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS i FROM lineitem)
 SELECT o_orderkey AS order_id, '$.id' AS path, o_orderkey::VARCHAR AS value FROM orders UNION ALL SELECT o_orderkey, '$.status', o_orderstatus FROM orders UNION ALL SELECT o_orderkey, '$.customer.customer_id', o_custkey::VARCHAR FROM orders
 UNION ALL SELECT l_orderkey, '$.lines[' || i || '].item_id', l_partkey::VARCHAR FROM l WHERE l_orderkey IN (SELECT o_orderkey FROM orders)"""
)
def output_refs(spark, d):
    """Ids and states out of nested order documents."""
    key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(key)).alias("x"))
    o = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.struct(F.col("o_custkey").alias("customer_id"), F.lit("x").alias("note")).alias("customer"), F.transform("x", lambda s: F.struct(s["l_partkey"].alias("item_id"), s["l_linenumber"].alias("line"))).alias("lines")))
    flat = jsonpath.flatten(o.select(F.col("o_orderkey").alias("order_id"), doc.alias("doc")), "doc", "order_id")
    return flat.where(jsonpath.is_reference(F.col("path"))).select("order_id", "path", "value")


_CALL_EDGES = """, e AS (SELECT DISTINCT a.endpoint_id AS source, b.endpoint_id AS target, CASE WHEN a.tool = b.tool THEN 'same_tool' ELSE 'same_category' END AS edge_type FROM calls a JOIN (SELECT DISTINCT endpoint_id, tool, category FROM calls) b ON a.category = b.category AND a.endpoint_id <> b.endpoint_id)"""


@query(
    sql(
        _CALL_EDGES + """, c AS (SELECT conv_id, step, endpoint_id, lag(endpoint_id) OVER (PARTITION BY conv_id ORDER BY step) AS before FROM calls)
 SELECT conv_id, step AS ord, 'tool_call' AS kind, endpoint_id, CASE WHEN before IS NULL THEN 'start' ELSE coalesce(edge_type, 'none') END AS relation, CASE WHEN before IS NULL OR edge_type IS NOT NULL THEN 'ok' ELSE 'warn' END AS status FROM c LEFT JOIN e ON source = before AND target = endpoint_id
 UNION ALL SELECT conv_id, max(step) + 1, 'judge', '', 'end', 'ok' FROM calls GROUP BY conv_id""",
        "calls",
    )
)
def trace_events(spark, d):
    c = adapters.calls(spark, d)
    n = c.select("endpoint_id", "tool", "category").distinct()
    a, b = n.alias("a"), n.alias("b")
    e = a.join(b, F.col("a.category") == F.col("b.category")).where("a.endpoint_id <> b.endpoint_id").select(F.col("a.endpoint_id").alias("source"), F.col("b.endpoint_id").alias("target"), F.when(F.col("a.tool") == F.col("b.tool"), "same_tool").otherwise("same_category").alias("edge_type"))
    return traces.events(c, e)


@query(sql("SELECT conv_id FROM calls GROUP BY conv_id HAVING bool_or(contains(lower(endpoint_id), 'order')) AND bool_or(tool = 'catalog_api') AND bool_or(tool = 'account_api')", "calls"))
def conversation_filter(spark, d):
    return traces.filter_conversations(adapters.calls(spark, d), "Order", ["catalog_api", "account_api"], True)


@query(sql("SELECT endpoint_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, endpoint_id) AS rank FROM calls GROUP BY endpoint_id", "calls"))
def tool_options(spark, d):
    return traces.tool_options(adapters.calls(spark, d))


# Steering ------------------------------------------------------------------

@query(sql(_with(_PAIRS, source="traces") + "SELECT first, second, n FROM (SELECT * FROM pairs ORDER BY n DESC, first, second LIMIT 5) WHERE n >= greatest(2.0, (SELECT max(n) FROM pairs) * 0.7)", "traces"))
def steering_avoid_pairs(spark, d):
    return steering.overused_pairs(diversity.tool_pairs(adapters.traces(spark, d)))


@query(
    sql(
        _with(_DOMAINS) + """, a AS (SELECT c.category, coalesce(conversations, 0) AS n FROM (SELECT DISTINCT category FROM raw_endpoints) c LEFT JOIN domains USING (category)),
 l AS (SELECT *, n < 0.5 * (SELECT avg(n) FROM a) AS low, row_number() OVER (ORDER BY n, category) AS rank FROM a)
 SELECT category, n FROM l WHERE low OR (NOT (SELECT bool_or(low) FROM l) AND rank <= 3)""",
        "calls",
        "raw_endpoints",
    )
)
def steering_prefer_domains(spark, d):
    return steering.underused_domains(adapters.raw_endpoints(spark, d), diversity.domain_counts(adapters.calls(spark, d)))


@query(sql(_with(_CONV) + ", r AS (SELECT count(*) FILTER (pattern IN ('multi_step', 'search_and_act')) / count(*) AS r FROM conversations_) SELECT round(r, 4) AS multi_step_ratio, CASE WHEN r < 0.5 THEN 'Prefer multi-step scenarios' WHEN r > 0.7 THEN 'Allow simpler single-step scenarios' ELSE '' END AS hint FROM r", "calls"))
def steering_complexity(spark, d):
    return steering.complexity_hint(diversity.patterns(adapters.calls(spark, d)))


@query(
    sql(
        """, daily AS (SELECT right(conv_id, 10) AS day, category, count(DISTINCT conv_id) AS n FROM calls GROUP BY ALL),
 grid AS (SELECT * FROM (SELECT DISTINCT day FROM daily), (SELECT DISTINCT category FROM daily)), f AS (SELECT day, category, coalesce(n, 0) AS n FROM grid LEFT JOIN daily USING (day, category))
 SELECT day, category, coalesce(sum(n) OVER (PARTITION BY category ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM f""",
        "calls",
    )
)
def steering_running_coverage(spark, d):
    return steering.running_domains(adapters.calls(spark, d).withColumn("day", F.expr("right(conv_id, 10)")))


@query(sql(_with(_PAIRS, _DOMAINS, _CONV) + "SELECT 'domain' AS kind, category AS label, conversations AS n FROM domains UNION ALL SELECT 'pattern', pattern, count(*) FROM conversations_ GROUP BY pattern UNION ALL SELECT 'pair', first || ' + ' || second, n FROM (SELECT * FROM pairs ORDER BY n DESC, first, second LIMIT 10)", "calls"))
def steering_summary(spark, d):
    return steering.summary(adapters.calls(spark, d))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def steering_stream(spark, d):
    """The counters as a stream keeps them, drained once over the stored events."""
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return coverage.drained(spark, stream, shared_folder(spark), "event_type")


# Execution and conversations -----------------------------------------------

@query(
    sql(
        f""", c AS (SELECT p_partkey AS call_id, tool_name || '/' || endpoint_name AS endpoint_id, {_OPERATION} AS operation, {_ENTITY} AS entity, required, p_partkey || ':' || tool_name || '/' || endpoint_name AS key FROM raw_endpoints),
 p AS (SELECT *, CASE entity {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in classify.ENTITIES.items())} ELSE 'itm' END AS prefix FROM c)
 SELECT call_id, endpoint_id, operation, entity, CASE operation WHEN 'search' THEN prefix || '_' || substr(md5(entity || ':' || key || ':0'), 1, 4) WHEN 'create' THEN prefix || '_' || substr(md5(entity || ':' || key), 1, 4) WHEN 'get' THEN 'x' || call_id WHEN 'update' THEN 'x' || call_id WHEN 'delete' THEN 'x' || call_id END AS result_id,
  CASE WHEN operation = 'search' THEN (2 + floor({_U.format("key || ':count'")} * 4))::BIGINT ELSE 1 END AS results,
  CASE operation WHEN 'create' THEN 'confirmed' WHEN 'update' THEN 'updated' WHEN 'delete' THEN 'deleted' WHEN 'search' THEN 'ok' WHEN 'get' THEN 'ok' ELSE 'success' END AS status FROM p""",
        "raw_endpoints",
    )
)
def mock_execute(spark, d):
    r = adapters.raw_endpoints(spark, d)
    calls = r.select(F.col("p_partkey").alias("call_id"), classify.endpoint_id(F.col("tool_name"), F.col("endpoint_name")).alias("endpoint_id"), "endpoint_name", "description", F.create_map(F.lit("id"), F.concat(F.lit("x"), F.col("p_partkey").cast("string"))).alias("arguments"))
    return executor.execute(calls).drop("result")


@query()
def mock_results(spark, d):
    r = adapters.raw_endpoints(spark, d).repartition("p_partkey")  # parts are few bytes a row, so a split has very many
    calls = r.select(F.col("p_partkey").alias("call_id"), classify.endpoint_id(F.col("tool_name"), F.col("endpoint_name")).alias("endpoint_id"), "endpoint_name", "description", F.create_map(F.lit("id"), F.concat(F.lit("x"), F.col("p_partkey").cast("string"))).alias("arguments"))
    return jsonpath.flatten(executor.execute(calls), "result", "call_id").where(jsonpath.is_id(F.col("path")))


@query()
def offline_conversations(spark, d):
    e, c = _chains(spark, d, attempts=1)
    return conversation.conversations(c.select("chain_id", "path"), e)


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE len(embedding) > 0), n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS l FROM v),
 s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e) / (q.l * x.l) AS score FROM n q JOIN n x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0)
 SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, vec_id) AS rank FROM s QUALIFY rank <= 5"""
)
def memory_topk(spark, d):
    v = table(spark, d, "embeddings")
    return memory.nearest(v, v.where("vec_id % 20 = 0"))


# Text ----------------------------------------------------------------------

_LAST = r"greatest({})".format(", ".join(f"CASE WHEN instr(reverse(left(t, 200)), '{m[::-1]}') > 0 THEN 200 - instr(reverse(left(t, 200)), '{m[::-1]}') - 1 ELSE -1 END" for m in (". ", "? ", "! ")))


@query(
    f"""WITH x AS (SELECT doc_id, {_FLAT} AS t FROM documents), y AS (SELECT *, {_LAST} AS cut FROM x)
 SELECT doc_id, {_SHORT.format("t", 200)} AS short, CASE WHEN length(t) <= 200 THEN t WHEN cut >= 100 THEN left(t, cut + 1) ELSE rtrim(left(t, 197)) || '...' END AS sentence, CASE WHEN length(t) <= 60 THEN t ELSE rtrim(left(t, 59)) || '…' END AS status,
  translate({_SHORT.format("t", 80)}, '"[]{{}}', '''()()') AS label FROM y"""
)
def shortened_texts(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.shorten(t, 200).alias("short"), text.shorten_at_sentence(t, 200).alias("sentence"), text.ellipsis(t, 60).alias("status"), text.diagram_label(t).alias("label"))


@query(
    r"""WITH x AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS p FROM pages), y AS (SELECT page_id, list_filter(string_split(p, '/'), lambda s: s NOT IN ('', '.', '..')) AS parts FROM x),
 z AS (SELECT page_id, list_transform(parts, lambda s: regexp_replace(regexp_replace(s, '[^\p{L}\p{N}_.-]', '_', 'g'), '^[._]+|[._]+$', '', 'g')) AS parts FROM y)
 SELECT page_id, CASE WHEN len(parts) = 0 THEN 'unnamed.json' ELSE array_to_string(list_transform(parts, lambda s: CASE WHEN s = '' THEN 'unnamed' ELSE s END), '/') END AS path FROM z"""
)
def safe_paths(spark, d):
    return table(spark, d, "pages").select("page_id", text.safe_path(F.regexp_replace("url", "^[a-z]+://", "")).alias("path"))


_SOFT = "CASE " + " ".join(f"WHEN {{0}} LIKE '{a}%' THEN '{b}' || substr({{0}}, {len(a) + 1})" for a, b in text.SOFTER.items()) + " ELSE {0} END"


@query(
    sql(
        f""", x AS (SELECT *, lower(regexp_replace(trim(description), '\\.+$', '')) AS s, lower(replace(endpoint_name, '_', ' ')) AS n FROM endpoints)
 SELECT endpoint_id, CASE WHEN description <> '' THEN {_SOFT.format("s")} ELSE {_SOFT.format("n")} END AS task, 'Step 1/2: ' || CASE WHEN trim(description) <> '' THEN trim(description) ELSE 'call ' || replace(endpoint_name, '_', ' ') END AS goal,
  CASE len(params) WHEN 0 THEN 'details' WHEN 1 THEN replace(l[1], '_', ' ') WHEN 2 THEN l[1] || ' and ' || l[2] ELSE array_to_string(l[:-2], ', ') || ', and ' || l[-1] END AS labels
 FROM (SELECT *, list_transform(params, lambda p: CASE WHEN p = 'max_price' THEN 'budget' WHEN p LIKE '%\\_id' ESCAPE '\\' THEN replace(p[:-4], '_', ' ') || ' reference' ELSE replace(p, '_', ' ') END) AS l FROM x)""",
        "endpoints",
    )
)
def natural_phrases(spark, d):
    name, said = F.col("endpoint_name"), F.col("description")
    return adapters.endpoints(spark, d).select("endpoint_id", text.natural_task(name, said).alias("task"), text.step_goal(name, said, F.col("endpoint_id"), F.lit(1), F.lit(2)).alias("goal"), text.join_naturally(F.transform("params", text.parameter_label)).alias("labels"))


@query(
    r"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace('Use the API endpoint of ' || text || ' tools', 'catalog_api', 'the service', 'gi'), '\bAPIs?\b', 'service', 'gi'), '\bendpoints\b', 'options', 'gi'), '\bendpoint\b', 'option', 'gi'), '\btools\b', 'steps', 'gi'), '\s+', ' ', 'g')) AS text
 FROM (SELECT conv_id, turn, replace(text, ' de ', ' CATALOG_API ') AS text FROM conversations)"""
)
def sanitized_messages(spark, d):
    m = adapters.messages(spark, d).withColumn("text", F.concat(F.lit("Use the API endpoint of "), F.replace("text", F.lit(" de "), F.lit(" CATALOG_API ")), F.lit(" tools")))
    names = F.array(F.struct(F.lit("catalog_api").alias("raw"), F.lit("the service").alias("plain")))
    return m.select("conv_id", "turn", text.sanitize(F.col("text"), names).alias("text"))


@query(
    """SELECT event_id, event_type AS endpoint, '{"k":' || json_extract_string(props, '$.k') || '}' AS arguments FROM events WHERE event_id % 3 <> 0 AND event_type <> 'error'"""
)
def json_tool_calls(spark, d):
    """Calls read out of prose with a fenced JSON object; two of three are well formed."""
    e = table(spark, d, "events")
    fence = "`" * 3
    prose = F.concat(F.lit(f"Sure.\n{fence}json\n"), F.lit('{"action": "'), F.when(F.col("event_id") % 3 == 0, "reply").otherwise("tool_call"), F.lit('", "endpoint": "'), F.when(F.col("event_type") == "error", " ").otherwise(F.col("event_type")), F.lit('", "arguments": '), F.col("props"), F.lit(f"}}\n{fence}\n")) 
    call = jsonpath.tool_call(prose)
    return e.select("event_id", call.alias("c")).where("c is not null").select("event_id", "c.endpoint", "c.arguments")


@query(
    """SELECT event_id, greatest(1.0, least(5.0, CASE WHEN event_id % 3 = 2 THEN 3.0 ELSE value / 10 END)) AS score FROM events"""
)
def json_judge_scores(spark, d):
    e = table(spark, d, "events")
    v = (F.col("value") / 10).cast("string")
    doc = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"naturalness": {"score": '), v, F.lit("}}"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"naturalness": '), v, F.lit("}"))).otherwise("{}")
    return e.select("event_id", jsonpath.judge_score(doc, "naturalness").alias("score"))

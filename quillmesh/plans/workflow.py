"""From tool files to judged conversations: what the command line runs, as functions over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions import classify, jsonpath
from quillmesh.operators import conversation, diversity, graph, judge, registry, sampler, steering
from quillmesh.plans.runtime import written
from quillmesh.sources import files


def load_registry(spark: SparkSession, folder: str, categories: list[str] | None = None, most: int = 0) -> DataFrame:
    """Endpoints of all tool files: ids unique, parameters merged, types and methods normal."""
    rows = files.api_columns(files.tool_files(spark, folder, categories, most))
    rows = registry.unique_names(rows.withColumn("group", F.concat_ws("/", "path", "tool_name")), "group", "endpoint_name", F.col("pos"))
    names = lambda c: F.array_distinct(F.transform(c, lambda p: p["name"]))
    rows = rows.select("path", "pos", "category", "tool_name", F.col("unique_name").alias("endpoint_name"), "description", classify.http_method(F.col("raw_method")).alias("method"), names("required").alias("required"), F.array_union(names("required"), names("optional")).alias("params"), "response_schema")
    rows = rows.withColumn("endpoint_id", classify.endpoint_id(F.col("tool_name"), F.col("endpoint_name")))
    # Of two files with one endpoint, the later counts.
    last = rows.groupBy("endpoint_id").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "endpoint_id")), F.struct("path", "pos")).alias("r"))
    return last.select("endpoint_id", "r.*").drop("path", "pos")


def build_graph(endpoints: DataFrame) -> DataFrame:
    return written(graph.edges(graph.relations(endpoints)))


def build(endpoints: DataFrame, out: str) -> None:
    """Endpoints, edges, statistics and a diagram below ``out``."""
    edges = build_graph(endpoints)
    files.write_json_lines(endpoints, f"{out}/endpoints", "endpoint_id")
    files.write_json_lines(edges, f"{out}/edges", "source", "target")
    files.write_json_lines(registry.statistics(endpoints, endpoints), f"{out}/registry_stats")
    files.write_json_lines(graph.degree_statistics(endpoints, edges), f"{out}/graph_stats")
    files.write_json_lines(graph.histogram(edges), f"{out}/edge_types", "edge_type")
    files.write_diagram(edges, f"{out}/graph_edges")


def generate(endpoints: DataFrame, edges: DataFrame, count: int, seed: int = 42, least: int = 1, most: int = 5, attempts: int = 8, domains: list[str] | None = None) -> DataFrame:
    """chain_id, attempt, tier, path, steps, tools, domains, pattern: one chain for each of ``count`` ids, the first 55 % of many steps.

    ``domains`` are preferred: chains that reach them come from a lower tier than those that don't.
    """
    ids = endpoints.sparkSession.range(count).withColumnRenamed("id", "chain_id")
    found = written(sampler.described(sampler.walks(ids, endpoints, edges, least, most, attempts, seed), endpoints).join(sampler.quota(ids, 0.55, count), "chain_id"))
    strict = F.when(F.col("forced"), sampler.violations(3, most, 2, domains)).otherwise(sampler.violations(least, most, 1, domains))
    loose = F.when(F.col("forced"), sampler.violations(3, most, 2)).otherwise(sampler.violations(least, most))
    return sampler.relaxed(found, [strict, loose, sampler.violations(1, most, 1, domains), sampler.violations(1, most)])


def with_quota(ids: DataFrame, endpoints: DataFrame, edges: DataFrame, share: float, total: int, seed: int = 42, least: int = 1, most: int = 5, attempts: int = 100, domains: list[str] | None = None) -> DataFrame:
    """As ``generate`` for given ids (numbers), walked again up to ``attempts`` times while they miss the first tier, with forced: the first floor(share * total) must have three steps and two tools, and each part is retried by its own tiers."""
    flags = written(sampler.quota(ids, share, total))
    last = [sampler.Limits(1, most, 1, domains), sampler.Limits(1, most)]

    def part(forced: bool, first: list[sampler.Limits]) -> DataFrame:
        chosen = flags.where(F.col("forced") == forced)
        return sampler.retried(chosen, endpoints, edges, first + last, least, most, attempts, seed).withColumn("forced", F.lit(forced))

    many = part(True, [sampler.Limits(3, most, 2, domains), sampler.Limits(3, most, 2)])
    free = part(False, [sampler.Limits(least, most, 1, domains), sampler.Limits(least, most)])
    return many.unionByName(free)


def evaluate(talk: DataFrame) -> DataFrame:
    """Scores of conversations (conv_id, turn, role, text, endpoint_id), from the calls and results that they hold."""
    talk = talk.withColumn("conv_id", F.col("conv_id").cast("string"))
    calls = talk.where("role = 'assistant' and endpoint_id is not null")
    ids = jsonpath.flatten(calls, "text", "conv_id", "turn").where(jsonpath.is_id(F.col("path"))).groupBy("conv_id", "turn").agg(F.first("value").alias("k"))
    c = calls.select("conv_id", "turn").join(ids, ["conv_id", "turn"], "left").select("conv_id", F.col("turn").alias("step"), "k", F.lit(0).alias("structural"))
    shown = jsonpath.flatten(talk.where("role = 'tool'"), "text", "conv_id", "turn").where(jsonpath.is_id(F.col("path"))).groupBy("conv_id", "turn").agg(F.collect_set("value").alias("ids"))
    r = talk.where("role = 'tool'").select("conv_id", "turn").join(shown, ["conv_id", "turn"], "left").select("conv_id", F.col("turn").alias("step"), F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))
    said = talk.select("conv_id", "turn", "role", F.when(F.col("endpoint_id").isNull(), F.col("text")).alias("text"))
    return judge.scores(c, r, said)


def calls_of(chains: DataFrame, endpoints: DataFrame) -> DataFrame:
    """The chains as calls, for the diversity measures."""
    steps = chains.select(F.col("chain_id").alias("conv_id"), F.posexplode("path").alias("pos", "endpoint_id"))
    return steps.join(endpoints.select("endpoint_id", F.col("tool_name").alias("tool"), F.col("endpoint_name").alias("endpoint"), "category"), "endpoint_id").select("conv_id", (F.col("pos") + 1).cast("long").alias("step"), "endpoint_id", "tool", "endpoint", "category")


def experiment(endpoints: DataFrame, edges: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """metric, run_a, run_b, change: without steering, and with the domains preferred that run A used least."""
    a = calls_of(written(generate(endpoints, edges, count, seed)), endpoints)
    low = [r.category for r in steering.underused_domains(endpoints, diversity.domain_counts(a)).collect()]  # as many as there are domains
    b = calls_of(written(generate(endpoints, edges, count, seed, domains=low[:1])), endpoints)
    return diversity.compare(diversity.metrics(a), diversity.metrics(b))


def talks(chains: DataFrame, endpoints: DataFrame) -> DataFrame:
    return conversation.conversations(chains.select("chain_id", "path"), endpoints)

"""Relations between endpoints: heuristics as equi-joins, resolution to one edge a pair, statistics.

Pairs come from equi-joins on the tool, and on the category where it has at most ``mesh`` endpoints. In larger categories an
inverted index finds the ``neighbours`` best targets of each source (``candidates``); without ``mesh`` all their pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import classify
from quillmesh.operators import candidates
from quillmesh.plans.runtime import written

# Fixed values.
SEQUENCES = [("search", "get"), ("search", "create"), ("get", "update"), ("get", "delete"), ("create", "get"), ("create", "update"), ("create", "delete")]
WEIGHTS = {"same_tool": 0.3, "same_category": 0.5, "complementary": 0.8, "io_chain": 1.0}
PRIORITY = {"io_chain": 4, "complementary": 3, "same_category": 2, "same_tool": 1}
#: How much likelier the sampler is to follow an edge.
MULTIPLIERS = {"io_chain": 3.0, "complementary": 2.0, "same_tool": 1.0, "same_category": 0.5}


def nodes(endpoints: DataFrame) -> DataFrame:
    name = F.col("endpoint_name")
    return endpoints.select(F.col("endpoint_id").alias("id"), "tool_name", "category", classify.verb(name).alias("verb"), classify.noun(name).alias("noun"), F.transform("params", F.lower).alias("params"))


def feeds(a: str = "a", b: str = "b") -> Column:
    """The source's output names a parameter of the target, or a reading source shares two parameters with it."""
    return F.arrays_overlap(candidates.wanted(F.col(f"{a}.noun")), F.col(f"{b}.params")) | ((F.size(F.array_intersect(f"{a}.params", f"{b}.params")) >= 2) & F.coalesce(F.col(f"{a}.verb").isin("search", "get"), F.lit(False)))


def completes() -> Column:
    """Of one tool: nouns equal or one within the other, verbs in a usual sequence."""
    a, b = F.col("a.noun"), F.col("b.noun")
    verbs = F.concat_ws(">", "a.verb", "b.verb").isin([f"{x}>{y}" for x, y in SEQUENCES])
    return (a.contains(b) | b.contains(a)) & F.col("a.verb").isNotNull() & F.col("b.verb").isNotNull() & verbs


#: Sources of a category that meet all its endpoints in one place.
BLOCK = 64


def across(n: DataFrame, size: DataFrame) -> DataFrame:
    """source, target, io: all pairs of two tools in a category. The sources of a category are dealt over blocks, so no task has a large one alone."""
    blocks = F.ceil(F.col("size") / BLOCK)
    n = n.join(size, "category")
    parts = int(n.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = n.withColumn("block", F.pmod(F.xxhash64("id"), blocks)).repartition(parts, "category", "block").alias("a")
    b = n.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).alias("b")
    met = a.join(b, (F.col("a.category") == F.col("b.category")) & (F.col("a.block") == F.col("b.block"))).where("a.tool_name <> b.tool_name")
    return met.select(F.col("a.id").alias("source"), F.col("b.id").alias("target"), feeds().alias("io"))


def relations(endpoints: DataFrame, mesh: int | None = 80, neighbours: int = 30) -> DataFrame:
    """source, target, edge_type, weight: every heuristic that holds for a pair. With ``mesh`` None no target of a category is left out, whatever its size."""
    n = written(nodes(endpoints))
    a, b = n.alias("a"), n.alias("b")
    tool = a.join(b, F.col("a.tool_name") == F.col("b.tool_name")).where("a.id <> b.id").select(F.col("a.id").alias("source"), F.col("b.id").alias("target"), F.lit(True).alias("near"), feeds().alias("io"), completes().alias("complement"))
    size = n.groupBy("category").agg(F.count("*").alias("size"))
    if mesh is None:
        pairs = across(n, size)
    else:
        few = n.join(size.where(F.col("size") <= mesh), "category", "left_semi")
        a, b = few.alias("a"), few.alias("b")
        small = a.join(b, F.col("a.category") == F.col("b.category")).where("a.tool_name <> b.tool_name").select(F.col("a.id").alias("source"), F.col("b.id").alias("target"), feeds().alias("io"))
        many = n.join(size.where(F.col("size") > mesh), "category", "left_semi")
        pairs = small.union(candidates.best_targets(many, neighbours).select("source", "target", "io"))
    other = pairs.select("source", "target", F.lit(False).alias("near"), "io", F.lit(False).alias("complement"))
    kinds = F.array(F.when(F.col("near"), "same_tool").otherwise("same_category"), F.when(F.col("complement"), "complementary"), F.when(F.col("io"), "io_chain"))
    rows = tool.union(other).select("source", "target", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("edge_type"))
    return rows.withColumn("weight", classify.first_match([(F.col("edge_type") == k, F.lit(w)) for k, w in WEIGHTS.items()], F.lit(None)))


def priority(kind: Column) -> Column:
    return classify.first_match([(kind == k, F.lit(p)) for k, p in PRIORITY.items()], F.lit(0))


def edges(found: DataFrame) -> DataFrame:
    """One edge a pair: the strongest type, all types, the largest weight."""
    return found.groupBy("source", "target").agg(F.max_by("edge_type", priority(F.col("edge_type"))).alias("edge_type"), F.array_join(F.array_sort(F.collect_set("edge_type")), ",").alias("edge_types"), F.max("weight").alias("weight"))


def histogram(edge: DataFrame) -> DataFrame:
    return edge.groupBy("edge_type").agg(F.count("*").alias("edges"))


def degree_statistics(endpoints: DataFrame, edge: DataFrame) -> DataFrame:
    n, e = endpoints.agg(F.count("*").alias("nodes")), edge.agg(F.count("*").alias("edges"))
    return n.join(e).withColumn("avg_degree", F.round(2 * F.col("edges") / F.col("nodes"), 2))


def diagram_counts(endpoints: DataFrame, most: int = 80) -> DataFrame:
    """category, endpoints, shown, omitted: of each category, how many are among the first ``most`` of a diagram."""
    order = ["category", "tool_name", "endpoint_name"]
    shown = endpoints.select(*order).orderBy(*order).limit(most).groupBy("category").agg(F.count("*").alias("shown"))
    n = endpoints.groupBy("category").agg(F.count("*").alias("endpoints")).join(shown, "category", "left").withColumn("shown", F.coalesce("shown", F.lit(0)))
    return n.select("category", "endpoints", "shown", (F.col("endpoints") - F.col("shown")).alias("omitted"))


def components(ids: DataFrame, edge: DataFrame) -> DataFrame:
    """id, component: the least id that a node is linked with, direction aside.

    Each round a node takes the least label round it and then its label's own label, so long paths
    shorten fast; each is written to the shared folder, and ends when no label moved.
    """
    links = written(edge.select("source", "target").union(edge.select(F.col("target").alias("source"), F.col("source").alias("target"))).distinct())
    now = ids.select("id", F.col("id").alias("component"))
    while True:
        near = links.join(now, F.col("target") == F.col("id")).groupBy("source").agg(F.min("component").alias("least"))
        step = now.join(near, F.col("id") == F.col("source"), "left").select("id", "component", F.least("component", F.coalesce("least", "component")).alias("next"))
        jump = step.select(F.col("id").alias("label"), F.col("next").alias("further"))
        moved = step.join(jump, F.col("next") == F.col("label"), "left").select("id", "component", F.least("next", F.coalesce("further", "next")).alias("next"))
        moved = written(moved)
        now = moved.select("id", F.col("next").alias("component"))
        if moved.where("component <> next").isEmpty():
            return now

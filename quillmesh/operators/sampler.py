"""Self-avoiding weighted walks over the endpoint graph, all chains and attempts at once.

Random numbers are hashes of (seed, chain, attempt, step), so a result depends on nothing else and any
engine can repeat it. A graph that is small enough is sent to the tasks, which walk their chains themselves (``walker``). In a larger one
each step is one join with the neighbour lists; the draw among them is an expression, so no candidates are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions import classify
from quillmesh.operators import walker
from quillmesh.operators.graph import MULTIPLIERS
from quillmesh.operators.walker import Limits
from quillmesh.plans.runtime import written


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 32 bits of md5."""
    text = F.concat_ws(":", *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _weighted(edges: DataFrame) -> DataFrame:
    return edges.select("source", "target", (F.col("weight") * classify.first_match([(F.col("edge_type") == k, F.lit(m)) for k, m in MULTIPLIERS.items()], F.lit(1.0))).alias("w"))


def walks(chains: DataFrame, endpoints: DataFrame, edges: DataFrame, least: int, most: int, attempts: int = 3, seed: int = 42, start_in: list[str] | None = None, excluded: list[str] | None = None, first: int = 1) -> DataFrame:
    """chain_id, attempt, path (array of ids): ``chains`` has chain_id; a walk stops early where it has no unvisited neighbour.

    Walks begin in the categories ``start_in``, where given, and never touch the ``excluded`` endpoints. Attempts are ``first`` to ``attempts``.
    """
    if excluded:
        endpoints, edges = endpoints.where(~F.col("endpoint_id").isin(excluded)), edges.where(~F.col("source").isin(excluded) & ~F.col("target").isin(excluded))
    nodes = endpoints.where(F.col("category").isin(start_in)) if start_in else endpoints
    # Ids by their rank; as many rows as endpoints.
    ranked = nodes.select("endpoint_id", (F.row_number().over(Window.orderBy("endpoint_id")) - 1).cast("long").alias("at"))
    total = ranked.agg(F.count("*").alias("total"))
    s = F.lit(seed)
    w = chains.select("chain_id", F.explode(F.sequence(F.lit(first), F.lit(attempts))).alias("attempt"))
    w = w.withColumn("goal", F.lit(least) + F.floor(uniform(s, "chain_id", "attempt", F.lit("length")) * (most - least + 1)))
    w = w.join(F.broadcast(total)).withColumn("at", F.floor(uniform(s, "chain_id", "attempt", F.lit("start")) * F.col("total")).cast("long"))
    w = w.join(ranked, "at").select("chain_id", "attempt", "goal", F.array("endpoint_id").alias("path"))
    weighted = _weighted(edges)
    # A row a source: its neighbours by id, all of its tool and category if the graph has no bound on them.
    near = weighted.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("target", "w"))).alias("near"))
    for step in range(2, most + 1):
        w = w.withColumn("source", F.when((F.col("goal") >= step) & (F.size("path") == step - 1), F.element_at("path", -1)))
        w = w.join(near, "source", "left").withColumn("near", F.filter("near", lambda x: ~F.array_contains("path", x["target"]))).withColumn("r", uniform(s, "chain_id", "attempt", F.lit(step)))
        all_ = F.aggregate("near", F.lit(0.0), lambda sum_, x: sum_ + x["w"])
        # The first whose running sum reaches the draw; rounding leaves the last one if none does.
        none = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("string").alias("next"), F.round(F.col("r") * all_, 9).alias("draw"))
        pick = F.aggregate("near", none, lambda a, x: F.struct((a["cum"] + x["w"]).alias("cum"), F.coalesce(a["next"], F.when(a["draw"] <= F.round(a["cum"] + x["w"], 9), x["target"])).alias("next"), a["draw"].alias("draw")))
        w = w.withColumn("next", F.coalesce(pick["next"], F.try_element_at("near", F.lit(-1))["target"]))
        w = w.select("chain_id", "attempt", "goal", F.when(F.col("next").isNotNull(), F.concat("path", F.array("next"))).otherwise(F.col("path")).alias("path"))
    return w.select("chain_id", "attempt", "path")


def described(walked: DataFrame, endpoints: DataFrame) -> DataFrame:
    """chain_id, attempt, path, steps, tools, domains, pattern."""
    one = walked.select("chain_id", "attempt", "path", F.posexplode("path").alias("pos", "endpoint_id")).join(endpoints.select("endpoint_id", "tool_name", "endpoint_name", "category"), "endpoint_id")
    has = lambda *words: F.bool_or(F.lower("endpoint_name").rlike("|".join(words)))
    return one.groupBy("chain_id", "attempt").agg(
        F.first("path").alias("path"), F.count("*").alias("steps"), F.countDistinct("tool_name").alias("tools"), F.array_sort(F.collect_set("category")).alias("domains"),
        classify.chain_pattern(F.count("*"), has("create", "add", "book"), has("get", "list", "search"), has("update", "modify"), has("delete", "remove", "cancel")).alias("pattern"),
    )


def described_walks(chains: DataFrame, endpoints: DataFrame, edges: DataFrame, least: int, most: int, attempts: int = 3, seed: int = 42, start_in: list[str] | None = None, excluded: list[str] | None = None) -> DataFrame:
    """``described`` of ``walks``."""
    endpoints, edges = written(endpoints), written(edges)
    if small := walker.small_graph(endpoints, _weighted(edges), start_in, excluded):
        return walker.attempted(chains, small, least, most, attempts, seed)
    return described(walks(chains, endpoints, edges, least, most, attempts, seed, start_in, excluded), endpoints)


def violations(least: int, most: int, min_tools: int = 1, domains: list[str] | None = None, excluded: list[str] | None = None, allowed: list[str] | None = None) -> Column:
    """Which constraints a described chain breaks, as an array of their names."""
    cases = [(F.col("steps") < least, "min_steps"), (F.col("steps") > most, "max_steps"), (F.col("tools") < min_tools, "min_distinct_tools")]
    if domains:
        cases.append((F.size(F.array_except(F.array(*map(F.lit, domains)), "domains")) > 0, "required_domains"))
    if excluded:
        cases.append((F.arrays_overlap("path", F.array(*map(F.lit, excluded))), "exclude_endpoints"))
    if allowed:
        cases.append((~F.col("pattern").isin(allowed), "pattern"))
    return F.filter(F.array(*(F.when(c, n) for c, n in cases)), lambda x: x.isNotNull())


def first_passing(chains: DataFrame, broken: Column) -> DataFrame:
    """The first attempt of each chain that breaks nothing."""
    ok = chains.where(F.size(broken) == 0)
    cols = [c for c in chains.columns if c not in ("chain_id", "attempt")]
    return ok.groupBy("chain_id").agg(F.min_by(F.struct("attempt", *cols), "attempt").alias("x")).select("chain_id", "x.*")


def relaxed(chains: DataFrame, tiers: list[Column]) -> DataFrame:
    """With constraints given up tier by tier: the passing attempt of the lowest tier, then of the lowest number."""
    tier = classify.first_match([(F.size(t) == 0, F.lit(i)) for i, t in enumerate(tiers)], F.lit(None))
    cols = [c for c in chains.columns if c != "chain_id"]
    x = chains.withColumn("tier", tier).where("tier is not null")
    return x.groupBy("chain_id").agg(F.min_by(F.struct("tier", *cols), F.struct("tier", "attempt")).alias("x")).select("chain_id", "x.*")


def labels(least: int, most: int, min_tools: int = 1, domains: list[str] | None = None, allowed: list[str] | None = None) -> Column:
    """Which constraints a described chain keeps, as an array of labels with their values."""
    cases = [(F.col("steps").between(least, most), f"steps in [{least}, {most}]"), (F.col("tools") >= min_tools, f"distinct tools >= {min_tools}")]
    cases += [(F.array_contains("domains", x), f"domain: {x}") for x in domains or []]
    if allowed:
        cases.append((F.col("pattern").isin(allowed), f"pattern in {allowed}"))
    return F.filter(F.array(*(F.when(c, n) for c, n in cases)), lambda x: x.isNotNull())


def retried(chains: DataFrame, endpoints: DataFrame, edges: DataFrame, tiers: list[Column | Limits], least: int = 1, most: int = 5, attempts: int = 50, seed: int = 42, start_in: list[str] | None = None, excluded: list[str] | None = None) -> DataFrame:
    """``relaxed`` over up to ``attempts`` walks a chain, in rounds that grow: only chains that no attempt has brought to the first tier go on.

    Where all tiers are ``Limits`` and the graph is small, a chain's rounds are all in one task."""
    if all(isinstance(t, Limits) for t in tiers) and (small := walker.small_graph(endpoints, _weighted(edges), start_in, excluded)):
        return walker.retried(chains, small, tiers, least, most, attempts, seed)
    tiers = [violations(**vars(t)) if isinstance(t, Limits) else t for t in tiers]
    found, still, first, wide = None, chains.select("chain_id"), 1, 2
    while first <= attempts:
        last = min(attempts, first + wide - 1)
        walked = walks(still, endpoints, edges, least, most, last, seed, start_in, excluded, first)
        now = written(relaxed(described(walked, endpoints), tiers))
        found = now if found is None else found.union(now)
        still = written(still.join(now.where("tier = 0").select("chain_id"), "chain_id", "left_anti"))
        if still.isEmpty():
            break
        first, wide = last + 1, 2 * wide
    cols = [c for c in found.columns if c != "chain_id"]
    return found.groupBy("chain_id").agg(F.min_by(F.struct(*cols), F.struct("tier", "attempt")).alias("x")).select("chain_id", "x.*")


def quota(chains: DataFrame, share: float, total: int) -> DataFrame:
    """chain_id (a number), forced: the first floor(share * total) chains by id must be of many steps.

    The last id that is forced is a quantile: ids are counted in ranges, the range that holds it is counted in finer ones,
    and so on to single ids. No rows are sorted, and a round sends ``RANGES`` counts at most.
    """
    need = int(share * total)
    bounds = chains.agg(F.min("chain_id").alias("low"), F.max("chain_id").alias("high")).head()
    if need <= 0 or bounds.low is None:
        return chains.select("chain_id", F.lit(False).alias("forced"))
    low, high, before = int(bounds.low), int(bounds.high), 0
    while low < high:
        step = -(-(high - low + 1) // RANGES)
        counts = chains.where(F.col("chain_id").between(low, high)).groupBy(F.floor((F.col("chain_id") - low) / step).cast("long").alias("k")).agg(F.count("*").alias("n"))
        for k, n in sorted((r.k, r.n) for r in counts.collect()):
            if before + n >= need:
                low, high = low + k * step, min(high, low + (k + 1) * step - 1)
                break
            before += n
        else:
            low = high
    return chains.select("chain_id", (F.col("chain_id") <= F.lit(low)).alias("forced"))


#: Ranges that a round of ``quota`` counts.
RANGES = 4096

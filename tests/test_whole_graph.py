"""Chains over graphs that leave out no pair of a category, however large, against plain walks over plain pairs."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from quillmesh.operators import graph, walker
from quillmesh.plans import adapters, catalogue, exports, views  # noqa: F401

MULTIPLIED = {"io_chain": 3.0, "complementary": 1.6, "same_category": 0.25, "same_tool": 0.3}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """800 parts, whose categories have more than 80 endpoints each, and 120 orders."""
    at = tmp_path_factory.mktemp("wide")
    for name, n in (("part", 800), ("orders", 120)):
        duckdb.sql(f"copy (select * from '/root/testdata/sf0.01/{name}.parquet' limit {n}) to '{at}/{name}.parquet'")
    return str(at)


@pytest.fixture(scope="module")
def plain(spark, folder):
    """Endpoints by id, and the types of all pairs that share a tool or a category."""
    e = adapters.endpoints(spark, folder)
    rows = graph.nodes(e).join(e.selectExpr("endpoint_id AS id", "endpoint_name"), "id").collect()
    kinds = {}
    for a in rows:
        takes, own = {f"{a.noun}_id", f"{a.noun}id", f"{a.noun}_name", "id", "item_id", "resource_id"}, set(a.params)
        for b in rows:
            if a.id != b.id and (a.tool_name == b.tool_name or a.category == b.category):
                found = {"same_tool" if a.tool_name == b.tool_name else "same_category"}
                if takes & set(b.params) or (len(own & set(b.params)) >= 2 and a.verb in ("search", "get")):
                    found.add("io_chain")
                if a.tool_name == b.tool_name and a.verb and b.verb and (a.noun in b.noun or b.noun in a.noun) and (a.verb, b.verb) in graph.SEQUENCES:
                    found.add("complementary")
                kinds[a.id, b.id] = found
    assert min(Counter(r.category for r in rows).values()) > 80
    return {r.id: r for r in rows}, kinds


def strongest(found):
    return next(k for k in ("io_chain", "complementary", "same_category", "same_tool") if k in found)


class Walks:
    """path(chain, attempt): the walk of that attempt, drawn one neighbour at a time."""

    def __init__(self, by, kinds):
        self.by, self.ids, self.near = by, sorted(by), {i: [] for i in by}
        for a, b in sorted(kinds):
            # The weight is the largest of all types, times the multiplier of the strongest.
            self.near[a].append((b, MULTIPLIED[strongest(kinds[a, b])]))

    def path(self, chain, attempt):
        u = lambda what: int(hashlib.md5(f"42:{chain}:{attempt}:{what}".encode()).hexdigest()[:8], 16) / 2**32
        goal, path = 1 + math.floor(u("length") * 5), [self.ids[math.floor(u("start") * len(self.ids))]]
        for step in range(2, goal + 1):
            free = [(t, w) for t, w in self.near[path[-1]] if t not in path]
            cum, draw = 0.0, round(u(step) * sum(w for _, w in free), 9)
            for t, w in free:
                cum += w
                if draw <= round(cum, 9):
                    break
            if not free:
                break
            path.append(t)
        return path

    def described(self, chain, attempt):
        """path, steps, tools, domains, pattern."""
        path = self.path(chain, attempt)
        names = [self.by[i].endpoint_name for i in path]
        c, r, u, d = (any(re.search(w, n) for n in names) for w in ("create|add|book", "get|list|search", "update|modify", "delete|remove|cancel"))
        pattern = "single_step" if len(path) == 1 else "crud_cycle" if c + r + u + d >= 3 else "search_and_act" if r and (c or u or d) else "multi_step"
        return path, len(path), len({self.by[i].tool_name for i in path}), sorted({self.by[i].category for i in path}), pattern


@pytest.fixture(scope="module")
def walks(plain):
    return Walks(*plain)


@pytest.fixture(scope="module")
def chains(folder):
    return [k for (k,) in duckdb.sql(f"select o_orderkey from '{folder}/orders.parquet'").fetchall()]


def in_sql(folder, name):
    c = duckdb.connect()
    for t in ("part", "orders"):
        c.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    found = c.sql(catalogue.oracle_sql()[name])
    return [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]


@pytest.mark.parametrize("block", [64, 7])
def test_no_pair_of_a_large_category_is_left_out(spark, folder, plain, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK", block)
    found = graph.edges(graph.relations(adapters.endpoints(spark, folder), mesh=None)).collect()
    assert len(found) == len(plain[1])
    assert {(r.source, r.target): set(r.edge_types.split(",")) for r in found} == plain[1]
    assert all(r.edge_type == strongest(plain[1][r.source, r.target]) for r in found)


def test_constraint_violations_walk_the_whole_graph(spark, folder, walks, chains, monkeypatch):
    want = Counter()
    for chain in chains:
        for attempt in (1, 2):
            _, steps, tools, domains, pattern = walks.described(chain, attempt)
            want.update([k for k, broken in (("min_steps", steps < 2), ("min_distinct_tools", tools < 2), ("required_domains", "Food" not in domains), ("pattern", pattern not in ("search_and_act", "multi_step"))) if broken])
    assert {r["reason"]: r["chains"] for r in in_sql(folder, "constraint_violations")} == want
    for edges in (walker.EDGES, 10):  # in the tasks, and by joins
        monkeypatch.setattr(walker, "EDGES", edges)
        assert {r.reason: r.chains for r in catalogue.queries()["constraint_violations"](spark, folder).collect()} == want


def test_offline_conversations_walk_the_whole_graph(spark, folder, walks, chains):
    calls = {}
    for r in catalogue.queries()["offline_conversations"](spark, folder).where("role = 'assistant' and endpoint_id is not null").orderBy("conv_id", "turn").collect():
        calls.setdefault(r.conv_id, []).append(r.endpoint_id)
    assert calls == {chain: walks.path(chain, 1) for chain in chains}


def first_of_lowest_tier(walks, chains, attempts, tier):
    """chain: (tier, attempt, described) of the attempt with the lowest tier, then the lowest number; none where no attempt has a tier."""
    out = {}
    for chain in chains:
        found = [(t, i, x) for i in range(1, attempts + 1) if (t := tier(x := walks.described(chain, i))) is not None]
        if found:
            out[chain] = min(found, key=lambda f: f[:2])
    return out


def test_relaxed_chains_walk_the_whole_graph(spark, folder, walks, chains):
    def tier(x):
        return (0 if "Travel" in x[3] else 1) if x[1] >= 3 and x[2] >= 2 else 2 if "Travel" in x[3] else 3

    want = {(chain, t, i, x[1], x[4]) for chain, (t, i, x) in first_of_lowest_tier(walks, chains, 100, tier).items()}
    columns = "chain_id", "tier", "attempt", "steps", "pattern"
    assert {tuple(r[c] for c in columns) for r in in_sql(folder, "relaxed_chains")} == want
    assert {tuple(r[c] for c in columns) for r in catalogue.queries()["relaxed_chains"](spark, folder).collect()} == want


def test_sample_chains_walk_the_whole_graph(spark, folder, walks, chains):
    found = first_of_lowest_tier(walks, chains, 50, lambda x: 0 if x[1] >= 2 and x[2] >= 2 else None)
    want = {(chain, i, " > ".join(x[0]), x[1], x[2], ",".join(x[3]), x[4]) for chain, (_, i, x) in found.items()}
    columns = "chain_id", "attempt", "path", "steps", "tools", "domains", "pattern"
    assert {tuple(r[c] for c in columns) for r in in_sql(folder, "sample_chains")} == want
    assert {tuple(r[c] for c in columns) for r in catalogue.queries()["sample_chains"](spark, folder).collect()} == want


def test_rows_of_neighbours_are_looked_at_in_blocks(plain, walks, monkeypatch):
    """Few places at a time, whatever the width of the table of neighbours, with the paths of plain walks."""
    ids, wide = walks.ids, max(map(len, walks.near.values()))
    near, weight, at = np.full((len(ids), wide), -1, np.int32), np.zeros((len(ids), wide)), {v: i for i, v in enumerate(ids)}
    for a, b in walks.near.items():
        near[at[a], : len(b)], weight[at[a], : len(b)] = [at[t] for t, _ in b], [w for _, w in b]
    g = walker.Graph(ids, np.arange(len(ids)), near, weight, None, None, [], None)
    seen, moved = [], walker._moved
    monkeypatch.setattr(walker, "_moved", lambda g, path, rows, *rest: seen.append(len(rows)) or moved(g, path, rows, *rest))
    monkeypatch.setattr(walker, "CELLS", 5 * wide)
    path = walker.walk(g, walker.Keys([f"42:{i}".encode() for i in range(300)]), np.arange(300), 1, 1, 5)
    assert max(seen) == 5
    assert [[ids[i] for i in row if i >= 0] for row in path.tolist()] == [walks.path(i, 1) for i in range(300)]


def test_a_category_of_a_thousand_endpoints_is_sent_to_the_tasks(spark):
    ids = spark.range(1010).selectExpr("format_string('é%04d', id) AS endpoint_id", "concat('t', id % 9) AS tool_name", "'get_x' AS endpoint_name", "'A' AS category")
    edge = ids.select("endpoint_id").alias("a").crossJoin(ids.select("endpoint_id").alias("b")).where("a.endpoint_id <> b.endpoint_id").selectExpr("a.endpoint_id AS source", "b.endpoint_id AS target", "0.25D AS w")
    g = walker.small_graph(ids, edge)
    assert g.ids[3] == "é0003" and g.near.shape == (1010, 1009) and g.near[3, :5].tolist() == [0, 1, 2, 4, 5] and (g.weight == 0.25).all()
    few = edge.where("source < 'é0003'")
    assert walker.small_graph(ids, few) and not walker.small_graph(ids.where("endpoint_id <> 'é0007'"), few) and not walker.small_graph(ids.where("endpoint_id > 'é0001'"), few)

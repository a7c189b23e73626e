"""Connected components of an edge table by union-find in the tasks and star contraction between them.

Each round links every node's neighbours to its least neighbour by joins and grouped minima, in which nodes with very many
neighbours are broadcast instead of shuffled, and unites what each task then has (union-find, which leaves a
forest of at most one edge a node). Rounds end when the edges are stars around the least node of each
component; their number grows with the logarithm of the number of nodes. Nothing but two sums a
round reaches the driver; each round is written to the shared folder, so a lost executor loses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import discard, spread_join, written_at


def _united(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The edges of a task, ``most`` at a time, as a forest of stars."""
    held: list[np.ndarray] = []
    n = 0
    for batch in batches:
        held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
        n += batch.num_rows
        if n >= most:
            yield _stars(held)
            held, n = [], 0
    if held:
        yield _stars(held)


def _stars(held: list[np.ndarray]) -> pa.RecordBatch:
    u, v = np.concatenate(held, axis=1)
    names, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = list(range(len(names)))
    for a, b in zip(code[: len(u)].tolist(), code[len(u) :].tolist(), strict=True):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
    for k in range(len(parent)):
        parent[k] = parent[parent[k]]  # parents come first: they are smaller
    root = names[np.array(parent, np.int64)] if parent else names
    far = root != names
    return pa.RecordBatch.from_arrays([pa.array(names[far], pa.int64()), pa.array(root[far], pa.int64())], names=["v", "u"])


def _least_neighbours(edges: DataFrame, total: int) -> DataFrame:
    """The edges (v, u) with m: the least of v and its neighbours u."""
    least = edges.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"), F.count("*").alias("n"))
    return spread_join(edges, least, ["v"], total)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (u long, v long) that aren't the least of their component.

    Loops, repeated and reversed edges are allowed and change nothing; nulls are ignored.
    """
    start = edges.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    now, at = written_at(start.mapInArrow(_united, "v long, u long").distinct())
    seen = None
    while True:
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)")).alias("h")).head()
        if (row.n, row.h) == seen or not row.n:
            return now.select(F.col("v").alias("node"), F.col("u").alias("component"))
        seen = (row.n, row.h)
        # Large star: every neighbour above a node joins the node's least neighbour.
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        large = _least_neighbours(both, 2 * row.n).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v != u")
        large, between = written_at(large.mapInArrow(_united, "v long, u long").distinct())
        # Small star: a node and its lesser neighbours join the least of them.
        small = _least_neighbours(large, 2 * row.n)
        small = small.select(F.explode(F.array("v", "u")).alias("v"), F.col("m").alias("u")).where("v != u")
        before, old = now, at
        now, at = written_at(small.mapInArrow(_united, "v long, u long").distinct())
        discard(large, between)
        discard(before, old)

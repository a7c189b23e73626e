"""Vector memory: the nearest stored vectors of each query by cosine, among all vectors or among those of the cells nearest to it.

A cell index is fitted on a bounded sample (k-means of unit vectors) and covers every row; more rows are added to it as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.plans.runtime import written

#: Vectors that meet a block of queries at once: tables of scores are of block times this.
SLICE = 128


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 2000, shards: int = 8) -> DataFrame:
    """query_id, vec_id, score, rank: ``queries`` and ``vectors`` have vec_id and embedding; a query never finds itself.

    Blocks of at most about ``block`` queries, dealt by hash, meet the vectors in the tasks: the vectors are copied to each block
    and dealt over ``shards`` parts of it, so no driver and no task holds all of either side. A part keeps k vectors for each query, and the best of
    the parts' are ranked. Null or empty vectors, and those of another length than the query, are skipped.
    """
    some = F.size("embedding") > 0
    total = queries.where(some).count()
    blocks = max(1, -(-total // block))
    parts = F.sequence(F.lit(0), F.lit(shards - 1))
    q = queries.where(some).select(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block"), F.explode(parts).alias("shard"), F.lit(True).alias("asks"), "vec_id", "embedding")
    v = vectors.where(some).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(shards)).cast("int").alias("shard"), F.lit(False), "vec_id", "embedding")
    return _ranked(q.union(v), k)


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best for each query among the vectors that it meets: block, shard, asks (a query), vec_id, embedding."""
    both = rows.repartition("block", "shard").sortWithinPartitions("block", "shard", F.desc("asks"), "vec_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, best = None, {}, {}

        def close() -> Iterator[pa.RecordBatch]:
            for ids, val, own in best.values():
                keep = val > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, val.shape[1])[keep.ravel()]), pa.array(own[keep]), pa.array(val[keep])], names=["query_id", "vec_id", "score"])

        for batch in batches:
            block_of, shard_of, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            key = np.stack([block_of, shard_of, ~asks], 1)
            cut = sorted({*range(0, batch.num_rows, SLICE), *(np.flatnonzero((np.diff(key, axis=0) != 0).any(1)) + 1).tolist(), batch.num_rows})
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if a == b:
                    continue
                if (place := (int(block_of[a]), int(shard_of[a]))) != now:
                    yield from close()
                    now, asked, best = place, {}, {}
                ids, rows = batch.column("vec_id")[a:b].to_numpy(), batch.column("embedding")[a:b].to_pylist()
                for size in {len(r) for r in rows}:
                    at = [i for i, r in enumerate(rows) if len(r) == size]
                    x = np.array([rows[i] for i in at], np.float64)
                    n = np.linalg.norm(x, axis=1, keepdims=True)
                    x /= np.where(n == 0, 1, n)
                    if asks[a]:
                        old = asked.get(size, (np.zeros(0, np.int64), np.zeros((0, size))))
                        asked[size] = (np.concatenate([old[0], ids[at]]), np.vstack([old[1], x]))
                    elif size in asked:
                        mine, y = asked[size]
                        s = np.round(y @ x.T, 6)
                        s[mine[:, None] == ids[at][None, :]] = -np.inf
                        _, val, own = best.get(size, (mine, np.zeros((len(mine), 0)), np.zeros((len(mine), 0), np.int64)))
                        val, own = np.hstack([val, s]), np.hstack([own, np.repeat(ids[at][None, :], len(mine), 0)])
                        top = np.argsort(-val, 1, kind="stable")[:, :k]  # ids come in order, so ties go to the least
                        best[size] = (mine, np.take_along_axis(val, top, 1), np.take_along_axis(own, top, 1))
        yield from close()

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = both.mapInArrow(search, "query_id long, vec_id long, score double")
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k)


def fit_cells(vectors: DataFrame, cells: int, sample: int = 20_000, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Centres of cells, from at most ``sample`` vectors taken by the hash of their ids; only they reach the driver. Vectors of the commonest length count."""
    some = vectors.where("size(embedding) > 0").orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample).select("embedding").collect()
    lengths = [len(r.embedding) for r in some]
    if not some:
        return np.zeros((0, 0))
    x = np.array([r.embedding for r in some if len(r.embedding) == max(set(lengths), key=lengths.count)], float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    centre = x[np.random.default_rng(seed).permutation(len(x))[:cells]]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-300), centre)
    return centre


def in_cells(rows: DataFrame, centres: np.ndarray, nearest_cells: int = 1) -> DataFrame:
    """vec_id, embedding, cells: the numbers of the nearest cells; vectors of another length than the centres' share cell -1."""
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        for batch in batches:
            cells: list[list[int]] = [[-1]] * batch.num_rows
            vectors = batch.column("embedding").to_pylist()
            at = [i for i, v in enumerate(vectors) if len(v) == c.shape[1]]
            if at:
                s = np.array([vectors[i] for i in at], float) @ c.T
                for i, near in zip(at, np.argsort(-s, 1, kind="stable")[:, :nearest_cells].tolist(), strict=True):
                    cells[i] = near
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=["vec_id", "embedding", "cells"])

    kind = rows.schema["embedding"].dataType.simpleString()
    return rows.where("size(embedding) > 0").select(F.col("vec_id").cast("long"), "embedding").mapInArrow(place, f"vec_id long, embedding {kind}, cells array<int>")


class Cells:
    """A stored index: every vector lies in one cell; cells with more than ``most`` vectors are searched in parts."""

    def __init__(self, vectors: DataFrame, cells: int, sample: int = 20_000, most: int = 50_000):
        self.centres, self.most = fit_cells(vectors, cells, sample), most
        self.rows = self._placed(vectors)

    def _placed(self, vectors: DataFrame) -> DataFrame:
        return written(in_cells(vectors, self.centres).select(F.col("cells")[0].alias("cell"), "vec_id", "embedding"))

    def add(self, vectors: DataFrame) -> None:
        """Further vectors, in the cells as they are."""
        self.rows = self.rows.union(self._placed(vectors))

    def search(self, queries: DataFrame, k: int, probes: int) -> DataFrame:
        """query_id, vec_id, score, rank: among the vectors of each query's ``probes`` nearest cells, scored in full."""
        parts = self.rows.groupBy("cell").agg(F.ceil(F.count("*") / self.most).cast("int").alias("parts"))
        kind = self.rows.schema["embedding"].dataType
        q = in_cells(queries, self.centres, probes).select("vec_id", F.col("embedding").cast(kind).alias("embedding"), F.explode("cells").alias("cell")).join(parts, "cell")
        q = q.select(F.col("cell").cast("long").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("shard"), F.lit(True).alias("asks"), "vec_id", "embedding")
        v = self.rows.join(parts, "cell").select(F.col("cell").cast("long"), F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"), F.lit(False), "vec_id", "embedding")
        return _ranked(q.union(v), k)

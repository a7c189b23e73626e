"""Approximate nearest neighbours by cosine: a neighbour graph built by NN-descent, searched greedily.

Build. Random hyperplanes deal the vectors into blocks, a few times over; the nearest of each block are a first graph. Then in
each round a node's neighbours, and some of the nodes that name it, meet at the node by a join and are compared with one another: neighbours of
neighbours. Pairs compared in an earlier round are left out; what is nearer than a node's farthest neighbour replaces it. Rounds end when few edges change.

Search. A query starts at its own node, if it has one, and at sampled entry nodes. In each round the neighbours of all nodes
in its beam that aren't yet expanded are scored, where they lie, by a join on the node; those that enter the beam stay.
It ends when every node of every beam is expanded. The beams' nearest are scored again in double precision on the original vectors.

Every vector is a node of the graph; equal vectors are one node, with as many of their ids as a result can show. A node has at most
``degree`` neighbours and is named back at most as often; a block has about ``block`` vectors and is split by hash beyond twice that; queries are
searched in blocks of bounded bytes. So no group grows with the data. Vectors travel in half precision while the graph is built and
are scored in single precision while it is searched, so vectors whose cosines differ by less than some 1e-5 are told apart in the beam alone. The graph is approximate by nature: README has its
recall against brute force.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an id; of rows that share an id the
least vector stands. Only vectors of one length are compared. Ties go to the smaller id. With fewer candidates than k all are returned, an empty
table gives an empty result. Further columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.common import discard, only, written, written_at

EDGES = "node long, id long, score float, fresh boolean"
#: What one task's vectors are compared with at a time, and bytes of a block of queries.
ROWS, QUERY_BYTES = 512, 16 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vec (doubles): the vectors that take part, one an id."""
    v = only(vectors, "vec_id", "embedding").where("vec_id is not null").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return v.where(fine).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """node (the least id), vec, ids (the least k + 1), dim; written. Equal vectors are one node."""
    first = Window.partitionBy("vec").orderBy("vec_id")
    some = usable(vectors).withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
    got = some.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return written(got.select(F.col("ids")[0].alias("node"), "vec", "ids", F.size("vec").alias("dim")))


def unit(column: pa.Array) -> np.ndarray:
    """Vectors of one length, as rows of length 1 in single precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def by_dim(batch: pa.RecordBatch, column: str = "vec") -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The rows of a batch, a length of vectors at a time."""
    size = np.diff(batch.column(column).offsets.to_numpy())
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield at, batch if len(at) == len(size) else batch.take(pa.array(at))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each key of sorted batches, together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in keys], 1)
        cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        if held and all(held[-1].column(x)[-1].as_py() == batch.column(x)[0].as_py() for x in keys):
            held.append(batch.slice(0, cut[1]))
            cut = cut[1:]
        if len(cut) > 1:
            if held:
                yield joined(held)
            for a, b in zip(cut[:-2], cut[1:-1], strict=True):
                yield batch.slice(a, b - a)
            held = [batch.slice(cut[-2], cut[-1] - cut[-2])]
    if held:
        yield joined(held)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def edges(node: np.ndarray, other: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array(other), pa.array(score, pa.float32()), pa.array(np.ones(len(node), bool))], names=["node", "id", "score", "fresh"])


def first_graph(nodes: DataFrame, tables: int, block: int, degree: int, seed: int) -> DataFrame:
    """Edges to the nearest nodes within each block, of ``tables`` ways to cut the vectors into blocks by random hyperplanes."""
    sizes = {r.dim: r.n for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, batch in by_dim(whole):
                x = unit(batch.column("vec"))
                d = x.shape[1]
                bits = min(62, max(0, int(sizes[d] / block).bit_length()))
                planes = np.random.default_rng([seed, d]).standard_normal((d, tables, bits)).astype(np.float32)
                key = ((np.tensordot(x, planes, 1) > 0) * (1 << np.arange(bits, dtype=np.int64))).sum(2)
                vec = pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t)), pa.array(np.full(len(x), d)), pa.array(key[:, t]), batch.column("node"), vec], names=["t", "dim", "key", "node", "vec"])

    dealt = written(nodes.select("node", "vec").mapInArrow(deal, "t long, dim long, key long, node long, vec binary"))
    cell = ["t", "dim", "key"]
    parts = dealt.groupBy(*cell).agg(F.ceil(F.count("*") / (2 * block)).alias("parts"))
    cut = dealt.join(parts, cell).withColumn("part", F.pmod(F.xxhash64("node", "t"), F.col("parts"))).drop("parts")
    cell += ["part"]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, cell):
            if (n := group.num_rows) < 2:
                continue
            ids = group.column("node").to_numpy()
            x = halves(group.column("vec"))
            k = min(degree, n - 1)
            for a in range(0, n, ROWS):
                s = x[a : a + ROWS] @ x.T
                s[np.arange(len(s)), np.arange(a, a + len(s))] = -2
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                yield edges(np.repeat(ids[a : a + ROWS], k), ids[top].ravel(), np.take_along_axis(s, top, 1).ravel())

    return cut.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(nearest, EDGES)


def halves(column: pa.Array) -> np.ndarray:
    """Vectors of half precision, sent as bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


def kept(found: DataFrame, degree: int) -> tuple[DataFrame, str]:
    """The ``degree`` nearest of each node's edges, each once; an edge that was there before isn't fresh. Written."""
    once = found.repartition("node").groupBy("node", "id").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    at = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "id"))
    return written_at(once.withColumn("at", at).where(F.col("at") <= degree).drop("at"))


def local_join(graph: DataFrame, nodes: DataFrame, degree: int, sample: int, seed: int) -> DataFrame:
    """Edges between nodes that meet at a node as its neighbours or as nodes that name it; at least one of the two edges is fresh.

    Of a node's fresh edges, its old edges, and those that name it of either kind, ``sample`` each are taken by hash.
    """
    both = graph.select(F.col("node").alias("at"), F.col("id").alias("who"), "fresh", F.lit(0).alias("way")).union(graph.select("id", "node", "fresh", F.lit(1)))
    some = Window.partitionBy("at", "way", "fresh").orderBy(F.xxhash64("at", "who", F.lit(seed)))
    met = both.withColumn("n", F.row_number().over(some)).where(F.col("n") <= sample).groupBy("at", "who").agg(F.max("fresh").alias("fresh"))
    floor = graph.groupBy("node").agg(F.when(F.count("*") >= degree, F.min("score")).otherwise(F.lit(-2.0)).cast("float").alias("floor"))
    who = nodes.join(floor, "node").select(F.col("node").alias("who"), "vec", "floor")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, batch in by_dim(whole):
                yield pa.RecordBatch.from_arrays([batch.column("who"), pa.array([r.tobytes() for r in unit(batch.column("vec")).astype(np.float16)], pa.binary()), batch.column("floor")], names=["who", "vec", "floor"])

    came = met.join(who.mapInArrow(send, "who long, vec binary, floor float"), "who")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for group in runs(batches, ["at"]):
            ids, fresh = group.column("who").to_numpy(), group.column("fresh").to_numpy(zero_copy_only=False)
            x = halves(group.column("vec"))
            s = x @ x.T
            np.fill_diagonal(s, -3)
            i, j = np.nonzero((s > group.column("floor").to_numpy()[:, None]) & (fresh[:, None] | fresh[None, :]))
            held.append((ids[i], ids[j], s[i, j]))
            if len(held) == 500:
                yield edges(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
        if held:
            yield edges(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return came.repartition("at").sortWithinPartitions("at").mapInArrow(compare, EDGES)


def build(nodes: DataFrame, degree: int = 32, tables: int = 6, block: int = 2048, rounds: int = 4, still: float = 0.1, sample: int = 16, seed: int = 1) -> DataFrame:
    """node, near (neighbours and nodes that name it, nearest first, ``degree`` of each at most); written.

    NN-descent ends after ``rounds``, or when fewer than ``still`` of the edges are new.
    """
    graph, at = kept(first_graph(nodes, tables, block, degree, seed), degree)
    for r in range(rounds):
        before, old = graph, at
        met = local_join(before, nodes, degree, sample, seed + r)
        graph, at = kept(before.withColumn("fresh", F.lit(False)).union(met), degree)
        discard(before, old)
        n, fresh = graph.agg(F.count("*"), F.count_if("fresh")).head()
        if fresh < still * n:
            break
    back = Window.partitionBy("node").orderBy(F.desc("score"), "id")
    named = graph.select(F.col("id").alias("node"), F.col("node").alias("id"), "score").withColumn("at", F.row_number().over(back)).where(F.col("at") <= degree).drop("at")
    return written(graph.select("node", "id", "score").union(named).groupBy("node").agg(F.collect_set("id").alias("near")))


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = 128, entries: int = 64) -> DataFrame:
    """query_id, node, score (single precision): the ``beam`` nearest nodes found for each query; written.

    ``queries``: query_id, vec, start (a node, or null). Entry nodes are taken by hash, ``entries`` of each length of vectors at most.
    """
    dims = {r.dim: r.n for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    share = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for d, n in dims.items() for x in (d, max(1, n // entries)))), F.col("dim")), F.lit(1)) if dims else F.lit(1)
    doors = nodes.where(F.pmod(F.xxhash64("node", F.lit(7)), share) == 0).select("node", "dim")
    doors = written(doors.withColumn("at", F.row_number().over(Window.partitionBy("dim").orderBy("node"))).where(F.col("at") <= entries).drop("at"))
    total = queries.agg(F.sum(8 * F.size("vec") + 64)).head()[0] or 0
    blocks = -(-total // QUERY_BYTES)
    dealt = written(queries.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(max(1, blocks)))))
    out = None
    for b in range(blocks):
        found = _search(nodes, graph, dealt.where(F.col("block") == b), doors, beam)
        out = found if out is None else out.union(found)
    return out if out is not None else nodes.sparkSession.createDataFrame([], "query_id long, node long, score float")


def _search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, doors: DataFrame, beam: int) -> DataFrame:
    rows = [(r.query_id, np.array(r.vec)) for r in queries.select("query_id", "vec").collect()]
    sent = nodes.sparkSession.sparkContext.broadcast({q: (v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())).astype(np.float32) for q, v in rows})
    start = queries.where("start is not null").select(F.col("start").alias("to"), "query_id")
    enter = queries.select("query_id", F.size("vec").alias("dim")).join(F.broadcast(doors), "dim").select(F.col("node").alias("to"), "query_id")
    asked, table = start.union(enter), None
    while True:
        visits = asked.groupBy("to").agg(F.collect_set("query_id").alias("asks")).join(nodes.select(F.col("node").alias("to"), "vec"), "to")
        floor = None
        if table is not None:
            state = table[0]
            floor = state.groupBy("query_id").agg(F.when(F.count("*") >= beam, F.min("score")).otherwise(F.lit(-2.0)).alias("floor"))
            floor = nodes.sparkSession.sparkContext.broadcast({r.query_id: r.floor for r in floor.collect()})
        found = visits.mapInArrow(_scorer(sent, floor), "query_id long, node long, score float, open boolean")
        if table is not None:
            found = found.union(state.withColumn("open", F.lit(False)))
        once = found.repartition("query_id").groupBy("query_id", "node").agg(F.max("score").alias("score"), F.min("open").alias("open"))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
        before, table = table, written_at(once.withColumn("at", F.row_number().over(best)).where(F.col("at") <= beam).drop("at"))
        if before is not None:
            discard(*before)
        state = table[0]
        if state.where("open").isEmpty():
            return state.select("query_id", "node", "score")
        asked = state.where("open").join(graph, "node").select(F.explode("near").alias("to"), "query_id")


def _scorer(sent, floor) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value
        least = floor.value if floor is not None else {}
        for whole in batches:
            for _, batch in by_dim(whole):
                x = unit(batch.column("vec"))
                asks = batch.column("asks")
                of = np.repeat(np.arange(len(x)), np.diff(asks.offsets.to_numpy()))
                who = asks.flatten().to_numpy()
                names, code = np.unique(who, return_inverse=True)
                vec, low = [q[n] for n in names.tolist()], np.array([least.get(n, -2.0) for n in names.tolist()])
                fits = np.array([len(v) == x.shape[1] for v in vec])
                for a in range(0, len(of), 1 << 16):
                    i, j = of[a : a + (1 << 16)], code[a : a + (1 << 16)]
                    ok = fits[j]
                    i, j = i[ok], j[ok]
                    if not len(i):
                        continue
                    y = np.stack([v if f else np.zeros(x.shape[1], np.float32) for v, f in zip(vec, fits, strict=True)])
                    s = np.einsum("ij,ij->i", x[i], y[j])
                    near = s >= low[j]
                    i, j, s = i[near], j[near], s[near]
                    yield pa.RecordBatch.from_arrays([pa.array(names[j]), batch.column("to").take(pa.array(i)), pa.array(s), pa.array(np.ones(len(i), bool))], names=["query_id", "node", "score", "open"])

    return score


def nearest(vectors: DataFrame, asks: DataFrame, k: int = 5, **build_options) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows of ``asks`` (vec_id, embedding; rows of ``vectors``) their ``k`` nearest other rows."""
    nodes = nodes_of(vectors, k)
    graph = build(nodes, **build_options)
    own = usable(asks).select(F.col("vec_id").alias("query_id"), "vec")
    queries = written(own.join(nodes.select("vec", F.col("node").alias("start")), "vec").select("query_id", "vec", "start"))
    found = search(nodes, graph, queries)
    # What single precision can't tell from the k-th is scored again.
    near = Window.partitionBy("query_id").orderBy(F.desc("score"))
    edge = F.min(F.when(F.col("at") <= k + 1, F.col("score"))).over(Window.partitionBy("query_id"))
    found = found.withColumn("at", F.row_number().over(near)).withColumn("edge", edge).where(F.col("score") >= F.col("edge") - 1e-5)
    met = found.select("query_id", "node").join(nodes.select("node", "ids", F.col("vec").alias("other")), "node").join(queries.select("query_id", "vec"), "query_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, batch in by_dim(whole):
                x, y = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in ("vec", "other"))
                with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                    s = cosine(x, y)
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("ids"), pa.array(s)], names=["query_id", "ids", "score"])

    scored = met.select("query_id", "ids", "vec", "other").mapInArrow(measure, "query_id long, ids array<long>, score double")
    rows = scored.select("query_id", F.explode("ids").alias("vec_id"), "score").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; powers of two keep squares of very large or small components finite."""
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (x, y))
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))

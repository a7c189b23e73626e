"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full sets, union-find.

SuperMinHash gives every element of a set a random permutation of the signature's places: at step j
the element puts the rank j plus a fraction on the next place of its permutation. The ranks of one
element are thus distinct, which lowers the variance of the estimate, and once a text has all places
filled at step j, later steps can't lower any and are skipped. Here one step runs for all
elements of a batch of texts at once.

Texts with the same set form a class; only its least id takes part in what follows. Representatives
that share a band are tied to its least member, and what is so tied, directly or not, is one
candidate group, by union-find. A group's full sets then meet in blocks of bounded size, where intersections
of all its pairs come from products of 0/1 matrices; a task emits only a forest of the links that
hold, at most one a text. So no link that banding finds is lost, no pairs are listed, and no group
is held whole in one task. At similarity 0.85 the chance that no band of 24 x 4 agrees is below 3e-8; at 0.8,
below 5e-6.

Null texts and texts without words have an empty set: linked with nothing, a component of their own.
Null ids are dropped from links and keep a null component. Repeated rows of one id share its class;
rows of one id with different texts are one node that has the links of each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import only, spread_join, written
from quillmesh.llm.components import connected_components

PLACES, BANDS = 96, 24
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(p: tk.Packed, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-word shingles of each text, sorted by row and hash; a shorter text has its whole sequence."""
    s, e = p.runs(tk.WORD)
    row, word = p.rows(s), p.hashes(s, e, tk.LOWER)
    h, first = tk.ngrams(word, row, n)
    r = row[first]
    for k in range(1, n):  # texts of k words
        few = np.flatnonzero(tk.counts(row, p.n) == k)
        at = np.searchsorted(row, few)
        g = np.zeros(len(few), tk.U)
        for j in range(k):
            g = tk.mix(g + word[at + j] + tk.U(k))
        h, r = np.concatenate([h, g]), np.concatenate([r, few])
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(h) != 0) | (np.diff(r) != 0)
    return r[new], h[new]


def superminhash(h: np.ndarray, row: np.ndarray, n: int, m: int = PLACES) -> np.ndarray:
    """Signatures (n x m) of the sets whose distinct elements are h[row == i]; rows without elements stay EMPTY."""
    out = np.full(n * m, EMPTY, tk.U)
    perm = None
    at = np.arange(len(h))
    for j in range(m):
        x = tk.mix(h[at] + tk.U((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = j + ((x >> tk.U(48)) % tk.U(m - j)).astype(np.int64)
        if perm is None:
            place = k
        else:
            rows = np.arange(len(at))
            place = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
        np.minimum.at(out, row[at] * m + place, (tk.U(j) << tk.U(48)) | (x & tk.U((1 << 48) - 1)))
        full = (out.reshape(n, m) != EMPTY).all(1)
        go = ~full[row[at]]
        if not go.any():
            break
        if perm is None:
            perm = np.repeat(np.arange(m, dtype=np.uint8)[None, :], int(go.sum()), 0)
            perm[np.arange(len(perm)), k[go]] = 0
        else:
            perm = perm[go]
        at = at[go]
    return out.reshape(n, m)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, fp1 and fp2 (of the set), bands; one row for each row of docs."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                row, h = shingles(p, words)
                size = tk.counts(row, p.n)
                cut = np.searchsorted(row, np.arange(p.n + 1))
                fp = []
                for salt in (0x51ED270B, 0x2545F491):
                    c = np.concatenate([np.zeros(1, tk.U), np.cumsum(tk.mix(h ^ tk.U(salt)))])
                    fp.append((c[cut[1:]] - c[cut[:-1]]).view(np.int64))
                sig = tk.mix(superminhash(h, row, p.n))
                parts = sig.reshape(p.n, BANDS, PLACES // BANDS)
                band = np.zeros((p.n, BANDS), tk.U)
                for k in range(parts.shape[2]):
                    band = tk.mix(band + parts[:, :, k])
                band = tk.mix(band + np.arange(BANDS, dtype=tk.U)[None, :])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(p.n + 1) * BANDS, pa.int32()), pa.array(band.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column("doc_id"), pa.array(size), pa.array(fp[0]), pa.array(fp[1]), lists], names=["doc_id", "n_shingles", "fp1", "fp2", "bands"])

    return only(docs, "doc_id", "text").mapInArrow(apply, "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>")


def sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, elements: the full set of each text, sorted 64-bit hashes as bytes."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                row, h = shingles(p, words)
                cut = np.searchsorted(row, np.arange(1, p.n))
                yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column("doc_id"), pa.array([x.tobytes() for x in np.split(h, cut)], pa.binary())], names=["doc_id", "elements"])

    return docs.mapInArrow(apply, "doc_id long, elements binary")


def linked(elements: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of n sets (of distinct hashes) have 100 * intersection >= percent * union, as an n x n matrix.

    Intersections are products of 0/1 matrices over the hashes that two sets or more share, in bounded parts.
    """
    n = len(elements)
    size = np.array([len(x) for x in elements])
    owner = np.repeat(np.arange(n), size)
    _, code, times = np.unique(np.concatenate(elements), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    keep = times[code] > 1
    owner, code = owner[keep], column[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    same = np.zeros((n, n), np.float32)
    columns = int(code[-1]) + 1 if len(code) else 0
    width = min(columns, max(256, (4 << 20) // n))
    for at in range(0, columns, width or 1):
        a, b = np.searchsorted(code, (at, at + width))
        m = np.zeros((n, width), np.float32)
        m[owner[a:b], code[a:b] - at] = 1
        for r in range(0, n, 256):
            same[r : r + 256] += m[r : r + 256] @ m.T
    out = np.empty((n, n), bool)
    for r in range(0, n, 256):
        both = same[r : r + 256].astype(np.int64)
        out[r : r + 256] = 100 * both >= percent * (size[r : r + 256, None] + size[None, :] - both)
    return out


def forest(ids: np.ndarray, link: np.ndarray) -> Iterator[tuple[int, int]]:
    """At most n - 1 links that join what the matrix joins."""
    free = np.ones(len(ids), bool)
    for i in range(len(ids)):
        if free[i]:
            free[i], stack = False, [i]
            while stack:
                near = np.flatnonzero(link[stack.pop()] & free)
                free[near] = False
                stack += near.tolist()
                yield from ((int(ids[i]), int(ids[k])) for k in near)


def _links(percent: int):
    """Of rows (grp, i, j, doc_id, elements) sorted by the first three: a forest of each block's links."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, elements, out = None, [], [], []

        def close():
            if len(ids) > 1:
                out.extend(forest(np.array(ids, np.int64), linked(elements, percent)))

        for batch in tk.slices(batches, 500):
            for *key, doc, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    close()
                    now, ids, elements = key, [], []
                ids.append(doc)
                elements.append(np.frombuffer(raw, tk.U))
        close()
        u, v = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return apply


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, block: int = 2048, block_elements: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable, itself included), kept; a row for each row of docs."""
    docs = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    sig = written(signatures(docs, words))
    some = sig.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "fp1", "fp2"]
    classes = written(some.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    total = sig.count()
    # A row of each class, with its bands: copies take no part in what follows.
    reps = classes.select(F.col("rep").alias("doc_id"), *same).join(sig, ["doc_id", *same]).select("doc_id", "n_shingles", "bands").dropDuplicates(["doc_id", "n_shingles", "bands"])
    reps = written(reps)
    # Candidate groups: what shares a band, or a chain of bands, with its least member.
    shared = reps.select("doc_id", F.explode("bands").alias("band"))
    meet = shared.groupBy("band").agg(F.min("doc_id").alias("u"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("u != last").select("band", "u", "n")
    near = spread_join(shared, meet, ["band"], total * BANDS).where("doc_id != u").select("u", F.col("doc_id").alias("v"))
    group = connected_components(near)
    group = written(group.select(F.col("component").alias("doc_id"), F.col("component").alias("grp")).distinct().union(group.select("node", "component")))
    # Blocks bound what a task holds; every two blocks of a group meet in one task.
    size = group.join(reps.groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles")), "doc_id").groupBy("grp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("elements"))
    parts = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("elements") / block_elements)).cast("int")
    rows = spread_join(group, size.select("grp", "n", parts.alias("parts")), ["grp"], total).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    other = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: q != F.col("part")))
    rows = rows.select("grp", "doc_id", "part", F.explode(other).alias("q")).select("grp", F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"), "doc_id")
    full = sets(docs.join(group.select("doc_id"), "doc_id", "left_semi"), words)
    placed = rows.join(full, "doc_id").select("grp", "i", "j", "doc_id", "elements").repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    links = placed.mapInArrow(_links(percent), "u long, v long")
    # Rows of one id that are not copies of one another tie their classes together.
    ids = some.groupBy("doc_id").agg(F.min(F.struct(*same)).alias("a"), F.max(F.struct(*same)).alias("b")).where("a != b").select("doc_id")
    mixed = some.select("doc_id", *same).join(ids, "doc_id").distinct().join(classes, same).select(F.col("rep").alias("u"), F.col("doc_id").alias("v"))
    final = written(connected_components(written(links.union(mixed))))  # written first: a task runs one Python worker at a time
    # A class has its least member's component; ids of several classes are nodes themselves.
    node = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(*same, "n", F.coalesce("component", "rep").alias("component_id"))
    linked_rows = spread_join(some.select("doc_id", *same), node, same, total).select("doc_id", "n_shingles", "component_id")
    rest = sig.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked_rows.union(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

"""Ranked lexical search: the best documents of each item by exact integer scores, found with norm buckets.

A document is a vector with the impact of each term of the items that it holds; an item is a 0/1 vector of its terms; a
score is their product. Vectors are dealt by ranges of length, longest first, and searched in buckets of vectors of
similar length. An item's threshold is the ``k``-th best score so far. By Cauchy-Schwarz no vector of a bucket can
reach it where sqrt(terms) * (greatest length) is less: the bucket is skipped for that item. Inside a bucket the coordinates of the item's rarest
terms are added up, and what a vector has left of its length bounds the rest; survivors are scored exactly in 64-bit integers.
The longest vectors, one in 50, are searched first and give every task its thresholds. Bounds have a slack of 1e-9, so nothing is lost.

Texts are split once a block of items; a block has about ``terms_a_block`` terms, so what is broadcast (its terms, weights and
thresholds) is bounded. A task keeps at most k rows an item of its block. No document meets another, and a term's
documents never meet in one task.

Terms are runs of letters, digits and non-ASCII characters with A to Z in lower case. Null and empty texts have none: as documents they aren't counted, as
items they find nothing. Texts of any length are read whole, in parts. Rows that share a doc_id are ranked each on its own; among equal scores a null doc_id comes
last. Rows that share an item_id are items each of its own, so they have each rank once a row. Empty tables give an empty result. Further columns take no
part, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.common import discard, only, written, written_at
from quillmesh.llm.textkernels import trim

#: Bytes to bytes: separators become spaces, A to Z lower case.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
#: Bytes of a text that are split at a time, and vectors of a bucket.
PART, BUCKET = 1 << 20, 1024
LAST = np.iinfo(np.int64).max
FOUND = "item long, doc_id long, score long"


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a part at a time; no term is cut."""
    s, at = text.translate(TABLE), 0
    while len(s) - at > PART:
        cut = s.find(b" ", at + PART)
        if cut < 0:
            break
        yield s[at:cut].split()
        at = cut
    yield s[at:].split() if at else s.split()


def item_terms(items: DataFrame, terms_a_block: int) -> DataFrame:
    """item (a number of its own), item_id, terms (distinct), block; written."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted({t for part in pieces(x or b"") for t in part}) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(terms, pa.list_(pa.binary()))], names=["item", "item_id", "terms"])

    i = only(items, "item_id", "text").select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
    found = written(i.mapInArrow(split, "item long, item_id long, terms array<binary>").where(F.size("terms") > 0))
    total = found.agg(F.sum(F.size("terms"))).head()[0] or 0
    return found.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(-(-total // terms_a_block) or 1)))


def counted(docs: DataFrame, terms: list[bytes]) -> tuple[DataFrame, str]:
    """doc_id, n (terms of the text), term, tf (of the given terms, by their place in the list); written. Texts without terms are left out."""
    sent = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value.get
        for batch in batches:
            n, term, tf, off = [], [], [], [0]
            for x in batch.column("text").cast(pa.binary()):
                c, words = Counter(), 0
                for part in pieces(x.as_py() or b""):
                    words += len(part)
                    c.update(map(place, part))
                c.pop(None, None)
                n.append(words)
                term.extend(c.keys())
                tf.extend(c.values())
                off.append(len(term))
            off = pa.array(off, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(off, pa.array(term, pa.int32())), pa.ListArray.from_arrays(off, pa.array(tf, pa.int64()))], names=["doc_id", "n", "term", "tf"])
            trim()

    d = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return written_at(d.mapInArrow(count, "doc_id long, n long, term array<int>, tf array<long>").where("n > 0"))


def impacts(vectors: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """doc_id, length, term, impact: the vectors in ranges of falling length, written; those of length 0 are left out."""
    sent = vectors.sparkSession.sparkContext.broadcast(weights)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, term, tf = flat(batch, "term", "tf")
            m = np.array([50 + 50 * n * n_docs // n_terms for n in batch.column("n").to_pylist()], np.int64)[of]
            x = sent.value[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            of, term, x = of[x > 0], term[x > 0], x[x > 0]
            length = np.sqrt(np.bincount(of, x.astype(np.float64) ** 2, batch.num_rows))
            off = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=batch.num_rows))]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(length), pa.ListArray.from_arrays(off, pa.array(term, pa.int32())), pa.ListArray.from_arrays(off, pa.array(x))], names=["doc_id", "length", "term", "impact"])

    x = vectors.mapInArrow(weigh, "doc_id long, length double, term array<int>, impact array<long>").where("length > 0")
    parts = max(8, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Copies have one length: the id and a hash of it spread them over ranges.
    return written(x.repartitionByRange(parts, F.desc("length"), F.xxhash64("doc_id", "term")).sortWithinPartitions(F.desc("length")))


def flat(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, ...]:
    """The row of each element of the lists, and their elements."""
    first = batch.column(names[0])
    size = np.diff(first.offsets.to_numpy())
    return np.repeat(np.arange(batch.num_rows), size), *(batch.column(x).flatten().to_numpy() for x in names)


def search(vectors: DataFrame, asked: dict[int, np.ndarray], least: dict[int, int], k: int) -> DataFrame:
    """item, doc_id, score: what each task keeps of its vectors, at most ``k`` rows an item, none below the item's threshold ``least``.

    ``asked``: for each item its terms, the rarest first.
    """
    sent = vectors.sparkSession.sparkContext.broadcast((asked, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least = sent.value
        least, best = dict(least), {}
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                _bucket(batch.slice(at, BUCKET), asked, least, best, k)
        for item, (score, ids) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item)), pa.array(ids, mask=ids == LAST), pa.array(score)], names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, FOUND)


def _bucket(batch: pa.RecordBatch, asked: dict[int, np.ndarray], least: dict[int, int], best: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> None:
    """Adds what a bucket has to ``best`` and raises the thresholds in ``least``."""
    slack, length = 1 + 1e-9, batch.column("length").to_numpy()
    longest = length.max()
    live = [q for q, terms in asked.items() if np.sqrt(len(terms)) * longest * slack >= least[q]]
    if not live:
        return
    of, term, x = flat(batch, "term", "impact")
    order = np.argsort(term, kind="stable")
    of, x, names = of[order], x[order], term[order]
    names, start = np.unique(names, return_index=True)
    column = dict(zip(names.tolist(), zip(start.tolist(), [*start[1:].tolist(), len(x)], strict=True), strict=True))
    near, square = x.astype(np.float64), length**2
    ids = batch.column("doc_id").fill_null(LAST).to_numpy()
    for q in live:
        terms = asked[q]
        focus = (len(terms) + 1) // 2
        part, used = np.zeros(len(length)), np.zeros(len(length))
        for t in terms[:focus].tolist():
            if t in column:
                a, b = column[t]
                part[of[a:b]] += near[a:b]
                used[of[a:b]] += near[a:b] ** 2
        bound = part + np.sqrt(len(terms) - focus) * np.sqrt(np.maximum(square - used, square * 1e-12))
        left = np.flatnonzero(bound * slack >= least[q])
        if not len(left):
            continue
        exact = np.zeros(len(length), np.int64)
        for t in terms.tolist():
            if t in column:
                a, b = column[t]
                exact[of[a:b]] += x[a:b]
        left = left[exact[left] >= least[q]]
        score, own = best.get(q, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        score, own = np.concatenate([score, exact[left]]), np.concatenate([own, ids[left]])
        top = np.lexsort((own, -score))[:k]
        best[q] = score[top], own[top]
        if len(top) == k:
            least[q] = max(least[q], int(score[top[-1]]))


def rank(docs: DataFrame, items: DataFrame, k: int = 50, terms_a_block: int = 100_000) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents with the highest scores above 0 for each item."""
    i = item_terms(items, terms_a_block)
    blocks, all_found = [r.block for r in i.select("block").distinct().collect()], []
    for block in blocks:
        own = i.where(F.col("block") == block).select("item", "terms").collect()
        terms = sorted({bytes(t) for r in own for t in r.terms})
        vectors, at = counted(docs, terms)
        n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).head()
        df = np.zeros(len(terms), np.int64)
        for r in vectors.select(F.explode("term").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
            df[r.t] = r.df
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        long = impacts(vectors, weights, n_docs, n_terms or 1)
        discard(vectors, at)
        place, live = {t: j for j, t in enumerate(terms)}, (weights > 0) & (df > 0)
        asked = {}
        for r in own:
            t = np.array([place[bytes(t)] for t in r.terms])
            t = t[live[t]]
            asked[r.item] = t[np.argsort(-weights[t], kind="stable")]
        asked, least = {q: t for q, t in asked.items() if len(t)}, dict.fromkeys(asked, 1)
        edge = long.agg(F.expr("percentile_approx(length, 0.98)")).head()[0] or 0.0
        head = written(search(long.where(F.col("length") >= edge), asked, least, k))
        best = Window.partitionBy("item").orderBy(F.desc("score"))
        for r in head.select("item", "score", F.row_number().over(best).alias("at")).where(F.col("at") == k).collect():
            least[r.item] = r.score
        all_found += [head, search(long.where(F.col("length") < edge), asked, least, k)]
    if not all_found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = all_found[0]
    for more in all_found[1:]:
        found = found.union(more)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.join(i.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

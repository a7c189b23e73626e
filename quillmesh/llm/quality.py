"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

A text is split into runs of letters and digits and runs of other marks; features are the hashes of
these runs, of pairs of neighbours, of each run's shape (class, case, length) and of repeats of the
run before, modulo a power of two. A text's feature values are the counts' square roots, scaled to
length one, so that length alone does not decide. Scoring is one gather and one segmented sum a
batch: a sparse dot product.

Training reads labels only of rows that the caller lets in, at most ``sample`` of them, chosen by a
hash of the row's id (a documented bound). All else covers every row. Null and empty texts have no
features and get the score of the bias alone; a table without labels gives the score 0.5 to all.
Repeated rows are scored alike; other columns are ignored or kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import only

#: Letters, digits and all bytes of characters beyond ASCII; the rest but white space are marks.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
MARK = tk.WORD & ~ALNUM


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int


def features(p: tk.Packed, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value), sorted by row, of the texts of a pack."""
    parts = [p.runs(ALNUM), p.runs(MARK)]
    s = np.concatenate([x[0] for x in parts])
    e = np.concatenate([x[1] for x in parts])
    order = np.argsort(s, kind="stable")
    s, e = s[order], e[order]
    row, word = p.rows(s), p.hashes(s, e)
    if not len(s):
        return row, np.zeros(0, np.int64), np.zeros(0)
    up = ((p.buf >= 65) & (p.buf <= 90)).astype(np.int32)
    c = np.concatenate([[0], np.cumsum(up)])
    size, ups = e - s, c[e] - c[s]
    first = p.buf[s]
    shape = np.where(ALNUM[first], np.where((first >= 48) & (first <= 57), 1, np.where(ups == 0, 2, np.where((ups == size) & (size > 1), 3, 4))), 5)
    shape = tk.mix((shape * 64 + np.minimum(size, 12)).astype(tk.U) + tk.U(1 << 40))
    pair, at = tk.ngrams(word, row, 2)
    same = at[word[at] == word[at + 1]]
    shapes, at2 = tk.ngrams(shape, row, 2)
    f = np.concatenate([word, pair, shape, shapes, np.full(len(same), tk.U(77))])
    r = np.concatenate([row, row[at], row, row[at2], row[same]])
    key = (r.astype(np.int64) << bits) | (f & tk.U((1 << bits) - 1)).astype(np.int64)
    key.sort()
    new = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(np.append(new, len(key)))
    key = key[new]
    r, v = key >> bits, np.sqrt(n)
    v /= np.sqrt(np.maximum(np.bincount(r, v * v, p.n), 1e-12))[r]
    return r, key & ((1 << bits) - 1), v


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, epochs: int = 2) -> Model:
    """FTRL-proximal over (features, values, label) rows, one update a row."""
    n, z, w = (np.zeros((1 << bits) + 1) for _ in range(3))
    bias = 1 << bits
    for _ in range(epochs if len({y for *_, y in rows}) > 1 else 0):
        for f, v, y in rows:
            f, v = np.append(f.astype(np.int64), bias), np.append(v.astype(float), 1.0)
            zi, ni = z[f], n[f]
            wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            g = (1 / (1 + np.exp(-np.clip(wi @ v, -35, 35))) - y) * v
            z[f] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * wi
            n[f] += g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return Model(w[:-1].astype(np.float32), float(w[-1]), bits)


def score_pack(p: tk.Packed, m: Model) -> np.ndarray:
    r, f, v = features(p, m.bits)
    x = m.bias + (np.bincount(r, m.weights[f] * v, p.n) if len(r) else np.zeros(p.n))
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", bits: int = 20, sample: int = 12_000) -> Model:
    """``learn``: over doc_id, which rows' labels may be read. ``sample`` bounds the rows, also where many share an id; the join below broadcasts at most so many ids."""
    chosen = only(labels, "doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn).orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", label).limit(sample)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                r, f, v = features(p, bits)
                cut = np.searchsorted(r, np.arange(p.n + 1))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column(label).cast(pa.int32()), pa.array([x.astype("<i4").tobytes() for x in np.split(f, cut[1:-1])], pa.binary()), pa.array([x.astype("<f4").tobytes() for x in np.split(v, cut[1:-1])], pa.binary())], names=["doc_id", "y", "f", "v"])

    def learn_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(f, "<i4"), np.frombuffer(v, "<f4"), y) for batch in tk.slices(batches, 500) for y, f, v in zip(*(batch.column(c).to_pylist() for c in ("y", "f", "v")), strict=True)]
        m = train(rows, bits)
        del rows
        tk.trim()
        yield pa.RecordBatch.from_arrays([pa.array([m.weights.tobytes()], pa.binary()), pa.array([m.bias])], names=["weights", "bias"])

    # One task has the sample, which is bounded, and the driver only gets the weights.
    rows = only(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(sparse, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y int, f binary, v binary")
    rows = rows.orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id", "y", F.xxhash64("f", "v")).limit(sample)
    found = rows.mapInArrow(learn_all, "weights binary, bias double").collect()
    return Model(np.frombuffer(found[0].weights, np.float32), found[0].bias, bits) if found else train([], bits)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """The rows with one more column (0 to 1), which takes the place of one of that name."""
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [score_pack(p, handle.value) for _, _, p in tk.packs(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(x) if x else np.zeros(0), pa.float64())], names=[*batch.schema.names, column])

    docs = docs.drop(column)
    return docs.mapInArrow(apply, StructType([*docs.schema.fields, StructField(column, DoubleType())]))

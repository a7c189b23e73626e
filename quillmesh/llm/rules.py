"""Quality rules: gradient-boosted trees over document statistics.

Statistics of a whole text come from vectorised passes over its bytes. The trees are grown in numpy
on quantile bins by second-order logistic loss, then flattened into node arrays (feature, threshold,
left, right, value), which score a batch level by level for all rows and trees at once. Features
named in ``monotone`` only ever raise (+1) or lower (-1) the verdict: a split on one is taken only
if its children's values are in that order, and children keep within the bounds of the mid value.

Training reads at most ``sample`` labelled rows, chosen by a hash of their id (a documented bound).
Null and empty texts have all statistics 0 and fail the base rule (under 10 words). Without labels
the trees keep everything. Repeated rows get the same result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import only

SYMBOL = np.zeros(256, bool)
SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
CODE_POINT = (np.arange(256) & 0xC0) != 0x80
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios that the trees see, and the direction in which each may move the chance of being kept.
RATIOS = {"log_words": 0, "mean_word": 0, "symbol_share": -1, "upper_share": -1, "digit_share": 0, "dup_line_share": -1, "repeat_share": -1, "mark_share": -1, "same_next_share": -1, "distinct_share": 0, "end_mark_share": 0, "words_a_line": 0}
NAMES = tuple(RATIOS)


def statistics(p: tk.Packed) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts, and the matrix of ratios, of each text."""
    s, e = p.runs(tk.WORD)
    row, word = p.rows(s), p.hashes(s, e)
    n = tk.counts(row, p.n)
    within = np.zeros(len(p.buf) + 1, np.int64)
    np.cumsum(CODE_POINT[p.buf] & tk.WORD[p.buf], out=within[1:])
    total = lambda table: np.add.reduceat(table[p.buf].astype(np.int64), p.off[:-1])
    out = {"n_words": n, "word_chars": within[p.off[1:]] - within[p.off[:-1]], "n_symbols": total(SYMBOL)}
    # Lines: each ends at a line feed, the last one at the feed that packing adds.
    end = np.flatnonzero(p.buf == 10)
    start = np.concatenate([[0], end[:-1] + 1])
    some = np.searchsorted(s, end) > np.searchsorted(s, start)
    start, end = start[some], end[some]
    line_row = p.rows(start)
    lines = tk.counts(line_row, p.n)
    key = np.lexsort((h := p.hashes(start, end), line_row))
    again = (np.diff(h[key]) == 0) & (np.diff(line_row[key]) == 0)
    out["n_dup_lines"] = tk.counts(line_row[key][1:][again], p.n)
    # Words in a window of five that the text has twice or more.
    five, first = tk.ngrams(word, row, 5)
    repeated = np.zeros(len(word) + 5, np.int32)
    if len(five):
        r = row[first]
        key = np.lexsort((five, r))
        same = (np.diff(five[key]) == 0) & (np.diff(r[key]) == 0)
        hit = np.zeros(len(key), bool)
        hit[1:] |= same
        hit[:-1] |= same
        at = first[key[hit]]
        repeated[at] = 1
        covered = np.convolve(repeated, np.ones(5, np.int32))[: len(word)] > 0
        out["n_repeat_words"] = tk.sums(covered, row, p.n)
    else:
        out["n_repeat_words"] = np.zeros(p.n, np.int64)
    upper, digit, letter = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
    upper[65:91], digit[48:58], letter[65:91], letter[97:123], letter[128:] = True, True, True, True, True
    mark = tk.WORD & ~letter & ~digit
    some_words, chars = np.maximum(n, 1), np.maximum(out["word_chars"], 1)
    same_next = (row[1:] == row[:-1]) & (word[1:] == word[:-1])
    kinds = np.lexsort((word, row))
    distinct = tk.counts(row[kinds][np.concatenate([[True], (np.diff(word[kinds]) != 0) | (np.diff(row[kinds]) != 0)])], p.n) if len(row) else np.zeros(p.n)
    ends = tk.sums(np.isin(p.buf[e - 1], np.frombuffer(b".!?", np.uint8)), row, p.n)
    ratio = np.column_stack([np.log1p(n), chars / some_words, out["n_symbols"] / chars, total(upper) / chars, total(digit) / chars, out["n_dup_lines"] / np.maximum(lines, 1), out["n_repeat_words"] / some_words, total(mark) / chars, tk.counts(row[1:][same_next], p.n) / some_words, distinct / some_words, ends / some_words, n / np.maximum(lines, 1)])
    return out, ratio


@dataclass
class Trees:
    """Nodes of all trees in one set of arrays; a leaf has feature -1 and points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            low = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(f < 0, at, np.where(low, self.left[at], self.right[at]))
        return self.bias + self.value[at].sum(1)


def grow(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 40, depth: int = 4, rate: float = 0.3, l2: float = 1.0, bins: int = 64, least: float = 5.0) -> Trees:
    """Boosted trees for 0/1 labels y. Ties of gain go to the first feature and the lowest threshold."""
    node: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def add(value: float) -> int:
        k = len(node["feature"])
        for name, v in (("feature", -1), ("threshold", 0.0), ("left", k), ("right", k), ("value", value)):
            node[name].append(v)
        return k

    rate0 = float(np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3))
    bias = float(np.log(rate0 / (1 - rate0))) if len(set(y.tolist())) > 1 else 5.0
    roots: list[int] = []
    if len(set(y.tolist())) > 1:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        code = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
        margin = np.full(len(y), bias)
        for _ in range(trees):
            prob = 1 / (1 + np.exp(-margin))
            g, h = prob - y, np.maximum(prob * (1 - prob), 1e-9)

            def split(rows: np.ndarray, low: float, high: float, level: int) -> int:
                gs, hs = g[rows].sum(), h[rows].sum()  # noqa: B023
                value = float(np.clip(-gs / (hs + l2), low, high))
                k = add(value * rate)
                if level == depth or len(rows) < 2 * least:
                    margin[rows] += value * rate  # noqa: B023
                    return k
                best = (1e-6, -1, 0, 0.0, 0.0)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = code[rows, f]
                    gl, hl, nl = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g[rows], h[rows], None))  # noqa: B023
                    vl, vr = np.clip(-gl / (hl + l2), low, high), np.clip(-(gs - gl) / (hs - hl + l2), low, high)
                    score = lambda v, a, d: -(a * v + 0.5 * (d + l2) * v * v)
                    gain = score(vl, gl, hl) + score(vr, gs - gl, hs - hl) - score(value, gs, hs)
                    gain[(nl < least) | (len(rows) - nl < least) | (monotone[f] * (vr - vl) < 0)] = -1
                    if gain[j := int(np.argmax(gain))] > best[0]:
                        best = (float(gain[j]), f, j, float(vl[j]), float(vr[j]))
                if best[1] < 0:
                    margin[rows] += value * rate  # noqa: B023
                    return k
                _, f, j, a, d = best
                go, mid = code[rows, f] <= j, (a + d) / 2
                bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[monotone[f]]
                node["feature"][k], node["threshold"][k] = f, float(cuts[f][j])
                node["left"][k] = split(rows[go], *bounds[0], level + 1)
                node["right"][k] = split(rows[~go], *bounds[1], level + 1)
                return k

            roots.append(split(np.arange(len(y)), -4.0, 4.0, 0))
    if not roots:
        roots = [add(0.0)]
    return Trees(np.array(node["feature"]), np.array(node["threshold"]), np.array(node["left"]), np.array(node["right"]), np.array(node["value"]), np.array(roots), depth, bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 12_000) -> Trees:
    """Trees from at most ``sample`` labelled rows, also where many share an id; their ids are the only rows that are broadcast."""
    chosen = only(labels, "doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", label).limit(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(label).cast(pa.int32()), pa.array(statistics(p)[1].tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    rows = sorted((tuple(r.x), r.y) for r in only(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(measure, "y int, x array<double>").orderBy(F.xxhash64("x", "y"), "y").limit(sample).collect())
    return grow(np.array([x for x, _ in rows]).reshape(-1, len(NAMES)), np.array([y for _, y in rows], float), list(RATIOS.values()))


def apply(docs: DataFrame, trees: Trees, least_words: int = 10, most_repeated: int = 20, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, ratios' verdict: base_failed, kept, score (the trees' chance that the label is 1)."""
    handle = docs.sparkSession.sparkContext.broadcast(trees)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                base, ratio = statistics(p)
                failed = (base["n_words"] < least_words) | (100 * base["n_repeat_words"] > most_repeated * base["n_words"])
                score = 1 / (1 + np.exp(-handle.value.margin(ratio)))
                yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column("doc_id"), *(pa.array(base[k]) for k in BASE), pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)], names=["doc_id", *BASE, "base_failed", "kept", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(judge, f"doc_id {kind}, {', '.join(f'{k} long' for k in BASE)}, base_failed boolean, kept boolean, score double")

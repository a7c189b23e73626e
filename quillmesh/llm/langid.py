"""Language of every word and text by a linear-chain conditional random field.

A chain is a line's words that hold a letter. A word's emission
sums learned weights of its features: the word, its prefixes and suffixes, its byte trigrams, and
whether a learned lexicon of a language has it. Transitions between languages are learned too, from chains that
switch between texts of different languages. Forward-backward gives each word's probabilities; a
text's language is the one with the largest mean over its words, the mean its score. A long line is worked on in parts
of ``CHAIN`` words at a time, which the products of their transfer matrices join: the probabilities are those of the whole line.

Training texts are a bounded sample: at most ``per_lang`` a language, chosen by a hash of the id, of
every value of lang, and of each at most four stretches of 60 words, cut in the tasks. Null texts, and texts without a letter, get
``und`` and 0. Ties go to the first language by name. With nothing to learn from, all is ``und``.
Very long texts and lines are read whole. Repeated rows get the same result, rows with a null id are predicted (and learned from) like others; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import only

CHAIN, BITS = 200, 18
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # log potentials, from x to
    lexicon: np.ndarray  # sorted word hashes
    lexicon_lang: np.ndarray


def word_features(p: tk.Packed, s: np.ndarray, e: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs for words at [s, e)."""
    n = np.arange(len(s))
    word = p.hashes(s, e, tk.LOWER)
    ids, words = [word], [n]
    for kind, k in (("p", 1), ("p", 2), ("p", 3), ("s", 1), ("s", 2), ("s", 3), ("s", 4)):
        fit = n[e - s >= k]
        a, b = (s[fit], s[fit] + k) if kind == "p" else (e[fit] - k, e[fit])
        ids.append(tk.mix(p.rolling(a, b, tk.LOWER) + tk.U(k + 10 * (kind == "s") + 1)))
        words.append(fit)
    size = np.maximum(e - s - 2, 0)
    owner = np.repeat(n, size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + s[owner]
    ids.append(p.rolling(at, at + 3, tk.LOWER))
    words.append(owner)
    feature = (np.concatenate(ids) & tk.U((1 << BITS) - 1)).astype(np.int64)
    if len(m.lexicon):
        k = np.minimum(np.searchsorted(m.lexicon, word), len(m.lexicon) - 1)
        known = np.flatnonzero(m.lexicon[k] == word)
        feature = np.concatenate([feature, (1 << BITS) + m.lexicon_lang[k[known]]])
        words.append(known)
    return np.concatenate(words), feature


def chains(p: tk.Packed) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words with a letter, without marks at their sides, the first word of each part of a line, and whether the part goes on the one before."""
    s, e = p.runs(LETTER)  # apostrophes and hyphens part words; harmless here
    line = np.searchsorted(np.flatnonzero(p.buf == 10), s)
    new = np.flatnonzero(np.diff(line, prepend=-1))
    size = np.diff(np.append(new, len(s)))
    parts = -(-size // CHAIN)
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return s, e, np.repeat(new, parts) + CHAIN * within, within > 0


def _blocks(first: np.ndarray, n: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Parts in blocks of like length: (parts, their first words, for each step how many of them reach it; those come first)."""
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    at = 0
    while at < len(order):
        block = order[at : at + max(1, width // max(1, int(length[order[at]])))]
        at += len(block)
        size = length[block]
        yield block, first[block], [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]))]


def borders(local: np.ndarray, first: np.ndarray, goes_on: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What comes into each part from the words before it in its line, and from those after it."""
    parts, k = len(first), local.shape[1]
    into, back = np.ones((parts, k), np.float32), np.ones((parts, k), np.float32)
    some = np.flatnonzero(goes_on | np.append(goes_on[1:], False))  # parts of lines with more than one
    if not len(some):
        return into, back
    moved = np.empty((parts, k, k), np.float32)
    stop = np.append(first, len(local))
    for block, start, live in _blocks(np.arange(len(some)) * CHAIN, len(some) * CHAIN, 100_000 // k):
        del start
        own = some[block]
        size = stop[own + 1] - stop[own]
        m = np.where(goes_on[own][:, None, None], step[None], np.eye(k, dtype=np.float32)[None]) * local[first[own]][:, None, :]
        for t in range(1, len(live)):
            go = np.flatnonzero(size > t)
            x = (m[go] @ step) * local[first[own[go]] + t][:, None, :]
            m[go] = x / x.max((1, 2), keepdims=True)
        moved[own] = m
    out = np.ones(k, np.float32)
    for j in some.tolist():
        if goes_on[j]:
            into[j] = out @ step
            into[j] /= into[j].sum()
        out = (out if goes_on[j] else np.ones(k, np.float32)) @ moved[j]
        out /= out.sum()
    for j in some[::-1].tolist():
        if goes_on[j]:
            b = moved[j] @ back[j]
            back[j - 1] = b / b.sum()
    return into, back


def forward_backward(emission: np.ndarray, first: np.ndarray, transitions: np.ndarray, pairs: np.ndarray | None = None, goes_on: np.ndarray | None = None) -> np.ndarray:
    """Probabilities (word x language) of parts of chains that begin at ``first`` and lie one after another; adds expected transitions to ``pairs``."""
    n, k = emission.shape
    out = np.empty((n, k), np.float32)
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    local = np.exp(emission - emission.max(1, keepdims=True)) + np.float32(1e-12)
    into, back = borders(local, first, np.zeros(len(first), bool) if goes_on is None else goes_on, step)
    for block, start, live in _blocks(first, n, 400_000):
        alpha = []
        for t, on in enumerate(live):
            e = local[start[:on] + t]
            a = e * into[block] if t == 0 else (alpha[-1][:on] @ step) * e
            alpha.append(a / a.sum(1, keepdims=True))
        beta = back[block]
        for t in range(len(live) - 1, -1, -1):
            on = live[t]
            g = alpha[t] * beta[:on]
            out[start[:on] + t] = g / g.sum(1, keepdims=True)
            if t:
                right = local[start[:on] + t] * beta[:on]
                if pairs is not None:
                    joint = alpha[t - 1][:on, :, None] * step[None] * right[:, None, :]
                    pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                b = right @ step.T
                beta[:on] = b / b.sum(1, keepdims=True)
    return out


def train(texts: list[str], langs: list[str], epochs: int = 4, rate: float = 0.3, batch: int = 200, words: int = 120, seed: int = 1, lexicon: int = 200) -> Model:
    """Adagrad on the chains' likelihood. Each text gives a few parts of lines; chains join parts of one or two texts. The lexicon has
    ``lexicon`` words a language at most, the commonest of those that it has nearly to itself."""
    names = sorted(set(langs))
    k = len(names)
    m = Model(names, np.zeros(((1 << BITS) + k, k), np.float32), np.zeros((k, k)), np.zeros(0, tk.U), np.zeros(0, np.int64))
    if k < 2:
        return m
    p = next(tk.packs(pa.array(texts, pa.string()), 1 << 62))[2]
    s, e = p.runs(LETTER)
    row = p.rows(s)
    label = np.searchsorted(names, langs)[row]
    hashes = p.hashes(s, e, tk.LOWER)
    # The lexicon: commonest words that one language has nearly to itself.
    kinds, code, n = np.unique(hashes, return_inverse=True, return_counts=True)
    of = np.zeros((len(kinds), k))
    np.add.at(of, (code, label), 1)
    own = np.flatnonzero((n >= 5) & (of.max(1) >= 0.9 * n))
    own = np.sort(own[np.argsort(-n[own], kind="stable")][: lexicon * k])
    m.lexicon, m.lexicon_lang = kinds[own], of[own].argmax(1)
    rng = np.random.default_rng(seed)
    begin = np.searchsorted(row, np.arange(p.n + 1))
    sums, sums_t = np.full_like(m.weights, 1e-6), np.full((k, k), 1e-6)
    full = np.flatnonzero(np.diff(begin) > 0)
    for _ in range(epochs):
        order = rng.permutation(full)
        for at in range(0, len(order), batch):
            take, first, count = [], [], 0
            for i, d in enumerate(order[at : at + batch]):
                a, b = begin[d], begin[d + 1]
                size = min(b - a, int(rng.integers(1, words // 2)))
                a += int(rng.integers(0, b - a - size + 1))
                if i % 3 != 1:  # every third text goes on in the chain of the one before
                    first.append(count)
                take.append(np.arange(a, a + size))
                count += size
            take = np.concatenate(take)
            w, f = word_features(p, s[take], e[take], m)
            emission = np.zeros((len(take), k), np.float32)
            for j in range(k):
                emission[:, j] = np.bincount(w, m.weights[f, j], len(take))
            pairs = np.zeros((k, k))
            post = forward_backward(emission, np.array(first), m.transitions, pairs)
            y = label[take]
            gap = post.copy()
            gap[np.arange(len(y)), y] -= 1
            used, inverse = np.unique(f, return_inverse=True)
            g = np.column_stack([np.bincount(inverse, gap[w, j], len(used)) for j in range(k)]) / batch + 1e-5 * m.weights[used]
            sums[used] += g * g
            m.weights[used] -= rate * g / np.sqrt(sums[used])
            inner = np.ones(len(y), bool)
            inner[first] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
            g = (pairs - seen) / batch
            sums_t += g * g
            m.transitions -= rate * g / np.sqrt(sums_t)
    return m


def word_probabilities(p: tk.Packed, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a pack, and each one's probability of each language."""
    s, e, first, goes_on = chains(p)
    kinds, one, code = np.unique(p.hashes(s, e, tk.LOWER), return_index=True, return_inverse=True)
    w, f = word_features(p, s[one], e[one], m)
    emission = np.column_stack([np.bincount(w, m.weights[f, j], len(kinds)) for j in range(len(m.langs))]).astype(np.float32)
    return s, e, forward_backward(emission[code], first, m.transitions, goes_on=goes_on)


def stretches(text: str, seed: int, parts: int = 4, words: int = 60) -> str:
    """At most ``parts`` stretches of at most ``words`` words with a letter, a line each."""
    p = next(tk.packs(pa.array([text], pa.string())))[2]
    s, e = p.runs(LETTER)
    if len(s) <= parts * words:
        return text
    at = np.random.default_rng(seed).integers(0, len(s) - words + 1, parts)
    return "\n".join(p.buf[s[k] : e[k + words - 1]].tobytes().decode("utf-8", "replace").replace("\n", " ") for k in at.tolist())


def fit(docs: DataFrame, learn: Column, per_lang: int = 800) -> Model:
    """``learn``: which rows may be read. Of each language at most ``per_lang`` texts, also where many share an id."""
    rows = only(docs, "doc_id", "text", "lang").where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Ids first: the ordering moves no texts. A rank filter of a window is cut before the shuffle.
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id")
    ids = rows.select("lang", "doc_id").withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_lang).select(F.col("doc_id").alias("chosen")).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [stretches(t, zlib.crc32(str(i).encode())) for t, i in zip(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(texts, pa.string())], names=["lang", "text"])

    # Equal ids are met null-safe: rows without an id are learned from too.
    met = rows.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("chosen"))).select("doc_id", "lang", "text")
    again = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    some = met.mapInArrow(cut, "lang string, text string").withColumn("k", F.row_number().over(again)).where(F.col("k") <= per_lang)
    sample = sorted((r.lang, r.text) for r in some.select("lang", "text").collect())
    return train([t for _, t in sample], [x for x, _ in sample])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score; a row for each row of docs."""
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = handle.value
        names = np.array([*m.langs, "und"], object)
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                part = batch.slice(a, b - a)
                if len(m.langs) > 1:
                    s, _, prob = word_probabilities(p, m)
                    row = p.rows(s)
                    mean = np.column_stack([np.bincount(row, prob[:, j], p.n) for j in range(len(m.langs))]) / np.maximum(np.bincount(row, minlength=p.n), 1)[:, None]
                else:
                    mean = np.ones((p.n, max(1, len(m.langs))))
                ascii_letter = np.zeros(256, bool)
                ascii_letter[[*range(65, 91), *range(97, 123)]] = True
                some = np.add.reduceat(ascii_letter[p.buf].astype(np.int64), p.off[:-1]) > 0
                for i in np.flatnonzero(~some):
                    some[i] = any(c.isalpha() for c in p.buf[p.off[i] : p.off[i + 1]].tobytes().decode("utf-8", "replace"))
                some &= bool(m.langs)
                best = np.where(some, mean.argmax(1), len(m.langs))
                score = np.where(some, np.clip(mean.max(1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(apply, f"doc_id {kind}, lang_pred string, score double")


def label_words(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, word, pos, lang, score: a row for each word of code-switched texts."""
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = handle.value
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                s, e, prob = word_probabilities(p, m)
                row = p.rows(s)
                ids = batch.slice(a, b - a).column("doc_id").take(pa.array(row))
                first = np.searchsorted(row, np.arange(p.n))
                yield pa.RecordBatch.from_arrays([ids, pa.array([p.buf[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(s, e, strict=True)], pa.string()), pa.array((np.arange(len(s)) - first[row]).astype(np.int32)), pa.array(np.array(m.langs, object)[prob.argmax(1)], pa.string()), pa.array(prob.max(1).astype(float))], names=["doc_id", "word", "pos", "lang", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(apply, f"doc_id {kind}, word string, pos int, lang string, score double")

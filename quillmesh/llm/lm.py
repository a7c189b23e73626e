"""Language-model scores: a causal self-attention model in numpy over subword ids, and an exact unigram base.

The model reads the ids of a public byte-level BPE. For every place it attends, by one head with
learned relative offsets, to the ``WINDOW`` ids before; the attended values and the last id choose
a mixture of ``MIX`` learned distributions over the ids, so a probability costs a few dozen products
instead of a softmax over the whole vocabulary, yet the distributions sum to one. Texts are laid out one after another and cut into overlapping windows
(``LONG`` places behind those that the first of them attends to), in batches of ``LANES`` under one causal mask: each id is scored once, with the
``WINDOW`` ids before it. Between texts stands the end id; ids end with it.

No weight comes from a sample. A pass over all training rows counts, for each id, the buckets (a hash of the id) of the ids next to it
and some places on (``pair_counts``); one task splits these counts, a table bounded by the vocabulary, into ``MIX`` parts, which give
all weights to start from (``from_pairs``). A second pass over all training rows sums expected counts, by which the gates are scaled and
the mixtures replaced (``learned_from_all``): scores don't depend on how rows lie in tasks. The base
counts are over all training words, which grow with the corpus: words more frequent than a
threshold (at most ``frequent`` of them) go to all tasks, the others are joined by hash, once a text and word.

Null text is empty: one end token, no words. With no training rows all counts are 0 and N is 0 (log10(1/1) = 0
if V is 0 too). Rows of one id, and rows without one, are scored row by row; very long texts are scored whole, window by window;
repeated rows get the same result; extra columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import only, written
from quillmesh.llm.packing import encoder

WINDOW, STRIDE, WIDTH, MIX = 16, 16, 8, 12
#: The hash that stands for the end token.
END = 0x0E2D


@dataclass
class Model:
    """Tables by id: query, key, value (vocabulary x WIDTH), gate (x MIX); offset: WINDOW; out: WIDTH x MIX; tables: log probabilities, vocabulary x MIX."""

    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    gate: np.ndarray
    offset: np.ndarray
    out: np.ndarray
    tables: np.ndarray  # probabilities, not logs


def windows(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and targets, valid targets) of texts that begin at ``starts``: rows of WINDOW ids before STRIDE targets.

    Places before a text, and after its last id, hold -1; the id before the first is the end id. As WINDOW is STRIDE, a text is laid out
    in blocks behind an empty one, and each further block is a window with the block before it.
    """
    length = np.diff(np.append(starts, len(ids)))
    blocks = 1 - (-length // STRIDE)
    first = np.cumsum(blocks) - blocks
    laid = np.full((blocks.sum(), STRIDE), -1)
    laid.ravel()[np.arange(len(ids)) + np.repeat((first + 1) * STRIDE - starts, length)] = ids
    laid[first, -1] = end_id
    own = np.ones(len(laid), bool)
    own[first] = False
    own = np.flatnonzero(own)
    grid = np.hstack([laid[own - 1], laid[own]])
    return grid, grid[:, WINDOW:] >= 0


def lookup(m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Rows by id: query and gate; key, value and a 1. The second's last row, for places without an id (-1), is 0: they add nothing to a sum or its weight."""
    held = np.hstack([m.key, m.value, np.ones((len(m.key), 1), np.float32)])
    return np.hstack([m.query, m.gate]), np.vstack([held, np.zeros((1, held.shape[1]), np.float32)])


def _band(x: np.ndarray) -> np.ndarray:
    """Of rows x STRIDE x places, a view of the WINDOW places before each target, the farthest first."""
    return np.lib.stride_tricks.as_strided(x, (len(x), STRIDE, WINDOW), (x.strides[0], x.strides[1] + x.strides[2], x.strides[2]))


def _attend(m: Model, look: tuple[np.ndarray, np.ndarray], grid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Batched masked attention: (query and gate of the place before each target, keys and values of all places, weights, their sums, state, gate)."""
    asks = np.take(look[0], np.maximum(grid[:, WINDOW - 1 : -1], 0), axis=0)
    held = np.take(look[1], grid[:, :-1], axis=0)
    weight = asks[:, :, :WIDTH] @ held[:, :, :WIDTH].transpose(0, 2, 1)
    offset, inside = np.zeros((1, *weight.shape[1:]), np.float32), np.zeros((1, *weight.shape[1:]), np.float32)
    _band(offset)[:], _band(inside)[:] = m.offset[::-1], 1
    weight += offset
    np.clip(weight, -60, 30, out=weight)
    np.exp(weight, out=weight)
    weight *= inside
    mixed = weight @ held[:, :, WIDTH:]
    total = mixed[:, :, WIDTH:]
    state = mixed[:, :, :WIDTH] / total
    gate = (state.reshape(-1, WIDTH) @ m.out).reshape(*state.shape[:2], MIX)
    gate += asks[:, :, WIDTH:]
    np.clip(gate, -30, 30, out=gate)
    np.exp(gate, out=gate)
    return asks, held, weight, total, state, gate


def tables_by_id(m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by id: query, key, value and a 1; gate; probabilities. A last row stands for places without an id (-1), which add nothing to a state or its weight."""
    last = lambda x, value: np.vstack([x, np.full((1, x.shape[1]), value, np.float32)])
    held = np.hstack([m.query, m.key, m.value, np.ones((len(m.key), 1), np.float32)])
    return last(held, 0), last(m.gate, 0), last(m.tables, 1)


#: A batch has ``LANES`` windows of ``LONG`` places, which lie side by side: a step back in all of them is a step back by LANES.
LANES, LONG = 16, 512


def laid_out(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, target of each, where the ids' own are) of texts that begin at ``starts``: WINDOW places go before each text, of -1 but for the end id; the target is the next id of the text, or -1."""
    n, length = len(starts), np.diff(np.append(starts, len(ids)))
    places, target = np.full((2, len(ids) + WINDOW * n), -1)
    places[starts + WINDOW * np.arange(1, n + 1) - 1] = end_id
    own = np.arange(len(ids)) + np.repeat(WINDOW * np.arange(1, n + 1), length)
    places[own] = ids
    target[own - 1] = ids
    return places, target, own - 1


def _gates(m: Model, look: tuple[np.ndarray, ...], places: np.ndarray, target: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block of places: their ids, their targets and (places x MIX) what the ids there and before, WINDOW in all, give each mixture.

    The last block is filled up. An array of a block holds until the next one is asked for.
    """
    block, span = LANES * LONG, LONG + WINDOW - 1
    n = -(-len(places) // block) * block
    padded = np.full(n + WINDOW - 1, -1)
    padded[WINDOW - 1 : WINDOW - 1 + len(places)] = places
    wanted = np.append(target, np.full(n - len(target), -1))
    offset = np.ascontiguousarray(m.offset[::-1, None])
    # What no score can exceed needs no clipping.
    tame = np.linalg.norm(m.query, axis=1).max() * np.linalg.norm(m.key, axis=1).max() + np.abs(m.offset).max() < 30
    width = look[0].shape[1]
    rows, weight, mixed, gate = (np.empty(x, np.float32) for x in ((width, span * LANES), (WINDOW, block), (WIDTH + 1, block), (block, MIX)))
    # Of the places one after another, a view of each one's WINDOW ids, the farthest first.
    back = np.lib.stride_tricks.as_strided(rows, (width, WINDOW, block), (rows.strides[0], LANES * rows.itemsize, rows.itemsize))
    for a in range(0, n, block):
        near = np.lib.stride_tricks.as_strided(padded[a:], (span, LANES), (padded.itemsize, LONG * padded.itemsize)).ravel()
        rows[:] = np.take(look[0], near, axis=0).T
        np.einsum("fc,fdc->dc", rows[:WIDTH, (WINDOW - 1) * LANES :], back[WIDTH : 2 * WIDTH], out=weight)
        if offset.any():
            weight += offset
        if not tame:
            np.clip(weight, -60, 30, out=weight)
        np.exp(weight, out=weight)
        np.einsum("dc,fdc->fc", weight, back[2 * WIDTH :], out=mixed)
        mixed[:-1] /= np.maximum(mixed[-1], 1e-30)
        at = near[(WINDOW - 1) * LANES :]
        np.matmul(mixed[:-1].T, m.out, out=gate)
        gate += np.take(look[1], at, axis=0)
        np.clip(gate, -30, 30, out=gate)
        np.exp(gate, out=gate)
        yield at, wanted[a : a + block].reshape(LANES, LONG).T.ravel(), gate


def place_log_probs(m: Model, look: tuple[np.ndarray, ...], places: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of each place's target, 0 or next to it where that is -1."""
    out, ones = [np.zeros(0, np.float32)], np.ones(MIX, np.float32)
    for _, to, gate in _gates(m, look, places, target):
        p = np.einsum("cm,cm->c", gate, np.take(look[2], to, axis=0))
        out.append(np.log(p / (gate @ ones)).reshape(LONG, LANES).T.ravel())
    return np.concatenate(out)[: len(places)]


def log_probs(m: Model, grid: np.ndarray) -> np.ndarray:
    """Natural log probability of each target (rows x STRIDE) of ``windows``; those of -1 mean nothing."""
    target = np.full_like(grid, -1)
    target[:, :-1] = grid[:, 1:]
    return place_log_probs(m, tables_by_id(m), grid.ravel(), target.ravel()).reshape(grid.shape)[:, WINDOW - 1 : -1]


def _shares(m: Model, gate: np.ndarray, g: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Each mixture's share in the targets, 0 where there is none; makes ``gate`` its share before the target is known."""
    valid, ones = ok.astype(np.float32), np.ones(MIX, np.float32)
    joint = np.take(m.tables, np.maximum(g[:, WINDOW:], 0), axis=0)
    joint *= gate
    joint *= (valid / np.maximum(joint @ ones, 1e-30))[:, :, None]
    gate *= (valid / (gate @ ones))[:, :, None]
    return joint


#: Columns of the gradients by place: those of query and gate, of key and value, and each mixture's share in the id.
ASKS, HELD, SHARE = slice(0, WIDTH + MIX), slice(WIDTH + MIX, 3 * WIDTH + MIX), slice(3 * WIDTH + MIX, 3 * WIDTH + 2 * MIX)


def gradients(m: Model, look: tuple[np.ndarray, np.ndarray], g: np.ndarray, ok: np.ndarray) -> tuple[int, dict[str, np.ndarray], np.ndarray]:
    """Of windows: valid targets, gradients of offset and out, and a row for every place of the grid with those of its id in all tables."""
    asks, held, weight, total, state, gate = _attend(m, look, g)
    joint = _shares(m, gate, g, ok)
    n = max(1, int(ok.sum()))
    d_gate = (gate - joint) / np.float32(n)
    d_state = (d_gate.reshape(-1, MIX) @ m.out.T).reshape(state.shape)
    query, key, value, seen = asks[:, :, :WIDTH], held[:, :, :WIDTH], held[:, :, WIDTH:-1], held[:, :, -1]
    near = _band(weight)
    near *= np.lib.stride_tricks.sliding_window_view(seen, WINDOW, axis=1) / total
    d_near = _band(d_state @ value.transpose(0, 2, 1)) - np.einsum("bsd,bsd->bs", d_state, state)[:, :, None]
    d_near *= near
    d_score = np.zeros_like(weight)
    _band(d_score)[...] = d_near
    shared = {"offset": d_near.sum((0, 1))[::-1], "out": state.reshape(-1, WIDTH).T @ d_gate.reshape(-1, MIX)}
    rows = np.zeros((*g.shape, SHARE.stop), np.float32)
    rows[:, WINDOW - 1 : -1, :WIDTH] = d_score @ key
    rows[:, WINDOW - 1 : -1, WIDTH : ASKS.stop] = d_gate
    rows[:, :-1, HELD.start : HELD.start + WIDTH] = d_score.transpose(0, 2, 1) @ query
    rows[:, :-1, HELD.start + WIDTH : HELD.stop] = weight.transpose(0, 2, 1) @ d_state
    rows[:, WINDOW:, SHARE] = joint
    return n, shared, rows


def train(texts: list[np.ndarray], counts: np.ndarray, end_id: int, steps: int = 250, batch: int = 256, rate: float = 0.05, seed: int = 0) -> Model:
    """Adam on the mean log probability of random windows; rows of the tables move with the ids that stand in a batch."""
    size, rng = len(counts), np.random.default_rng(seed)
    base = np.log((counts + 0.5) / (counts + 0.5).sum()).astype(np.float32)
    w = {"query": rng.normal(0, 0.3, (size, WIDTH)), "key": rng.normal(0, 0.3, (size, WIDTH)), "value": rng.normal(0, 0.3, (size, WIDTH)), "gate": rng.normal(0, 0.1, (size, MIX)), "offset": np.linspace(0, -2, WINDOW), "out": rng.normal(0, 0.3, (WIDTH, MIX)), "logits": base[:, None] + rng.normal(0, 0.3, (size, MIX))}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}

    def model() -> Model:
        t = np.exp(w["logits"] - w["logits"].max(0))
        return Model(w["query"], w["key"], w["value"], w["gate"], w["offset"], w["out"], t / t.sum(0))

    if not texts:
        return model()
    ids = np.concatenate(texts)
    grid, valid = windows(ids, np.cumsum([0, *map(len, texts[:-1])]), end_id)
    table = model().tables
    for step in range(steps):
        pick = rng.integers(0, len(grid), batch)
        g, ok = grid[pick], valid[pick]
        m = Model(w["query"], w["key"], w["value"], w["gate"], w["offset"], w["out"], table)
        n, grads, rows = gradients(m, lookup(m), g, ok)
        total = np.zeros((size, SHARE.stop), np.float32)
        np.add.at(total, np.maximum(g, 0).ravel(), rows.reshape(-1, SHARE.stop))
        grads |= dict(zip(("query", "gate", "key", "value", "logits"), np.split(total, np.cumsum([WIDTH, MIX, WIDTH, WIDTH]), axis=1), strict=True))
        # Of the mixture: what the distribution gives less expected counts.
        grads["logits"] = (table * rows[:, :, SHARE].sum((0, 1)) - grads["logits"]) / n
        for name, d in grads.items():
            first[name] = 0.9 * first[name] + 0.1 * d
            second[name] = 0.99 * second[name] + 0.01 * d * d
            w[name] -= rate * (1 - step / steps) * (first[name] / (1 - 0.9 ** (step + 1))) / (np.sqrt(second[name] / (1 - 0.99 ** (step + 1))) + 1e-6)
        table = model().tables
    return model()


def encoded(texts: list[str | None], tokenizer: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts one after another, each with the end id, and where each begins."""
    ids, begin = encoder(tokenizer).pack(next(tk.packs(pa.array(texts, pa.string()), 1 << 62))[2], end_id)
    return ids.astype(np.int64), begin[:-1]


def _words(p: tk.Packed) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the words of each text, without the end."""
    s, e = p.runs(tk.WORD)
    return p.rows(s), p.keys(s, e, tk.LOWER)


def tokenized(docs: DataFrame, learn: Column, tokenizer: str, end_id: int = 2) -> DataFrame:
    """doc_id, learn, text, ids (little-endian 16 or 32 bits, with the end id): every text is encoded once, for the counts and the scores."""
    kind = "<u2" if encoder(tokenizer).size <= 1 << 16 else "<u4"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, wide = encoder(tokenizer), np.dtype(kind).itemsize
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text"), 2 << 20):
                ids, begin = encode.pack(p, end_id)
                raw, at = ids.astype(kind).tobytes(), (begin * wide).tolist()
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array([raw[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=[*batch.schema.names, "ids"])
        tk.trim()

    rows = only(docs, "doc_id", "text").select("doc_id", learn.alias("learn"), "text")
    return rows.mapInArrow(apply, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, learn boolean, text string, ids binary")


def unpacked(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the rows one after another, and where each row begins."""
    kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind).astype(np.int64), np.cumsum([0, *(len(x) // kind.itemsize for x in parts[:-1])])


#: Buckets of ids, and how many places on the context's pairs are.
BUCKETS, APART = 64, (2, 4, 8, 16)
#: The ids that one row of sums covers.
SPAN = 128
#: Tasks whose sums one task adds up; two rounds of it cover a million tasks.
FAN = 1024


def _buckets(size: int) -> np.ndarray:
    return ((np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).astype(np.int64)


def _spans(some: np.ndarray, take, size: int) -> Iterator[pa.RecordBatch]:
    """Of a task's sums, those of the ids ``some`` (sorted), which ``take`` gives by id: a row for each span of ids."""
    bound = np.searchsorted(some, np.arange(0, size + SPAN, SPAN))
    task = TaskContext.get().partitionId() // FAN
    for k, (a, b) in enumerate(zip(bound[:-1], bound[1:], strict=True)):
        if b > a:
            yield pa.RecordBatch.from_pylist([{"part": k, "task": task, "ids": (some[a:b] - k * SPAN).astype("<i4").tobytes(), "sums": take(some[a:b]).tobytes()}], _SUMS)


_SUMS = pa.schema([("part", pa.int32()), ("task", pa.int32()), ("ids", pa.binary()), ("sums", pa.binary())])


def _added(found: DataFrame, width: int, kind: str, whole: str) -> DataFrame:
    """part, raw: the sums (of ``kind``) of all tasks, of ``whole`` kind; a row for each span of ids that has any."""

    def adder(kind: str):
        def add(group: pa.Table) -> pa.Table:
            total = np.zeros((SPAN, width), whole)
            for ids, sums in zip(group.column("ids").to_pylist(), group.column("sums").to_pylist(), strict=True):
                total[np.frombuffer(ids, "<i4")] += np.frombuffer(sums, kind).reshape(-1, width)
            return pa.table({"part": group.column("part").slice(0, 1), "task": group.column("task").slice(0, 1), "ids": [np.arange(SPAN, dtype="<i4").tobytes()], "sums": [total.tobytes()]}, _SUMS)

        return add

    schema = "part int, task int, ids binary, sums binary"
    rounds = found.groupBy("part", "task").applyInArrow(adder(kind), schema).groupBy("part").applyInArrow(adder(whole), schema)
    return rounds.select("part", F.col("sums").alias("raw"))


def _table(part: list[int], raw: list[bytes], size: int, width: int, kind: str) -> np.ndarray:
    out = np.zeros((-(-size // SPAN) * SPAN, width), np.float32)
    for k, x in zip(part, raw, strict=True):
        out[k * SPAN : (k + 1) * SPAN] = np.frombuffer(x, kind).reshape(SPAN, width)
    return out[:size]


def pair_counts(rows: DataFrame, size: int, end_id: int = 2, flush: int = 1 << 28) -> DataFrame:
    """part, raw: of each id of all training rows, how often ids of each bucket come next, come right before, and stand in one of the places ``APART`` after it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, one = _buckets(size), np.int32(1)
        held, n = np.zeros((3, size * BUCKETS + 1), np.int32), 0  # the last cell is for pairs across texts

        def out() -> Iterator[pa.RecordBatch]:
            by_id = held[:, :-1].reshape(3, size, BUCKETS)
            yield from _spans(np.flatnonzero(by_id.any((0, 2))), lambda ids: np.hstack(by_id[:, ids]), size)

        for part in tk.slices(batches, 500):
            ids, starts = unpacked(part.column("ids"), size)
            starts = starts[starts < len(ids)]
            before = np.append(end_id, ids[:-1])
            before[starts] = end_id
            code = bucket[ids]
            np.add.at(held[0], before * BUCKETS + code, one)
            np.add.at(held[1], ids * BUCKETS + bucket[before], one)
            for d in APART:
                at = ids[:-d] * BUCKETS + code[d:]
                cross = (starts[1:, None] - np.arange(1, d + 1)).ravel()
                at[cross[(cross >= 0) & (cross < len(at))]] = size * BUCKETS
                np.add.at(held[2], at, one)
            n += len(ids)
            if n > flush:  # cells have 32 bits
                yield from out()
                held[:], n = 0, 0
        tk.trim()
        if n:
            yield from out()

    return _added(rows.where("learn").select("ids").mapInArrow(count, "part int, task int, ids binary, sums binary"), 3 * BUCKETS, "<i4", "<i8")


def from_pairs(pairs: np.ndarray, id_counts: np.ndarray, rounds: int = 60, sharp: float = 4.0, prior: float = 1000.0) -> Model:
    """Weights from ``pair_counts``.

    By expectation-maximization the counts of next buckets are split into MIX parts by id, and those of the places on into the same parts: an id's
    shares of the first are its gate, the logs of its shares of the second its value, of as many dimensions as the state has. Counts of buckets before an
    id give its share of each mixture. An id that says what the last one says has the less weight in attention.
    """
    size, f = len(id_counts), np.float32
    near, before, far = (pairs[:, k * BUCKETS : (k + 1) * BUCKETS] for k in range(3))
    far = far / f(len(APART))
    rng = np.random.default_rng(0)
    gate, value = (rng.dirichlet(np.ones(MIX), size).astype(f) for _ in range(2))
    parts = (near.sum(0) + far.sum(0) + 1e-6) * (1 + 0.5 * rng.random((MIX, BUCKETS)))
    parts = (parts / parts.sum(1, keepdims=True)).astype(f)
    for _ in range(rounds):
        x = near / np.maximum(gate @ parts, 1e-12)
        y = far / np.maximum(value @ parts, 1e-12)
        new = parts * (gate.T @ x + value.T @ y)
        gate, value = gate * (x @ parts.T), value * (y @ parts.T)
        share = (value.sum(0) + 1e-6) / (value.sum() + MIX * 1e-6)
        gate += gate.sum(0) / max(1.0, gate.sum()) + 1e-6
        value += 20 / len(APART) * share
        gate, value = gate / gate.sum(1, keepdims=True), value / value.sum(1, keepdims=True)
        parts = (new + 1e-6) / (new + 1e-6).sum(1, keepdims=True)
    # The bucket before, by mixture; and each id's share of the mixtures.
    left = np.zeros((BUCKETS, MIX))
    np.add.at(left, _buckets(size), near.sum(1, keepdims=True) * gate)
    mass = (left.sum(0) + 1e-6) / (left + 1e-6).sum()
    left = ((left + 1e-6) / (left + 1e-6).sum(0)).astype(f)
    base = (id_counts + 0.5) / (id_counts + 0.5).sum()
    expected = (base[:, None] * mass).astype(f)
    for _ in range(20):
        expected *= (before / np.maximum(expected @ left.T, 1e-20)) @ left
        expected /= max(expected.sum(), f(1e-20))
    tables = (prior * base)[:, None] + expected * float(before.sum())
    logs = np.log(value / share)
    logs = np.clip(logs - logs.mean(1, keepdims=True), -5, 5)
    *_, axes = np.linalg.svd((logs * near.sum(1, keepdims=True)).T @ logs)
    state = logs @ axes[:WIDTH].T
    unit = state / np.maximum(np.linalg.norm(state, axis=1, keepdims=True), 1e-6)
    return Model(*(x.astype(f) for x in (-0.7 * unit, unit, state, np.log(gate), np.zeros(WINDOW), sharp * axes[:WIDTH], tables / tables.sum(0))))


def fit(rows: DataFrame, id_counts: np.ndarray, sample: int = 0, end_id: int = 2, stretch: int = 1024) -> Model:
    """The attention model, of all training rows: ``from_pairs`` and then ``learned_from_all``. ``id_counts`` cover all training rows.

    With a ``sample`` (for comparison; the query has none) the weights to start from are instead those that ``train`` finds on one stretch
    of at most ``stretch`` ids of each of so many rows.
    """
    size = len(id_counts)
    wide = 2 if size <= 1 << 16 else 4
    if sample:
        n = F.octet_length("ids") / wide
        mixed = F.xxhash64("doc_id", "ids", F.lit(11))
        begin = F.pmod(mixed, F.greatest(n - stretch, F.lit(0)).cast("long") + 1)
        chosen = rows.where("learn").select(mixed.alias("k"), F.substring("ids", (1 + wide * begin).cast("int"), F.lit(wide * stretch)).alias("ids")).orderBy("k", "ids").limit(sample).select(F.lit(0).alias("part"), F.col("ids").alias("raw"))
    else:
        chosen = pair_counts(rows, size, end_id)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for batch in batches for x in zip(batch.column("part").to_pylist(), batch.column("raw").to_pylist(), strict=True)]
        if not held:
            return
        part, raw = zip(*held, strict=True)
        if sample:
            flat, starts = unpacked(pa.array(sorted(raw), pa.binary()), size)
            m = train(np.split(flat, starts[1:]), id_counts, end_id)
        else:
            m = from_pairs(_table(part, raw, size, 3 * BUCKETS, "<i8"), id_counts)
        names = list(vars(m))
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([getattr(m, k).astype("<f4").tobytes() for k in names], pa.binary())], names=["name", "raw"])

    # One task has the counts, which the vocabulary bounds, and the driver only gets the weights.
    shapes = {"query": (size, WIDTH), "key": (size, WIDTH), "value": (size, WIDTH), "gate": (size, MIX), "offset": (WINDOW,), "out": (WIDTH, MIX), "tables": (size, MIX)}
    found = {r.name: np.frombuffer(r.raw, "<f4").reshape(shapes[r.name]).copy() for r in chosen.repartition(1).mapInArrow(first, "name string, raw binary").collect()}
    return learned_from_all(rows, Model(**found) if found else train([], id_counts, end_id), id_counts, end_id)


class Sums:
    """Sums by id over places of ``_gates``: the share of each mixture expected with the target, by the target; the same, and that without the target, by the id before."""

    def __init__(self, size: int):
        # Two sums are added at a time, as the parts of a complex number.
        self.expected, self.gates = np.zeros((size, MIX // 2), complex), np.zeros((size, MIX), complex)
        self.pairs = np.empty((MIX // 2, LANES * LONG), complex), np.empty((MIX, LANES * LONG), complex)

    def add(self, look: tuple[np.ndarray, ...], at: np.ndarray, to: np.ndarray, gate: np.ndarray) -> None:
        """``at`` and ``to``: ids and targets of a block."""
        some = to >= 0
        joint = np.take(look[2], to, axis=0)
        joint *= gate
        ones = np.ones(MIX, np.float32)
        joint = joint.T * (some / np.maximum(joint @ ones, 1e-30))
        own, both = self.pairs
        own.real, own.imag = joint[::2], joint[1::2]
        both.real, both.imag = joint, gate.T * (some / (gate @ ones))
        # Without a target, zeros are added somewhere.
        for total, ids, x in ((self.gates, at, both), (self.expected, to, own)):
            for t, y in zip(total.T, x, strict=True):
                np.add.at(t, ids, y)

    def ids(self) -> np.ndarray:
        """Those with a sum."""
        return np.flatnonzero(self.expected.any(1) | self.gates.any(1))

    def of(self, ids: np.ndarray) -> np.ndarray:
        """Rows of ``ids``: expected by target, by the id before, and without the target."""
        gates = self.gates[ids]
        return np.hstack([self.expected[ids].view(float), gates.real, gates.imag])


def learned_from_all(rows: DataFrame, start: Model, id_counts: np.ndarray, end_id: int = 2, prior: float = 1000.0, calm: float = 1.0) -> Model:
    """``start`` after a pass over every training row.

    Tasks sum, of all windows, the expected counts of each id in each mixture, and by the id before how much of each mixture was expected with
    and without the target, all under ``start``: the sums don't depend on how rows lie in tasks, nor on a task that runs twice. Then the
    gates are scaled by the ratio of the latter (a step of iterative scaling; ``calm`` occurrences without a change are added to an id's),
    and the mixtures become the expected counts, with ``prior`` times the unigram distribution added. The sums are as many as the vocabulary has ids, whatever the number of rows.
    """
    size, handle = len(id_counts), rows.sparkSession.sparkContext.broadcast(start)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = handle.value
        look, sums = tables_by_id(m), Sums(size)
        for part in tk.slices(batches, 500):
            places, target, _ = laid_out(*unpacked(part.column("ids"), size), end_id)
            for at, to, gate in _gates(m, look, places, target):
                sums.add(look, at, to, gate)
        tk.trim()
        yield from _spans(sums.ids(), lambda ids: sums.of(ids).astype("<f4"), size)

    found = _added(rows.where("learn").select("ids").mapInArrow(learn, "part int, task int, ids binary, sums binary"), 3 * MIX, "<f4", "<f4").collect()
    if not found:
        return start
    expected, after, ahead = np.split(_table([r.part for r in found], [r.raw for r in found], size, 3 * MIX, "<f4").astype(np.float64), 3, axis=1)
    share = calm * (after.sum(0) + 1e-6) / (after + 1e-6).sum()
    gate = start.gate + np.log((after + share) / (ahead + share))
    base = (id_counts + 0.5) / (id_counts + 0.5).sum()
    tables = (prior * base)[:, None] + expected
    return Model(start.query, start.key, start.value, np.clip(gate, -30, 30).astype(np.float32), start.offset, start.out, (tables / tables.sum(0)).astype(np.float32))


def token_counts(rows: DataFrame, size: int) -> DataFrame:
    """token, subword, c: counts over the training rows of ``tokenized`` of words (by hash, the end included) and of subword ids; summed in the tasks before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        words = ends = 0
        ids = np.zeros(size, np.int64)

        def flush():
            nonlocal held, words, ends, ids
            w, n = np.unique(np.concatenate([*held, np.zeros(0, tk.U)]), return_counts=True)
            some = np.flatnonzero(ids)
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate([w.view(np.int64), [END], some])), pa.array(np.arange(len(w) + 1 + len(some)) > len(w)), pa.array(np.concatenate([n, [ends], ids[some]]))], names=["token", "subword", "c"])
            held, words, ends, ids = [], 0, 0, np.zeros(size, np.int64)
            return out

        for batch in tk.slices(batches, 2000):
            for a, b, p in tk.packs(batch.column("text")):
                h = _words(p)[1]
                held.append(h)
                words += len(h)
                ends += p.n
                ids += np.bincount(unpacked(batch.column("ids").slice(a, b - a), size)[0], minlength=size)
                if words > 2_000_000:
                    yield flush()
        if ends:
            yield flush()

    return rows.where("learn").select("text", "ids").mapInArrow(count, "token long, subword boolean, c long").groupBy("subword", "token").agg(F.sum("c").alias("c"))


def score(docs: DataFrame, learn: Column, tokenizer: str, frequent: int = 500_000, end_id: int = 2) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; a row for each row of docs."""
    size = encoder(tokenizer).size
    texts = written(tokenized(docs, learn, tokenizer, end_id))
    both = written(token_counts(texts, size))
    id_counts = np.zeros(size, np.int64)
    for r in both.where("subword").collect():  # as many rows as the vocabulary has ids
        id_counts[r.token] = r.c
    model = fit(texts, id_counts, end_id=end_id)
    counts = both.where("not subword").select(F.col("token").alias("word"), "c")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.max(F.when(F.col("word") == END, F.col("c"))), F.lit(0)).alias("end")).head()
    end = total.end
    # The least threshold with at most ``frequent`` words above it, from the counts of counts by powers of two.
    level = {r.k: r.n for r in counts.groupBy(F.floor(F.log2("c")).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()}
    cut, above = 64, 0
    while cut > 0 and above + level.get(cut - 1, 0) <= frequent:
        cut -= 1
        above += level.get(cut, 0)
    top = counts.where(F.col("c") >= F.lit(2.0**cut).cast("long") if cut < 63 else F.lit(False)).toPandas()
    names = top["word"].to_numpy(np.int64)
    order = np.argsort(names)
    handle = docs.sparkSession.sparkContext.broadcast((names[order], top["c"].to_numpy(np.int64)[order], model))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, c, m = handle.value
        log, look = np.log10(c + 1.0), tables_by_id(m)
        for batch in tk.slices(batches, 500):
            tk.trim()
            for a, b, p in tk.packs(batch.column("text"), 1 << 19):
                part = batch.slice(a, b - a)
                row, h = _words(p)
                h = h.view(np.int64)
                kinds, code = np.unique(h, return_inverse=True)
                k = np.minimum(np.searchsorted(known, kinds), max(0, len(known) - 1))
                hit = known[k] == kinds if len(known) else np.zeros(len(kinds), bool)
                value = np.where(hit, log[k] if len(known) else 0.0, 0.0)
                n = tk.counts(row, p.n)
                base = np.bincount(row, value[code], p.n) if len(row) else np.zeros(p.n)
                n_known = tk.sums(hit[code], row, p.n) if len(row) else np.zeros(p.n, np.int64)
                rest = ~hit[code]
                ids, starts = unpacked(part.column("ids"), size)
                places, target, own = laid_out(ids, starts, end_id)
                text = np.repeat(np.arange(p.n), np.diff(np.append(starts, len(ids))))
                lp = place_log_probs(m, look, places, target)[own]
                # Words beyond the frequent ones, once a text, with how often they stand in it.
                own, times = np.unique(row[rest] * len(kinds) + code[rest], return_counts=True)
                cut = pa.array(np.searchsorted(own, np.arange(p.n + 1) * len(kinds)), pa.int32())
                rare = pa.StructArray.from_arrays([pa.array(kinds[own % max(1, len(kinds))]), pa.array(times)], names=["word", "times"])
                lists = pa.ListArray.from_arrays(cut, rare)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n + 1), pa.array(n_known + (end > 0)), pa.array(base + np.log10(end + 1.0)), pa.array(np.bincount(text, lp, p.n) / np.log(10)), lists], names=["doc_id", "n_tokens", "n_known", "known_log", "score", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.select("doc_id", "text", "ids").mapInArrow(apply, f"doc_id {kind}, n_tokens long, n_known long, known_log double, score double, rare array<struct<word: long, times: long>>")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    rare = rows.select("row", F.inline("rare")).join(counts.where(F.col("c") < F.lit(2.0**cut)), "word")
    rare = rare.groupBy("row").agg(F.sum("times").alias("m"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"))
    base = F.col("known_log") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(total.n + total.v + 1)))
    return rows.drop("rare").join(rare, "row", "left").select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("m", F.lit(0))).alias("n_known"), F.lit(total.n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")

"""Repeated passages from the common-prefix interval tree of a suffix array, built in many tasks.

Every string of ``size`` bytes is sampled by its least k-gram (by hash, leftmost of equals), so equal
strings have their anchors at the same place, in whatever document. Suffixes are therefore sorted
at anchors only. A task has all passages round the same anchor k-gram: it sorts their suffixes (what
follows the anchor), finds neighbours' common prefixes, and scans them with a stack into the tree of
common-prefix intervals. In each interval the left contexts are sorted and scanned alike: members
that extend to the left by enough to reach ``size`` with the interval's length are occurrences of one
repeat, which is maximal if what precedes and what follows differ among them. Intervals of any depth
are scanned, so all occurrences come out, not just neighbours'. What is removed is the union of the maximal repeats'
occurrences. A passage reaches as far as the windows of its anchor do; a longer repeat shows as overlapping pieces, which
``maximal_repeats`` joins where they have the same occurrences.

Exact copies of a text meet in one representative (their bytes all repeat). Anchors that occur in one place are
dropped before any text moves. An anchor with more than ``most`` places is split by content: its windows fall into
shorter runs, and what all windows of a run have in common becomes part of the key. Runs are split again while their keys
have too many places; a run of one window is its key. So a task never has more than ``most`` places of a key, where equal places
that follow one another in a text at the same distance (a periodic stretch) are one place with a number of times.

Null text is empty. Texts shorter than ``size`` lose nothing; very long ones are read whole. Rows repeated in the table are copies of
one another, whatever their ids; rows with a null id are texts like others. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import discard, in_bitmap, key_bitmap, only, spread_join, written, written_at

#: Bytes of an anchor; bits of a place in a pack; how many windows a run has at most, from one splitting of hot anchors to the next.
GRAM, PLACE, RUNS = 24, 32, (16, 4, 1)


def anchors(p: tk.Packed, size: int) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, first window, anchor, last window) of each run of windows that share an anchor; places are relative to the row."""
    k, n = min(GRAM, size), len(p.buf)
    length = np.diff(p.off) - 1
    go = length >= size
    if not go.any():
        return tuple(np.zeros(0, t) for t in (np.int64, tk.U, np.int64, np.int64, np.int64))
    at = np.arange(n - k + 1)
    g = p.rolling(at, at + k)
    bits = tk.U(PLACE)
    key = (g >> bits << bits) | at.astype(tk.U)
    w = size - k + 1
    pad = np.concatenate([key, np.full(-len(key) % w, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, w)
    before = np.minimum.accumulate(pad, 1).ravel()
    after = np.minimum.accumulate(pad[:, ::-1], 1)[:, ::-1].ravel()
    valid = np.zeros(n + 1, np.int8)
    np.add.at(valid, p.off[:-1][go], 1)
    np.add.at(valid, (p.off[:-1] + length - size + 1)[go], -1)
    start = np.flatnonzero(np.cumsum(valid[:-1]))
    spot = (np.minimum(after[start], before[start + w - 1]) & ((tk.U(1) << bits) - tk.U(1))).astype(np.int64)
    row = p.rows(start)
    new = np.flatnonzero((np.diff(spot, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    last = np.append(new[1:], len(start)) - 1
    row, base = row[new], p.off[row[new]]
    return row, g[spot[new]], start[new] - base, spot[new] - base, start[last] - base


def periodic(p: tk.Packed, size: int, row: np.ndarray, h: np.ndarray, first: np.ndarray, at: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the runs of ``anchors``: heads of stretches whose runs have the same bytes one after another, and how many runs each stretch has."""
    more = last - first
    like = (row[1:] == row[:-1]) & (h[1:] == h[:-1]) & (more[1:] == more[:-1]) & (first[1:] == last[:-1] + 1) & (np.diff(at) == np.diff(first))
    edge = np.flatnonzero(np.diff(like.astype(np.int8), prepend=0, append=0))
    same = np.zeros(len(row), bool)
    for a, b in zip(edge[0::2], edge[1::2], strict=True):
        d = more[a] + 1
        base = p.off[row[a]]
        low, high = base + first[a], base + last[b] + size
        bad = np.zeros(high - low - d + 1, np.int32)
        np.cumsum(p.buf[low : high - d] != p.buf[low + d : high], out=bad[1:])
        start = first[a:b] - first[a]
        same[a + 1 : b + 1] = bad[start + more[a] + size] == bad[start]
    head = np.flatnonzero(~same)
    return head, np.diff(head, append=len(row))


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) of the common-prefix intervals of length >= least; lcp[i] is that of sorted items i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, x in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > x:
            length, first = stack.pop()
            if length >= least:
                yield first, i, length
        if x >= 0 and (not stack or stack[-1][0] < x):
            stack.append((x, first))


def repeats(passages: list[tuple[bytes, bytes]], size: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of the maximal repeats of ``size`` bytes or more among distinct (reversed left context, right context) round one anchor."""
    order = sorted(range(len(passages)), key=lambda i: passages[i][1])
    lcp = [common(passages[a][1], passages[b][1]) for a, b in itertools.pairwise(order)]
    most = max(len(x) for x, _ in passages)
    for first, last, right in intervals(lcp, size - most):
        members = sorted(range(first, last + 1), key=lambda i: passages[order[i]][0])
        sides = [common(passages[order[a]][0], passages[order[b]][0]) for a, b in itertools.pairwise(members)]
        for a, b, left in intervals(sides, size - right):
            ranks = sorted(members[a : b + 1])
            # Left extensions differ beyond the interval; right ones must differ within it, or a deeper interval has these members.
            if min(lcp[ranks[0] : ranks[-1]]) == right:
                yield left, right, [order[i] for i in ranks]


def scan(passages: list[tuple[bytes, bytes]], size: int) -> list[tuple[int, int]]:
    """For each passage the bytes to the left and right of the anchor that its maximal repeats cover; (0, 0) where it has none."""
    left, right = [0] * len(passages), [0] * len(passages)
    for a, b, members in repeats(passages, size):
        for j in members:
            left[j], right[j] = max(left[j], a), max(right[j], b)
    return list(zip(left, right, strict=True))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[tuple[int, bytes], list[tuple[int, int, int, int]]]]:
    """Of each key of a sorted partition with two places or more: places (text, first, times, step) by passage (bytes before the anchor, passage)."""
    now, same, n = None, {}, 0
    for batch in tk.slices(batches):
        for *key, cut, seg, texts, firsts, times, steps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now:
                if n > 1:
                    yield same
                now, same, n = key, {}, 0
            same.setdefault((cut, seg), []).extend(zip(texts, firsts, times, steps, strict=True))
            n += sum(times)
    if n > 1:
        yield same


def _covered(size: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []

        def flush():
            nonlocal out
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            out = []
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())], names=["text", "start", "stop"])

        for same in _groups(batches):
            kinds = list(same)
            spans = scan([(seg[:cut][::-1], seg[cut:]) for cut, seg in kinds], size) if len(kinds) > 1 else [(0, 0)]
            for (cut, seg), (a, b) in zip(kinds, spans, strict=True):
                places = same[cut, seg]
                if len(places) > 1 or places[0][2] > 1:  # equal passages: the whole of them is a repeat
                    a, b = cut, len(seg) - cut
                if a + b:  # the step is less than a passage, so what a stretch covers has no gaps
                    out.extend((text, first + cut - a, first + cut + b + (times - 1) * step) for text, first, times, step in places)
            if len(out) > 20_000:
                yield flush()
        yield flush()
        tk.trim()

    return apply


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, sha (of the text), n_bytes, body (compressed)."""
    pack = zstandard.ZstdCompressor(level=5)
    for batch in tk.slices(batches):
        texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary()), pa.array([len(x) for x in texts], pa.int64()), pa.array([pack.compress(x) for x in texts], pa.binary())], names=["doc_id", "sha", "n_bytes", "body"])


def _maybe(rows: DataFrame, keys: DataFrame, *on: str, among: bool = True) -> DataFrame:
    """The rows whose key may be among those of ``keys``, or, if not ``among``, those whose key surely isn't: what is left for a join is less."""
    mixed = F.xxhash64(*on).alias("mixed")
    bitmap = key_bitmap(keys.select(mixed), "mixed")
    if bitmap is None:
        return rows if among else rows.where(F.lit(False))
    handle = rows.sparkSession.sparkContext.broadcast(bitmap)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(in_bitmap(handle.value, batch.column("mixed").to_numpy()) == among))
            yield part.select(part.schema.names[:-1])

    return rows.select("*", mixed).mapInArrow(apply, rows.schema)


def _bodies(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(x) for x in column.to_pylist()]


SPOTS = "anchor long, tag long, row long, first int, cut smallint, more smallint, times int, step smallint"
SPOT = ("anchor", "tag", "first", "cut", "more", "times", "step")


def _spots_batch(columns: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int32(), pa.int16())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "tag", "row", "first", "cut", "more", "times", "step"])


class Corpus:
    """The texts in the shared folder, each row with a number, and the places of their repeated anchors.

    A spot is a run of windows with the same key (anchor, tag) in a text: ``first`` window, anchor ``cut`` bytes after
    it, ``more`` windows after the first. The same spot may follow ``times`` times in all, each ``step`` bytes on (0 if alone):
    periodic texts (a word, line or byte over and over) are one row, however long. No two spots of a key are the same, so it repeats
    if it has two, or one several times.
    """

    def __init__(self, docs: DataFrame, size: int, most: int):
        self.size, self.most = size, most
        kind = docs.schema["doc_id"].dataType.simpleString()
        rows = only(docs, "doc_id", "text").mapInArrow(_stored, f"doc_id {kind}, sha binary, n_bytes long, body binary")
        self.texts = written(rows.select(F.monotonically_increasing_id().alias("row"), "*"))
        self.total = self.texts.count()
        same = self.texts.groupBy("sha").agg(F.min("row").alias("row"), F.count("*").alias("n"), F.min("n_bytes").alias("n_bytes"))
        self.copies = written(same)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in tk.slices(batches):
                text = pa.array(_bodies(batch.column("body")), pa.large_binary()).view(pa.large_string())
                number = batch.column("row").to_numpy()
                for a, _, p in tk.packs(text, 1 << 19):
                    found = anchors(p, size)
                    head, times = periodic(p, size, *found)
                    row, h, first, at, last = (x[head] for x in found)
                    yield _spots_batch([h.view(np.int64), np.zeros(len(h), np.int64), number[a:][row], first, at - first, last - first, times, np.where(times > 1, last - first + 1, 0)])
                    del p
            tk.trim()

        # Copies of a text are no new places: one row of each takes part.
        texts = self.texts.where(F.col("n_bytes") >= size).select("row", "body")
        more = written(self.texts.select("row").join(self.copies.select("row"), "row", "left_anti"))
        doubtful = written(_maybe(self.texts.select("row"), more, "row").join(more, "row", "left_anti"))
        spots = _maybe(texts, more, "row", among=False).mapInArrow(place, SPOTS)
        if not doubtful.isEmpty():
            spots = spots.union(_maybe(texts, doubtful, "row").join(doubtful, "row").mapInArrow(place, SPOTS))
        #: For each splitting: row, spots. Windows that stand alone for a key with many places: piece, row, start.
        self.found: list[DataFrame] = []
        self.single: DataFrame | None = None
        for width in (None, *RUNS):
            spots, at = written_at(spots if width is None else spots.mapInArrow(self._split(width), SPOTS))
            n = spots.count()
            keys = written(spots.groupBy("anchor", "tag").agg(F.count("*").alias("n"), F.sum("times").alias("times")).where("times > 1").select("anchor", "tag", "n"))
            few, many = keys.where(F.col("n") <= most).drop("n"), keys.where(F.col("n") > most)
            some = not many.isEmpty()
            limit = max(most, n // 100_000)  # at most 100,000 keys have more: these are broadcast, their rows stay where they are
            largest = F.broadcast(many.where(F.col("n") > limit).drop("n"))
            cold = spots.join(largest, ["anchor", "tag"], "left_anti") if some else spots
            self.found.append(written(_maybe(cold, few, "anchor", "tag").join(few, ["anchor", "tag"]).groupBy("row").agg(F.collect_set(F.struct(*SPOT)).alias("spots"))))
            if not some:
                discard(spots, at)
                break
            left = spots.join(largest, ["anchor", "tag"])
            if limit > most:
                left = left.union(cold.join(many.where(F.col("n") <= limit).drop("n"), ["anchor", "tag"]).select(*left.columns))
            if width == 1:  # one window a run: its key says that it repeats
                self.single = written(left.select(F.xxhash64("anchor", "tag").alias("piece"), "row", F.col("first").cast("long").alias("start"), "times", "step"))
                break
            spots = self._with_bodies(written(left.groupBy("row").agg(F.collect_set(F.struct(*SPOT)).alias("spots"))))

    def _with_bodies(self, spots: DataFrame) -> DataFrame:
        """row, body, spots: other texts don't move."""
        return _maybe(self.texts.select("row", "body"), spots, "row").join(spots, "row").select("row", "body", "spots")

    def _split(self, width: int):
        """Runs of at most ``width`` windows, aligned at the anchor; the key gains what all windows of a run have in common."""
        size = self.size

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in tk.slices(batches):
                out = []
                for row, body, spots in zip(batch.column("row").to_pylist(), _bodies(batch.column("body")), batch.column("spots").to_pylist(), strict=True):
                    for s in spots:
                        high, low = s["cut"], s["cut"] - s["more"]  # bytes before the anchor in the first and in the last window
                        for k in range(low // width, high // width + 1):
                            a, b = max(low, k * width), min(high, k * width + width - 1)
                            # The core of the aligned run, cut short by the spot's own ends only where the text's windows end.
                            at = s["first"] + s["cut"]
                            core = body[at - k * width : at - (k * width + width - 1) + size]
                            name = hashlib.blake2b(core, digest_size=16, key=k.to_bytes(4, "big", signed=True)).digest()
                            out.append((int.from_bytes(name[:8], "big", signed=True), int.from_bytes(name[8:], "big", signed=True), row, at - b, b, b - a, s["times"], s["step"]))
                yield _spots_batch(list(zip(*out, strict=True)) or [()] * 8)

        return apply

    def passages(self) -> DataFrame:
        """anchor, tag, cut, passage, texts, firsts, times, steps: dealt out and sorted by key; a task sends a passage once, with all its places."""
        size = self.size

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in tk.slices(batches):
                same: dict[tuple[int, int, int, bytes], list[tuple[int, int, int, int]]] = {}
                for row, body, spots in zip(batch.column("row").to_pylist(), _bodies(batch.column("body")), batch.column("spots").to_pylist(), strict=True):
                    for s in spots:
                        same.setdefault((s["anchor"], s["tag"], s["cut"], body[s["first"] : s["first"] + s["more"] + size]), []).append((row, s["first"], s["times"], s["step"]))
                anchor, tag, at, seg = zip(*same, strict=True) if same else ((), (), (), ())
                lists = [pa.array([[place[k] for place in x] for x in same.values()], pa.list_(kind)) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int16()))]
                yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(tag, pa.int64()), pa.array(at, pa.int16()), pa.array(seg, pa.binary()), *lists], names=["anchor", "tag", "cut", "passage", "texts", "firsts", "times", "steps"])
            tk.trim()

        parts = [self._with_bodies(x).mapInArrow(cut, "anchor long, tag long, cut smallint, passage binary, texts array<long>, firsts array<int>, times array<int>, steps array<smallint>") for x in self.found]
        rows = parts[0]
        for x in parts[1:]:
            rows = rows.union(x)
        return rows.repartition("anchor", "tag").sortWithinPartitions("anchor", "tag")

    def covered(self) -> DataFrame:
        """text (its row), start, stop: bytes of texts that lie in a string of ``size`` that also starts elsewhere."""
        out = self.passages().mapInArrow(_covered(self.size), "text long, start int, stop int")
        if self.single is None:
            return out
        return out.union(self.single.select("row", F.col("start").cast("int").alias("start"), (F.col("start") + (F.col("times") - 1) * F.col("step") + self.size).cast("int").alias("stop")))


def remove_repeats(docs: DataFrame, size: int = 200, most: int = 50_000, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_text also kept (the remaining bytes); a row for each row of docs."""
    c = Corpus(docs, size, most)
    spans = c.covered().groupBy("text").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).withColumnRenamed("text", "row")
    # Of a text with copies all bytes repeat, if it is long enough: only single texts need their spans.
    state = written(c.copies.where("n = 1").select("row").join(spans, "row"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.slices(batches):
            removed, runs, sha, kept = [], [], [], []
            for body, spans in zip(_bodies(batch.column("body")), batch.column("spans").to_pylist(), strict=True):
                parts, at, n = [], 0, 0
                for a, b in sorted((s["start"], s["stop"]) for s in spans):
                    if a > at or not n:
                        n += 1
                        parts.append(body[at:a])
                    at = max(at, b)
                parts.append(body[at:])
                rest = b"".join(parts)
                removed.append(len(body) - len(rest))
                runs.append(n)
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_text else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array([b"" if gone else x for gone, x in zip(batch.column("gone").to_pylist(), _bodies(batch.column("body")), strict=True)], pa.binary())], names=[*batch.schema.names[:-2], "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    # Only texts that lose a part need their bytes again.
    changed = _maybe(c.texts.select("row", "doc_id", "n_bytes", "body"), state, "row").join(state, "row").select("doc_id", "n_bytes", "body", "spans").mapInArrow(cut, schema)
    rows = c.texts.select("row", "doc_id", "sha", "n_bytes", *(["body"] if with_text else []))
    copied = spread_join(rows, c.copies.where("n > 1").select("sha", "n"), ["sha"], c.total).withColumn("gone", F.col("n_bytes") >= size)
    alone = c.copies.where("n = 1").select("row").join(state.select("row"), "row", "left_anti")
    others = rows.join(alone, "row").withColumn("gone", F.lit(False))
    zero = lambda x: F.when(F.col("gone"), x).otherwise(F.lit(0)).cast("long")
    left = F.when(F.col("gone"), F.sha2(F.lit(""), 256)).otherwise(F.lower(F.hex("sha")))
    columns = ["doc_id", "n_bytes", zero(F.col("n_bytes")).alias("n_removed"), zero(F.lit(1)).alias("n_spans"), left.alias("kept_sha256")]
    if with_text:
        both = copied.select(*columns, "gone", "body").union(others.select(*columns, "gone", "body")).mapInArrow(whole, schema)
        return changed.union(both)
    return changed.drop("kept").union(copied.select(*columns)).union(others.select(*columns))


def maximal_repeats(docs: DataFrame, size: int = 200, most: int = 50_000) -> DataFrame:
    """repeat_id (of the string), n_bytes, doc_id, start: all occurrences, in all copies too, of the maximal repeats of ``size`` bytes or more.

    Pieces that follow one another in all their occurrences, at the same distance, are joined into the whole repeat. A text that
    has copies is itself a repeat, if it is long enough.
    """
    c = Corpus(docs, size, most)

    def each(places: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int]]:
        return ((text, first + k * step) for text, first, times, step in places for k in range(times))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same in _groups(batches):
            kinds = list(same)
            out: set[tuple[int, int, int, int]] = set()

            def found(a: int, b: int, members: list[int]) -> None:
                places = sorted((text, first + kinds[m][0] - a) for m in members for text, first in each(same[kinds[m]]))  # noqa: B023
                name = int.from_bytes(hashlib.blake2b(repr((a + b, places)).encode(), digest_size=8).digest(), "big", signed=True)
                out.update((name, a + b, text, at) for text, at in places)  # noqa: B023

            if len(kinds) > 1:
                for group in repeats([(seg[:cut][::-1], seg[cut:]) for cut, seg in kinds], size):
                    found(*group)
            for k, (cut, seg) in enumerate(kinds):
                if len(same[cut, seg]) > 1 or same[cut, seg][0][2] > 1:
                    found(cut, len(seg) - cut, [k])
            cols = list(zip(*sorted(out), strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["piece", "n_bytes", "row", "start"])

    pieces = c.passages().mapInArrow(apply, "piece long, n_bytes long, row long, start long")
    if c.single is not None:
        start = F.explode(F.sequence("start", F.col("start") + (F.col("times") - 1) * F.col("step"), F.col("step").cast("long")))
        pieces = pieces.union(c.single.select("piece", F.lit(size).cast("long"), "row", start))
    pieces = written(pieces)
    # Pieces with the same places, but for a shift, follow one another in all of them.
    total = pieces.count()
    least = written(pieces.groupBy("piece", "n_bytes").agg(F.min(F.struct("row", "start")).alias("at"), F.count("*").alias("n")))
    shift = F.col("start") - F.col("at.start")
    shape = spread_join(pieces.drop("n_bytes"), least, ["piece"], total).groupBy("piece", "n_bytes", "at", "n").agg(*(F.bit_xor(F.xxhash64("row", shift, F.lit(k))).alias(f"h{k}") for k in (1, 2)))
    shape = shape.select("piece", "n_bytes", "n", "h1", "h2", F.col("at.start").alias("low"), (F.col("at.start") + F.col("n_bytes")).alias("high"))
    run = Window.partitionBy("n", "h1", "h2").orderBy("low", "high", "piece")
    reach = F.max("high").over(run.rowsBetween(Window.unboundedPreceding, -1))
    shape = shape.withColumn("new", F.when(reach >= F.col("low"), 0).otherwise(1)).withColumn("part", F.sum("new").over(run))
    whole = written(shape.groupBy("n", "h1", "h2", "part").agg(F.min_by("piece", F.struct("low", "piece")).alias("piece"), (F.max("high") - F.min("low")).alias("n_bytes")))
    rows = spread_join(pieces.select("piece", "row", "start"), whole.select("piece", "n", "n_bytes"), ["piece"], total)
    # Back to every copy of the texts; copies themselves are repeats.
    rep = rows.join(c.copies.select("row", "sha", F.col("n").alias("copies")), "row").select(F.col("piece").alias("repeat_id"), "n_bytes", "sha", "start")
    own = c.copies.where((F.col("n") > 1) & (F.col("n_bytes") >= size)).select(F.xxhash64("sha").alias("repeat_id"), "n_bytes", "sha", F.lit(0).cast("long").alias("start"))
    texts = c.texts.select("sha", "doc_id")
    found = rep.join(texts, "sha").select("repeat_id", "n_bytes", "doc_id", "start")
    return found.union(spread_join(texts, own.join(c.copies.select("sha", "n"), "sha"), ["sha"], c.total).select("repeat_id", "n_bytes", "doc_id", "start"))

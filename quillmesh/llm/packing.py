"""Best-fit packing by bin completion with branch and bound, over the histogram of piece lengths.

Lengths lie between 1 and the sequence size, so the packing problem of any number of documents is a
histogram of at most ``size`` counts: all that the driver sees. Best-fit decreasing gives the first
incumbent, the volume and the count of long pieces a lower bound; where they meet, the packing is proved best.
Otherwise bin completion takes the longest length left, enumerates the undominated fillings of the rest of
its sequence, least waste first, and branches over them and over how many sequences get each. Waste
beyond what a packing with one sequence less could have prunes fillings and nodes alike. Every better packing
becomes the incumbent. Bin packing is NP-hard: the search ends after ``steps`` (a bound of work, stated in
``plan``), and the incumbent, which holds every piece, stands then.

Tasks give each piece its place: its rank among the pieces of its length falls into one slot of the
plan. Ranks are counted within each input partition; a window over the partitions' counts gives where each partition
begins, so no length is one task's work and no number of tasks is fixed.

Null text is empty: one end id. Repeated rows are packed as rows of their own; rows with a null id keep
it. Very long texts are cut into pieces. Equal lengths are placed in the order of input partition and row. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import only, written


def byte_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks of a byte-level BPE file of the tokenizers library, and its added tokens. Ids of merged tokens are in the order of the merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
    return {bytes(char[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}, added


#: First bytes of characters that are surely no white space in any library's eyes; a space before another character parts nothing.
SURE = np.zeros(256, bool)
SURE[[*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True


#: Letters of ASCII, and second bytes of letters after 0xC3.
LETTER, SECOND = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
SECOND[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True


def letters(buf: np.ndarray) -> np.ndarray:
    """The bytes of letters of ASCII and Latin-1."""
    out = LETTER[buf]
    two = np.flatnonzero((buf[:-1] == 0xC3) & SECOND[buf[1:]])
    out[two] = out[two + 1] = True
    return out


#: Parts that a worker keeps the ids of, at most 8 ids each on average: no more are added beyond.
KNOWN = 300_000


class Encoder:
    """Ids of whole texts by a byte-level BPE.

    A text falls apart before every space that a non-space follows, and no token spans such a place; the ids of
    a part depend on it alone. So the distinct parts of a pack of texts are encoded once, not at all where an earlier pack had them, and each text's ids are gathered from
    theirs. Parts that begin with such a space are encoded as one text, those of a space and letters alone with a simpler
    pattern, which takes each whole as the full one would; the lengths of the tokens tell whose they are. The other parts have a special token between them.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken

        ranks, self.added = byte_ranks(path)
        self.size = max([*ranks.values(), *self.added.values()], default=-1) + 1
        self.core = tiktoken.Encoding("byte_bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        self.plain = tiktoken.Encoding("byte_bpe_words", pat_str=" [^ ]+", mergeable_ranks=ranks, special_tokens={})
        self.bytes = np.zeros(self.size, np.int64)
        self.bytes[[*ranks.values()]] = [len(x) for x in ranks]
        #: Parts met so far, by hash, and where their ids stand in ``ids``; the first stands for none.
        self.known, self.at, self.size_of, self.ids = np.zeros(1, tk.U), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)
        #: What parts are joined by; texts that hold it are encoded whole and alone.
        self.mark, self.mark_id = next(iter(self.added.items()))

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.core.encode_to_numpy(text, allowed_special="all"), np.uint32)

    def many(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts without the mark, one after another, and where each part's begin (one more than parts)."""
        ids = self(self.mark.encode().join(parts).decode("utf-8", "replace"))
        cut = np.flatnonzero(ids == self.mark_id)
        return np.delete(ids, cut), np.concatenate([[0], cut - np.arange(len(cut)), [len(ids) - len(cut)]])

    def spaced(self, parts: list[bytes], length: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
        """As ``many``, of parts that each begin with a space before a character that is surely none; ``words``: nothing but letters follows in any."""
        raw = b"".join(parts)
        ids = (self.plain if words else self.core).encode_to_numpy(raw.decode("utf-8", "replace"), allowed_special=set(), disallowed_special=()).astype(np.uint32)
        done = np.cumsum(self.bytes[ids])
        if len(raw) != (done[-1] if len(done) else 0):  # bytes that are no UTF-8 were replaced
            return self.many(parts)
        return ids, np.concatenate([[0], np.searchsorted(done, np.cumsum(length)) + 1])

    def fresh(self, p: tk.Packed, raw: bytes, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of parts of a pack: ids, where each part's begin, and how many they are."""
        offset, size, held, total = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64), [np.zeros(0, np.uint32)], 0
        other = np.cumsum(~letters(p.buf), dtype=np.int32)
        # 0: parts that don't begin with a space that parts, 1: other ones, 2: a space and letters.
        kind = ((p.buf[low] == 32) & SURE[p.buf[low + 1]]) * (1 + (other[high - 1] == other[low]))
        for k in range(3):
            if len(mine := np.flatnonzero(kind == k)):
                parts = [raw[x:y] for x, y in zip(low[mine].tolist(), high[mine].tolist(), strict=True)]
                ids, at = self.spaced(parts, high[mine] - low[mine], k == 2) if k else self.many(parts)
                offset[mine], size[mine] = at[:-1] + total, np.diff(at)
                held.append(ids)
                total += len(ids)
        return np.concatenate(held), offset, size

    def pack(self, p: tk.Packed, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a pack, each with the end id, one after another, and where each begins (one more than texts)."""
        first, last = p.off[:-1], p.off[1:] - 1
        start = np.zeros(len(p.buf), bool)
        start[:-1] = (p.buf[:-1] == 32) & SURE[p.buf[1:]]
        raw, mark = p.buf.tobytes(), self.mark.encode()
        odd = np.flatnonzero([mark in raw[a:b] for a, b in zip(first, last, strict=True)] if mark in raw else [])
        for i in odd:
            start[first[i] : last[i]] = False
        start[first] = start[last] = True
        begin = np.flatnonzero(start)
        stop = np.append(begin[1:], len(p.buf))
        # The line feed that ends a text in the pack stands for the end id.
        close = np.searchsorted(begin, last)
        key = p.keys(begin, stop)
        key[close] = 0
        kinds, one, code = np.unique(key, return_index=True, return_inverse=True)
        whole = np.zeros(len(begin), bool)
        whole[np.searchsorted(begin, first[odd])] = True
        plain = (kinds != 0) & ~whole[one]
        # Parts that a pack before had are known.
        k = np.minimum(np.searchsorted(self.known, kinds), len(self.known) - 1)
        met = plain & (self.known[k] == kinds)
        offset, size = np.where(met, self.at[k], 0), np.where(met, self.size_of[k], 0)
        total = len(self.ids)
        new = np.flatnonzero(plain & ~met)
        ids, at, n = self.fresh(p, raw, begin[one[new]], stop[one[new]])
        offset[new], size[new] = at + total, n
        held = [self.ids, ids, np.array([end_id], np.uint32)]
        total += len(ids)
        ended = np.flatnonzero(kinds == 0)
        offset[ended], size[ended] = total, 1
        total += 1
        for k in np.flatnonzero(whole[one]):
            own = self(raw[begin[one[k]] : stop[one[k]]].decode("utf-8", "replace"))
            offset[k], size[k] = total, len(own)
            held.append(own)
            total += len(own)
        if len(self.known) < KNOWN and total < 8 * KNOWN:
            where = np.searchsorted(self.known, kinds[new])
            self.known, self.at, self.size_of = (np.insert(x, where, y) for x, y in ((self.known, kinds[new]), (self.at, offset[new]), (self.size_of, n)))
            self.ids = np.concatenate(held[:2])
        n = size[code]
        done = np.cumsum(n)
        where = np.repeat(offset[code] - done + n, n) + np.arange(done[-1] if len(done) else 0)
        return np.concatenate(held)[where], np.concatenate([[0], done[close]])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the token ids of each text and the end id, cut where longer than a sequence; the first piece is the short one.

    part, nth: the input partition, and how many pieces of the same length came before in it.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text"), 2 << 20):
                ids, begin = encode.pack(p, end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                at, piece, start, length, crc, nth = [], [], [], [], [], []
                for i, (low, high) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
                    cuts = [0, *range((high - low) % size or size, high - low + 1, size)]
                    for k in range(len(cuts) - 1):
                        at.append(i)
                        piece.append(k)
                        start.append(cuts[k])
                        length.append(wide := cuts[k + 1] - cuts[k])
                        nth.append(seen[wide])
                        seen[wide] += 1
                        crc.append(zlib.crc32(raw[4 * (low + cuts[k]) : 4 * (low + cuts[k + 1])]))
                numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, [part] * len(at), nth)]
                yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *numbers], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
        tk.trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(apply, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part long, nth long")


Filling = tuple[tuple[int, int], ...]


def best_fit(count: np.ndarray, size: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over a histogram: (filling, number of sequences that have it)."""
    open_: dict[int, dict[Filling, int]] = {}  # room: fillings with that room
    rooms: list[int] = []

    def put(room: int, filling: Filling, n: int) -> None:
        if room not in open_:
            open_[room] = {}
            bisect.insort(rooms, room)
        open_[room][filling] = open_[room].get(filling, 0) + n

    for x in range(size, 0, -1):
        left = int(count[x])
        while left:
            k = bisect.bisect_left(rooms, x)
            if k == len(rooms):
                each = size // x
                full, rest = divmod(left, each)
                if full:
                    put(size - each * x, ((x, each),), full)
                if rest:
                    put(size - rest * x, ((x, rest),), 1)
                break
            room = rooms[k]
            filling, n = open_[room].popitem()
            if not open_[room]:
                del open_[room], rooms[k]
            # The tightest sequence takes as many as it can before the next one is touched.
            each = room // x
            full = min(n, left // each)
            if full:
                put(room - each * x, (*filling, (x, each)), full)
                left -= full * each
                n -= full
            elif left:
                put(room - left * x, (*filling, (x, left)), 1)
                left, n = 0, n - 1
            if n:
                put(room, filling, n)
    return [(f, n) for group in open_.values() for f, n in group.items()]


def lower_bound(count: np.ndarray, size: int) -> int:
    """Sequences that any packing needs: by volume, and by pieces too long to share one, for every least length that counts (Martello and Toth)."""
    length = np.arange(size + 1)
    n, mass = np.cumsum(count), np.cumsum(count * length)
    best = -(-int(mass[-1]) // size)
    for a in range(size // 2 + 1):
        alone = int(n[size] - n[size - a])  # longer than size - a
        half = int(n[size - a] - n[size // 2])
        room = half * size - int(mass[size - a] - mass[size // 2])
        small = int(mass[size // 2] - (mass[a - 1] if a else 0))
        best = max(best, alone + half + max(0, -(-(small - room) // size)))
    return best


@dataclass
class Search:
    """What is left of the work that the search may do."""

    steps: int


def fillings(first: int, count: np.ndarray, size: int, slack: int, search: Search) -> Iterator[tuple[int, Filling]]:
    """(waste, filling) of the undominated fillings around a piece of length ``first`` that waste at most ``slack``.

    ``count``: pieces left by length, without that piece. Lengths are tried in falling order, as many pieces of
    each as fit, then fewer; a branch is left when all that follows could not bring the waste under ``slack``.
    A filling is dominated, and dropped, if a piece left fits in its waste, or a longer one fits in place of one or
    two of its pieces.
    """
    room = size - first
    left = [int(x) for x in np.flatnonzero(count[: room + 1])[::-1] if x]
    have = [int(count[x]) for x in left]
    down = [-x for x in left]
    mass = [*np.cumsum([x * n for x, n in zip(left[::-1], have[::-1], strict=True)])[::-1].tolist(), 0]
    chosen: list[list[int]] = []  # (place in ``left``, pieces)
    at = 0

    def dominated() -> bool:
        used = {left[k]: n for k, n in chosen}
        spare = lambda low, high: any(have[k] > used.get(left[k], 0) for k in range(bisect.bisect_left(down, -high), bisect.bisect_right(down, -low)))
        if room and spare(1, room):
            return True
        kinds = list(used)
        if any(spare(x + 1, x + room) for x in kinds if room):
            return True
        pairs = [(x, y) for i, x in enumerate(kinds) for y in kinds[i:] if x != y or used[x] > 1]
        return any(spare(x + y, x + y + room) for x, y in pairs)

    while True:
        at = max(at, bisect.bisect_left(down, -room))
        while room and at < len(left) and mass[at] >= room - slack:
            n = min(have[at], room // left[at])
            chosen.append([at, n])
            room -= n * left[at]
            search.steps -= 1
            at = max(at + 1, bisect.bisect_left(down, -room))
        if room <= slack and not dominated():
            yield room, ((first, 1), *((left[k], n) for k, n in chosen))
        search.steps -= 1
        if search.steps <= 0:
            return
        while chosen:
            last = chosen[-1]
            room += left[last[0]]
            last[1] -= 1
            at = last[0] + 1
            if not last[1]:
                chosen.pop()
            if mass[at] >= room - slack:
                break
        else:
            return


def _options(count: np.ndarray, size: int, slack: int, search: Search, some: int = 64) -> Iterator[tuple[int, Filling, int]]:
    """(waste, filling, sequences) to branch on: fillings in parts of ``some``, each part by least waste; many sequences at once before few."""
    first = int(np.flatnonzero(count)[-1])
    count = count.copy()
    count[first] -= 1
    source = fillings(first, count, size, slack, search)
    count_all = count.copy()
    count_all[first] += 1
    while True:
        part: list[tuple[int, Filling]] = []
        for x in source:
            part.append(x)
            if not x[0] or len(part) == some:
                break
        if not part:
            return
        for waste, filling in sorted(part, key=lambda f: f[0]):
            need: dict[int, int] = {}
            for x, n in filling:
                need[x] = need.get(x, 0) + n
            joined = tuple(need.items())
            times = min(int(count_all[x]) // n for x, n in joined)
            while times:
                if waste * times <= slack:
                    yield waste, joined, times
                times //= 2


def completed(count: np.ndarray, size: int, steps: int) -> list[tuple[Filling, int]]:
    """The best packing found: (filling, sequences)."""
    best = best_fit(count, size)
    used, bound, total = sum(n for _, n in best), lower_bound(count, size), int((count * np.arange(size + 1)).sum())
    if used == bound:
        return best
    search = Search(steps)
    slack = (used - 1) * size - total  # the waste of a packing with one sequence less
    count, path = count.copy(), []
    levels = [_options(count, size, slack, search)]
    while levels and search.steps > 0:
        option = next(levels[-1], None)
        search.steps -= 10  # a node costs about as much
        if option is None:
            levels.pop()
            if path:
                waste, filling, times = path.pop()
                slack += waste * times
                for x, n in filling:
                    count[x] += n * times
            continue
        waste, filling, times = option
        if waste * times > slack:  # the incumbent has become better since
            continue
        path.append(option)
        slack -= waste * times
        for x, n in filling:
            count[x] -= n * times
        if count.any():
            levels.append(_options(count, size, slack, search))
            continue
        best = [(f, n) for _, f, n in path]
        fewer = sum(n for _, n in best)
        slack -= size * (used - fewer)
        used = fewer
        if used == bound:
            break
        levels.append(iter(()))
    return best


def plan(histogram: dict[int, int], size: int = 1024, steps: int = 300_000) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, ranks, first sequence, offset): rank r of a length lies in sequence first + r - first rank, at offset.

    ``steps`` bounds the search beyond best-fit decreasing: pieces placed while fillings are enumerated.
    """
    count = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    taken = np.zeros(size + 1, np.int64)
    slots, sequence = [], 0
    for filling, times in completed(count, size, steps):
        offset = 0
        for x, n in filling:
            for _ in range(n):
                slots.append((x, int(taken[x]), times, sequence, offset))
                taken[x] += times
                offset += x
        sequence += times
    return slots


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, steps: int = 300_000) -> DataFrame:
    """The pieces with sequence_id and offset (gapless from 0 in each sequence of at most ``size`` ids)."""
    cut = written(pieces(docs, tokenizer, size, end_id))
    tally = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    slots = np.array(sorted(plan(histogram, size, steps)), np.int64).reshape(-1, 5)
    handle = docs.sparkSession.sparkContext.broadcast(slots)  # bounded by the lengths' ways to share a sequence, not by the pieces
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = tally.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = handle.value
        wide = int(slots[:, 1:3].sum(1).max()) + 1 if len(slots) else 1
        key = slots[:, 0] * wide + slots[:, 1]
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(key, batch.column("length").to_numpy() * wide + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(slots[at, 3] + rank - slots[at, 1]), pa.array(slots[at, 4])], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ranked = cut.join(begin, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("begin") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

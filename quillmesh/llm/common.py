"""What the operators share: held-out splits, joins of skewed keys, bitmaps of keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.plans.adapters import table
from quillmesh.plans.runtime import discard, shared_folder, written, written_at

__all__ = ["bucket", "discard", "in_bitmap", "key_bitmap", "only", "shared_folder", "spread_join", "table", "written", "written_at"]


def bucket(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def spread_join(rows: DataFrame, keys: DataFrame, on: list[str], total: int, count: str = "n", least: int = 10_000) -> DataFrame:
    """``rows`` with the columns of ``keys``, which has one row a key and how many rows have it (``count``).

    Keys with more than ``least`` rows, and more than 1 in 100,000 of the ``total``, are at most 100,000: they are
    broadcast, so their rows stay where they are. All others are joined by shuffles, none of them large.
    """
    limit = max(least, total // 100_000)
    if total <= limit:  # no key can have more
        return rows.join(keys, on)
    hot = F.broadcast(keys.where(F.col(count) > limit))
    cold = rows.join(hot.select(*on), on, "left_anti").join(keys.where(F.col(count) <= limit), on)
    near = rows.join(hot, on)
    return near.select(*cold.columns).union(cold)


#: Bits of the bitmap below, as powers of two: at least, at most (1 and 64 MB), those of a piece that one task makes (1 MB), and how many a key has.
LEAST_BITS, MOST_BITS, PIECE_BITS, BITS_A_KEY = 23, 29, 23, 16


def key_bitmap(keys: DataFrame, column: str) -> np.ndarray | None:
    """A bitmap of evenly spread 64-bit keys, made by grouped ORs, larger for more keys. None for more keys than the largest has bits.

    It only spares moving rows that can't match; a join must follow, which does the same without it.
    """
    n = keys.count()
    if n > 1 << MOST_BITS:
        return None
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_A_KEY * n - 1).bit_length()))
    words = 1 << bits - 6
    piece = min(words, 1 << PIECE_BITS - 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{column}`, {bits - 6}) & 63 AS int))")
    ors = keys.groupBy(F.col(column).bitwiseAND(words - 1).alias("w")).agg(F.bit_or(bit).alias("b"))

    def fill(group: pa.Table) -> pa.Table:
        at = group.column("w").to_numpy()
        part = np.zeros(piece, "<i8")
        part[at % piece] = group.column("b").to_numpy()
        return pa.table({"piece": pa.array([at[0] // piece], pa.int64()), "raw": pa.array([part.tobytes()], pa.binary())})

    out = np.zeros(words, np.uint64)
    for r in ors.groupBy(F.floor(F.col("w") / piece).cast("long").alias("piece")).applyInArrow(fill, "piece long, raw binary").collect():  # 64 pieces at most
        out[r.piece * piece : (r.piece + 1) * piece] = np.frombuffer(r.raw, "<u8")
    return out


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    k, words = keys.view(np.uint64), len(bitmap)
    return (bitmap[(k & np.uint64(words - 1)).astype(np.int64)] >> ((k >> np.uint64(words.bit_length() - 1)) & np.uint64(63))) & np.uint64(1) == 1


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone: extra columns of a table never clash with the operators' own."""
    return df.select(*(F.col(f"`{n}`") for n in names))

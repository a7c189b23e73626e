"""The first message of a conversation that names each of its values, by one scan of the texts.

Values and messages of a conversation meet sorted in one stream, values first: they become an automaton (Aho-Corasick), and the
messages run through it in order, so work is the length of texts and values, not their product. Nothing of the messages is held. A
conversation with very many values is cut into blocks of about ``values_a_block``, each with a copy of its messages, and one with very long
texts into parts of about ``chars_a_part``, each with a copy of its values.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_mentions(values: DataFrame, messages: DataFrame, values_a_block: int = 100_000, chars_a_part: int = 1 << 27) -> DataFrame:
    """conv_id, needle, turn: for each value, in lower case, the least turn of a message that contains it; values that none contains are left out.

    ``values``: conv_id, value; ``messages``: conv_id, turn, text. Case is ignored. Null and empty values and texts name nothing.
    """
    kind = values.schema["conv_id"].dataType.simpleString()
    v = values.select("conv_id", F.lower("value").alias("needle")).where("needle <> ''").distinct()
    m = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.lower("text").alias("text")).where("text <> ''")
    blocks = v.groupBy("conv_id").agg(F.ceil(F.count("*") / values_a_block).cast("int").alias("blocks"))
    parts = m.groupBy("conv_id").agg(F.ceil(F.sum(F.length("text").cast("long")) / chars_a_part).cast("int").alias("parts"))
    cuts = blocks.join(parts, "conv_id")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = v.join(cuts, "conv_id").select("conv_id", F.pmod(F.xxhash64("needle"), F.col("blocks")).cast("int").alias("block"), upto("parts").alias("part"), F.lit(-1).cast("long").alias("turn"), F.lit(True).alias("is_value"), F.col("needle").alias("text"))
    right = m.join(cuts, "conv_id").select("conv_id", upto("blocks").alias("block"), F.pmod(F.xxhash64("turn", F.length("text")), F.col("parts")).cast("int").alias("part"), "turn", F.lit(False), "text")
    both = left.union(right).repartition("conv_id", "block", "part").sortWithinPartitions("conv_id", "block", "part", F.desc("is_value"), "turn")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known, seen, left, conv, out = None, [], set(), None, None, ([], [], [])

        def batch() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(out[0], conv.type), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["conv_id", "needle", "turn"])
            for x in out:
                x.clear()
            return rows

        for b in batches:
            conv = b.column("conv_id")
            for *at, turn, is_value, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "block", "part", "turn", "is_value", "text")), strict=True):
                if at != place:
                    place, known, left = at, [], None
                if is_value:
                    known.append(text)
                    continue
                if left is None:
                    left = ahocorasick.Automaton()
                    for x in known:
                        left.add_word(x, x)
                    left.make_automaton()
                    known, seen = [], set()
                # Turns rise, so the first sight of a value is the one that counts.
                for x in {x for _, x in left.iter(text)} - seen if len(left) else ():
                    seen.add(x)
                    out[0].append(at[0])
                    out[1].append(x)
                    out[2].append(turn)
            if out[0]:
                yield batch()

    found = both.mapInArrow(scan, f"conv_id {kind}, needle string, turn long")
    return found.groupBy("conv_id", "needle").agg(F.min("turn").alias("turn"))

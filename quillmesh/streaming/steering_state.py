"""Steering as keyed state: counters of tool pairs, domains and patterns that a stream of conversations keeps up to date.

A key is a shard of conversations, so no key holds a large part of them; its counters are a map in the state store, a row a
label, read and written one by one, whatever their number. What conversations count is told by expressions and added up in the tasks that read
them, so a key gets a row a label and task; a run has at most ``BATCHES`` micro-batches, of as many state tasks as there are keys at most. A timer, set whenever a shard has counted, sends what
the shard would advise before its next conversation. ``counters`` adds the shards' maps up from the store's checkpoint, in a batch: that
is the exact state of the whole, and what ``steering`` advises from.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quillmesh.functions import classify

GUIDANCE = "shard int, conversations long, avoid string, avoid_n long, prefer string, prefer_n long, hint string"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def records(calls: DataFrame, shards: int = 16) -> DataFrame:
    """shard, conv_id, pattern, categories, endpoints (with how often each is called): what a stream carries of a conversation."""
    has = lambda *words: F.bool_or(F.lower("endpoint").rlike("|".join(words)))
    pattern = classify.chain_pattern(F.sum("n"), has("create", "add", "book"), has("get", "list", "search"), has("update", "modify"), has("delete", "remove", "cancel"))
    each = calls.groupBy("conv_id", "endpoint_id", "endpoint", "category").agg(F.count("*").alias("n"))
    rows = each.groupBy("conv_id").agg(pattern.alias("pattern"), F.collect_set("category").alias("categories"), F.collect_list(F.struct("endpoint_id", "n")).alias("endpoints"))
    return rows.select(F.pmod(F.xxhash64("conv_id"), F.lit(shards)).cast("int").alias("shard"), "conv_id", "pattern", "categories", "endpoints")


def counted(records: DataFrame) -> DataFrame:
    """shard, kind, label, n: what each conversation counts; a row holds an endpoint's pairs, not those of all."""
    e = F.array_sort("endpoints")
    item = lambda kind, label, n: F.struct(F.lit(kind).alias("kind"), label.alias("label"), n.cast("long").alias("n"))
    plain = F.concat(F.array(item("conversations", F.lit(""), F.lit(1)), item("pattern", F.col("pattern"), F.lit(1))), F.transform("categories", lambda c: item("domain", c, F.lit(1))))
    x = F.get("e", F.col("i") - 1)
    itself = F.shiftright(x["n"] * (x["n"] - 1), 1)
    pairs = F.transform(F.slice("e", F.greatest("i", F.lit(1)), F.size("e")), lambda y: item("pair", F.concat(x["endpoint_id"], F.lit(" + "), y["endpoint_id"]), F.when(x["endpoint_id"] == y["endpoint_id"], itself).otherwise(x["n"] * y["n"])))
    each = records.select("shard", "pattern", "categories", e.alias("e")).select("*", F.explode(F.sequence(F.lit(0), F.size("e"))).alias("i"))
    return each.select("shard", F.explode(F.when(F.col("i") == 0, plain).otherwise(pairs)).alias("x")).select("shard", "x.*").where("n > 0")


#: Sums that a task holds before it passes them on.
HELD = 200_000


def summed(rows: DataFrame) -> DataFrame:
    """The rows of ``counted``, those of one shard, kind and label added up within a task: a stream's own aggregation would be state."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        more = 0

        def total() -> pa.Table:
            t = pa.concat_tables(held).group_by(["shard", "kind", "label"]).aggregate([("n", "sum")])
            return t.select(["shard", "kind", "label", "n_sum"]).rename_columns(["shard", "kind", "label", "n"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            more += batch.num_rows
            if more > HELD:
                held = [total()]
                more = held[0].num_rows
                if 2 * more > HELD:
                    yield from held[0].to_batches()
                    held, more = [], 0
        if held:
            yield from total().to_batches()

    return rows.mapInArrow(add, "shard int, kind string, label string, n long")


class Steering(StatefulProcessor):
    """Counts a shard's conversations and, when its timer is due, sends what they advise."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "kind string, label string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        more: Counter = Counter()
        for frame in rows:
            for kind, label, n in zip(frame["kind"], frame["label"], frame["n"], strict=True):
                more[kind, label] += int(n)
        for what, n in more.items():
            before = self.counts.getValue(what)[0] if self.counts.containsKey(what) else 0
            self.counts.updateValue(what, (before + n,))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = {"pair": ("", 0), "domain": ("", 0)}
        many = total = 0
        for (kind, label), (n,) in self.counts.iterator():
            if kind == "pair":
                best[kind] = min((best[kind], (label, n)), key=lambda x: (-x[1], x[0]))
            elif kind == "domain":
                best[kind] = min((best[kind], (label, n)), key=lambda x: (not x[0], x[1], x[0]))
            elif kind == "conversations":
                total = n
            elif label in ("multi_step", "search_and_act"):
                many += n
        hint = "Prefer multi-step scenarios" if many < 0.5 * total else "Allow simpler single-step scenarios" if many > 0.7 * total else ""
        yield pd.DataFrame({"shard": [key[0]], "conversations": [total], "avoid": [best["pair"][0]], "avoid_n": [best["pair"][1]], "prefer": [best["domain"][0]], "prefer_n": [best["domain"][1]], "hint": [hint]}, dtype=object)

    def close(self) -> None:
        pass


#: Micro-batches of a run at most: each costs all state tasks a start and a commit, so with one for so many files they would grow with the input.
BATCHES = 4
#: State tasks at most, of a new stream; there are no more keys than shards.
TASKS = 16


def steered(spark: SparkSession, path: str, schema, at: str, files_a_batch: int = 1) -> None:
    """Runs the stream over the record files of ``path`` that it hasn't seen; guidance goes to ``at``/guidance, state and progress to ``at``/state.

    A batch has ``files_a_batch`` files, or so many more that a run has at most ``BATCHES`` batches. A later call goes on where the last one ended.
    The state store that maps need is set for this stream's own session alone.
    """
    own = spark.newSession()
    files_a_batch = max(files_a_batch, -(-len(own.read.schema(schema).parquet(path).inputFiles()) // BATCHES))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", False)  # timers are due with the next data, else batches without any never end
    own.conf.set("spark.sql.shuffle.partitions", min(TASKS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)
    out = summed(counted(stream)).groupBy("shard").transformWithStateInPandas(Steering(), GUIDANCE, "Append", "ProcessingTime")
    out.writeStream.format("parquet").option("path", f"{at}/guidance").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()


def counters(spark: SparkSession, at: str) -> DataFrame:
    """kind, label, n: the counters of all shards, from the state as the stream left it."""
    state = spark.read.format("statestore").option("stateVarName", "counts").load(f"{at}/state")
    return state.groupBy("user_map_key.kind", "user_map_key.label").agg(F.sum("user_map_value.n").alias("n"))


def stored(rows: DataFrame, shared: str) -> str:
    """The records as files for a stream to read; the folder."""
    path = f"{shared}/records-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return path

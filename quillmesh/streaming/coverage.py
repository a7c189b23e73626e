"""Coverage counters kept up to date by Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType


def counts(stream: DataFrame, *keys: str) -> DataFrame:
    """Running number of rows for each key; the state is one row a key."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n"))


def windowed(stream: DataFrame, time: str, late: str, width: str, *keys: str) -> DataFrame:
    """Counts in windows of event time; the watermark bounds the state."""
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


def merged(stream: DataFrame, path: str, checkpoint: str, *keys: str) -> StreamingQuery:
    """Each micro-batch's own counts go to a Parquet table, by batch, so a batch that runs again replaces itself."""

    def add(batch: DataFrame, number: int) -> None:
        batch.groupBy(*keys).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(spark: SparkSession, stream: DataFrame, shared: str, *keys: str) -> DataFrame:
    """All that the stream now holds, counted batch by batch, as one table."""
    at = f"{shared}/coverage-{uuid.uuid4().hex}"
    merged(stream, f"{at}/counts", f"{at}/state", *keys).awaitTermination()
    schema = StructType([*stream.select(*keys).schema.fields, StructField("n", LongType()), StructField("batch", LongType())])
    return spark.read.schema(schema).parquet(f"{at}/counts").groupBy(*keys).agg(F.sum("n").alias("n"))

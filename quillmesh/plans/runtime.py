"""Getting the package to the executors, and the folder they share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]
#: Rows and bytes of an Arrow batch, unless the session asks for fewer: rows hold whole texts, and a Python worker holds a batch.
BATCH, BATCH_BYTES = 2000, 4 << 20
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to all executors, once a context (Spark's own file server carries it), and bounds Arrow batches."""
    sc = spark.sparkContext
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    if spark.conf.get(BYTES) == "67108864b":  # as Spark sets it
        spark.conf.set(BYTES, BATCH_BYTES)
    if getattr(sc, "_quillmesh", None) is None:
        at = os.path.join(tempfile.mkdtemp(prefix="quillmesh-"), f"{ROOT.name}.zip")
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(ROOT.rglob("*.py")):
                z.write(p, p.relative_to(ROOT.parent))
        sc.addPyFile(at)
        sc._quillmesh = at
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Where none is named, a temporary one on a single machine; on a cluster that is an error."""
    if not (at := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="quillmesh-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def written_at(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows as a Parquet table in the shared folder, and where it is: what follows reads them and repeats nothing that led to them."""
    path = f"{shared_folder(df.sparkSession)}/quillmesh-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame) -> DataFrame:
    return written_at(df)[0]


#: Rows of a task, where ``parts_for`` says how many tasks there are.
TASK_ROWS = 1_000_000


def parts_for(df: DataFrame) -> int:
    """How many parts to deal rows over that cost a task far more memory than their compressed bytes, which Spark would go by; ``df`` has as many rows, or about as many, and is cheap to count."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TASK_ROWS))


def discard(table: DataFrame, path: str) -> None:
    """Empties a table of ``written_at`` once nothing that is still to be computed reads it."""
    table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(path)

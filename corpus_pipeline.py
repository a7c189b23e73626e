"""From raw documents to packed training sequences, in stages that each apply one operator to all that the one before kept.

Rejected by the quality classifier: documents with score < 0.5. Of each group of near-duplicates
(five words, similarity 0.8) the least id stays. Documents with a ten-word window of a benchmark item go. Personal
data are replaced by their kind in the texts that stay. The last stage packs the texts. n_chars
follows the text where a stage changes it. Repeated rows of one id count as copies of it: one stays (the first text in order).
Rows without an id or a text are judged like others by all stages but the second, which keeps rows without an id. Further columns of documents stay,
whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.llm import decontam, minhash, packing, pii, quality
from quillmesh.llm.common import bucket, shared_folder, table, written
from quillmesh.llm.queries import TOKENIZER
from quillmesh.plans.runtime import ship

#: Columns that a stage adds for itself; a table's own columns don't have such names.
ID, ROWS, SCORE = "_quillmesh_id", "_quillmesh_rows", "_quillmesh_score"


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), bucket("doc_id", 3) != 1)
    return quality.score(docs, model, SCORE).where(F.col(SCORE) >= 0.5).drop(SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = minhash.near_duplicates(docs, words=5, percent=80)
    flags = found.groupBy("doc_id").agg(F.min("kept").alias("stays"), F.count("*").alias("rows")).where("not stays or rows > 1")
    flags = written(flags.select(F.col("doc_id").alias(ID), F.when(F.col("stays"), F.col("rows")).otherwise(F.lit(0)).alias(ROWS)))
    rest = docs.join(flags, F.col("doc_id") == F.col(ID), "left").where(F.col(ROWS).isNull() | (F.col(ROWS) > 0))
    once = rest.where(F.col(ROWS).isNull()).drop(ID, ROWS)
    if flags.where(F.col(ROWS) > 0).isEmpty():
        return once
    first = Window.partitionBy("doc_id").orderBy("text")
    again = rest.where(F.col(ROWS) > 0).withColumn(ROWS, F.row_number().over(first)).where(F.col(ROWS) == 1)
    return once.union(again.drop(ID, ROWS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts are met by their sha256, so rows without an id, or with one id, are each judged by their own text."""
    ship(spark)
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = docs.select(sha.alias("doc_id"), "text")
    hit = decontam.contamination(rows, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id").alias(ID)).distinct()
    return docs.join(hit, sha == F.col(ID), "left_anti")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", reject_low_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: The classifier, the signatures and the tokenizer have no SQL form: tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents; each stage's result is a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

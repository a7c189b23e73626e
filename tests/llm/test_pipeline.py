"""Each stage against a brute-force version on its own input."""

import corpus_pipeline
from pyspark.sql import functions as F

from quillmesh.llm import pii
from tests.llm.conftest import frame
from tests.llm.test_exact import brute_groups, brute_hits


def test_stages(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, d).cache()
        a, b = [r.asDict() for r in before.collect()], [r.asDict() for r in after.collect()]
        kept = {r["doc_id"] for r in b}
        if name == "quality_classifier":
            judged = [i for i in labels if i in {r["doc_id"] for r in a}]
            assert sum((i in kept) == (labels[i] == 1) for i in judged) > 0.95 * len(judged)
        elif name == "minhash_near_dedup":
            assert kept == {i for i, (_, c) in brute_groups([(r["doc_id"], r["text"]) for r in a], 5, 80).items() if i == c}
        elif name == "benchmark_decontamination":
            assert kept == {i for i, *_, hit in brute_hits([(r["doc_id"], r["text"]) for r in a], bench) if not hit}
        elif name == "pii":
            assert len(a) == len(b) and not any(pii.base_spans(r["text"]) for r in b)
            same = {r["doc_id"]: r["text"] for r in b}
            assert all(same[r["doc_id"]] == r["text"] for r in a if not pii.candidates(r["text"]))
        else:
            assert kept == {r["doc_id"] for r in a}
        if name != "best_fit_packing":
            assert after.columns == docs.columns
        before = after


def test_repeated_rows_leave_one(spark):
    t = "some words that make up a text long enough to be a document of its own right here"
    d = frame(spark, [(1, t), (1, t), (2, t), (3, "another text altogether, with nothing in common at all"), (4, None), (4, None)])
    out = corpus_pipeline.drop_near_duplicates(spark, d, "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4] and out.columns == d.columns


def test_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert F is not None

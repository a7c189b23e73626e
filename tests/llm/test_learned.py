"""Learned operators: held-out accuracy, bounds and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.llm import components, decontam, langid, licenses, lm, minhash, packing, pii, quality, rules, suffix_dedup
from quillmesh.llm.common import bucket, table
from tests.llm.conftest import frame


@pytest.fixture(scope="module")
def real(spark):
    return table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")


def test_quality_classifier(spark, real, docs):
    d, labels = real
    held = bucket("doc_id", 3) == 1
    m = quality.fit(d, labels, ~held)
    s = quality.score(d, m).join(labels, "doc_id").where(held).select("score", "quality").toPandas()
    assert ((s.score >= 0.5) == (s.quality == 1)).mean() > 0.95 and s.score.between(0, 1).all()
    odd = {r.doc_id: r.score for r in quality.score(docs, m).collect()}
    assert len(odd) == docs.count() and odd[0] == odd[1] == odd[2]


def test_quality_without_labels(spark, docs, real):
    none = real[1].limit(0)
    m = quality.fit(docs, none, F.lit(True))
    assert {r.score for r in quality.score(docs, m).collect()} == {0.5}


def test_rules_drop_bad_and_keep_good(spark, real):
    d, labels = real
    out = rules.apply(d, rules.fit(d, labels)).join(labels, "doc_id").select("kept", "quality", "base_failed").toPandas()
    assert not out.kept[out.quality == 0].any() and out.kept[(out.quality == 1) & ~out.base_failed].mean() > 0.97


def test_trees_respect_monotone_features():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 2))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + 0.2 * rng.normal(size=2000)) < 0.5).astype(float)
    t = rules.grow(x, y, [-1, 0], trees=20)
    grid = np.column_stack([np.linspace(0, 1, 200), np.full(200, 0.5)])
    assert (np.diff(t.margin(grid)) <= 1e-9).all() and ((t.margin(x) > 0) == (y > 0.5)).mean() > 0.8
    assert t.feature.dtype.kind == "i" and len({len(a) for a in (t.feature, t.threshold, t.left, t.right, t.value)}) == 1


def test_language_id(spark, real, docs):
    d, _ = real
    held = bucket("doc_id", 4) == 2
    m = langid.fit(d, ~held)
    out = langid.predict(d, m).join(d.select("doc_id", "lang"), "doc_id").where(held).toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.97
    odd = {r.doc_id: r for r in langid.predict(docs, m).collect()}
    assert [odd[i].lang_pred for i in (0, 1, 2, 3)] == ["und"] * 4 and odd[0].score == 0 and odd[51].lang_pred != "und" and len(odd) == docs.count()
    rows = d.where("lang in ('en', 'de')").orderBy("doc_id").limit(20).collect()
    mixed = " ".join(next(r.text for r in rows if r.lang == x)[:300].replace("\n", " ") for x in ("en", "de"))
    words = langid.label_words(frame(spark, {1: mixed, 2: None}), m).orderBy("pos").collect()
    half = len(words) // 2
    assert sum(w.lang == "en" for w in words[: half - 5]) > 0.85 * (half - 5) and sum(w.lang == "de" for w in words[half + 5 :]) > 0.85 * (half - 5)


def test_language_id_learns_every_language(spark):
    """Seventy languages with words of their own: none is left out, the rarest included."""
    text = lambda i, k: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}q{chr(97 + (j * 7 + k) % 20)}{chr(97 + i % 26)}" for j in range(12))
    rows = [(100 * i + k, text(i, k), f"l{i:02d}") for i in range(70) for k in range(4 if i < 69 else 3)]
    d = frame(spark, [r[:2] for r in rows], lang={r[0]: r[2] for r in rows})
    m = langid.fit(d, lm.F.lit(True))
    assert m.langs == [f"l{i:02d}" for i in range(70)]
    got = {r.doc_id: r.lang_pred for r in langid.predict(d, m).collect()}
    assert sum(got[i] == x for i, _, x in rows) > 0.9 * len(rows) and got[6900] == "l69"


def test_forward_backward_matches_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    e, t = rng.normal(size=(7, 3)).astype(np.float32), rng.normal(size=(3, 3))
    first = np.array([0, 4])
    got = langid.forward_backward(e, first, t)
    for a, b in ((0, 4), (4, 7)):
        mass = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            p = np.exp(sum(e[a + i, x] for i, x in enumerate(path)) + sum(t[x, y] for x, y in zip(path, path[1:], strict=False)))
            for i, x in enumerate(path):
                mass[i, x] += p
        assert np.allclose(got[a:b], mass / mass.sum(1, keepdims=True), atol=1e-4)


def test_language_model_beats_unigrams(spark, real):
    d, _ = real
    texts = [r.text for r in d.orderBy("doc_id").limit(400).collect()]
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids, starts = lm.encoded(texts[:300], path, 2)
    counts = np.bincount(ids, minlength=50257)
    m = lm.train(np.split(ids, starts[1:]), counts, 2, steps=120)
    held, s = lm.encoded(texts[300:], path, 2)
    grid, ok = lm.windows(held, s, 2)
    assert np.where(ok, lm.log_probs(m, grid), 0).sum() / ok.sum() > np.log((counts + 0.5) / (counts + 0.5).sum())[held].mean() + 0.3


def test_language_model_learns_from_rows_outside_the_sample(spark):
    """Documents that the first weights have not seen raise the probability of texts like them."""
    rng = np.random.default_rng(3)
    size, end = 400, 2
    # Two kinds of texts: each id is followed by its own next one, which differs between the kinds.
    follow = np.stack([rng.permutation(np.arange(10, 200)), rng.permutation(np.arange(200, 390))])
    make = lambda kind: np.array([*follow[kind][(np.arange(60) + rng.integers(190)) % 190], end])
    texts = [make(i % 2) for i in range(300)]
    rows = spark.createDataFrame([(i, i % 2 == 1 or i < 20, t.astype("<u2").tobytes()) for i, t in enumerate(texts)], "doc_id long, learn boolean, ids binary").repartition(4).cache()
    learnt = [t for i, t in enumerate(texts) if i % 2 == 1 or i < 20]
    counts = np.bincount(np.concatenate(learnt), minlength=size)
    grid, ok = lm.windows(*lm.unpacked(lm.pa.array([make(1).astype("<u2").tobytes() for _ in range(40)], lm.pa.binary()), size), end)
    chosen = [r.doc_id for r in rows.where("learn").orderBy(lm.F.xxhash64("doc_id", lm.F.lit(11)), "doc_id").limit(5).collect()]
    first = lm.train(sorted((texts[i] for i in chosen), key=lambda t: t.astype("<u2").tobytes()), counts, end)
    mean = lambda m: np.where(ok, lm.log_probs(m, grid), 0).sum() / ok.sum()
    m = lm.fit(rows, counts, sample=5, end_id=end)
    assert np.allclose(m.tables.sum(0), 1, atol=1e-4)
    assert mean(m) > mean(first) + 0.3, (mean(m), mean(first))


def test_pairs_are_counted_over_all_places_of_all_rows(spark, monkeypatch):
    """The counts that the weights start from, against loops: long texts whole, none across texts, rows outside ``learn`` left out, tasks added up."""
    rng = np.random.default_rng(12)
    size, end = 300, 2
    texts = [np.append(rng.integers(3, size, n), end) for n in (0, 1, 5, 16, 3000, 40)]
    held = [(i, i != 5, t.astype("<u2").tobytes()) for i, t in enumerate(texts)]
    monkeypatch.setattr(lm, "FAN", 2)
    got = lm.pair_counts(spark.createDataFrame(held, "doc_id long, learn boolean, ids binary").repartition(3), size, end, flush=50).collect()
    got = lm._table([r.part for r in got], [r.raw for r in got], size, 3 * lm.BUCKETS, "<i8")
    want, bucket = np.zeros((3, size, lm.BUCKETS)), lm._buckets(size)
    for t in texts[:5]:
        for i, x in enumerate(t):
            before = t[i - 1] if i else end
            want[0, before, bucket[x]] += 1
            want[1, x, bucket[before]] += 1
            for d in lm.APART:
                if i + d < len(t):
                    want[2, x, bucket[t[i + d]]] += 1
    assert (got == np.hstack(want)).all()


def test_language_model_starts_from_all_rows(spark):
    """Without a sample the model is as good on a kind of text that few rows have, and the same however rows lie in tasks."""
    rng = np.random.default_rng(3)
    size, end = 400, 2
    follow = np.stack([rng.permutation(np.arange(10, 200)), rng.permutation(np.arange(200, 390))])
    make = lambda kind: np.array([*follow[kind][(np.arange(60) + rng.integers(190)) % 190], end])
    texts = [make(int(i % 10 == 1)) for i in range(300)]
    rows = spark.createDataFrame([(i, True, t.astype("<u2").tobytes()) for i, t in enumerate(texts)], "doc_id long, learn boolean, ids binary").cache()
    counts = np.bincount(np.concatenate(texts), minlength=size)
    grid, ok = lm.windows(*lm.unpacked(lm.pa.array([make(1).astype("<u2").tobytes() for _ in range(40)], lm.pa.binary()), size), end)
    mean = lambda m: np.where(ok, lm.log_probs(m, grid), 0).sum() / ok.sum()
    m, again = (lm.fit(rows.repartition(n), counts, end_id=end) for n in (1, 5))
    assert all(np.allclose(getattr(m, k), getattr(again, k), rtol=1e-4, atol=1e-5) for k in vars(m))
    print(mean(m), mean(lm.fit(rows, counts, sample=5, end_id=end)))
    assert mean(m) > mean(lm.fit(rows, counts, sample=5, end_id=end)) + 0.3


def test_language_model_does_not_depend_on_partitions(spark, monkeypatch):
    """However rows lie in tasks, and however many rounds add up the tasks' sums, scores are the same."""
    from quillmesh.llm.queries import TOKENIZER

    rng = np.random.default_rng(8)
    words = [f"word{k}" for k in range(300)]
    docs = frame(spark, {i: " ".join(rng.choice(words, 80)) for i in range(120)} | {120: None, 121: ""})
    learn = bucket("doc_id", 7) != 2
    one = {r.doc_id: r for r in lm.score(docs.coalesce(1), learn, TOKENIZER).collect()}
    monkeypatch.setattr(lm, "FAN", 2)
    six = {r.doc_id: r for r in lm.score(docs.repartition(6), learn, TOKENIZER).collect()}
    assert one.keys() == six.keys()
    for i, r in one.items():
        assert r.n_known == six[i].n_known and np.isclose(r.base_score, six[i].base_score, rtol=1e-12) and np.isclose(r.score, six[i].score, rtol=1e-6)


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"][1]
    texts = {0: None, 1: "", 2: "word", 3: "plain text of no licence at all", 4: "intro\n" + mit.upper().replace(",", " ;") + "\noutro", 5: "See. Licensed under the Apache License, Version 2.0.", 6: mit.replace("without restriction", "with no limits"), 7: "the software is provided and the license of the work", 8: mit * 2}
    got = {r.doc_id: r for r in licenses.scan(frame(spark, texts)).collect()}
    assert [got[i].license for i in range(9)] == [None, None, None, None, "MIT", "Apache-2.0", "MIT", None, "MIT"]
    assert got[4].dice == 1 and texts[4].encode()[got[4].start : got[4].end].startswith(b"PERMISSION") and 0.9 < got[6].dice < 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 300)] + [(500 + rng.randrange(50), 500 + rng.randrange(50)) for _ in range(80)] + [(7, 7), (None, 3), (900, 899), (900, 899)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


def test_empty_tables(spark, empty):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for df in (
        suffix_dedup.remove_repeats(empty), minhash.near_duplicates(empty), decontam.contamination(empty, bench), licenses.scan(empty),
        packing.pack(empty, path), pii.find(empty, pii.fit(empty)), langid.predict(empty, langid.fit(empty, F.lit(True))),
        quality.score(empty, quality.fit(empty, labels, F.lit(True))), rules.apply(empty, rules.fit(empty, labels)), lm.score(empty, F.lit(True), path),
    ):
        assert df.count() == 0


def test_null_ids_are_kept(spark):
    d = frame(spark, [(None, "a few words that stand here twice"), (1, "a few words that stand here twice"), (None, None)])
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    bench = spark.createDataFrame([(1, "few words that")], "item_id long, text string")
    for df in (suffix_dedup.remove_repeats(d, 10), minhash.near_duplicates(d), decontam.contamination(d, bench), licenses.scan(d), lm.score(d, F.lit(True), path), rules.apply(d, rules.fit(d, spark.createDataFrame([], "doc_id long, quality int")))):
        assert df.count() == 3
    assert packing.pack(d, path).count() == 3


def test_samples_are_bounded_where_rows_share_an_id(spark, monkeypatch):
    """5,000 rows of one labelled id, and 5,000 without an id: what reaches the driver stays within the documented bound."""
    rows = [(1 if i % 2 else None, f"some words here {i}", "en" if i % 4 < 2 else "de") for i in range(10_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(rules, "grow", lambda x, y, m: seen.setdefault("rules", len(y)))
    monkeypatch.setattr(langid, "train", lambda t, x: seen.setdefault("langid", max(x.count("en"), x.count("de"))))
    rules.fit(d, labels, sample=10)
    langid.fit(d, F.lit(True), per_lang=10)
    assert seen == {"rules": 10, "langid": 10}
    assert np.isfinite(quality.fit(d, labels, F.lit(True), sample=10).bias)

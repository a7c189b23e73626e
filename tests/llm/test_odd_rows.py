"""All ten operators and five stages over one table of odd rows: null ids, repeated rows, ties, empty and very long texts, clashing columns."""

import math
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quillmesh.llm import decontam, langid, licenses, lm, minhash, packing, pii, quality, rules, suffix_dedup
from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import bucket
from tests.llm.conftest import LONG, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Names that the operators and stages use themselves.
CLASH = "score kept license rows stays n row k text_key anchor tag band component_id n_words n_hit ids part spans votes held_out rank phrase term pos w".split()


@pytest.fixture(scope="module")
def odd(spark):
    plain = texts()
    rows = [(i, plain[i]) for i in (0, 1, 2, 3, 4, 7, 8, 10, 22, 23, 30, 31, 51, 52)]
    rows += [(None, plain[22]), (None, plain[22]), (None, None), (7, plain[7]), (7, plain[7]), (60, plain[30]), (60, plain[31]), (70, LONG), (70, LONG), (71, "9" * 50_000 + " x@y.org"), (72, "a" * 60_000)]
    lang = ["en", "de", None]
    items = [Row(doc_id=i, text=t, lang=lang[k % 3], source=None, n_chars=None if t is None else len(t), **dict.fromkeys(CLASH, 9.0)) for k, (i, t) in enumerate(rows)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} double" for c in CLASH)
    return spark.createDataFrame(items, kinds).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in (1, 4, 7, 8, 10, 22, 30)] + [(None, 1, 0), (31, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, texts()[22].split("\n")[1]), (2, None), (3, texts()[22].split("\n")[1]), (None, "日本語 テキスト です。")], "item_id long, text string")


def results(odd, labels, bench):
    yield licenses.scan(odd)
    yield lm.score(odd, bucket("doc_id", 7) != 2, PATH)
    yield suffix_dedup.remove_repeats(odd)
    yield langid.predict(odd, langid.fit(odd, F.lit(True)))
    yield minhash.near_duplicates(odd)
    yield decontam.contamination(odd, bench)
    yield rules.apply(odd, rules.fit(odd, labels))
    yield pii.find(odd, pii.fit(odd))
    yield quality.score(odd, quality.fit(odd, labels, F.lit(True))).select("doc_id", "score")


def test_every_row_has_its_result_and_repeated_rows_the_same(odd, labels, bench):
    ids = sorted(str(r.doc_id) for r in odd.collect())
    for df in results(odd, labels, bench):
        got = df.collect()
        assert sorted(str(r.doc_id) for r in got) == ids, df.columns
        for same in (7, 70):
            assert len({str(r) for r in got if r.doc_id == same}) == 1, df.columns
    got = packing.pack(odd, PATH).collect()
    assert {str(r.doc_id) for r in got} == set(ids)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert len({(r.start, r.length, r.ids_crc32) for r in got if r.doc_id == 7}) == 1 and sum(r.doc_id == 7 for r in got) == 3


def test_columns_and_types_of_the_contracts(spark, data):
    import __spark_entry__ as e

    want = {
        "op2": "doc_id held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double", "op3": "doc_id n_bytes:bigint n_removed:bigint n_spans:bigint kept_sha256:string",
        "op4": "doc_id held_out:boolean lang_pred:string score:double", "op5": "doc_id n_shingles:bigint component_id kept:boolean", "op6": "doc_id n_words:bigint n_hit:bigint n_items:bigint items_sha256:string contaminated:boolean",
        "op7": "doc_id n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean", "op8": "doc_id n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
        "op9": "doc_id piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint", "op10": "doc_id held_out:boolean score:double predicted:int",
    }
    for name, f in e.queries().items():
        if columns := want.get(name.split("_")[0]):
            kinds = dict(f(spark, data).dtypes)
            assert all(kinds[c.split(":")[0]] == (c.split(":") + ["bigint"])[1] for c in columns.split()), name


def test_stages_keep_columns_of_any_name(spark, odd, labels, bench, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: {"labels": labels, "benchmark": bench}[name])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns, name
        got = out.collect()
        assert all(r[c] == 9.0 for r in got for c in CLASH), name
        if name == "benchmark_decontamination":
            passage = texts()[22].split("\n")[1]
            want = [r.doc_id for r in odd.collect() if passage not in (r.text or "") and "テキスト です" not in (r.text or "")]
            assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in got)
        if name == "minhash_near_dedup":
            kept = [r.doc_id for r in got]
            assert kept.count(7) == 1 and kept.count(8) == 0 and kept.count(70) == 1 and kept.count(None) == 3 and kept.count(0) == 1
        if name == "pii":
            assert len(got) == odd.count() and {r.text for r in got if r.doc_id == 0} == {None} and all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_stages_take_empty_tables(spark, odd, labels, bench, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: {"labels": labels.limit(0), "benchmark": bench.limit(0)}[name])
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_op1_by_plain_dice(spark):
    """Every text against every stretch of its words, by sets."""
    import random

    rng = random.Random(4)
    known = {"X": ["a b c d e f a b"], "Y": ["c d e f g h"], "Z": ["a b", "h g f e d c b a"]}
    words = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())
    pairs = lambda w: list(zip(w, w[1:], strict=False))
    rows = [(i, " ".join(rng.choice([*"abcdefgh", "c d e f g h", "a b c d e f a b", "É"]) for _ in range(rng.randrange(12)))) for i in range(150)]
    rows += [(500, "w a b c d " + "x x " * 30 + "e f a b"), (501, "a b " * 200), (502, "a b"), (502, "a b"), (503, None)]
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), 0.8, known).collect():
        own = pairs(words(next(t for i, t in rows if i == r.doc_id)))
        best = {}
        for name, templates in known.items():
            for t in templates:
                has = set(pairs(words(t)))
                for a in range(len(own)):
                    for b in range(a, len(own)):
                        if own[a] in has and own[b] in has:
                            dice = 2 * len(has & set(own[a : b + 1])) / (len(has) + len(set(own[a : b + 1])))
                            if dice >= 0.8:
                                best[name] = max(best.get(name, 0), dice)
        assert r.n_licenses == len(best) and math.isclose(r.dice, max(best.values(), default=0)), (r, best)
        assert {x.license for x in r.passages} == set(best) and all(x.dice >= 0.8 for x in r.passages)


def test_op4_by_plain_decoding(spark, odd):
    """A text's probabilities by scaled forward-backward in loops, on the fitted model."""
    m = langid.fit(odd, F.lit(True))
    got = {r.doc_id: r for r in langid.predict(odd, m).collect()}
    step = np.exp(m.transitions - m.transitions.max())
    for i in (7, 10, 22, 31, 52, 70):
        text = next(r.text for r in odd.collect() if r.doc_id == i)
        p = next(tk.packs(langid.pa.array([text])))[2]
        s, e = p.runs(langid.LETTER)
        w, f = langid.word_features(p, s, e, m)
        emission = np.zeros((len(s), len(m.langs)))
        np.add.at(emission, w, m.weights[f])
        line = np.searchsorted(np.flatnonzero(p.buf == 10), s)
        mean = np.zeros(len(m.langs))
        for x in np.unique(line):
            local = np.exp(emission[line == x] - emission[line == x].max(1, keepdims=True))
            alpha, beta = np.zeros_like(local), np.ones_like(local)
            for t in range(len(local)):
                alpha[t] = local[t] * (alpha[t - 1] @ step if t else 1)
                alpha[t] /= alpha[t].sum()
            for t in range(len(local) - 2, -1, -1):
                beta[t] = step @ (local[t + 1] * beta[t + 1])
                beta[t] /= beta[t].sum()
            g = alpha * beta
            mean += (g / g.sum(1, keepdims=True)).sum(0)
        mean /= len(s)
        assert math.isclose(got[i].score, mean.max(), abs_tol=2e-3) and got[i].lang_pred == m.langs[int(mean.argmax())], i


def test_op7_trees_by_walking(odd, labels):
    """Flat arrays against one node at a time."""
    trees = rules.fit(odd, labels)
    x = np.random.default_rng(1).random((40, len(rules.NAMES)))
    for row, margin in zip(x, trees.margin(x), strict=True):
        total = trees.bias
        for root in trees.roots:
            k = root
            while trees.feature[k] >= 0:
                k = trees.left[k] if row[trees.feature[k]] <= trees.threshold[k] else trees.right[k]
            total += trees.value[k]
        assert math.isclose(total, margin, rel_tol=1e-9)


def test_op10_by_plain_logistic(odd, labels):
    """Scores by a dictionary of features and loops, on the fitted model."""
    m = quality.fit(odd, labels, F.lit(True))
    got = {r.doc_id: r.score for r in quality.score(odd, m, "q").select("doc_id", F.col("q").alias("score")).collect()}
    for i in (0, 3, 7, 10, 22, 51):
        text = next(r.text for r in odd.collect() if r.doc_id == i) or ""
        p = next(tk.packs(quality.pa.array([text])))[2]
        one = lambda t: int(next(tk.packs(quality.pa.array([t])))[2].hashes(np.array([0]), np.array([len(t.encode())]))[0])
        kinds = [(x, bool(re.match(r"[0-9A-Za-z\u0080-\U0010ffff]", x))) for x in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+|[^\x00-\x08\x0e-\x200-9A-Za-z\u0080-\U0010ffff\s]+", text)]
        assert len(kinds) == len(p.runs(quality.ALNUM)[0]) + len(p.runs(quality.MARK)[0]), i
        mixed = lambda v: int(tk.mix(np.array([v], tk.U))[0])
        big = (1 << 64) - 1

        def pair(a: int, b: int) -> int:
            h = 0
            for k, v in enumerate((a, b), 1):
                h = ((h + v) * 0xD6E8FEB86659FD93 + k) & big
                h ^= h >> 32
            return mixed(h)

        word = [one(x) for x, _ in kinds]
        shape = []
        for x, alnum in kinds:
            n, ups = len(x.encode()), sum("A" <= c <= "Z" for c in x)
            kind = (1 if x[0] in "0123456789" else 2 if not ups else 3 if ups == n and n > 1 else 4) if alnum else 5
            shape.append(mixed((kind * 64 + min(n, 12) + (1 << 40)) & big))
        found = {}
        for f in [*word, *shape, *(pair(a, b) for a, b in zip(word, word[1:], strict=False)), *(pair(a, b) for a, b in zip(shape, shape[1:], strict=False)), *(77 for a, b in zip(word, word[1:], strict=False) if a == b)]:
            found[f & ((1 << m.bits) - 1)] = found.get(f & ((1 << m.bits) - 1), 0) + 1
        norm = math.sqrt(sum(found.values())) or 1.0
        x = m.bias + sum(m.weights[f] * math.sqrt(n) / norm for f, n in found.items())
        assert math.isclose(got[i], 1 / (1 + math.exp(-x)), rel_tol=1e-4), i

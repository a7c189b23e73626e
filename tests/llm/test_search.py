"""Ranked lexical search, the Merkle manifest and nearest neighbours against plain versions, on odd rows and on given tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Row

from quillmesh.llm import lexical, manifest, neighbours, queries
from tests.llm.conftest import frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def plain_rank(docs, items, k):
    words = [(i, [w.translate(LOW) for w in TERM.findall(t or "")]) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, n_terms = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        terms = {w.translate(LOW) for w in TERM.findall(text or "")}
        scored = []
        for i, w in words:
            tf, m = Counter(w), 50 + 50 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(0, "the river stone of copper"), (1, None), (2, ""), (3, "..."), (4, "unknownterm"), (5, "STRASSE Straße ñandú élève日本語"), (6, "garden garden window"), (7, "word3x3 word5x5 the and"), (8, "same")]


def items_frame(spark, items):
    return spark.createDataFrame([Row(item_id=i, text=t, doc_id="x", score="y", term="z") for i, t in items], "item_id long, text string, doc_id string, score string, term string")


@pytest.mark.parametrize("terms_a_block", [100_000, 6])
def test_rank_equals_a_plain_ranking(spark, corpus, docs, terms_a_block):
    found = lexical.rank(docs, items_frame(spark, ITEMS), k=7, terms_a_block=terms_a_block)
    assert sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == plain_rank(corpus.items(), ITEMS, 7)


def test_rank_of_copies_repeated_ids_and_null_ids(spark):
    rows = [(i, "alpha beta gamma") for i in range(200)] + [(3, "alpha beta gamma"), (None, "alpha beta gamma"), (None, "alpha alpha delta"), (900, "other words here")]
    found = lexical.rank(frame(spark, rows), items_frame(spark, [(1, "alpha delta other"), (2, "gamma")]), k=5)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_rank(rows, [(1, "alpha delta other"), (2, "gamma")], 5)


def test_rank_of_empty_tables(spark, docs, empty):
    assert lexical.rank(empty, items_frame(spark, ITEMS)).count() == 0
    assert lexical.rank(docs, items_frame(spark, [])).count() == 0
    assert lexical.rank(docs, items_frame(spark, [(1, None), (2, "--")])).count() == 0


def test_rank_keeps_all_survivors_of_the_bounds(spark, data):
    """Buckets of 3 vectors and thresholds from the start: as many rows as SQL has are compared in the query test; here the bounds' own loop."""
    rng = random.Random(3)
    best, least = {}, {0: 1}
    import pyarrow as pa

    rows = []
    for i in range(300):
        terms = sorted(rng.sample(range(20), rng.randint(1, 12)))
        rows.append((i, terms, [rng.randint(1, 10**9) for _ in terms]))
    rows.sort(key=lambda r: -math.sqrt(sum(x * x for x in r[2])))
    asked = {0: np.array([4, 7, 1, 13, 2])}
    for a in range(0, 300, 3):
        part = rows[a : a + 3]
        lengths = [math.sqrt(sum(x * x for x in r[2])) for r in part]
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array(lengths), pa.array([r[1] for r in part], pa.list_(pa.int32())), pa.array([r[2] for r in part], pa.list_(pa.int64()))], names=["doc_id", "length", "term", "impact"])
        lexical._bucket(batch, asked, least, best, 10)
    want = sorted(((sum(x for t, x in zip(r[1], r[2], strict=True) if t in asked[0]), -r[0]) for r in rows), reverse=True)[:10]
    assert [(s, -i) for s, i in zip(*(x.tolist() for x in best[0]), strict=True)] == want


def test_a_long_text_is_split_whole():
    text = ("word " * 300_000 + "x" * 2_500_000 + " End").encode()
    got = [t for p in lexical.pieces(text) for t in p]
    assert len(got) == 300_002 and got[-1] == b"end" and len(got[-2]) == 2_500_000


# Manifest -------------------------------------------------------------------


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def framed(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def plain_tree(nodes, fan):
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, own = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for j in range(len(run)):
                for o in owners[a + j]:
                    paths[o].append((run[:j], run[j + 1 :]))
            up.append(sha("".join(run)))
            own.append([o for x in owners[a : a + fan] for o in x])
        nodes, owners = up, own
    return (nodes or [None])[0], paths


def plain_proofs(rows, fan=8):
    by = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = sha("".join(map(framed, (doc_id, source, lang, n_chars, text))))
        low = sha("".join(map(framed, (doc_id, source, lang, n_chars, None if text is None else text.translate(LOW)))))
        crc = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        by[lang].append(((doc_id is not None, doc_id or 0), leaf, low if crc % 3 == 0 else leaf, doc_id))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by[x].sort(key=lambda r: r[:3])
        trees[x] = plain_tree([r[1] for r in by[x]], fan)
    root, tops = plain_tree([trees[x][0] for x in langs], fan)
    out = []
    for k, x in enumerate(langs):
        for (_, leaf, now, doc_id), path in zip(by[x], trees[x][1], strict=True):
            for before, after in (whole := path + tops[k]):
                now = sha("".join(before) + now + "".join(after))
            out.append((doc_id, leaf, trees[x][0], root, sha("".join("".join(b) + "".join(a) for b, a in whole)), now, now == root))
    return sorted(out, key=repr)


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, rank int, tree string").repartition(3)


def many_rows():
    rng = random.Random(9)
    langs = [None, "", "de", "en", "zz", "Ä", "a" * 3, "b", "c", "d", "e"]
    rows = [(i, rng.choice(["web", None]), langs[min(rng.randrange(30), 10)], rng.choice([None, i]), rng.choice([None, "", f"Text {i}", "straße ß", "X" * rng.randrange(5000)])) for i in range(160)]
    return rows + [(7, "web", "en", 1, "One"), (7, "web", "en", 1, "One"), (None, None, None, None, None), (None, "s", "en", 3, "No Id"), (1000, None, "lone", 2, "Lone")] + [(5, "w", "de", 2, "Copy")] * 20


def test_proofs_equal_a_plain_tree(spark):
    rows = many_rows()
    assert sorted(map(tuple, manifest.proofs(table_of(spark, rows)).collect()), key=repr) == plain_proofs(rows)


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 3, "abc")], [(0, None, None, None, None)], [(3, "s", "en", 3, "ABC"), (4, "s", "en", 3, "abc")], [(i, "s", "en", 3, "ABC") for i in range(9)]])
def test_small_manifests(spark, rows):
    assert sorted(map(tuple, manifest.proofs(table_of(spark, rows)).collect()), key=repr) == plain_proofs(rows)


def test_descent_answers_some_requests_alone(spark):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(100)]
    ranked = manifest.ranked(manifest.leaves(table_of(spark, rows)), "tree", "doc_id")
    store, roots = manifest.levels(ranked.selectExpr("tree", "rank", "size", "leaf as digest"), 8)
    start = roots.selectExpr("tree", "digest", "height", "cast(array() as array<struct<before string, after string>>) as path")
    asked = ranked.where("doc_id in (0, 50, 99)").select("tree", "rank")
    found = manifest.descend(store, start, 8, asked).collect()
    assert sorted(r["rank"] for r in found) == [0, 6, 12]


# Neighbours -----------------------------------------------------------------


def plain_nearest(rows, asks, k=5):
    out = {}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in asks:
        s = x @ x[np.flatnonzero(ids == i)[0]]
        rest = ids != i
        o = np.lexsort((ids[rest], -s[rest]))[:k]
        out[i] = [(int(ids[rest][j]), float(s[rest][j])) for j in o]
    return out


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "n", 1.0) for i, v in rows], "vec_id long, embedding array<float>, node string, score double").repartition(4)


def test_recall_of_the_graph_search(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((3000, 24)).astype(np.float32))]
    v = vectors_frame(spark, rows)
    got = defaultdict(list)
    for r in neighbours.nearest(v, v.where("vec_id % 50 = 0"), block=200, tables=4, degree=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = plain_nearest(rows, range(0, 3000, 50))
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    true = {(q, i): s for q in want for i, s in want[q]}
    assert all(abs(s - true[q, i]) < 1e-12 for q in got for i, s in got[q] if (q, i) in true)


def test_recall_on_the_given_vectors(spark):
    got = queries.op13_nearest_neighbours(spark, "/root/testdata/sf0.01").collect()
    rows = [(r.vec_id, np.array(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = plain_nearest(rows, [i for i, _ in rows if i % 50 == 0])
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == {(q, n, i) for q, x in want.items() for n, (i, _) in enumerate(x, 1)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [1, 0]), (2, [2, 0]), (3, [0, 1]), (4, [-1, 0]), (5, None), (6, []), (7, [0, 0]), (8, [nan, 1]), (9, [inf, 1]), (10, [None, 1]), (None, [1, 0]), (11, [1, 1, 1]), (50, [1, 1]), (100, [3, 3]), (150, [1, 2, 3]), (200, [0, 0]), (250, [5]), (12, [1, 0]), (13, [1, 0]), (14, [1, 0]), (15, [1, 0]), (16, [1, 0]), (3, [0, 1])]
    v = vectors_frame(spark, rows)
    got = defaultdict(list)
    for r in neighbours.nearest(v, v.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    assert got[0] == [(1, 1.0), (2, 1.0), (12, 1.0), (13, 1.0), (14, 1.0)]
    half = round(math.sqrt(0.5), 9)
    assert got[50][0] == (100, 1.0) and got[50][1:] == [(0, half), (1, half), (2, half), (3, half)]
    assert got[150] == [(11, round(6 / math.sqrt(42), 9))]
    assert set(got) == {0, 50, 100, 150}
    assert neighbours.nearest(v.where("1 = 0"), v.where("1 = 0")).count() == 0


def test_many_copies_and_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16).astype(np.float32)
    rows = [(i, base) for i in range(400)] + [(i, base + rng.standard_normal(16).astype(np.float32) * 3e-2) for i in range(400, 700)] + [(i, rng.standard_normal(16).astype(np.float32)) for i in range(700, 1000)]
    v = vectors_frame(spark, rows)
    got = defaultdict(list)
    for r in neighbours.nearest(v, v.where("vec_id % 50 = 0"), block=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got[50] == [0, 1, 2, 3, 4] and got[0] == [1, 2, 3, 4, 5]
    want = plain_nearest(rows, range(400, 1000, 50))
    assert sum(len(set(got[q]) & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)

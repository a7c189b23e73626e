"""Graph candidates, mentions, flat JSON, dropped records, published lines, progress and cells against plain versions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import jsonpath, replies
from quillmesh.operators import candidates, graph, memory, mentions, progress
from quillmesh.plans import catalogue, exports, views  # noqa: F401
from quillmesh.sources import committed, quarantine
from quillmesh.streaming import steering_state


# Graph candidates -----------------------------------------------------------


def registry(n, seed, generic):
    rng = random.Random(seed)
    pool = ["query", "limit", "name", "date", "city"] + (["id", "item_id"] if generic else [])
    nouns = ["user", "order", "hotel", "flight", "gear", "bus"]
    out = []
    for i in range(n):
        own = sorted({p for p in pool if rng.random() < 0.35} | {f"{rng.choice(nouns)}_{rng.choice(['id', 'name', 'kind'])}" for _ in range(rng.randrange(3))})
        out.append((f"t{rng.randrange(9)}/e{i:04d}", f"tool{rng.randrange(9)}", rng.choice(["a", "a", "a", "b"]), rng.choice(["search", "get", "create", None]), rng.choice(nouns), own))
    return out


def plain_targets(nodes, most):
    out = set()
    for i, tool, cat, verb, noun, params in nodes:
        scored = []
        for j, tool2, cat2, _, noun2, params2 in nodes:
            if cat2 == cat and tool2 != tool:
                shared = len(set(params) & set(params2))
                io = bool({f"{noun}_id", f"{noun}id", f"{noun}_name", "id", "item_id", "resource_id"} & set(params2)) or (shared >= 2 and verb in ("search", "get"))
                scored.append((-(shared + 2 * (noun == noun2) + 5 * io), j, io))
        out |= {(i, j, io, -s) for s, j, io in sorted(scored)[:most]}
    return out


@pytest.mark.parametrize(("n", "generic", "most", "head"), [(150, False, 5, 64), (300, True, 7, 3), (60, True, 30, 64), (1, False, 5, 64)])
def test_best_targets_equal_all_pairs(spark, monkeypatch, n, generic, most, head):
    monkeypatch.setattr(candidates, "HEAD", head)
    rows = registry(n, n, generic)
    found = candidates.best_targets(spark.createDataFrame(rows, "id string, tool_name string, category string, verb string, noun string, params array<string>"), most)
    assert {tuple(r) for r in found.select("source", "target", "io", "score").collect()} == plain_targets(rows, most)


def test_long_lists_that_cannot_reach_the_threshold_are_not_read(spark):
    """A parameter that all 600 endpoints have must not make pairs where rarer terms decide."""
    rows = [(f"e{i:04d}", f"tool{i % 40}", "a", "create", f"noun{i % 30}", ["limit", f"noun{(i + 1) % 30}_id"]) for i in range(600)]
    nodes = spark.createDataFrame(rows, "id string, tool_name string, category string, verb string, noun string, params array<string>")
    found = candidates.best_targets(nodes, 10)
    assert {tuple(r) for r in found.select("source", "target", "io", "score").collect()} == plain_targets(rows, 10)
    terms = F.array(*(F.struct(F.lit(n).cast("long").alias("rows"), F.lit(t).alias("term"), F.lit(p).alias("p"), F.lit(0).alias("n"), F.lit(io).alias("io")) for n, t, p, io in [(600, "p:limit", 1, False), (20, "p:x_id", 0, True)]))
    read = spark.range(1).select(candidates.essential(terms, F.lit(False), F.lit(6)).alias("high"), candidates.essential(terms, F.lit(False), F.lit(1)).alias("low")).head()
    assert read.high == ["p:x_id"] and set(read.low) == {"p:limit", "p:x_id"}


def test_components_of_a_long_path(spark):
    n = 300
    ids = spark.createDataFrame([(f"{i:03d}",) for i in range(n)], "id string")
    e = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(n - 1) if i != 149], "source string, target string")
    assert {(r.id, r.component) for r in graph.components(ids, e).collect()} == {(f"{i:03d}", "000" if i < 150 else "150") for i in range(n)}


# Mentions -------------------------------------------------------------------


@pytest.mark.parametrize(("block", "part"), [(100_000, 1 << 27), (2, 40)])
def test_first_mentions_equal_contains(spark, block, part):
    rng = random.Random(5)
    values = [(c, v) for c in range(6) for v in ["7", "17", "Über", "a b", "zz", "", None, "ABC", "bc", *(str(rng.randrange(300)) for _ in range(8))]] + [(0, "7")]
    texts = [(c, t, " ".join(rng.choice(["7x", "über", "A  b", "a b", "abc", "BC", str(rng.randrange(300)), "ﬀ"]) for _ in range(rng.randrange(9)))) for c in range(5) for t in range(12)] + [(0, 99, None), (3, 100, "")]
    found = mentions.first_mentions(spark.createDataFrame(values, "conv_id long, value string"), spark.createDataFrame(texts, "conv_id long, turn int, text string"), block, part)
    want = {}
    for c, v in values:
        turns = [t for d, t, x in texts if d == c and x and v and v.lower() in x.lower()]
        if turns:
            want[c, v.lower()] = min(turns)
    assert {(r.conv_id, r.needle): r.turn for r in found.collect()} == want


def test_messages_after_a_call_do_not_count(spark, data):
    rows = catalogue.queries()["argument_sources"](spark, data)
    by = {r.source: r.n for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert by["user_request"] and by["generated"]


# Flat JSON ------------------------------------------------------------------

DOCS = [
    '{"b":1,"a":{"z":[1,2.50,{"q":null}],"y":"{\\"k\\":1}"},"c":true,"d":"x\\ny","e":1e3,"f":12345678901234567890,"g":[],"h":{},"a.b":1,"i":"","j":0.1,"k":"true","l":"[1]"}',
    ' [1,"two",[3,{"x":"y"}],false,null]', "not json", "7", '"s"', "", None, '{"a":[1,]}', "null", "true", "[]", '{"x":' * 30 + "[[5]]" + "}" * 30,
]


def leaves(v, path="$"):
    for k, x in v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ():
        yield from leaves(x, f"{path}.{k}" if isinstance(v, dict) else f"{path}[{k}]")
    if v is not None and not isinstance(v, dict | list):
        yield path, v if isinstance(v, str) else str(v)


def test_flatten_equals_a_recursive_walk(spark):
    want = []
    for i, d in enumerate(DOCS):
        try:
            want += [(i, *x) for x in leaves(json.loads(d))] if d else []
        except ValueError:
            pass
    flat = jsonpath.flatten(spark.createDataFrame(list(enumerate(DOCS)), "i int, doc string"), "doc", "i")
    assert "Python" not in flat._jdf.queryExecution().toString()
    assert [tuple(r) for r in flat.orderBy("i", "ord").select("i", "path", "value").collect()] == want


def test_flatten_deals_documents_over_tasks_and_tells_types_of_unclear_texts(spark, tmp_path):
    """A single split of documents is opened by all tasks; what only looks like an object or a boolean stays text."""
    doc = F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "s": "{x", "t": "true", "b": true, "l": ["[", 1, null, {"n": "false"}]}'))
    spark.range(400).coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d")).select("id", doc.alias("doc"))
    flat = jsonpath.flatten(docs, "doc", "id")
    want = [("$.id", "7"), ("$.s", "{x"), ("$.t", "true"), ("$.b", "True"), ("$.l[0]", "["), ("$.l[1]", "1"), ("$.l[3].n", "false")]
    assert [(r.path, r.value) for r in flat.where("id = 7").orderBy("ord").collect()] == want and flat.count() == 2800
    firsts = {f.rsplit("/", 2)[1] for f in flat.inputFiles()}
    assert all(sum(f"/{t}/" in f for f in flat.inputFiles()) == 4 for t in firsts)


def test_flatten_evaluates_a_document_once(spark):
    times = spark.sparkContext.accumulator(0)
    doc = F.udf(lambda i: times.add(1) or f'{{"id": {i}}}')
    docs = spark.range(50).select("id", doc("id").alias("doc"))
    assert jsonpath.flatten(docs, "doc", "id").count() == 50 == times.value


def test_text_of_leaves_and_contents(spark):
    r = spark.createDataFrame([("1.0", None, '{"b": 1, "a": 2}'), ("1.50", "said", "{}"), ("True", None, "plain"), ("v1.0", None, None)], "value string, text string, body string")
    got = r.select(jsonpath.script_text(F.col("value")), jsonpath.content_text(F.col("text"), F.col("body"))).collect()
    assert [tuple(x) for x in got] == [("1", '{"a":2,"b":1}'), ("1.50", "said"), ("true", "plain"), ("v1.0", "")]


# Files ----------------------------------------------------------------------


def test_every_record_is_good_or_has_a_reason(spark):
    bodies = ["", " ", None, "{", "[1]", "3", "{}", '{"api_list": {}}', '{"api_list": []}', '{"api_list": [{"name": " "}, 3, null]}', '{"api_list": [{"name": "ok"}, {"name": ""}, "x"], "more": 1}']
    good, bad = quarantine.split(spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "path string, body string"))
    assert [(r.path, r.pos) for r in good.collect()] == [("10", 0)]
    whole = {r.path: r.reason for r in bad.where("pos is null").collect()}
    assert whole == {"0": "empty", "1": "empty", "2": "empty", "3": "not_json", "4": "not_an_object", "5": "not_an_object", "6": "no_api_list", "7": "no_api_list", "8": "no_valid_api", "9": "no_valid_api"}
    assert {(r.path, r.pos): r.reason for r in bad.where("pos is not null").collect()} == {("9", 0): "api_without_name", ("9", 1): "api_not_an_object", ("9", 2): "api_not_an_object", ("10", 1): "api_without_name", ("10", 2): "api_not_an_object"}


def test_document_with_a_default(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text('{"x": ')
    read = lambda name: quarantine.json_document(spark, str(tmp_path / name), "x int", '{"x": 9}').head().x
    assert (read("a.json"), read("b.json"), read("none.json")) == (1, 9, 9)


def test_a_failed_write_leaves_the_earlier_result(spark, tmp_path):
    at = str(tmp_path / "lines")
    assert committed.read(spark, at, "id long").count() == 0
    committed.write(spark.range(100).repartition(7), at, "id")
    before = committed.manifest(at)
    lines = [json.loads(x)["id"] for name, _ in before for x in open(name)]
    assert lines == list(range(100)) and sum(n for _, n in before) == 100
    broken = spark.range(100).repartition(7).select("id", F.when(F.col("id") == 93, F.raise_error(F.lit("lost"))).otherwise(F.lit("")).cast("string").alias("x"))
    with pytest.raises(Exception, match="lost"):
        committed.write(broken, at, "id")
    assert committed.manifest(at) == before and committed.read(spark, at, "id long").count() == 100
    committed.write(spark.range(3), at, "id")
    assert committed.read(spark, at, "id long").count() == 3


def test_stream_progress_and_state_after_a_restart(spark, tmp_path):
    rows = spark.createDataFrame([(f"c{i}", f"t{i % 3}/get_x", "get_x", "A") for i in range(40)] + [(f"c{i}", "t9/create_y", "create_y", "B") for i in range(0, 40, 2)], "conv_id string, endpoint_id string, endpoint string, category string")
    records = steering_state.records(rows, 4)
    heard = progress.Progress()
    path, at = str(tmp_path / "r"), str(tmp_path / "s")
    records.where("hash(conv_id) % 2 = 0").repartition(2).write.parquet(path)
    steering_state.steered(spark, path, records.schema, at)
    first = {(r.kind, r.label): r.n for r in steering_state.counters(spark, at).collect()}
    records.where("hash(conv_id) % 2 <> 0").write.mode("append").parquet(path)
    steering_state.steered(spark, path, records.schema, at)
    got = {(r.kind, r.label): r.n for r in steering_state.counters(spark, at).collect()}
    assert 0 < first["conversations", ""] < 40 and got["conversations", ""] == 40
    assert got["domain", "A"] == 40 and got["domain", "B"] == 20 and got["pattern", "single_step"] == 20 and got["pattern", "search_and_act"] == 20
    assert sum(n for (kind, _), n in got.items() if kind == "pair") == 20
    advice = spark.read.parquet(f"{at}/guidance").collect()
    assert advice and all(r.prefer in ("A", "B") and r.conversations <= 40 for r in advice)
    assert heard.failed == []


def test_steering_batches_do_not_grow_with_files(spark, tmp_path):
    rng, want, rows = random.Random(3), {}, []
    for i in range(60):
        called = [f"t/e{rng.randrange(6)}" for _ in range(rng.randrange(1, 9))]
        rows += [(f"c{i}", e, e[2:], "A") for e in called]
        for j, a in enumerate(called):
            for b in called[j + 1 :]:
                label = f"{min(a, b)} + {max(a, b)}"
                want[label] = want.get(label, 0) + 1
    records = steering_state.records(spark.createDataFrame(rows, "conv_id string, endpoint_id string, endpoint string, category string"), 4)
    path, at = str(tmp_path / "r"), str(tmp_path / "s")
    for i in range(9):
        records.where(f"pmod(hash(conv_id), 9) = {i}").coalesce(1).write.mode("append").parquet(path)
    steering_state.steered(spark, path, records.schema, at)
    got = {(r.kind, r.label): r.n for r in steering_state.counters(spark, at).collect()}
    assert got["conversations", ""] == 60 and {x: n for (kind, x), n in got.items() if kind == "pair"} == want
    assert len([p for p in (tmp_path / "s" / "state" / "commits").iterdir() if p.name.isdigit()]) <= steering_state.BATCHES


def test_listener_hears_of_batches(spark, tmp_path):
    heard = progress.Progress()
    spark.streams.addListener(heard)
    try:
        spark.range(50).write.parquet(str(tmp_path / "in"))
        spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("noop").queryName("heard").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        for _ in range(100):
            if any(n == "heard" for n, _, _ in heard.batches):
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(heard)
    assert sum(rows for n, _, rows in heard.batches if n == "heard") == 50


def test_stages_tell_their_rows(spark):
    told = []
    rows, seen = progress.staged(spark.range(100), {"even": lambda x: x.where("id % 2 = 0"), "none": lambda x: x.where("false"), "again": lambda x: x}, lambda *x: told.append(x))
    assert rows.count() == 0 and told == [("even", 100, 50), ("none", 50, 0), ("again", 0, 0)]
    assert [tuple(r) for r in seen.orderBy("place").collect()] == [(0, "even", 100, 50), (1, "none", 50, 0), (2, "again", 0, 0)]


def test_cells_find_what_all_vectors_give(spark, data):
    q = catalogue.queries()
    exact = {(r.query_id, r.vec_id) for r in q["memory_topk"](spark, data).collect()}
    found = {(r.query_id, r.vec_id) for r in q["memory_cells"](spark, data).collect()}
    assert len(exact & found) >= 0.9 * len(exact)
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, []), (5, [1.0, 2.0, 3.0]), (6, [0.0, 1.0]), (7, [1.0, 2.0, 3.1])], "vec_id long, embedding array<float>")
    got = memory.Cells(v, 2, most=1).search(v.where("vec_id in (1, 5)"), 3, 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(1, 2), (1, 6), (5, 7)]


def test_the_timeline_makes_its_calls_once(spark, data):
    files = catalogue.queries()["trace_timeline"](spark, data).inputFiles()
    assert files and not any(f.endswith("events.parquet") for f in files)


def test_profiles_and_lists(spark):
    r = spark.createDataFrame([(" Hybrid-Live ", []), ("live", ["a"]), ("FAST", list("abcdefg")), (None, None)], "p string, x array<string>")
    got = [tuple(x) for x in r.select(replies.is_hybrid(F.col("p")), replies.listed(F.col("x"), 5)).collect()]
    assert got == [(True, "none"), (False, "a"), (True, "a,b,c,d,e+2"), (None, "none")]

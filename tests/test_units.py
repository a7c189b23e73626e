"""Functions and operators on small hand-made cases."""

import json

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import classify, jsonpath, text
from quillmesh.operators import conversation, diversity, executor, graph, judge, memory, registry, repair, sampler, steering, traces
from quillmesh.plans.runtime import written
from quillmesh.sources import files
from quillmesh.streaming import coverage


def apply(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(f(F.col("x"))).collect()]


def test_names(spark):
    assert apply(spark, classify.verb, "search_hotels", "GET_x", "book_hotel", "get_all_x", "listing", "track") == ["search", "get", "create", "search", "search", None]
    assert apply(spark, classify.noun, "search_hotels", "list_categories", "search_buses", "get_class", "reserve_seats") == ["hotel", "category", "buse", "class", "reserve_seat"]
    assert apply(spark, classify.entity_name, "get_item_details", "reserve_seats", "get_") == ["item", "seat", "item"]
    assert apply(spark, classify.operation, "target_list", "cancel_order", "reset", "noop") == ["search", "delete", "update", "generic"]
    assert apply(spark, classify.parameter_type, None, " INT ", "text", "weird", "JSON") == ["string", "integer", "string", "unknown", "object"]
    assert apply(spark, classify.http_method, None, " post ", "HEAD") == ["GET", "POST", "GET"]
    assert apply(spark, lambda c: classify.entity_type(c, F.lit("Create payment for an order.")), "create_payment", "x") == ["order", "order"]


def test_text(spark):
    assert apply(spark, lambda c: text.shorten(c, 10), "a  b\nc", "abcdefg hijkl") == ["a b c", "abcdefg..."]
    assert apply(spark, lambda c: text.shorten_at_sentence(c, 20), "One two three. Four five six.", "No end in this rather long text") == ["One two three.", "No end in this rat..."[:17] + "..."]
    assert apply(spark, text.safe_name, "a b/c", "..", "ok-1_2.x") == ["a_b_c", "unnamed", "ok-1_2.x"]
    assert apply(spark, text.safe_path, "../a/./b c/x.json", "/..") == ["a/b_c/x.json", "unnamed.json"]
    assert apply(spark, text.soften, "get a room", "search a", "do it", "") == ["look up a room", "look for a", "do it", text.NOTHING]
    names = F.array(F.struct(F.lit("hotel_api/search").alias("raw"), F.lit("find $1 room").alias("plain")))
    assert apply(spark, lambda c: text.sanitize(c, names), "Use HOTEL_API/search tools via API") == ["Use find $1 room steps via service"]
    lists = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (["a", "b", "c"],)], "x array<string>")
    assert [r[0] for r in lists.select(text.join_naturally(F.col("x"))).collect()] == ["details", "a", "a and b", "a, b, and c"]
    assert [r[0] for r in lists.select(text.join_sentences(F.col("x"))).collect()] == ["I can share whatever details you need.", "a.", "a. b.", "a. b. c."]
    assert apply(spark, text.parameter_label, "item_id", "hotel_id", "check_in", "party_size", "max_price") == ["reference", "hotel reference", "check-in date", "party size", "budget"]


def test_json(spark):
    doc = json.dumps({"results": [{"id": "h1", "ok": True}, {"id": "h2", "tags": ["a", None]}], "page": 1})
    flat = jsonpath.flatten(spark.createDataFrame([(1, doc), (2, "no json"), (3, None)], "k int, d string"), "d", "k")
    assert [(r.k, r.path, r.value) for r in flat.orderBy("ord").collect()] == [(1, "$.results[0].id", "h1"), (1, "$.results[0].ok", "True"), (1, "$.results[1].id", "h2"), (1, "$.results[1].tags[0]", "a"), (1, "$.page", "1")]
    assert jsonpath.first_reference(flat, "k").first().reference == "h1"
    fence = "`" * 3
    said = [f'{fence}json\n{{"action":"tool_call","endpoint":"a/b","arguments":{{"x":1}}}}\n{fence}', '{"action":"tool_call","endpoint":"a/b","arguments":[1]}', "no"]
    assert [r and (r.endpoint, r.arguments) for r in apply(spark, jsonpath.tool_call, *said)] == [("a/b", '{"x":1}'), None, None]
    assert apply(spark, lambda c: jsonpath.judge_score(c, "n"), '{"n":{"score":4.5}}', '{"n":9}', "{}", '{"n":"x"}') == [4.5, 5.0, 3.0, 3.0]


@pytest.fixture
def tool_folder(tmp_path):
    api = lambda name, **more: {"name": name, "description": "d", "method": "get", **more}
    hotel = {"tool_name": " hotel_api ", "api_list": [api("search", required_parameters=[{"name": "city", "type": "STR", "default": ""}], optional_parameters={"limit": {"type": "int", "default": "1"}, "sort": "string"}), api("search "), api(""), {"name": "plain", "optional_parameters": "bad", "response": {"id": "x"}}]}
    for path, body in (("Travel/hotel.json", json.dumps(hotel)), ("Travel/deep/er.json", json.dumps({"title": "deep", "api_list": [api("x")]})), ("Travel/.hidden/no.json", json.dumps(hotel)), ("Food/bad.json", "{no"), ("Food/none.json", json.dumps({"api_list": []})), ("root.json", json.dumps({"api_list": [api("r")]}))):
        (tmp_path / "tools" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "tools" / path).write_text(body)
    return str(tmp_path / "tools")


def test_tool_files(spark, tool_folder):
    rows = files.api_columns(files.tool_files(spark, tool_folder)).orderBy("path", "pos").collect()
    assert {(r.category, r.tool_name, r.endpoint_name) for r in rows} == {("Travel", "hotel_api", "search"), ("Travel", "hotel_api", "plain"), ("Travel", "deep", "x"), ("Uncategorized", "root", "r")}
    first = next(r for r in rows if r.endpoint_name == "search" and r.required)
    assert first.required[0].default is None and [(p.name, p.raw_type) for p in first.optional] == [("limit", "int"), ("sort", "string")]
    assert next(r for r in rows if r.endpoint_name == "plain").response_schema == '{"id":"x"}'
    assert {r.category for r in files.tool_files(spark, tool_folder, ["Food"]).collect()} == {"Uncategorized"}
    dup = registry.unique_names(spark.createDataFrame([r.asDict() for r in rows], "tool_name string, endpoint_name string, pos int"), "tool_name", "endpoint_name", F.col("pos"))
    assert {r.unique_name for r in dup.collect()} >= {"search", "search_dup1"}


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "i int, t string")
    at = str(tmp_path / "x")
    files.write_json_lines(df, at, "i")
    assert files.json_lines(spark, at, "i int, t string").count() == 2 == files.count_records(spark, at)
    assert files.json_lines(spark, str(tmp_path / "missing"), "i int").count() == 0
    assert {r.part for r in files.bundle(a=df, b=df).collect()} == {"a", "b"}
    edges = spark.createDataFrame([("a[1]", "b", "io_chain")], "source string, target string, edge_type string")
    files.write_diagram(edges, str(tmp_path / "d"))
    assert any("a(1) -->|io_chain| b" in r.value for r in spark.read.text(str(tmp_path / "d")).collect())
    e = spark.createDataFrame([("Travel", "t", "x")], "category string, tool_name string, endpoint_name string")
    files.write_tools(e, str(tmp_path / "tools"))
    files.write_tools(e.where("false"), str(tmp_path / "tools"))
    assert spark.read.json(str(tmp_path / "tools")).count() == 1


def calls(spark, rows):
    return spark.createDataFrame([(c, s, e, e.split("/")[0], e.split("/")[1], cat) for c, s, e, cat in rows], "conv_id string, step long, endpoint_id string, tool string, endpoint string, category string")


def test_diversity_and_steering(spark):
    c = calls(spark, [(x, s, e, "Travel") for x in "abc" for s, e in ((1, "hotel/search"), (2, "flight/book"))] + [("d", 1, "p/search", "Commerce")])
    assert [(r["first"], r["second"], r.n) for r in diversity.tool_pairs(c).collect()] == [("flight/book", "hotel/search", 3)]
    assert [(r["first"], r["second"]) for r in steering.overused_pairs(diversity.tool_pairs(c)).collect()] == [("flight/book", "hotel/search")]
    available = spark.createDataFrame([("Travel",), ("Food",), ("Commerce",)], "category string")
    assert {r.category for r in steering.underused_domains(available, diversity.domain_counts(c)).collect()} == {"Food"}
    same = spark.createDataFrame([("Travel", 2), ("Food", 2), ("Commerce", 2)], "category string, conversations long")
    assert steering.underused_domains(available, same).count() == 3
    assert {r.pattern for r in diversity.patterns(c).collect()} == {"search_and_act", "single_step"}
    loop = calls(spark, [("a", 1, "x/get", "T"), ("a", 2, "x/get", "T"), ("a", 3, "x/get", "T")])
    assert [r.n for r in diversity.tool_pairs(loop).collect()] == [3]


def endpoints(spark):
    rows = [("hotel/search_hotels", "hotel", "search_hotels", "Travel", ["city", "date"]), ("hotel/get_hotel", "hotel", "get_hotel", "Travel", ["hotel_id"]), ("hotel/book_hotel", "hotel", "book_hotel", "Travel", ["hotel_id", "date"]), ("flight/search_flights", "flight", "search_flights", "Travel", ["city", "date"]), ("shop/list_items", "shop", "list_items", "Shop", ["q"])]
    return spark.createDataFrame([(*r[:4], "", r[4], r[4][:1]) for r in rows], "endpoint_id string, tool_name string, endpoint_name string, category string, description string, params array<string>, required array<string>")


def test_graph(spark):
    e = endpoints(spark)
    found = {(r.source, r.target): r for r in graph.edges(graph.relations(e)).collect()}
    one = found["hotel/search_hotels", "hotel/get_hotel"]
    assert one.edge_type == "io_chain" and one.edge_types == "complementary,io_chain,same_tool" and one.weight == 1.0
    assert found["flight/search_flights", "hotel/search_hotels"].edge_type == "io_chain"  # shared parameters
    assert found["hotel/get_hotel", "flight/search_flights"].edge_type == "same_category"
    capped = graph.relations(e, mesh=1, neighbours=1).where("edge_type = 'same_category'").collect()
    assert {(r.source, r.target) for r in capped if r.source.startswith("flight")} == {("flight/search_flights", "hotel/search_hotels")}
    ids = e.select(F.col("endpoint_id").alias("id"))
    assert {r.component for r in graph.components(ids, graph.edges(graph.relations(e))).collect()} == {"flight/search_flights", "shop/list_items"}
    path = spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(100)], "source string, target string")
    ends = graph.components(spark.createDataFrame([(f"{i:03}",) for i in range(101)], "id string"), path)
    assert {r.component for r in ends.collect()} == {"000"}


def test_sampler(spark):
    e = endpoints(spark)
    edge = graph.edges(graph.relations(e))
    ids = spark.createDataFrame([(i,) for i in range(200)], "chain_id long")
    walked = sampler.walks(ids, e, edge, 1, 3, 2)
    assert sorted(map(tuple, walked.collect())) == sorted(map(tuple, sampler.walks(ids.repartition(5), e, edge, 1, 3, 2).collect()))
    rows = walked.collect()
    known = {(r.source, r.target) for r in edge.collect()}
    assert len(rows) == 400 and all(len(set(r.path)) == len(r.path) and all((a, b) in known for a, b in zip(r.path, r.path[1:], strict=False)) for r in rows)
    d = sampler.described(walked, e)
    ok = sampler.first_passing(d, sampler.violations(2, 3, 2, ["Travel"], ["flight/search_flights"])).collect()
    assert all(2 <= r.steps <= 3 and r.tools >= 2 and "flight/search_flights" not in r.path for r in ok)
    assert sampler.relaxed(d, [sampler.violations(9, 9), sampler.violations(1, 3)]).where("tier = 1").count() == 200
    assert [r.forced for r in sampler.quota(ids.limit(4), 0.55, 4).orderBy("chain_id").collect()] == [True, True, False, False]
    talk = conversation.conversations(d.where("attempt = 1").select("chain_id", "path"), e)
    end = talk.groupBy("conv_id").agg(F.max_by("text", "turn").alias("t"), F.count("*").alias("n")).collect()
    assert len(end) == 200 and all(r.t.startswith("Done") for r in end)
    prose = [r.text for r in talk.where("role = 'user'").collect()]
    assert not any(x in p for p in prose for x in ("search_hotels", "hotel/", "get_hotel"))


def test_executor_echoes_ids(spark):
    rows = [(1, "h/get_hotel", "get_hotel", "", {"hotel_id": "htl_1"}), (2, "h/book_hotel", "book_hotel", "", {}), (3, "h/search_hotels", "search_hotels", "", {}), (4, "h/cancel_hotel", "cancel_hotel", "", {})]
    got = {r.call_id: r for r in executor.execute(spark.createDataFrame(rows, "call_id int, endpoint_id string, endpoint_name string, description string, arguments map<string,string>")).collect()}
    assert got[1].result_id == "htl_1" and json.loads(got[1].result)["id"] == "htl_1"
    assert got[2].status == "confirmed" and got[2].result_id.startswith("htl_") and json.loads(got[2].result)["confirmation_id"].startswith("bk_")
    assert 2 <= got[3].results <= 5 == len(json.loads(got[3].result)["results"]) + 5 - got[3].results and got[4].result_id == "unknown"


def test_judge_and_repair(spark):
    m = spark.createDataFrame([("a", 0, "user", "hi"), ("a", 1, "assistant", "which?"), ("a", 2, "user", "x"), ("a", 3, "assistant", "Done, reference 1"), ("b", 0, "user", "hi")], "conv_id string, turn long, role string, text string")
    c = spark.createDataFrame([("a", 1, "1", 0), ("a", 2, "9", 0), ("a", 3, "2", 1)], "conv_id string, step long, k string, structural int")
    r = spark.createDataFrame([("a", 1, ["2"]), ("a", 2, [])], "conv_id string, step long, ids array<string>")
    s = {x.conv_id: x for x in judge.scores(c, r, m).collect()}
    assert (s["a"].tool_correctness, s["a"].naturalness, s["a"].task_completion) == (5 - 1 - 0.75 - 0.5, 4.5, 5.0)
    assert (s["b"].tool_correctness, s["b"].naturalness, s["b"].task_completion) == (3.0, 3.0, 3.0)
    t = spark.createDataFrame([("a", 0, "user", "u", 0), ("a", 1, "assistant", None, 0), ("a", 2, "assistant", "x", 0), ("a", 3, "assistant", None, 2), ("a", 4, "assistant", "y", 1), ("a", 5, "assistant", "z", 0), ("a", 6, "robot", "q", 0)], "conv_id string, turn long, role string, text string, calls int")
    kept = [(x.turn, x.text, x.calls) for x in repair.folded(repair.valid(t)).orderBy("turn").collect()]
    assert kept == [(0, "u", 0), (2, "x\ny", 1), (5, "z", 0)]
    a = spark.createDataFrame([("a", 0, 2.0), ("a", 1, 4.1), ("a", 2, 5.0), ("b", 0, 3.0), ("b", 1, 3.0)], "conv_id string, attempt long, overall double")
    assert {(x.conv_id, x.attempt, x.passes) for x in repair.best_attempt(a, 4.0).collect()} == {("a", 1, True), ("b", 0, False)}


def test_argument_sources(spark):
    args = spark.createDataFrame([("a", 2, "h/get", "id", "h1"), ("a", 2, "h/get", "city", "Rome"), ("a", 2, "h/get", "cur", "USD"), ("a", 2, "h/get", "z", "q"), ("a", 3, "h/book", "id", "h1"), ("a", 3, "h/book", "e", "")], "conv_id string, step long, endpoint_id string, name string, value string")
    res = spark.createDataFrame([("a", 1, "h/search", 4, "$.b", "h1"), ("a", 1, "h/search", 0, "$.results[0].id", "h1"), ("a", 2, "h/get", 0, "$.id", "h1")], "conv_id string, step long, endpoint_id string, ord int, path string, value string")
    req = spark.createDataFrame([("a", 0, "a room in ROME please")], "conv_id string, turn int, text string")
    dfl = spark.createDataFrame([("h/get", "cur", "USD")], "endpoint_id string, name string, default string")
    got = {(r.step, r.name): r for r in traces.argument_sources(args, res, req, dfl).collect()}
    assert got[2, "id"].evidence == "matched $.results[0].id from h/search" and got[3, "id"].source_endpoint == "h/get"
    assert [got[2, n].source for n in ("city", "cur", "z")] == ["user_request", "tool_default", "generated"] and got[3, "e"].source == "generated"


def test_memory_and_stream(spark, tmp_path, data):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, None)], "vec_id long, embedding array<float>")
    for block in (1, 10):
        got = memory.nearest(v, v, 1, block).orderBy("query_id").collect()
        assert [(r.query_id, r.vec_id) for r in got] == [(1, 2), (2, 1), (3, 2)]
    schema = spark.read.parquet(f"{data}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(data)
    q = coverage.windowed(stream, "ts", "1 hour", "1 day", "event_type").writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("w").agg(F.sum("n")).first()[0] == 1000


def test_paged_source(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.parse import parse_qs, urlparse

    from quillmesh.sources import paged

    apis = [json.dumps({"name": f"hotel_search{i}", "category": "Travel"}) if i % 5 else "{bad" for i in range(23)]
    refused = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = parse_qs(urlparse(self.path).query)
            a, n = int(q["offset"][0]), int(q["length"][0])
            if a == 10 and not refused:
                refused.append(1)
                self.send_response(403)
                self.send_header("Retry-After", "0")
                self.end_headers()
                return
            body = json.dumps({"rows": [{"row": {"text": x}} for x in apis[a : a + n]], "num_rows_total": len(apis)}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = paged.paged_rows(spark, f"http://127.0.0.1:{server.server_port}/rows?dataset=x", length=5).cache()
    assert rows.count() == 23 and rows.rdd.getNumPartitions() == 5 and refused
    tools = paged.tool_rows(rows).collect()
    assert len(tools) == 18 and {(t.tool_name, t.category) for t in tools} == {("hotel", "Travel")}
    server.shutdown()


def test_walks_in_tasks_equal_walks_by_joins(spark, monkeypatch):
    verbs = ["search", "get", "create", "update", "delete", "track"]
    rows = [(f"tool{t}/{v}_{n}", f"tool{t}", f"{v}_{n}", "ABC"[t % 3] if t < 8 else None, "", ["id", f"{n}_id", "q"], ["id"]) for t in range(9) for v in verbs for n in ("cup", "pan")]
    e = spark.createDataFrame(rows + [("alone/x", "alone", "x", "D", "", [], [])], endpoints(spark).schema)
    edge = graph.edges(graph.relations(e))
    ids = spark.createDataFrame([(str(i),) for i in range(400)] + [("a",)], "chain_id string")
    plain = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    tiers = [sampler.Limits(3, 5, 2, ["A"], ["tool0/get_cup"], ["crud_cycle", "search_and_act"]), sampler.Limits(3, 5, 2), sampler.Limits(2, 9)]
    edge = written(edge)
    for more in ({"start_in": ["B", "D"]}, {"excluded": ["tool1/get_cup", "tool2/search_pan"]}):
        got = sampler.described_walks(ids, e, edge, 1, 5, 2, **more), sampler.retried(ids, e, edge, tiers, 1, 5, 6, **more)
        assert all("MapInArrow" in x._jdf.queryExecution().toString() for x in got)
        with monkeypatch.context() as m:
            m.setattr(sampler.walker, "EDGES", 10)
            want = sampler.described_walks(ids, e, edge, 1, 5, 2, **more), sampler.retried(ids, e, edge, tiers, 1, 5, 6, **more)
            assert not any("MapInArrow" in x._jdf.queryExecution().toString() for x in want)
        assert [plain(x) for x in got] == [plain(x) for x in want]


def test_traces_are_dealt_by_their_rows(spark, data, monkeypatch):
    from quillmesh.plans import adapters, runtime

    monkeypatch.setattr(runtime, "TASK_ROWS", 1000)
    plan = adapters.traces(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and adapters.traces(spark, data).count() > 0

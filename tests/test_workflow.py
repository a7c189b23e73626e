"""From tool files to judged conversations."""

import json

from pyspark.sql import functions as F

from quillmesh.plans import workflow
from quillmesh.sources import files


def test_workflow(spark, tmp_path):
    for category, tools in {"Travel": ["hotel", "flight"], "Commerce": ["shop", "order"], "Food": ["recipe"]}.items():
        for t in tools:
            api = [{"name": f"{v}_{t}{'s' if v == 'search' else ''}", "description": f"{v.title()} a {t}.", "required_parameters": [{"name": f"{t}_id" if v != "search" else "query", "type": "str"}], "optional_parameters": [{"name": "limit", "type": "int"}]} for v in ("search", "get", "create", "cancel")]
            (tmp_path / category).mkdir(exist_ok=True)
            (tmp_path / category / f"{t}.json").write_text(json.dumps({"tool_name": f"{t}_api", "api_list": api}))
    e = workflow.load_registry(spark, str(tmp_path)).cache()
    assert e.count() == 20 and e.select("category").distinct().count() == 3
    workflow.build(e, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/endpoints")).count() == 20
    g = workflow.build_graph(e)
    chains = workflow.generate(e, g, 100).cache()
    assert chains.count() == 100
    share = chains.where("steps >= 3 and tools >= 2").count() / 100
    assert 0.5 <= share <= 0.85
    at = str(tmp_path / "talk")
    files.write_json_lines(workflow.talks(chains, e), at, "conv_id", "turn")
    talk = files.json_lines(spark, at, "conv_id long, turn int, role string, text string, endpoint_id string")
    scores = workflow.evaluate(talk)
    assert scores.count() == 100 and scores.agg(F.avg("overall")).first()[0] >= 4.0
    assert workflow.experiment(e, g, 40).count() == 6

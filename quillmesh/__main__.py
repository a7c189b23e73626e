"""Command line: build, generate, evaluate, analyze, run-experiment, info."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quillmesh.operators import diversity, judge, registry
from quillmesh.plans import workflow
from quillmesh.plans.runtime import ship
from quillmesh.sources import files

TALK = "conv_id long, turn int, role string, text string, endpoint_id string"


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quillmesh", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "generate", "evaluate", "analyze", "run-experiment", "info"):
        s = sub.add_parser(name)
        s.add_argument("--tools", help="folder of tool files")
        s.add_argument("--input", help="conversations as JSON lines")
        s.add_argument("--output")
        s.add_argument("--count", type=int, default=100)
        s.add_argument("--seed", type=int, default=42)
        s.add_argument("--min-score", type=float, default=3.5)
    a = p.parse_args(argv)
    spark = ship(SparkSession.builder.appName("quillmesh").getOrCreate())
    if a.command in ("evaluate", "analyze"):
        talk = files.json_lines(spark, a.input, TALK)
        if a.command == "evaluate":
            scored = workflow.evaluate(talk)
            if a.output:
                files.write_json_lines(scored, a.output, "conv_id")
            judge.quality_gate(scored, a.min_score).show(truncate=False)
            return
        endpoints = workflow.load_registry(spark, a.tools)
        calls = talk.where("role = 'assistant' and endpoint_id is not null").withColumnRenamed("turn", "step").join(endpoints.selectExpr("endpoint_id", "tool_name AS tool", "endpoint_name AS endpoint", "category"), "endpoint_id")
        found = diversity.metrics(calls)
        if a.output:
            files.write_json_lines(found, a.output)
        found.show(truncate=False)
        return
    endpoints = workflow.load_registry(spark, a.tools)
    if a.command == "build":
        workflow.build(endpoints, a.output)
    elif a.command == "info":
        registry.statistics(endpoints, endpoints).show(truncate=False)
        registry.by_category(endpoints).orderBy("category").limit(15).show(truncate=False)
    elif a.command == "generate":
        chains = workflow.generate(endpoints, workflow.build_graph(endpoints), a.count, a.seed)
        files.write_json_lines(workflow.talks(chains, endpoints), a.output, "conv_id", "turn")
    else:
        workflow.experiment(endpoints, workflow.build_graph(endpoints), a.count, a.seed).orderBy("metric").show(truncate=False)


if __name__ == "__main__":
    main()

"""Analytics over tool-use conversations, as Spark jobs: registries, graphs, sampling, judging, steering, diversity."""

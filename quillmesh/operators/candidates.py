"""The best targets of each endpoint among all others of its category, without pairs of a whole category.

Targets with one noun and one set of parameters score alike, so they are one entry of an inverted index from
(category, term) to entries, terms being parameters and nouns. A source asks for the terms that can give it points: its own parameters
(1 each), its noun (2), and names that would take its output, or two shared parameters if it reads (5, once).

The search has two rounds. The heads of the lists that a source asks for give scores at once, and with them a
threshold: the score that ``most`` targets of other tools reach. Then the longest lists are left out as long as
all that they could give together is less than the threshold, as whatever lies in them alone can't be among the best; the rest are
read whole. What is compared grows with the rarer terms that endpoints share, not with the square of a category.
Where fewer targets than ``most`` score, the first by id fill up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.plans.runtime import written

#: Entries of a list that are tried first.
HEAD = 64


def wanted(noun: Column) -> Column:
    """Parameters that would take the output of a source with this noun."""
    return F.array(F.concat(noun, F.lit("_id")), F.concat(noun, F.lit("id")), F.concat(noun, F.lit("_name")), F.lit("id"), F.lit("item_id"), F.lit("resource_id"))


def spread(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """The first ``2 * most`` rows of each key by id, at most ``most`` of one tool: without any one tool, ``most`` are left if there are as many."""
    tool = F.row_number().over(Window.partitionBy(*keys, "tool_name").orderBy("id"))
    some = rows.withColumn("at", tool).where(F.col("at") <= most)
    return some.withColumn("at", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).where(F.col("at") <= 2 * most).drop("at")


def entries(nodes: DataFrame, most: int) -> DataFrame:
    """category, entry (its least id), noun, params, members (id, tool_name), by id."""
    keys = ["category", "noun", "params"]
    members = spread(nodes.select("id", "tool_name", *keys), most, *keys)
    grouped = members.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("id", "tool_name"))).alias("members"))
    return grouped.select(*keys, F.col("members")[0]["id"].alias("entry"), "members")


def postings(found: DataFrame) -> DataFrame:
    """category, term, entry, noun, params, members."""
    terms = F.concat(F.transform("params", lambda p: F.concat(F.lit("p:"), p)), F.array(F.concat(F.lit("n:"), F.col("noun"))))
    return found.select("category", F.explode(F.array_distinct(terms)).alias("term"), "entry", "noun", "params", "members")


def asked(nodes: DataFrame) -> DataFrame:
    """source, category, own (tool_name, noun, params, reads), term, p, n, io: what a term can give a source."""
    own = F.transform("params", lambda p: F.struct(F.concat(F.lit("p:"), p).alias("term"), F.lit(1).alias("p"), F.lit(0).alias("n"), F.lit(False).alias("io")))
    noun = F.array(F.struct(F.concat(F.lit("n:"), F.col("noun")).alias("term"), F.lit(0).alias("p"), F.lit(1).alias("n"), F.lit(False).alias("io")))
    takes = F.transform(wanted(F.col("noun")), lambda p: F.struct(F.concat(F.lit("p:"), p).alias("term"), F.lit(0).alias("p"), F.lit(0).alias("n"), F.lit(True).alias("io")))
    what = F.struct("tool_name", "noun", "params", F.coalesce(F.col("verb").isin("search", "get"), F.lit(False)).alias("reads"))
    rows = nodes.select(F.col("id").alias("source"), "category", what.alias("own"), F.explode(F.concat(own, noun, takes)).alias("x"))
    return rows.groupBy("source", "category", "own", "x.term").agg(F.max("x.p").alias("p"), F.max("x.n").alias("n"), F.max("x.io").alias("io"))


def scored(met: DataFrame) -> DataFrame:
    """source, own, entry, members (of other tools), io, score: each pair of a source and an entry once."""
    once = met.groupBy("source", "own", "entry").agg(F.first("noun").alias("noun"), F.first("params").alias("params"), F.first("members").alias("members"))
    shared = F.size(F.array_intersect("own.params", "params"))
    io = F.arrays_overlap(wanted(F.col("own.noun")), F.col("params")) | ((shared >= 2) & F.col("own.reads"))
    score = shared + F.when(F.col("own.noun") == F.col("noun"), 2).otherwise(0) + F.when(io, 5).otherwise(0)
    others = F.filter("members", lambda m: m["tool_name"] != F.col("own.tool_name"))
    return once.select("source", "own", "entry", others.alias("members"), io.alias("io"), score.alias("score")).where((F.size("members") > 0) & (F.col("score") > 0))


def essential(terms: Column, reads: Column, threshold: Column) -> Column:
    """The terms (struct of rows, term, p, n, io) that must be read: the longest of the others can't give ``threshold`` together."""

    def step(now: Column, x: Column) -> Column:
        p, n, io = now["p"] + x["p"], now["n"] + x["n"], now["io"] | x["io"]
        most = p + 2 * n + F.when(io | (reads & (p >= 2)), 5).otherwise(0)
        without = F.struct(p.alias("p"), n.alias("n"), io.alias("io"), now["keep"].alias("keep"))
        with_it = F.struct(now["p"].alias("p"), now["n"].alias("n"), now["io"].alias("io"), F.array_append(now["keep"], x["term"]).alias("keep"))
        return F.when(most < threshold, without).otherwise(with_it)

    none = F.struct(F.lit(0).alias("p"), F.lit(0).alias("n"), F.lit(False).alias("io"), F.array().cast("array<string>").alias("keep"))
    return F.aggregate(F.reverse(F.array_sort(terms)), none, step, lambda now: now["keep"])


def best_targets(nodes: DataFrame, most: int = 30) -> DataFrame:
    """source, target, io, score: for each node the ``most`` of its category and of other tools with the highest scores, ties to the lesser id.

    ``nodes``: id, tool_name, category, verb, noun, params (lower case).
    """
    nodes = nodes.withColumn("params", F.array_sort(F.array_distinct("params")))
    index = written(postings(entries(nodes, most)))
    ask = written(asked(nodes))
    head = F.row_number().over(Window.partitionBy("category", "term").orderBy(F.desc(F.size("members")), "entry"))
    heads = index.withColumn("at", head).where(F.col("at") <= HEAD).drop("at")
    first = scored(ask.join(heads, ["category", "term"]))
    reach = F.sum(F.size("members")).over(Window.partitionBy("source").orderBy(F.desc("score"), "entry").rowsBetween(Window.unboundedPreceding, 0))
    threshold = first.select("source", "score", reach.alias("reach")).where(F.col("reach") >= most).groupBy("source").agg(F.max("score").alias("threshold"))
    lengths = index.groupBy("category", "term").agg(F.count("*").alias("rows"))
    lists = ask.join(lengths, ["category", "term"]).groupBy("source", "category", "own").agg(F.collect_list(F.struct("rows", "term", "p", "n", "io")).alias("terms"))
    lists = lists.join(threshold, "source", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0)))
    read = lists.select("source", "category", "own", "threshold", F.explode(essential(F.col("terms"), F.col("own.reads"), F.col("threshold"))).alias("term"))
    found = scored(read.join(index, ["category", "term"])).join(threshold, "source", "left").where(F.col("score") >= F.coalesce("threshold", F.lit(0)))
    each = found.select("source", F.explode(F.slice("members", 1, most)).alias("m"), "io", "score").select("source", F.col("m.id").alias("target"), "io", "score")
    each = written(each.withColumn("at", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("score"), "target"))).where(F.col("at") <= most).drop("at"))
    full = each.groupBy("source").agg(F.count("*").alias("n"))
    short = nodes.select(F.col("id").alias("source"), "category", "tool_name").join(full, "source", "left").where(F.coalesce("n", F.lit(0)) < most)
    filler = spread(nodes.select("id", "tool_name", "category"), 2 * most, "category").groupBy("category").agg(F.array_sort(F.collect_list(F.struct("id", "tool_name"))).alias("members"))
    more = short.join(filler, "category").select("source", F.explode(F.filter("members", lambda m: m["tool_name"] != F.col("tool_name"))).alias("m"), F.coalesce("n", F.lit(0)).alias("n"))
    more = more.select("source", F.col("m.id").alias("target"), "n").join(each.select("source", "target"), ["source", "target"], "left_anti")
    more = more.withColumn("at", F.row_number().over(Window.partitionBy("source").orderBy("target"))).where(F.col("at") + F.col("n") <= most)
    return each.union(more.select("source", "target", F.lit(False), F.lit(0)))

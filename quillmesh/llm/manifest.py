"""Merkle manifest of a dataset: a content-addressed DAG of digests, from which proofs are read by descent.

Leaves are ranked within their language by a range-partitioned sort whose partitions are counted, so a language that
holds most rows is spread like any other. Runs of ``fan`` consecutive nodes become the digest of their digests, level by
level; every level's records (digest, children) are stored under their digest. A proof is read from that
store alone: requests descend from the root by the digits of their rank, those with common digits together, and
gather the children they don't take; at the leaves the gathered segments are reversed into the proof.

What meets in one place is a node's ``fan`` children. Levels shrink by ``fan``; each is a table in the shared folder, so
a lost executor loses none, and only the height of the tree reaches the driver. A row's path has at most ``fan`` - 1 digests a level, and is carried once for each run
of leaves. Equal nodes (runs of equal rows) are one record; requests for them are a skewed join that Spark may split.

Nulls: a field is "-"; a null lang is a tree of its own, before all others; a null doc_id sorts first and counts as the
empty text where its crc32 is asked. Rows of one doc_id are ordered by their leaf, and each has its own place and
proof; equal rows have equal leaves. Empty texts are "0:". Texts of any length are hashed whole. A language with one row has
that leaf as its subroot. An empty table gives an empty result. Further columns take no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.common import bucket, only, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """- for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """tree (lang), doc_id, leaf, changed: the digest of each row, and that of its row after tampering."""
    d = only(docs, *FIELDS)
    own = digest(*(framed(F.col(c)) for c in FIELDS))
    lower = digest(*(framed(F.translate(c, UPPER, LOWER) if c == "text" else F.col(c)) for c in FIELDS))
    return d.select(F.col("lang").alias("tree"), "doc_id", own.alias("leaf"), F.when(bucket("doc_id", 3) == 0, lower).otherwise(own).alias("changed"))


def ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows`` with rank (from 0, by ``order`` within ``tree``) and size (rows of the tree), written.

    ``rows`` are read twice, so texts should lie behind them. They are dealt by ranges of (tree, order) and numbered as they lie; a number less the first of its tree in its
    partition, and the counts of the partitions before, make the rank. ``tie`` deals equal rows over partitions too.
    """
    parts = max(8, rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = rows.withColumn("tie", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(parts, tree, *order, "tie").sortWithinPartitions(tree, *order, "tie").drop("tie")
    spot = written(dealt.withColumn("spot", F.monotonically_increasing_id()))
    part = F.shiftright("spot", 33)
    counted = spot.groupBy(F.col(tree).alias("of"), part.alias("part")).agg(F.min("spot").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("of")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.select("of", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    met = spot.join(counted, (part == F.col("part")) & F.col(tree).eqNullSafe(F.col("of")))
    return written(met.select(*rows.columns, (F.col("spot") + F.col("shift")).alias("rank"), "size"))


def height(nodes: DataFrame, fan: int) -> int:
    """Levels above the leaves of the largest tree."""
    size, h = nodes.agg(F.max("size")).head()[0] or 1, 0
    while size > 1:
        size, h = -(-size // fan), h + 1
    return h


def levels(nodes: DataFrame, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """The records of each level, from the leaves' parents up (tree, rank, digest, children), and the roots (tree, digest, height).

    ``nodes``: tree, rank, size, digest. A tree ends at the level where one node remains.
    """
    roots = nodes.where("size = 1").select("tree", "digest", F.lit(0).alias("height"))
    store, now = [], nodes
    for h in range(1, height(nodes, fan) + 1):
        runs = now.where("size > 1").groupBy("tree", F.floor(F.col("rank") / fan).alias("rank"), F.ceil(F.col("size") / fan).alias("size"))
        runs = runs.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"]).alias("children"))
        now = written(runs.select("tree", "rank", "size", digest(F.array_join("children", "")).alias("digest"), "children"))
        store.append(now)
        roots = roots.union(now.where("size = 1").select("tree", "digest", F.lit(h)))
    return store, roots


def descend(store: list[DataFrame], start: DataFrame, fan: int, asked: DataFrame | None = None) -> DataFrame:
    """tree, rank, path, children for every run of leaves of the store (rank: that of the leaves, div ``fan``), and for lone leaves, which have no children.

    ``start``: tree, digest, height, path (segments of (before, after), the root's first). ``asked`` (tree, rank) names the leaves
    that are wanted, all without it; requests that share the digits of a level descend as one row.
    """
    lone = start.where("height = 0").select("tree", F.lit(0).cast("long").alias("rank"), "path", F.array().cast("array<string>").alias("children"))
    front = None
    for h in range(len(store), 0, -1):
        come = start.where(F.col("height") == h).select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path")
        front = come if front is None else front.union(come)
        if h == 1:
            break
        records = store[h - 1].select("digest", "children").dropDuplicates(["digest"])
        met = front.join(records, "digest").select("tree", F.col("rank").alias("up"), "path", "children", F.posexplode("children").alias("digit", "child"))
        front = met.select("tree", (F.col("up") * fan + F.col("digit")).alias("rank"), F.col("child").alias("digest"), F.array_append("path", segment(F.col("children"), F.col("digit"))).alias("path"))
        if asked is not None:
            wanted = asked.select(F.col("tree").alias("of"), F.floor(F.col("rank") / fan ** (h - 1)).alias("at")).distinct()
            front = front.join(wanted, F.col("tree").eqNullSafe(F.col("of")) & (F.col("rank") == F.col("at")), "left_semi")
        front = written(front)
    if front is None:
        return lone
    records = store[0].select("digest", "children").dropDuplicates(["digest"])
    return front.join(records, "digest").select("tree", "rank", "path", "children").union(lone)


def segment(children: Column, digit: Column) -> Column:
    """The children that are not taken: those before it and those after it, each joined."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("before"), F.array_join(F.slice(children, digit + 2, F.greatest(F.size(children) - digit - 1, F.lit(0))), "").alias("after"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its reversed path give."""
    return F.aggregate(path, leaf, lambda now, s: digest(s["before"], now, s["after"]))


def proofs(docs: DataFrame, fan: int = 8) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: a row for each row of docs."""
    rows = ranked(written(leaves(docs)), "tree", "doc_id", "leaf", "changed")
    below, subroots = levels(rows.select("tree", "rank", "size", F.col("leaf").alias("digest")), fan)
    subroots = written(subroots)
    tops = ranked(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("lang"), "digest", "height"), "tree", "lang")
    above, roots = levels(tops.select("tree", "rank", "size", "digest"), fan)
    none = F.array().cast("array<struct<before string, after string>>")
    root = roots.select("tree", "digest", "height", none.alias("path"))
    top = descend(above, root, fan)
    # Every language is met at its place in the runs of subroots, with the part of its path that lies above.
    runs = tops.select(F.floor(F.col("rank") / fan).alias("run"), (F.col("rank") % fan).cast("int").alias("digit"), "lang", "digest", "height")
    start = runs.join(top, F.col("run") == F.col("rank")).select(F.col("lang").alias("tree"), "digest", "height", stepped("path", "children", F.col("digit")).alias("path"))
    start = written(start)
    # Requests for leaves: one row a run, as all its digits but the last are the same.
    leaf = F.struct((F.col("rank") % fan).cast("int").alias("digit"), "doc_id", "leaf", "changed")
    asks = rows.groupBy(F.col("tree").alias("of"), F.floor(F.col("rank") / fan).alias("at")).agg(F.collect_list(leaf).alias("leaves"))
    found = descend(below, start, fan)
    met = found.join(asks, F.col("tree").eqNullSafe(F.col("of")) & (F.col("rank") == F.col("at")))
    met = met.select("tree", "path", "children", F.explode("leaves").alias("x")).select("tree", "x.*", F.reverse(stepped("path", "children", F.col("x.digit"))).alias("path"))
    proof = digest(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""))
    met = met.select("tree", "doc_id", "leaf", proof.alias("proof_sha256"), folded(F.col("changed"), F.col("path")).alias("folded_root"))
    ends = start.crossJoin(roots.select(F.col("digest").alias("root"))).select(F.col("tree").alias("of"), F.col("digest").alias("subroot"), "root")
    out = met.join(ends, F.col("tree").eqNullSafe(F.col("of")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def stepped(path: str, children: str, digit: Column) -> Column:
    """A path with its last segment, where there are children to take from."""
    return F.when(F.size(children) > 0, F.array_append(path, segment(F.col(children), digit))).otherwise(F.col(path))

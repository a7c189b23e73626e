"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

Every text is split into words once. Of the terms that the test set has, the index stores a posting
(term, row, place) for each occurrence in the corpus, in the shared folder. A phrase of the test set is looked up from its rarest
terms: the lists of the two rarest, adjusted by their offsets in the phrase, are intersected by a grouped
count that the tasks begin before anything moves; where both agree, the lists of all other terms are met at the places they must have.
``proximity`` searches the same postings for terms near one another.

The index has as many postings as the corpus has occurrences of test terms. Tables of the test set are joined
without a hint: Spark broadcasts them below its own size limit, and shuffles beyond it.

Words are runs of letters, digits and non-ASCII characters, with A to Z in lower case. Null and empty texts have no
words. An item without words matches nothing; items of fewer words than a window are one window. Repeated items count
once for each id; rows repeated in the corpus, and rows whose id is null, are each judged by their own text. Texts of any length are
indexed whole. An empty test set marks nothing. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.common import only, written

BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The term of the posting that ends each text: its place is the number of words.
END = -1


def fold(word: Column) -> Column:
    """A to Z in lower case; letters beyond ASCII stay, which ``lower`` alone would change."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words_of(text: str) -> Column:
    """Words in their own case; only the first and the last part of a split may be empty."""
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN, -1), lambda w: w != "")


def vocabulary(words: DataFrame) -> DataFrame:
    """word, term: a number for each of the words, and for the end of a text."""
    return written(words.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term")).union(words.sparkSession.createDataFrame([("", END)], "word string, term long")))


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """row, doc_id, term, pos: the postings of ``terms`` (word, term), written; rows are numbered as they are read."""
    rows = only(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(words_of("text"), F.array(F.lit(""))).alias("w"))
    rows = rows.select("row", "doc_id", F.posexplode("w").alias("pos", "own")).select("row", "doc_id", "pos", fold(F.col("own")).alias("word"))
    return written(rows.join(terms, "word").select("row", "doc_id", "term", "pos"))


def windows(items: DataFrame, size: int) -> DataFrame:
    """item_id, phrase (words with single spaces), n: the windows of each item, each once an item."""
    w = only(items, "item_id", "text").select("item_id", F.transform(words_of("text"), fold).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    w = w.select("item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("k"))
    return w.select("item_id", F.array_join(F.slice("w", F.col("k"), F.col("n")), " ").alias("phrase"), "n").distinct()


def ranked_terms(phrases: DataFrame, terms: DataFrame, postings: DataFrame) -> DataFrame:
    """phrase_id, n, term, offset, rank: the terms of each phrase, the rarest in the corpus first; phrases with a term that the corpus lacks are left out."""
    freq = postings.groupBy("term").agg(F.count("*").alias("freq"))
    parts = phrases.select("phrase_id", "n", F.posexplode(F.split("phrase", " ")).alias("offset", "word")).join(terms, "word").join(freq, "term")
    of = Window.partitionBy("phrase_id")
    parts = parts.withColumn("present", F.count("*").over(of)).where("present = n")
    return written(parts.select("phrase_id", "n", "term", "offset", F.row_number().over(of.orderBy("freq", "term", "offset")).alias("rank")))


def phrase_hits(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """phrase_id, n, row, start: every exact occurrence of the phrases."""
    place = ["phrase_id", "n", "row", "start"]
    rare = postings.join(ranked.where("rank <= 2").select("phrase_id", "n", "term", "offset"), "term").where(F.col("pos") >= F.col("offset"))
    met = rare.select("phrase_id", "n", "row", (F.col("pos") - F.col("offset")).alias("start")).groupBy(*place).agg(F.count("*").alias("met"))
    met = written(met.where(F.col("met") == F.least("n", F.lit(2))).select(*place))
    needed = met.join(ranked.where("rank > 2").select("phrase_id", "term", "offset"), "phrase_id").select(*place, "term", (F.col("start") + F.col("offset")).alias("pos"))
    found = needed.join(postings.select("row", "term", "pos"), ["row", "term", "pos"]).groupBy(*place).agg(F.count("*").alias("met")).where(F.col("met") == F.col("n") - 2)
    return met.where("n <= 2").union(found.select(*place))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; a row for each row of docs."""
    return _contamination(docs, items, size).drop("row")


def _contamination(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    own = written(windows(items, size))
    phrases = written(own.select("phrase", "n").distinct().select("phrase", "n", F.monotonically_increasing_id().alias("phrase_id")))
    terms = vocabulary(phrases.select(F.explode(F.split("phrase", " ")).alias("word")))
    postings = index(docs, terms)
    hits = written(phrase_hits(postings, ranked_terms(phrases, terms, postings)))
    covered = hits.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = hits.select("row", "phrase_id").distinct().join(phrases.select("phrase_id", "phrase"), "phrase_id").join(own.select("phrase", F.col("item_id").cast("string").alias("item")), "phrase").select("row", "item").distinct()
    named = named.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("list"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    ends = postings.where(F.col("term") == END).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    both = ends.join(covered, "row", "left").join(named, "row", "left")
    return both.select("row", "doc_id", "n_words", zero("n_hit"), zero("n_items"), F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def proximity(postings: DataFrame, queries: DataFrame, slop: int) -> DataFrame:
    """query_id, row, pos, found: places of each query's rarest term with all its distinct terms within ``slop`` words.

    ``queries``: query_id, term, of the index's terms. Postings of other terms meet the rarest's by row and block of
    slop + 1 words, neighbours included; nothing is paired across texts. A query with a term that the corpus lacks matches nothing.
    """
    terms = queries.select("query_id", "term").distinct()
    used = postings.select("row", "term", "pos").join(terms.select("term").distinct(), "term", "left_semi")
    freq = used.groupBy("term").agg(F.count("*").alias("freq"))
    need = terms.groupBy("query_id").agg(F.count("*").alias("need"))
    rare = terms.join(freq, "term").groupBy("query_id").agg(F.min(F.struct("freq", "term")).alias("r")).select("query_id", F.col("r.term").alias("term"))
    span = F.lit(slop + 1)
    anchor = used.join(rare, "term").select("query_id", "row", F.col("pos").alias("at"), F.explode(F.array(*(F.floor(F.col("pos") / span) + k for k in (-1, 0, 1)))).alias("cell"))
    other = used.join(terms, "term").select("query_id", "row", "term", "pos", F.floor(F.col("pos") / span).alias("cell"))
    met = anchor.join(other, ["query_id", "row", "cell"]).where(F.abs(F.col("pos") - F.col("at")) <= slop)
    met = met.groupBy("query_id", "row", "at").agg(F.countDistinct("term").alias("found"))
    return met.join(need, "query_id").where("found = need").select("query_id", "row", F.col("at").alias("pos"), "found")

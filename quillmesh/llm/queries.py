"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm import decontam, langid, lexical, licenses, lm, manifest, minhash, neighbours, packing, pii, quality, rules, suffix_dedup
from quillmesh.llm.common import bucket, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    places = F.transform("passages", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string")))
    return found.withColumn("passages", F.array_join(places, ","))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = bucket("doc_id", 7) == 2
    scored = lm.score(table(spark, sf_dir, "documents"), ~held_out, TOKENIZER)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = bucket("doc_id", 4) == 2
    return langid.predict(docs, langid.fit(docs, ~held_out)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.apply(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


def op8_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = bucket("doc_id", 3) == 1
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proofs(table(spark, sf_dir, "documents"), fan=8)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + least(len(w), 3) - 1], ' ') AS shingle FROM d, range(1, greatest(len(w) - 1, least(len(w), 1) + 1)) t(k)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
 link AS (SELECT u, v FROM both_ JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
 edge AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
 reach AS (SELECT u AS doc_id, v AS other FROM edge UNION SELECT r.doc_id, e.v FROM reach r JOIN edge e ON r.other = e.u)
 SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least_, d.doc_id)) AS component_id, least(d.doc_id, coalesce(m.least_, d.doc_id)) = d.doc_id AS kept
 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS least_ FROM reach GROUP BY doc_id) m USING (doc_id)"""

_RUNS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP6 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_RUNS}) AS w FROM documents), b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_RUNS}) AS w FROM benchmark),
 items AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
 win AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS phrase FROM items, range(1, len(w) - n + 2) t(k)),
 lengths AS (SELECT DISTINCT n FROM win),
 dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS phrase FROM d, lengths, range(1, len(w) - n + 2) t(k)),
 hit AS (SELECT DISTINCT doc_id, k, dw.n, item_id FROM dw JOIN win ON dw.phrase = win.phrase AND dw.n = win.n),
 pos AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS p FROM hit), words AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
 named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
 SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
 FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)"""


_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11 = f"""WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents), i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
 counts AS (SELECT doc_id, len(w) AS n, t, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM d) GROUP BY ALL),
 whole AS (SELECT count(*) AS c, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0), held AS (SELECT t, count(*) AS df FROM counts WHERE t IN (SELECT t FROM i) GROUP BY t),
 x AS (SELECT doc_id, t, floor(1000 * ln((2 * c + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * c) // l))) AS x FROM counts JOIN held USING (t), whole),
 r AS (SELECT item_id, doc_id, sum(x)::BIGINT AS score FROM i JOIN x USING (t) GROUP BY ALL HAVING sum(x) > 0)
 SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM r QUALIFY rank <= 50"""


def _merkle_sql(levels: int = 7) -> str:
    """``levels`` bounds the height of a language's tree: 8^7 rows."""
    framed = lambda c, v: f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(framed(c, text if c == "text" else c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    eight = "[xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce({eight}, lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
    sql = f"""WITH own AS (SELECT doc_id, lang, {leaf("text")} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(low)} ELSE {leaf("text")} END AS changed FROM documents),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM own), a0 AS (SELECT lang AS tree, r, n, leaf AS d FROM ranked)"""

    def up(name: str, top: int) -> str:
        out = ""
        for k in range(top):
            side = lambda frame: f"CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(d, '') OVER (PARTITION BY tree, r // 8 ORDER BY r ROWS BETWEEN {frame}), '') END"
            out += f""", {name}s{k} AS (SELECT *, {side("UNBOUNDED PRECEDING AND 1 PRECEDING")} AS before, {side("1 FOLLOWING AND UNBOUNDED FOLLOWING")} AS after FROM {name}{k}),
 {name}{k + 1} AS (SELECT tree, r // 8 AS r, (n + 7) // 8 AS n, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY r)) END AS d FROM {name}{k} GROUP BY ALL)"""
        return out.replace("GROUP BY ALL", "GROUP BY tree, r // 8, n")

    def climb(name: str, start: str, source: str, top: int) -> str:
        out = f", {start}0 AS ({source})"
        for k in range(top):
            out += f""", {start}{k + 1} AS (SELECT p.* EXCLUDE (f, proof), CASE WHEN s.n = 1 THEN f ELSE sha256(before || f || after) END AS f, proof || before || after AS proof
  FROM {start}{k} p JOIN {name}s{k} s ON s.tree IS NOT DISTINCT FROM p.tree AND s.r = p.r // {8**k})"""
        return out

    sql += up("a", levels) + climb("a", "p", "SELECT doc_id, leaf, lang AS tree, r, changed AS f, '' AS proof FROM ranked", levels)
    sql += f", b0 AS (SELECT 0 AS tree, tree AS lang, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS r, count(*) OVER () AS n, d FROM a{levels}), langs AS (SELECT lang, r, d FROM b0)"
    sql += up("b", 3) + climb("b", "q", f"SELECT doc_id, leaf, l.d AS subroot, 0 AS tree, l.r, f, proof FROM p{levels} p JOIN langs l ON l.lang IS NOT DISTINCT FROM p.tree", 3)
    return sql + " SELECT doc_id, leaf, subroot, b3.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b3.d AS verified FROM q3, b3"


def oracle_sql() -> dict[str, str]:
    return {"op5_minhash_near_dedup": OP5, "op6_benchmark_decontamination": OP6, "op11_ranked_lexical_search": OP11, "op12_merkle_manifest": _merkle_sql()}

"""Operators with exact results against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quillmesh.llm import decontam, lm, minhash, packing, pii, rules, suffix_dedup
from quillmesh.llm.common import bucket
from tests.llm.conftest import frame

FOLD = {i: i + 32 for i in range(65, 91)}
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", t or "")


def rows(df):
    return [r.asDict() for r in df.collect()]


def brute_repeats(texts, size):
    count = collections.Counter()
    raw = [(i, (t or "").encode()) for i, t in texts]
    for _, b in raw:
        count.update(b[k : k + size] for k in range(len(b) - size + 1))
    out = []
    for i, b in raw:
        hit = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if count[b[k : k + size]] > 1:
                hit[k : k + size] = b"\1" * size
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        runs = sum(hit[k] and (k == 0 or not hit[k - 1]) for k in range(len(b)))
        out.append((i, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup(spark, docs, corpus):
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffix_dedup.remove_repeats(docs)))
    assert got == brute_repeats(corpus.items(), 200)


def test_suffix_dedup_small_size_splits_and_repeated_rows(spark):
    """Keys with many places are split down to single windows; the result is the same however soon that is."""
    texts = [(1, "abcabcabcabcabcabcabc" * 4), (2, "zzabcabcabcxx" + "q" * 60), (3, None), (4, "unlike others " * 2), (4, "unlike others " * 2), (5, "\x00\x01" * 40), (6, "y" + "\x00\x01" * 30), (None, "unlike others, but for this: abcabcabcabcabcabcabcabcabcabcabc"), (None, "short")]
    want = brute_repeats([(-1 if i is None else i, t) for i, t in texts], 30)
    for most in (10_000, 40, 5, 1):
        got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffix_dedup.remove_repeats(frame(spark, texts), 30, most)))
        assert got == want, most


def test_suffix_dedup_of_a_common_passage(spark):
    """One passage in most texts, with unlike text on both sides: its keys are split, and just what repeats goes."""
    rng = np.random.default_rng(7)
    noise = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = noise(260)
    texts = [(i, noise(int(rng.integers(0, 120))) + (shared if i % 4 else shared[40:250]) + noise(int(rng.integers(0, 120)))) for i in range(60)]
    want = brute_repeats(texts, 60)
    for most in (10_000, 20):
        assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffix_dedup.remove_repeats(frame(spark, texts), 60, most))) == want


def test_suffix_dedup_of_periodic_texts(spark):
    """Stretches of one word, line or byte are few rows, and what they share with others goes as well."""
    rng = np.random.default_rng(11)
    units = ["a", "ab ", "lorem x ", "one line of it\n", "0123456789" * 4 + "\n", "xyxxyxyyx" * 9]
    texts = []
    for i in range(50):
        parts = [units[int(rng.integers(len(units)))] * int(rng.integers(1, 40)) + "".join(rng.choice(list("pqrst"), int(rng.integers(0, 50)))) for _ in range(int(rng.integers(1, 4)))]
        texts.append((i, "".join(parts)[int(rng.integers(0, 9)) :]))
    want = brute_repeats(texts, 60)
    for most in (10_000, 7, 1):
        assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffix_dedup.remove_repeats(frame(spark, texts), 60, most))) == want, most
    spots = suffix_dedup.Corpus(frame(spark, [(1, "lorem x " * 5000)]), 200, 50_000).found
    assert sum(len(r["spots"]) for f in spots for r in rows(f)) < 10


def test_maximal_repeats_count_every_period(spark):
    for most in (10_000, 1):
        found = collections.defaultdict(set)
        for r in rows(suffix_dedup.maximal_repeats(frame(spark, [(1, "lorem x " * 20), (2, "q" + "lorem x " * 12)]), 40, most)):
            found[r["repeat_id"], r["n_bytes"]].add((r["doc_id"], r["start"]))
        covered = {(i, k) for (_, n), v in found.items() if len(v) > 1 for i, at in v for k in range(at, at + n)}
        assert covered == {(1, k) for k in range(160)} | {(2, k) for k in range(1, 97)}, most


def test_maximal_repeats_have_all_occurrences(spark):
    s = "the quick brown fox jumps over the lazy dog and on"
    long = "".join(f"{i * 7919 % 10007} " for i in range(120))
    texts = [(1, "aa" + s + "bb"), (2, "cc" + s + "dd" + "-" * 9 + s), (3, "nothing of that"), (4, "x" + long + "y"), (5, "zz" + long), (6, "only in copies: " + "0123456789" * 3), (7, "only in copies: " + "0123456789" * 3)]
    for most in (10_000, 1):
        found = collections.defaultdict(set)
        for r in rows(suffix_dedup.maximal_repeats(frame(spark, texts), 40, most)):
            found[r["repeat_id"], r["n_bytes"]].add((r["doc_id"], r["start"]))
        kinds = {(n, tuple(sorted(v))) for (_, n), v in found.items()}
        assert (len(s), ((1, 2), (2, 2), (2, 2 + len(s) + 11))) in kinds, kinds
        assert (len(long), ((4, 1), (5, 2))) in kinds  # a repeat longer than an anchor's reach is one group
        assert (46, ((6, 0), (7, 0))) in kinds


def test_scan_finds_members_that_are_not_neighbours():
    p = [(b"aaaa", b"xyz1"), (b"aaab", b"xyz1q"), (b"aaaa", b"xyz0"), (b"cccc", b"xyz1")]
    assert suffix_dedup.scan(p, 7) == [(4, 4), (3, 4), (4, 3), (0, 0)]


def brute_groups(texts, n, percent):
    sets = {}
    for i, t in texts:
        w = [x.translate(FOLD) for x in words(t)]
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < n else (tuple(w[k : k + n]) for k in range(len(w) - n + 1)))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_minhash(spark, docs, corpus):
    for n, percent in ((3, 85), (5, 80)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(minhash.near_duplicates(docs, n, percent))}
        assert got == brute_groups(corpus.items(), n, percent)


def test_minhash_blocks_and_repeated_rows(spark, corpus):
    d = frame(spark, [*corpus.items(), *corpus.items()])
    got = rows(minhash.near_duplicates(d, 3, 85, block=3, block_elements=200))
    want = brute_groups(corpus.items(), 3, 85)
    assert len(got) == 2 * len(corpus) and all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:2500]
    h, row = np.concatenate([a, b]), np.repeat([0, 1], 2000)
    s = minhash.superminhash(h, row, 2)
    assert abs((s[0] == s[1]).mean() - 1500 / 2500) < 0.15 and (s >> np.uint64(48)).max() < 2
    few = minhash.superminhash(pool[:3], np.zeros(3, int), 1)
    assert len(np.unique(few)) == minhash.PLACES  # ranks of an element are distinct


def brute_hits(texts, items, size=10):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(FOLD))
    window = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            window[tuple(w[k : k + n])].add(i)
    out = []
    for i, t in texts:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in window}:
            for k in range(len(w) - n + 1):
                if x := window.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= x
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_decontamination(spark, docs, corpus):
    items = [(1, corpus[22].split("\n")[1]), (2, " ".join(corpus[30].split()[2:9]).upper()), (10, "Two, WORDS!"), (3, None), (4, ""), (5, "... !!"), (6, "absent from all of the corpus zzz"), (7, corpus[22].split("\n")[1]), (8, "日本語 テキスト です。"), (9, "É" + corpus[31][:40])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = sorted(tuple(r[k] for k in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows(decontam.contamination(docs, bench)))
    assert got == brute_hits(corpus.items(), items)


def test_decontamination_of_null_ids(spark, monkeypatch):
    """A benchmark passage in a row without an id is found, and the pipeline's stage drops that row."""
    import corpus_pipeline

    passage = "one two three four five six seven eight nine ten eleven"
    d = frame(spark, [(None, f"so {passage} then"), (1, passage), (2, "nothing of it here")])
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontam.contamination(d, items).collect()}
    assert got == {None: (11, 1, True), 1: (11, 1, True), 2: (0, 0, False)}
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: items)
    assert [r.doc_id for r in corpus_pipeline.drop_contaminated(spark, d, "").collect()] == [2]


def test_index_and_proximity(spark):
    d = frame(spark, {1: "red fox ran past a Blue hen", 2: "red " + "x " * 30 + "blue", 3: None})
    terms = decontam.vocabulary(spark.createDataFrame([("red",), ("blue",), ("green",)], "word string"))
    number = {r.word: r.term for r in terms.collect()}
    postings = decontam.index(d, terms)
    assert sorted((r.doc_id, r.pos) for r in postings.where(f"term = {number['blue']}").collect()) == [(1, 5), (2, 31)]
    assert {r.doc_id: r.pos for r in postings.where("term = -1").collect()} == {1: 7, 2: 32, 3: 0}
    q = spark.createDataFrame([(1, number["red"]), (1, number["blue"]), (2, number["green"]), (2, number["red"])], "query_id int, term long")
    got = decontam.proximity(postings, q, 6).join(postings.select("row", "doc_id").distinct(), "row").collect()
    assert [(r.query_id, r.doc_id) for r in got] == [(1, 1)]


def test_rules_base(spark, docs, corpus):
    trees = rules.grow(np.zeros((0, len(rules.NAMES))), np.zeros(0), [0] * len(rules.NAMES))
    got = {r["doc_id"]: r for r in rows(rules.apply(docs, trees))}
    assert len(got) == len(corpus)
    for i, t in corpus.items():
        t, w = t or "", words(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        five = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        hit = {j for k in range(len(w) - 4) if five[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), dup, len(hit)), i
        assert r["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w)) and r["kept"] == (not r["base_failed"])


def brute_pii(t):
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x.lstrip("0")[:4] or 0) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.ORDER[s[0]]))


PERSONAL = {
    0: None, 1: "", 2: "a@b@c.com and x.y+z@mail.example.org. é@a.b 1@2.3.4", 3: "ip 1.2.3.4.5.6 256.1.1.1 010.0.0.1 9.9.9.9", 4: "4111 1111 1111 1111 or 4111-1111-1111-1112; 12345678901234567890",
    5: "+1 (555) 123-4567, +44 20 7946 0958. ++49 30 901820", 6: "日本 +81-3-1234-5678 a@b.co 4111111111111111", 7: 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and plain words', 8: "Call Mr. John Smith or mail jo [at] example.org", 9: "0" * 5000 + "." + "1.2.3",
}


def test_pii_base_spans_stay(spark):
    d = frame(spark, PERSONAL)
    weights = pii.fit(d)
    got = {r["doc_id"]: r for r in rows(pii.find(d, weights))}
    for i, t in PERSONAL.items():
        if i is not None:
            want = brute_pii(t or "")
            text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
            assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (i, want, got[i])
            assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE]
            assert set(text.split(",")) - {""} <= set(got[i]["spans"].split(","))
    assert "secret:" in got[7]["spans"]
    clean = {r["doc_id"]: r["text"] for r in rows(pii.redact(d, weights))}
    assert clean[0] is None and "4111 1111 1111 1111" not in clean[4] and "24be" not in clean[7]


def test_pii_every_match_is_a_candidate():
    """Each pattern's match, alone in its text, in each case and beside each mark, gets a candidate: no gate is narrower than its pattern."""
    value = "abcDEF123456ghi"
    secrets = [f(w) + sep + value for w in ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "to\u212aen", "\u017fecret", "ap\u0131_key") for f in (str, str.upper, str.title, lambda x: "DB_" + x.upper(), lambda x: x[:3] + x[3:].capitalize()) for sep in ("=", ": ", '" = "')]
    people = [*(t + gap + "Smith" for t in ("Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora") for gap in (" ", "\n", "\t", "\u00a0")), *(g + gap + "Lopez" for g in pii.GIVEN for gap in (" ", "\n"))]
    handles = [f"joe {a}{w}{b} mail.org" for a in "[(" for b in "])" for w in ("at", "AT")]
    for kind, pattern, texts in (("secret", pii.SECRET, secrets), ("name", pii.NAME, people), ("handle", pii.HANDLE, handles)):
        for x in texts:
            for a, b in (("", ""), ("(", ")"), ('"', '"'), ("x ", ","), ("-", "."), ("\n", "\n")):
                if m := pattern.search(a + x + b):
                    at = next(m.span(k) for k in range(m.re.groups, -1, -1) if m[k] is not None)
                    assert (kind, *at) in [(c.kind, c.start, c.end) for c in pii.candidates(a + x + b)], a + x + b
    assert sum(pii.SECRET.search(x) is not None for x in secrets) > 130 and all(map(pii.NAME.search, people)) and all(map(pii.HANDLE.search, handles))


def test_pii_takes_time_in_proportion_to_length():
    """Runs on which a search that begins anew at each character would take hours, and matches by brute force on short odd texts."""
    import random
    import time

    rng = random.Random(2)
    for _ in range(5000):
        t = "".join(rng.choice("01+-. ()@a.b%_é1234") for _ in range(rng.randrange(40)))
        assert pii.base_spans(t) == brute_pii(t), t
    begin = time.process_time()
    for t in ("1" * 400_000, "a" * 400_000 + "@b", "+ " * 200_000, "1.2.3 " * 70_000, "a@" * 200_000, "joe" * 130_000, "a.b@c.de " * 10_000):
        pii.spans(t, np.ones(pii.WIDTH))
    assert time.process_time() - begin < 30


def test_pii_added_spans_are_those_the_weights_accept(spark):
    """find() against a plain reading of candidates: each accepted in order unless it meets a base span or an accepted one."""
    d = frame(spark, PERSONAL)
    weights = pii.fit(d)
    got = {r.doc_id: r.spans for r in pii.find(d, weights).collect()}
    for i, t in PERSONAL.items():
        found = pii.candidates(t or "")
        out = [(c.kind, c.start, c.end) for c in found if c.base]
        for c in found:
            if not c.base and sum(a * b for a, b in zip(c.features, weights, strict=True)) >= 0 and not any(c.start < b and a < c.end for _, a, b in out):
                out.append((c.kind, c.start, c.end))
        assert got[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(out, key=lambda s: (s[1], pii.ORDER[s[0]], s[2])))


def test_newton_on_counts_equals_newton_on_rows():
    rng = np.random.default_rng(5)
    x = np.hstack([np.ones((50, 1)), rng.random((50, pii.WIDTH - 1)).round(1)])
    y, n = rng.random(50), rng.integers(1, 9, 50).astype(float)
    w = np.zeros(pii.WIDTH)
    once = pii.newton_sums(np.repeat(x, n.astype(int), 0), np.repeat(y, n.astype(int)), np.ones(int(n.sum())), w)
    assert np.allclose(pii.newton_sums(x, y, n, w), once)
    for _ in range(30):
        w += pii.newton_step(pii.newton_sums(x, y, n, w), w, 1.0)
    assert np.abs(pii.newton_sums(x, y, n, w)[: pii.WIDTH] - w).max() < 1e-3  # the gradient with the penalty is nothing


def test_em_learns_reliable_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    votes = np.column_stack([np.where(rng.random(4000) < p, np.where(truth, 1, -1), np.where(truth, -1, 1)) for p in (0.95, 0.9, 0.55, 0.9, 0.5)])
    prior, _, post = pii.reliabilities(collections.Counter(map(tuple, votes.tolist())))
    guess = np.array([post[tuple(v)] for v in votes.tolist()]) > 0.5
    assert (guess == truth).mean() > 0.97 and abs(prior - 0.3) < 0.06


def test_packing(spark, docs, corpus):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(TOKENIZER)
    found = collections.defaultdict(list)
    for r in rows(packing.pack(docs, TOKENIZER)):
        found[r["doc_id"]].append(r)
    sequences = collections.defaultdict(list)
    total = 0
    for i, t in corpus.items():
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for k, r in enumerate(sorted(found[i], key=lambda r: r["piece"])):
            assert r["piece"] == k and r["start"] == at and r["length"] <= 1024 and (k == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes()), i
            at += r["length"]
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert at == len(ids)
        total += at
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= math.ceil(total / 1024) + 2


def fewest(lengths, size):
    """The least number of sequences, by trying all placements."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + lengths[i] <= size:
                bins[k] += lengths[i]
                go(i + 1, bins)
                bins[k] -= lengths[i]
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best


def placed(slots, size):
    """Sequences used, after checking that pieces lie gapless in them."""
    parts = collections.defaultdict(list)
    for length, _, times, sequence, offset in slots:
        for k in range(times):
            parts[sequence + k].append((offset, length))
    for x in parts.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= size
    return len(parts)


def test_plan_is_optimal_on_small_cases():
    import random

    rng = random.Random(1)
    for _ in range(200):
        lengths = [rng.randrange(1, 21) for _ in range(rng.randrange(1, 10))]
        slots = packing.plan(collections.Counter(lengths), 20)
        assert sorted(x for x, _, n, *_ in slots for _ in range(n)) == sorted(lengths)
        assert placed(slots, 20) == fewest(lengths, 20), lengths
    assert placed(packing.plan(collections.Counter([10, 9, 9, 8, 7, 5, 5, 4, 3]), 20), 20) == 3


def test_plan_is_near_the_bound_and_takes_any_histogram():
    rng = np.random.default_rng(3)
    for lengths in (rng.integers(1, 1025, 5000), rng.integers(200, 600, 3000)):
        count = np.bincount(lengths, minlength=1025)
        used = placed(packing.plan(collections.Counter(lengths.tolist())), 1024)
        assert used <= sum(n for _, n in packing.best_fit(count, 1024)) and used <= 1.03 * packing.lower_bound(count, 1024)
    for histogram, want in (({1: 1100}, 2), ({3: 5, 1: 3000}, 3), ({500: 4, 1: 5000}, 7), ({1: 1_500_000}, 1465), ({}, 0)):
        slots = packing.plan(histogram)
        assert max((s[3] + s[2] for s in slots), default=0) == want and sum(s[2] for s in slots) == sum(histogram.values())


def test_fillings_are_undominated_and_bounded_by_waste():
    count = np.bincount([300, 24, 200, 124], minlength=1025)
    found = list(packing.fillings(700, count, 1024, 1024, packing.Search(10_000)))
    assert (0, ((700, 1), (300, 1), (24, 1))) in found and (0, ((700, 1), (200, 1), (124, 1))) in found
    assert not any(waste >= 24 for waste, _ in found)  # 24 would fit
    assert all(waste == 0 for waste, _ in packing.fillings(700, count, 1024, 0, packing.Search(10_000)))


def test_many_empty_texts_are_packed(spark):
    d = frame(spark, [(i, None if i % 2 else "") for i in range(1500)])
    got = packing.pack(d, TOKENIZER).collect()
    assert len(got) == 1500 and len({r.sequence_id for r in got}) == 2 and len({(r.sequence_id, r.offset) for r in got}) == 1500


def test_encoder_agrees_with_the_tokenizers_library(spark, corpus):
    """Odd texts, and every text of a whole table."""
    from tokenizers import Tokenizer

    own, e = Tokenizer.from_file(TOKENIZER), packing.encoder(TOKENIZER)
    whole = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    odd = ["a b c d e f g", "  two  spaces\n x", "é ñ 1 2'll we're", "end ", "\x1c \x1d a", "a<|endoftext|> b", "x  <|endoftext|>", "<|endo", "a \u00a0b \u3000c \x85 d", "\n\n a\n \n b", " ", None]
    for some in (list(corpus.values()), odd, whole):
        for a, b, p in packing.tk.packs(packing.pa.array(some, packing.pa.string())):
            ids, begin = e.pack(p, 2)
            for i in range(a, b):
                want = [*own.encode(some[i] or "", add_special_tokens=False).ids, 2]
                assert ids[begin[i - a] : begin[i - a + 1]].tolist() == want, (some[i] or "")[:80]


def test_hashes_tell_thue_morse_words_apart():
    """Any polynomial hash modulo a power of two takes these two for one."""
    t = "a"
    for _ in range(11):
        t += t.translate({97: 98, 98: 97})
    p = next(packing.tk.packs(packing.pa.array([t + " " + t.translate({97: 98, 98: 97}) + " " + t])))[2]
    a, b, c = p.hashes(*p.runs(packing.tk.WORD))
    assert a == c != b


def test_keys_tell_words_apart_and_are_the_same_anywhere():
    rng = np.random.default_rng(5)
    parts = ["", "a", "a\0", "\0", "b", "abcdefgh", "abcdefgh\0", "abcdefghi", "x" * 511, "x" * 512, "x" * 513, "x" * 512 + "y", "é" * 300]
    parts += ["".join(rng.choice(list("ab"), n)) for n in range(1, 40) for _ in range(20)]
    text = packing.tk.packs(packing.pa.array([" ".join(rng.permutation(parts * 3).tolist())]))
    p = next(text)[2]
    raw = p.buf.tobytes()[:-1].split(b" ")
    ends = np.cumsum([len(x) + 1 for x in raw]) - 1
    for fold in (packing.tk.SAME, packing.tk.LOWER):
        keys = p.keys(ends - [len(x) for x in raw], ends, fold)
        assert len(set(zip(raw, keys.tolist(), strict=True))) == len(set(raw)) == len(set(keys.tolist()))
    one, two = (next(packing.tk.packs(packing.pa.array([x])))[2] for x in ("Some LONGER words", "..some longer WORDS"))
    assert (one.keys(*one.runs(packing.tk.WORD), packing.tk.LOWER)[1:] == two.keys(*two.runs(packing.tk.WORD), packing.tk.LOWER)[1:]).all()


def test_lm_base(spark, docs, corpus):
    learn = bucket("doc_id", 7) != 2
    got = {r["doc_id"]: r for r in rows(lm.score(docs, learn, TOKENIZER, frequent=50))}
    tokens = {i: [w.translate(FOLD) for w in words(t)] + [None] for i, t in corpus.items()}
    c = collections.Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r["score"] < 0


def test_lm_score_is_the_sum_over_windows_by_a_plain_reading():
    """The batched attention against one target at a time, with loops."""
    rng = np.random.default_rng(6)
    size = 30
    m = lm.train([rng.integers(0, size, 200)], np.ones(size), 2, steps=3)
    ids = rng.integers(0, size, 53)
    grid, ok = lm.windows(ids, np.array([0]), 2)
    got = np.where(ok, lm.log_probs(m, grid), 0).sum()
    text, total = [2, *ids.tolist()], 0.0
    for t in range(1, len(text)):
        low = lm.STRIDE * ((t - 1) // lm.STRIDE) - lm.WINDOW + 1  # the window begins here, or with the text
        seen = [j for j in range(max(0, low, t - lm.WINDOW), t)]
        s = [float(m.query[text[t - 1]] @ m.key[text[j]] + m.offset[t - 1 - j]) for j in seen]
        w = np.exp(np.array(s) - max(s))
        state = (w / w.sum()) @ np.array([m.value[text[j]] for j in seen])
        g = np.exp(m.gate[text[t - 1]] + state @ m.out)
        total += np.log(g / g.sum() @ m.tables[text[t]])
    assert math.isclose(got, total, rel_tol=1e-3)


def test_lm_windows_score_each_token_once_and_sum_to_one():
    ids, starts = np.arange(1, 101), np.array([0, 37, 38])
    grid, ok = lm.windows(ids, starts, 2)
    assert sorted(grid[:, lm.WINDOW :][ok].tolist()) == ids.tolist()
    assert (grid[:, lm.WINDOW - 1][ok[:, 0] & (grid[:, lm.WINDOW - 2] < 0)] == 2).all()
    m = lm.train([ids % 50], np.bincount(ids % 50, minlength=50), 2, steps=3)
    g = np.repeat(grid[:1] % 50, 50, 0)
    g[:, lm.WINDOW + 5] = np.arange(50)
    assert math.isclose(np.exp(lm.log_probs(m, g)[:, 5]).sum(), 1, rel_tol=1e-3)
    later = grid[:1] % 50
    changed = later.copy()
    changed[:, lm.WINDOW + 6 :] = 7
    assert np.allclose(lm.log_probs(m, later)[:, :6], lm.log_probs(m, changed)[:, :6])  # causal


def test_lm_places_in_batches_of_windows_by_a_plain_reading(monkeypatch):
    """Log probabilities and sums where windows, batches and texts begin and end, one target at a time; weights that need clipping and that don't."""
    rng = np.random.default_rng(7)
    size, lengths = 40, [1, 70, 2, 16, 17, 333, 1]
    m = lm.train([rng.integers(0, size, 200)], np.ones(size), 2, steps=3)
    monkeypatch.setattr(lm, "LANES", 3)
    monkeypatch.setattr(lm, "LONG", 20)
    ids, starts = rng.integers(0, size, sum(lengths)), np.cumsum([0, *lengths[:-1]])
    for scale in (1, 40):
        m.query *= scale
        look, sums, want, at = lm.tables_by_id(m), lm.Sums(size), [], np.zeros((size, 3 * lm.MIX))
        places, target, own = lm.laid_out(ids, starts, 2)
        for x in lm._gates(m, look, places, target):
            sums.add(look, *x)
        for a, n in zip(starts, lengths, strict=True):
            text = [2, *ids[a : a + n].tolist()]
            for t in range(1, len(text)):
                seen = range(max(0, t - lm.WINDOW), t)
                s = np.exp(np.clip([float(m.query[text[t - 1]] @ m.key[text[j]] + m.offset[t - 1 - j]) for j in seen], -60, 30))
                g = np.exp(np.clip(m.gate[text[t - 1]] + (s / s.sum()) @ m.value[[text[j] for j in seen]] @ m.out, -30, 30))
                p = g * m.tables[text[t]]
                want.append(np.log(p.sum() / g.sum()))
                at[text[t], : lm.MIX] += p / p.sum()
                at[text[t - 1], lm.MIX :] += np.concatenate([p / p.sum(), g / g.sum()])
        assert np.allclose(lm.place_log_probs(m, look, places, target)[own], want, rtol=1e-3, atol=1e-3)
        assert np.allclose(sums.of(np.arange(size)), at, rtol=1e-3, atol=1e-3) and (sums.ids() == np.flatnonzero(at.any(1))).all()


def test_parts_of_texts_are_encoded_once_in_a_worker(monkeypatch):
    """Each pack's ids are those of its whole texts, with parts from earlier packs, words, marks and spaces of all kinds; parts met before are not encoded again."""
    rng = np.random.default_rng(9)
    some = [" ", "  ", "\n", "\t", "a", "b", "Z", "é", "ß", "×", "÷", "'s", "'ll", " 's", "1", ".", ",", "日", "<|endoftext|>", "\u00a0", "\u2003", "\r", "ª", "Ã", "\x85", " x", " é", "\x00", "$"]
    enc = packing.Encoder(TOKENIZER)
    for known in (40, 300_000):
        monkeypatch.setattr(packing, "KNOWN", known)
        for _ in range(20):
            held = ["".join(rng.choice(some, rng.integers(0, 40))) for _ in range(20)]
            p = next(packing.tk.packs(packing.pa.array(held)))[2]
            ids, at = enc.pack(p, 2)
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [[*enc.core.encode(t, allowed_special="all"), 2] for t in held]
        assert known > 40 or len(enc.ids) <= 8 * 40
    p = next(packing.tk.packs(packing.pa.array(["some words, and others", "some words"])))[2]
    first = enc.pack(p, 2)
    enc.core = enc.plain = None
    again = enc.pack(p, 2)
    assert all((x == y).all() for x, y in zip(first, again, strict=True))


def test_suffix_dedup_with_text(spark, docs, corpus):
    got = {r["doc_id"]: r for r in rows(suffix_dedup.remove_repeats(docs, with_text=True))}
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in got.values())
    assert {i: r["n_removed"] for i, r in got.items()} == {r["doc_id"]: r["n_removed"] for r in rows(suffix_dedup.remove_repeats(docs))}


@pytest.mark.parametrize("most", [8, 0])
def test_suffix_dedup_where_the_bitmaps_are_full_or_left_out(spark, docs, corpus, monkeypatch, most):
    """Rows that a bitmap can't tell apart are left to the joins: the result is the same."""
    from quillmesh.llm import common

    want = sorted(map(tuple, rows(suffix_dedup.remove_repeats(docs))), key=str)
    monkeypatch.setattr(common, "LEAST_BITS", 7)
    monkeypatch.setattr(common, "BITS_A_KEY", 1)
    if not most:
        monkeypatch.setattr(common, "MOST_BITS", 0)
    assert sorted(map(tuple, rows(suffix_dedup.remove_repeats(docs))), key=str) == want


@pytest.mark.parametrize("bits", [23, 25])
def test_key_bitmap_has_all_keys(spark, monkeypatch, bits):
    from quillmesh.llm import common
    from quillmesh.llm.common import in_bitmap, key_bitmap

    keys = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 3000)
    monkeypatch.setattr(common, "LEAST_BITS", bits)
    held = spark.createDataFrame([(int(k),) for k in keys[:1000]], "key long")
    bitmap = key_bitmap(held, "key")
    assert len(bitmap) == 1 << bits - 6
    assert in_bitmap(bitmap, keys[:1000]).all() and in_bitmap(bitmap, keys[1000:]).mean() < 0.01
    monkeypatch.setattr(common, "MOST_BITS", 9)
    assert key_bitmap(held, "key") is None


def test_oracle_sql(spark, data):
    import duckdb

    import __spark_entry__ as e

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    for name in ("op5_minhash_near_dedup", "op6_benchmark_decontamination"):
        want = c.sql(e.oracle_sql()[name]).df()
        got = e.queries()[name](spark, data).toPandas()[list(want.columns)]
        assert sorted(map(tuple, got.astype(str).to_numpy())) == sorted(map(tuple, want.astype(str).to_numpy())), name

"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a span classifier decides.

Four base kinds (email, ip, card, phone) are exact patterns with checks; what they find always stays.
The method adds spans of the kinds secret, name, handle and number from wider candidates. On each candidate five
labelers (pattern, check, gazetteer, context, shape) vote for, against, or not at all. The counts of
the vote patterns over the whole corpus (a small bounded table) give each labeler's reliability by
EM; the posteriors of all candidates, counted by votes and features, train a logistic span classifier by
Newton steps whose sums are made in the tasks. It scores every candidate from its own shape and surroundings. An
added span never overlaps a base one, nor another added one (the first stays).

Places are code points, ends exclusive. Null text is empty and has no spans. Very long texts, and long runs of
digits or letters in them, take time in proportion to their length. An empty corpus, or one
without candidates, gives a classifier that adds nothing. Repeated rows get the same result, as do rows
with a null id; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.common import only, written

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "name", "handle", "number")
ORDER = {k: i for i, k in enumerate(KINDS)}

#: What follows the at sign of an email.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: A match ends with its digits, so none but the first of a run of digits can begin one: the others need not be tried.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Where an ip, card or phone can lie: runs of all their characters that begin with one that can begin one of them.
ZONE = re.compile(r"[0-9+][0-9\x20.()+-]*")
#: Words that go before a secret, and its form. Each match of the form has one of the first, once case-folded as IGNORECASE folds
#: (long s and the Kelvin sign too; "api" alone would miss the dotless i, which folds to itself).
SECRET_WORDS = ("token", "secret", "passw", "key")
SECRET = re.compile(r"(?:token|secret|password|passwd|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9+/_-]{12,})", re.IGNORECASE)
#: Forms of address and common given names, after which a name may follow.
TITLES = ("Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Herr", "Frau", "Monsieur", "Madame", "Señor")
GIVEN = frozenset(
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen "
    "Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Steven Ashley Paul Emily Andrew Donna Kevin Michelle Brian Laura George Amanda Edward Melissa "
    "Anna Peter Hans Klaus Ursula Wolfgang Jürgen Monika Sabine Stefan Heike Dieter Pierre Jean Marie Sophie Claude François Isabelle Nicolas Camille Luc "
    "Carlos Maria Juan Carmen José Luis Ana Pedro Lucía Miguel Sofía Javier Elena Giulia Marco Francesca Giovanni Ahmed Fatima Mohammed Aisha Wei Li Yuki Hiroshi Priya Raj Olga Ivan".split()
)
NAME = re.compile(r"(?:(?:Mr\.|Mrs\.|Ms\.|Dr\.|Prof\.|Herr|Frau|Monsieur|Madame|Señora?)\s([A-Z][\w'-]+(?:\s[A-Z][\w'-]+)?))|\b((?:" + "|".join(sorted(GIVEN)) + r")\s[A-Z][\w'-]+)")
HANDLE = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\s?[\[(](?:at|AT)[\])]\s?[A-Za-z0-9-]+(?:\s?(?:\.|[\[(](?:dot|DOT)[\])])\s?[A-Za-z0-9-]+)+")
CONTEXT_FOR = re.compile(r"(?i)e-?mail|contact|phone|\btel\b|call|mobile|\bip\b|address|card|visa|token|secret|password|key|name|account|ssn|iban")
CONTEXT_AGAINST = re.compile(r"(?i)version|isbn|figure|page|chapter|price|total|example|invoice|order|revision|build|\bno\.")
TLDS = frozenset("com org net edu gov mil int io ai app dev info biz name de fr es it uk eu co us ca mx br ar cl pt nl be ch at se no dk fi pl cz ru ua tr in cn jp kr au nz za".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def number_kinds(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passes the check) of all ip, card and phone matches."""
    for zone in ZONE.finditer(text):
        a, b = zone.span()
        if b - a < 7:
            continue
        for m in IP.finditer(text, a, b):
            yield "ip", m.start(), m.end(), all(len(y := x.lstrip("0")) < 4 and int(y or 0) <= 255 for x in m.group().split("."))
        for m in CARD.finditer(text, a, b):
            digits = m.group().replace(" ", "").replace("-", "")
            if len(digits) >= 9:
                yield "card", m.start(), m.end(), 14 <= len(digits) <= 19 and luhn(digits)
        for m in PHONE.finditer(text, a, b):
            yield "phone", m.start(), m.end(), 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15


def emails(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """From each at sign its local part backwards, to the last match or at sign at most, and its domain forwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in LOCAL:
            a -= 1
        done = at + 1
        if a < at and (m := DOMAIN.match(text, at + 1)):
            yield "email", a, m.end(), True
            done = m.end()
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [x[:3] for x in (*emails(text), *number_kinds(text)) if x[3]]
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]], s[2]))


@dataclass
class Candidate:
    kind: str
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]
    features: tuple[float, ...]


def candidates(text: str) -> list[Candidate]:
    """Base spans and wider ones, with the labelers' votes (1, -1, or 0 for none)."""
    found: list[tuple[str, int, int, bool, int]] = []  # the last: the check labeler's vote
    for kind, a, b, ok in (*emails(text), *number_kinds(text)):
        found.append((kind if ok else "number", a, b, ok, 1 if ok else -1))
    # Each gate holds wherever its pattern can match, whatever stands beside the match.
    folded = text.casefold()
    if any(w in folded for w in SECRET_WORDS):
        found += [("secret", *m.span(1), False, 1 if any(c.isdigit() for c in m[1]) else -1) for m in SECRET.finditer(text)]
    if any(t in text for t in TITLES) or any(g in text for g in GIVEN):
        found += [("name", *m.span(1 if m[1] else 2), False, 0) for m in NAME.finditer(text)]
    if any(x in text for x in ("(at", "[at", "(AT", "[AT")):
        found += [("handle", *m.span(), False, 1) for m in HANDLE.finditer(text)]
    out = []
    for kind, a, b, base, check in sorted(set(found), key=lambda s: (s[1], ORDER[s[0]], s[2])):
        span, near = text[a:b], text[max(0, a - 40) : a] + " " + text[b : b + 20]
        digits = sum("0" <= c <= "9" for c in span)
        uniform = digits > 3 and len({c for c in span if c.isdigit()}) == 1
        pattern = {"number": 0, "name": 1 if text[max(0, a - 2) : a] in (". ", "r ", "u ") else 0}.get(kind, 1)
        known = {"email": 1 if span.rpartition(".")[2].lower() in TLDS else 0, "name": 1 if span.split()[0] in GIVEN else 0, "ip": -1 if span.startswith(("0.", "127.")) else 0, "handle": 1 if re.split(r"\W+", span)[-1].lower() in TLDS else 0}.get(kind, 0)
        yes, no = bool(CONTEXT_FOR.search(near)), bool(CONTEXT_AGAINST.search(near))
        mixed = len(set(span)) / max(1, len(span))
        shape = -1 if uniform else {"secret": 1 if digits >= 4 and len(span) >= 20 else 0, "number": -1 if digits < 9 else 0, "card": 1, "phone": 1, "email": 1, "ip": 1}.get(kind, 0)
        inside = lambda i: 0 <= i < len(text) and text[i].isalnum()
        part = lambda x: round(10 * x) / 10  # noqa: E731  # few values, so that candidates can be counted by their features
        features = (1.0, *(float(kind == k) for k in KINDS), part(min(len(span), 60) / 60), part(digits / max(1, len(span))), part(sum(c.isupper() for c in span) / max(1, len(span))), part(mixed), float(inside(a - 1)), float(inside(b)), float(yes), float(no), float(uniform), float(check > 0), float(check < 0))
        out.append(Candidate(kind, a, b, base, (pattern, check, known, int(yes) - int(no), shape), features))
    return out


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[float, np.ndarray, dict[tuple[int, ...], float]]:
    """EM over counted vote patterns: (prior, P(vote | class) as labeler x class x vote, posterior of each pattern).

    Starts from the majority's opinion; all counts are smoothed, so a silent labeler stays neutral.
    """
    keys = sorted(patterns)
    if not keys:
        return 0.5, np.full((5, 2, 3), 1 / 3), {}
    votes, n = np.array(keys), np.array([patterns[k] for k in keys], float)
    post = 1 / (1 + np.exp(-votes.sum(1).astype(float)))
    for _ in range(rounds):
        prior = float(np.clip((post @ n + 1) / (n.sum() + 2), 0.01, 0.99))
        table = np.empty((votes.shape[1], 2, 3))
        for k in range(votes.shape[1]):
            for c, w in enumerate((n * (1 - post), n * post)):
                # Each labeler is held to be right more often than wrong, by the smoothing.
                table[k, c] = np.bincount(votes[:, k] + 1, w, 3) + (np.array([2.0, 2.0, 1.0]) if c == 0 else np.array([1.0, 2.0, 2.0]))
                table[k, c] /= table[k, c].sum()
        log = np.log(np.array([1 - prior, prior]))[None, :] + sum(np.log(table[k][:, votes[:, k] + 1]).T for k in range(votes.shape[1]))
        post = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -30, 30)))
    return prior, table, dict(zip(keys, post.tolist(), strict=True))


WIDTH = 1 + len(KINDS) + 11


def newton_sums(x: np.ndarray, y: np.ndarray, n: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and curvature of the log likelihood of soft labels y, each counted n times, in one row of numbers."""
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.concatenate([x.T @ (n * (y - p)), ((x * (n * (p * (1 - p) + 1e-6))[:, None]).T @ x).ravel()])


def newton_step(sums: np.ndarray, w: np.ndarray, l2: float) -> np.ndarray:
    k = len(w)
    return np.clip(np.linalg.solve(sums[k:].reshape(k, k) + l2 * np.eye(k), sums[:k] - l2 * w), -5, 5)


def logistic(counted: DataFrame, posterior: dict[tuple[int, ...], float], l2: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weights from all rows of ``counted`` (votes, features, n); a round sends one row of sums from each task."""
    w = np.zeros(WIDTH)
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            total = np.zeros(WIDTH + WIDTH**2)
            for batch in batches:
                if batch.num_rows:
                    x = np.array(batch.column("features").to_pylist())
                    y = np.array([posterior[tuple(v)] for v in batch.column("votes").to_pylist()])
                    total += newton_sums(x, y, batch.column("n").to_numpy().astype(float), w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

        found = {r.k: r.v for r in counted.mapInArrow(sums, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}  # WIDTH + WIDTH ** 2 rows
        step = newton_step(np.array([found.get(k, 0.0) for k in range(WIDTH + WIDTH**2)]), w, l2)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(docs: DataFrame) -> np.ndarray:
    """Weights of the span classifier, from all rows. Votes and features have few values each, so tasks count candidates before anything moves."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same: dict[tuple, int] = {}
            for text in batch.column("text").to_pylist():
                for c in candidates(text or ""):
                    same[c.votes, c.features] = same.get((c.votes, c.features), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([list(v) for v, _ in same], pa.list_(pa.int32())), pa.array([list(f) for _, f in same], pa.list_(pa.float64())), pa.array(list(same.values()), pa.int64())], names=["votes", "features", "n"])

    found = only(docs, "text").mapInArrow(label, "votes array<int>, features array<double>, n long")
    counted = written(found.groupBy("votes", "features").agg(F.sum("n").alias("n")))
    patterns = {tuple(r.votes): r.n for r in counted.groupBy("votes").agg(F.sum("n").alias("n")).collect()}  # at most 3 ** 5
    if not patterns:
        return np.eye(1, WIDTH, 0)[0] * -10.0
    return logistic(counted, reliabilities(patterns)[2])


def spans(text: str, weights: np.ndarray, threshold: float = 0.5) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) in order; added spans don't overlap any other."""
    found = candidates(text)
    out = [(c.kind, c.start, c.end, True) for c in found if c.base]
    # Base spans as disjoint stretches, by start.
    begin: list[int] = []
    stop: list[int] = []
    for _, a, b, _ in out:
        if begin and a < stop[-1]:
            stop[-1] = max(stop[-1], b)
        else:
            begin.append(a)
            stop.append(b)
    last, least = 0, float(np.log(threshold / (1 - threshold)))
    for c in found:
        if not c.base and c.start >= last and float(np.dot(c.features, weights)) >= least:
            k = bisect.bisect_left(begin, c.end) - 1
            if k < 0 or stop[k] <= c.start:
                out.append((c.kind, c.start, c.end, False))
                last = c.end
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def _written(found: list[tuple[str, int, int, bool]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)


def find(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end, comma-joined); a row for each row of docs."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_spans = [spans(text or "", weights) for text in batch.column("text").to_pylist()]
            base = [[s for s in x if s[3]] for x in all_spans]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in BASE), pa.array([hashlib.sha256(_written(x).encode()).hexdigest() for x in base], pa.string()), pa.array([_written(x) for x in all_spans], pa.string())], names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(apply, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in BASE)}, base_sha256 string, spans string")


def redact(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows with every span of their text replaced by its kind in angle brackets; overlapping spans fall to the first. Null stays null."""

    def one(text: str | None) -> str | None:
        if not text:
            return text
        parts, at = [], 0
        for kind, a, b, _ in spans(text, weights):
            if a >= at:
                parts += [text[at:a], f"<{kind.upper()}>"]
            elif b <= at:
                continue
            at = max(at, b)
        return "".join([*parts, text[at:]])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.names.index("text")
            yield batch.set_column(k, "text", pa.array([one(x) for x in batch.column("text").to_pylist()], pa.string()))

    return docs.mapInArrow(apply, docs.schema)

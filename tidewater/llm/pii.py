"""Personal data: candidate generators, boosted trees, calibrated thresholds.

Spans are code points, end exclusive.  *Base* spans are what the four plain
patterns match and their checks accept; they always stay.  High-recall
generators propose more spans, which may overlap each other: runs of digits
with separators (as ip, card and phone), everything around an ``@``, spelt-out
addresses (``name (at) host (dot) org``) and colon-separated hex groups.  Each
candidate is described by its format, after undoing the spelling, and by its
context; boosted trees score it; a score at or above its kind's threshold adds
the span, best score first, unless it overlaps a span that is already chosen.

The trees and thresholds learn from every candidate of every document: those
that are base spans are positive, those that overlap none are negative.  Equal
descriptions are counted by Spark (numbers above 64 rounded up to the next of 32
steps an octave); the driver gets the distinct ones, each with its two counts.
Only where there are more than ``MAX_CANDIDATES`` of these, the numbers of a
description are rounded up to the bounds of fewer and fewer bins of equal
weight, from histograms that Spark counts; no candidate is left out.  Every
candidate is scored by trees that were fitted on the other ``FOLDS - 1`` parts;
on these scores the threshold of each kind is the lowest at which at least
``PRECISION`` of the accepted candidates are positive, however few there are.
A kind without a positive adds nothing.

Between the digits of a candidate are at most three marks (more make two
candidates); nothing else limits a candidate's length.  Patterns run in linear
time on any text.  Null and empty texts have no spans;
rows that repeat a doc_id are searched each.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.boosting import Boosted, boost, weighted_cuts
from tidewater.llm.common import documents_of, fresh, written

KINDS = ("email", "ip", "card", "phone")
MAX_CANDIDATES = 50_000          # distinct descriptions on the driver
COARSER = (32, 16, 8, 4, 2, 1)    # bins of a number, where there are more
PRECISION = 0.98
FOLDS = 3
CONTEXT = 24

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# generators
DIGITS = re.compile(r"[0-9](?:[^\w\n]{0,3}[0-9]){3,}+")
SPELT = re.compile(r"(?<![\w.+-])[\w.+-]++ ?(?:\(at\)|\[at\]|\{at\}) ?[\w-]++"
                   r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[\w-]++)++", re.I)
HEX = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])")
AROUND = re.compile(r"[^\s@<>()\[\]{}\"',;:|]++")
UNSPELL = ((re.compile(r" ?[(\[{]at[)\]}] ?", re.I), "@"), (re.compile(r" ?[(\[{]dot[)\]}] ?", re.I), "."),
           (re.compile(r"\[\.\]|\(\.\)| ?\. ?"), "."))
HINTS = tuple(re.compile(p, re.I) for p in (
    r"mail|contact|write", r"tel|phone|call|fax|mobil", r"card|visa|credit|account|iban", r"\bip\b|host|server|addr",
    r"version|v\.|token|password|key|\bid\b|no\.|number"))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping: from each ``@`` the local part reaches back
    to its first other character or the last match."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at)
        nxt = at + 1
        if m:
            a = at
            while a > last and text[a - 1] in LOCAL:
                a -= 1
            if a < at:
                out.append((a, m.end()))
                last = nxt = m.end()
        at = text.find("@", nxt)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the accepted plain matches, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    first = DIGIT.search(text)
    if first:
        at = first.start()
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text, at) if all(int(g) <= 255 for g in m.groups() if len(g) < 9)
                and all(len(g.lstrip("0")) <= 3 for g in m.groups())]
        for m in CARD.finditer(text, at):
            d = NOT_DIGIT.sub("", m.group())
            if len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) proposed by the generators."""
    out = set()
    if DIGIT.search(text):
        for m in DIGITS.finditer(text):
            a, b = m.span()
            n = len(NOT_DIGIT.sub("", m.group()))
            groups = len(NOT_DIGIT.split(m.group()))
            if groups >= 4 and n <= 12:
                out.add((a, 1, b))
            if n >= 11:
                out.add((a, 2, b))
            if n >= 7:
                while a > 0 and text[a - 1] in "+(":
                    a -= 1
                out.add((a, 3, b))
        if ":" in text:
            out.update((m.start(), 1, m.end()) for m in HEX.finditer(text))
    last, at = 0, text.find("@")
    while at >= 0:
        right, left = AROUND.match(text, at + 1), AROUND.match(text[last:at][::-1])
        if right and left:
            out.add((at - left.end(), 0, at + 1 + len(right.group().rstrip(".!?"))))
        last = at + 1
        at = text.find("@", last)
    low = text.lower() if "at" in text or "AT" in text else ""
    if "(at)" in low or "[at]" in low or "{at}" in low:
        out.update((m.start(), 0, m.end()) for m in SPELT.finditer(text))
    return sorted(out)


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c in "\"'<>()[]" else 4 if c in "=:_/" else 5


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    s = text[start:end]
    for pattern, plain in UNSPELL:
        s = pattern.sub(plain, s)
    digits = NOT_DIGIT.sub("", s)
    groups = [g for g in NOT_DIGIT.split(s) if g] or [""]
    host = s.rpartition("@")[2]
    labels = host.split(".")
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    separators = {c for c in s if not c.isalnum()}
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        len(s), len(digits), sum(map(str.isalpha, s)), s.count("."), s.count("-"), s.count(" "), s.count("(") + s.count(")"),
        s.count(":"), s.count("@"), float(s.startswith("+")), float(s.startswith("00")), len(separators),
        len(groups), max(map(len, groups)), min(map(len, groups)), float(12 <= len(digits) <= 19 and luhn(digits)),
        float(len(groups) == 4 and all(len(g) <= 3 and int(g or 999) <= 255 for g in groups)),
        len(labels), len(labels[-1]), float(labels[-1].isalpha()), float(s.isascii()),
        float(_side(before[-1:])), float(_side(after[:1])),
        *[float(bool(h.search(before))) for h in HINTS]]


class Taken:
    """Disjoint intervals of a text that chosen spans cover."""

    def __init__(self, spans=()):
        self.starts, self.ends = [], []
        for a, _, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, span: tuple[int, int, int]) -> bool:
        i = bisect_right(self.ends, span[0])
        return i < len(self.starts) and self.starts[i] < span[2]

    def add(self, span: tuple[int, int, int]) -> None:
        i = bisect_right(self.starts, span[0])
        self.starts.insert(i, span[0])
        self.ends.insert(i, span[2])


class Finder:
    """Base spans and those that the trees add."""

    def __init__(self, model: tuple | None, thresholds: list[float]):
        self.model, self.thresholds = Boosted(*model) if model else None, thresholds

    def find(self, texts: list[str]) -> list[tuple[list, list]]:
        """(base, added) of each text."""
        found, rows, where, taken = [], [], [], {}
        for i, t in enumerate(texts):
            base = base_spans(t)
            found.append((base, []))
            if self.model and (proposed := candidates(t)):
                taken[i] = Taken(base)
                for c in proposed:
                    if not taken[i].meets(c):
                        rows.append(describe(t, *c))
                        where.append((i, c))
        if rows:
            score = self.model.probability(np.array(rows))
            for r in np.argsort(-score, kind="stable"):
                i, c = where[r]
                if score[r] >= self.thresholds[c[1]] and not taken[i].meets(c):
                    taken[i].add(c)
                    found[i][1].append(c)
        return found


def parts_of(weight: np.ndarray) -> np.ndarray:
    """How many of each row's copies fall into each of the ``FOLDS`` parts, when
    all copies are dealt in turn."""
    end = np.cumsum(weight)
    dealt = lambda n: (n[:, None] + FOLDS - 1 - np.arange(FOLDS)) // FOLDS
    return dealt(end) - dealt(end - weight)


def train(rows: np.ndarray, positive: np.ndarray, weight: np.ndarray | None = None) -> tuple[tuple | None, list[float]]:
    """Trees fitted on all rows, each counted ``weight`` times, and the
    threshold of each kind from scores of trees that did not see the copy."""
    never = [2.0] * len(KINDS)
    weight = np.ones(len(rows), np.int64) if weight is None else weight
    if weight[positive].sum() < 2 or positive.all():
        return None, never
    part = np.zeros((len(rows), FOLDS), np.int64)
    for label in (True, False):     # each part gets its share of both labels
        part[positive == label] = parts_of(weight[positive == label])
    score = np.zeros((len(rows), FOLDS))
    for f in range(FOLDS):
        seen = part[:, f] < weight
        if part[:, f].any():
            score[:, f] = boost(rows[seen], positive[seen].astype(float), weight=(weight - part[:, f])[seen]).probability(rows)
    for k in range(len(KINDS)):
        of, f = np.nonzero((rows[:, k] == 1)[:, None] & (part > 0))
        s, n, y = score[of, f], part[of, f], positive[of]
        if not y.any():
            continue
        order = np.argsort(-s, kind="stable")
        s, right = s[order], np.cumsum((n * y)[order]) / np.cumsum(n[order])
        ends = np.append(s[1:] != s[:-1], True)
        good = np.flatnonzero(ends & (right >= PRECISION))
        if len(good):
            never[k] = max(float(s[good[-1]]), 0.5)
    return boost(rows, positive.astype(float), weight=weight).parts(), never


def rounded_up(v: np.ndarray) -> np.ndarray:
    """Whole numbers, those above 64 on a grid of 32 steps an octave."""
    v = np.asarray(v, np.int64)
    step = np.int64(1) << np.maximum(np.frexp(np.maximum(v, 1).astype(float))[1] - 6, 0)
    return -(-v // step) * step


CELL = "x array<long>, pos long, neg long"


def _counted(cells: DataFrame) -> DataFrame:
    cells = cells.groupBy("x").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return written(cells, "pii-descriptions")


def described(docs: DataFrame) -> DataFrame:
    """(x, pos, neg): the distinct descriptions of all documents' candidates
    and how many are base spans and how many overlap none."""
    def gather(batches):
        for b in batches:
            rows, label = [], []
            for t in pc.fill_null(b.column("text"), "").to_pylist():
                proposed = candidates(t)
                base = set(base_spans(t)) if proposed else ()
                taken = Taken(base)
                for c in proposed:
                    if c in base or not taken.meets(c):
                        rows.append(describe(t, *c))
                        label.append(c in base)
            if rows:
                label = np.array(label, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rounded_up(rows)), pa.list_(pa.int64())), pa.array(label), pa.array(1 - label)], names=["x", "pos", "neg"])

    return _counted(documents_of(docs, "doc_id", "text").mapInArrow(gather, CELL))


def coarser(cells: DataFrame, bins: int) -> DataFrame:
    """The same with at most ``bins`` values (bounds, the highest the largest
    value) of every number but the kinds."""
    seen = cells.select(F.posexplode("x").alias("j", "v"), (F.col("pos") + F.col("neg")).alias("n")) \
        .groupBy("j", "v").agg(F.sum("n").alias("n")).orderBy("j", "v").toPandas()   # a grid's values of each number
    bounds = {}
    for j, of in seen.groupby("j"):
        if j >= len(KINDS):
            v = of["v"].to_numpy()
            bounds[j] = np.union1d(weighted_cuts(v, of["n"].to_numpy(), bins) if bins > 1 else [], v[-1:]).astype(np.int64)

    def merge(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy().reshape(b.num_rows, -1).copy()
                for j, at in bounds.items():
                    x[:, j] = at[np.searchsorted(at, x[:, j])]
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.int64())), b.column("pos"), b.column("neg")],
                                                 names=["x", "pos", "neg"])

    return _counted(cells.mapInArrow(merge, CELL))


def fit(docs: DataFrame, max_candidates: int = MAX_CANDIDATES) -> tuple[tuple | None, list[float]]:
    """Model and thresholds from the candidates of all documents; nothing is
    learnt where not even the kinds are at most ``max_candidates``."""
    cells, bins = described(docs), iter(COARSER)
    while (n := cells.count()) > max_candidates and (b := next(bins, None)):
        cells = coarser(cells, b)
    if n == 0 or n > max_candidates:
        return None, [2.0] * len(KINDS)
    got = cells.orderBy(F.xxhash64("x"), "x").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(n, -1).astype(np.float64)
    count = np.concatenate([got[c].to_numpy() for c in ("pos", "neg")])
    some = count > 0
    return train(np.concatenate((x, x))[some], (np.arange(2 * n) < n)[some], count[some])


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_pii(docs: DataFrame, model=None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added,
    n_spans) of every row; n_spans counts base and added spans of all kinds."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))  # one model: a few hundred numbers a tree

    def search(batches):
        finder = Finder(*shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                found = finder.find(pc.fill_null(b.column("text").slice(at, 512), "").to_pylist())
                count = np.zeros((len(found), len(KINDS)), np.int64)
                for i, (base, _) in enumerate(found):
                    for _, k, _ in base:
                        count[i, k] += 1
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, 512), *[pa.array(count[:, k]) for k in range(len(KINDS))],
                     pa.array([hashlib.sha256(_joined(x).encode()).hexdigest() for x, _ in found]),
                     pa.array([_joined(x + y) for x, y in found]), pa.array([len(y) for _, y in found], pa.int64()),
                     pa.array([len(x) + len(y) for x, y in found], pa.int64())],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "n_spans"])

    return documents_of(docs, "doc_id", "text").mapInArrow(
        search, "doc_id long, " + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string, n_added long, n_spans long")


def redacted(docs: DataFrame, model=None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; where
    spans overlap, the union is replaced under the first kind."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    @F.pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        finder, out = Finder(*shared.value), []
        for t in text:
            base, added = finder.find([t or ""])[0]
            parts, at = [], 0
            for a, k, b in sorted(base + added):
                if a >= at:
                    parts += [t[at:a], f"[{KINDS[k].upper()}]"]
                at = max(at, b)
            out.append(t if t is None else "".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    x = fresh(docs, "__clean")
    cols = [F.col(x).alias(c) if c == "text" else docs[c] for c in docs.columns]
    return docs.withColumn(x, clean(F.col("text").cast("string"))).select(*cols)

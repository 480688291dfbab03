"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1 outside the held-out fold;
unlabelled web text is what the labels do not cover in the same folds; where
that is under ``LEAST_UNLABELLED`` documents, it is all documents of these
folds with their labels hidden.  Each
whole text becomes a few shares and rates (see ``FEATURES``); each feature is
cut at its quantiles and the score is logistic in the cells.  Training
minimises the non-negative unbiased risk of Kiryo et al. (2017),

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),

with the logistic loss: where the second part is negative, the step raises it
instead.  The class prior is estimated first: a positive-against-unlabelled
score is fitted, and on rows kept out of that fit the prior is the smallest
upper bound of share(unlabelled above t) / share(positives above t) over all
thresholds t (best-bin estimation, Garg et al. 2021).  Last, the margin is
scaled to a posterior with the prior and the two densities of the margin.

Fitted on at most about ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` rows, chosen
by the hash of their id; every row is scored over its whole text.

Cases: a null text is an empty one, and empty texts have a score too;
repeated labels of a document count as positive if all say 1; null labels are
ignored; without positives every score is the prior 0.5;
rows that repeat a doc_id are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import (IS_SPACE, documents_of, held_out, mixed, per_row, run_hashes, text_slices, word_ends,
                                  word_starts, written)

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 40_000
LEAST_UNLABELLED = 1_000
THRESHOLD = 0.3
# Quantiles at which features are cut; junk sits in the tails.
CUTS = (0.005, 0.01, 0.02, 0.04, *(i / 12 for i in range(1, 12)), 0.96, 0.98, 0.99, 0.995)
CELLS = len(CUTS) + 1
STEPS = 600
FEATURES = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "mark", "odd_mark", "bang", "bar", "stop",
            "wide", "space", "line_words", "line_repeat", "word_repeat", "next_same", "new_words", "pair_repeat",
            "marked_word", "all_upper_word", "single_word")


def _bytes(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_UPPER, _LOWER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _bytes("0123456789")
_MARK = ~(_UPPER | _LOWER | _DIGIT | IS_SPACE)
_MARK[0x80:] = False
_ODD, _STOP = _bytes("#$%&*@^~<>{}[]\\_=+/"), _bytes(".,;:?")
_WIDE = np.zeros(256, bool)
_WIDE[0xC0:] = True


def distinct_share(doc: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """Distinct codes of each document over its number of codes (1 if none)."""
    total = np.bincount(doc, minlength=n)
    if not len(doc):
        return np.ones(n)
    key = mixed(code + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(key, kind="stable")
    k, d = key[order], doc[order]
    new = np.append(True, k[1:] != k[:-1])
    return np.where(total > 0, np.bincount(d[new], minlength=n) / np.maximum(total, 1), 1.0)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row per text (:data:`FEATURES`) from UTF-8 bytes and offsets; the
    first byte run of each text is aligned to its offset."""
    n = len(off) - 1
    size = np.diff(off)
    words = word_starts(data, off)
    start = np.flatnonzero(words)
    doc = np.searchsorted(off, start, side="right") - 1
    space = IS_SPACE[data]
    end = word_ends(data, off, start, doc)
    count = np.bincount(doc, minlength=n)
    safe, per = np.maximum(size, 1), np.maximum(count, 1)
    share = lambda mask: per_row(mask, off) / safe

    def in_words(table):
        run = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=run[1:])
        return run[end] - run[start]

    by_doc = lambda mask: np.bincount(doc[mask], minlength=n) / per
    code = run_hashes(data, start, end)
    same = np.zeros(len(start), bool)
    same[1:] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    pairs = mixed(code[pair] * np.uint64(3) + code[pair + 1])
    # lines: runs between newlines
    newline = data == 10
    lstart = np.unique(np.concatenate((off[:-1][size > 0], np.flatnonzero(newline) + 1)))
    lstart = lstart[lstart < len(data)]
    ldoc = np.searchsorted(off, lstart, side="right") - 1
    lend = np.append(lstart[1:], len(data))
    lines = np.bincount(ldoc, minlength=n)
    upper, lower, odd, mark = in_words(_UPPER), in_words(_LOWER), in_words(_ODD), in_words(_MARK)
    letters = np.maximum(per_row(_UPPER[data] | _LOWER[data], off), 1)
    # the most frequent word, among the hashes modulo 64
    top = np.bincount(doc * 64 + (code & np.uint64(63)).astype(np.int64), minlength=64 * n).reshape(n, 64).max(axis=1) / per
    return np.column_stack([
        np.log1p(size), np.log1p(count), np.bincount(doc, end - start, n) / per, per_row(_UPPER[data], off) / letters,
        share(_DIGIT[data]), share(_MARK[data]), share(_ODD[data]), share(data == 33), share(data == 124), share(_STOP[data]),
        share(_WIDE[data]), share(space), count / np.maximum(lines, 1), distinct_share(ldoc, run_hashes(data, lstart, lend), n),
        top, by_doc(same), distinct_share(doc, code, n), distinct_share(doc[pair], pairs, n),
        by_doc((odd > 0) | (mark > 1)), by_doc((upper > 1) & (lower == 0)), by_doc(end - start == 1)]).astype(np.float32)


def document_features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every row."""
    def extract(batches):
        for b in batches:
            for first, end, data, off in text_slices(b.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, end - first), pa.array(list(features(data, off)), pa.list_(pa.float32()))],
                    names=["doc_id", "x"])

    return documents_of(docs, "doc_id", "text").mapInArrow(extract, "doc_id long, x array<float>")


# ---------------------------------------------------------------- the model
def cells(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Column index of each feature's cell in the one-hot matrix."""
    return np.column_stack([np.searchsorted(c, x[:, j], side="right") + j * CELLS for j, c in enumerate(cuts)])


def logit(cell: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return weights[cell].sum(axis=1) + weights[-1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def gradient(cell: np.ndarray, slope: np.ndarray, size: int) -> np.ndarray:
    g = np.bincount(cell.ravel(), np.repeat(slope, cell.shape[1]), size)
    g[-1] = slope.sum()
    return g


def minimise(step, size: int, steps: int = STEPS, rate: float = 0.05) -> np.ndarray:
    """Adam on a gradient function."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = step(w) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def non_negative_risk(pos: np.ndarray, unl: np.ndarray, prior: float, size: int) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk (logistic loss)."""
    def step(w):
        zp, zu = logit(pos, w), logit(unl, w)
        slope_p, slope_u = sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)   # of the loss as negative
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_neg = gradient(unl, slope_u, size) - prior * gradient(pos, slope_p, size)
        if negative < 0:
            return -g_neg
        return prior * gradient(pos, slope_p - 1 / len(zp), size) + g_neg
    return minimise(step, size)


def class_prior(pos: np.ndarray, unl: np.ndarray, size: int) -> float:
    """Best-bin estimate of the share of positives in the unlabelled rows."""
    def step(w):
        zp, zu = logit(pos[::2], w), logit(unl[::2], w)
        return gradient(pos[::2], (sigmoid(zp) - 1) / len(zp), size) + gradient(unl[::2], sigmoid(zu) / len(zu), size)
    w = minimise(step, size, 400)
    zp, zu = np.sort(logit(pos[1::2], w)), np.sort(logit(unl[1::2], w))
    above_p = 1 - np.searchsorted(zp, zp, side="left") / len(zp)
    above_u = 1 - np.searchsorted(zu, zp, side="left") / len(zu)
    slack = np.sqrt(np.log(20) / (2 * len(zu))) + np.sqrt(np.log(20) / (2 * len(zp)))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def calibration(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset that turn the margin into a posterior.  In bins of the
    margin the posterior of unlabelled rows is prior * share(positives) /
    share(unlabelled), made monotone by pooling neighbours; a logistic curve
    is fitted to it."""
    edge = np.unique(np.quantile(zu, np.linspace(0, 1, 65)[1:-1]))
    bin_p = np.bincount(np.searchsorted(edge, zp, side="right"), minlength=len(edge) + 1)
    own = np.searchsorted(edge, zu, side="right")
    bin_u = np.bincount(own, minlength=len(edge) + 1)
    middle = np.bincount(own, zu, len(edge) + 1) / np.maximum(bin_u, 1)
    pools: list[list[float]] = []           # posterior, unlabelled rows, bins
    for p, u in zip(bin_p / len(zp), bin_u):
        pools.append([prior * p / max(u / len(zu), 1e-9), float(u), 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, n, k = pools.pop()
            w = pools[-1]
            w[0], w[1], w[2] = (w[0] * w[1] + v * n) / max(w[1] + n, 1e-9), w[1] + n, w[2] + k
    target = np.clip(np.repeat([v for v, _, _ in pools], [k for _, _, k in pools]), 0.001, 0.999)
    weight = bin_u / bin_u.sum()
    scale = max(float(np.std(zu)), 1e-6)
    x = middle / scale

    def step(w):
        slope = weight * (sigmoid(w[0] * x + w[1]) - target)
        return np.array([(slope * x).sum(), slope.sum()])

    a, b = minimise(step, 2, 3000)
    return (a / scale, b) if a > 0 else (1.0, 0.0)


class Quality:
    def __init__(self, cuts: list[np.ndarray], weights: np.ndarray):
        self.cuts, self.weights = cuts, weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return sigmoid(logit(cells(x, self.cuts), self.weights))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[Quality, float]:
    """The model and the estimated class prior."""
    if not len(positive) or not len(unlabelled):
        return Quality([], None), 0.5
    both = np.concatenate((positive, unlabelled))
    cuts = [np.unique(np.quantile(both[:, j], CUTS)) for j in range(both.shape[1])]
    size = len(cuts) * CELLS + 1
    pos, unl = cells(positive, cuts), cells(unlabelled, cuts)
    prior = class_prior(pos, unl, size) if len(pos) > 20 and len(unl) > 20 else 0.5
    weights = non_negative_risk(pos, unl, prior, size)
    a, b = calibration(logit(pos, weights), logit(unl, weights), prior)
    weights = a * weights
    weights[-1] += b
    return Quality(cuts, weights), prior


def _bounded(rows: DataFrame, most: int) -> np.ndarray:
    """At most about ``most`` feature rows, by the hash of the id, in a fixed
    order."""
    n = rows.count()
    keep = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) * F.lit(n) < F.lit(most << 20)) if n > most else rows
    got = keep.select("x").toArrow()["x"].to_pylist()
    return np.array(sorted(got), np.float64).reshape(-1, len(FEATURES))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, class_prior) of every row."""
    rows = written(document_features(docs), "quality-features")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter(~held_out() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")))
    known = written(known, "quality-labels")
    covered = labels.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    learn = rows.filter(~held_out())
    positive = _bounded(learn.join(known.filter("quality = 1"), "doc_id", "left_semi"), MAX_POSITIVE)
    uncovered = written(learn.join(covered, "doc_id", "left_anti"), "quality-unlabelled")
    unlabelled = _bounded(learn if uncovered.count() < LEAST_UNLABELLED else uncovered, MAX_UNLABELLED)
    model, prior = train(positive, unlabelled)
    cuts, weights = model.cuts, model.weights

    def score(batches):
        m = Quality(cuts, weights)
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(m.score(x))], names=["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.lit(prior).alias("class_prior"))

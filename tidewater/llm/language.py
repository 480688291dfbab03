"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (pairs and triples inside a word
and at its edges, lower case): ``log(1 + count) * idf``, length 1.  Each
language of the labelled sample is split into several clusters by spherical
k-means; a text gets the language of the centroid with the largest cosine.
A text is rejected when it has no letter, or when that cosine is below what
the sample's texts of about the same length reach (``FLOOR_QUANTILE`` of them,
times ``FLOOR_SLACK``): it is too far from every centroid.  Lengths are bands of
one power of two; a band with under ``FLOOR_ROWS`` rows is pooled with as many
neighbours on both sides as give that many, so every band has a floor.  A
sample row is measured without its own part in its centroid.

The model is fitted on at most about ``TRAIN_PER_LANG`` rows per language,
chosen by the hash of their id among the rows outside the held-out fold; every
row is then scored over its whole text.

Cases: null text, or no letter: ``und`` with score 0; no labelled row to learn
from: ``und`` for all; rows that repeat a doc_id are scored each; a null lang
is never learned; a sample of under ``FLOOR_ROWS`` rows is one pool; a language's
only sample row says nothing about floors.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import documents_of, fresh, held_out, written

TRAIN_PER_LANG = 1500
MAX_LANGS = 1000                  # languages, the most frequent first
CENTROIDS = 4
ROUNDS = 12
DIM = 4096
FLOOR_QUANTILE = 0.001
FLOOR_SLACK = 0.75
FLOOR_ROWS = 100
BANDS = 16
LETTER = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]")
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x61:0x7b] = np.arange(0x61, 0x7b)
_FOLD[0x41:0x5b] = np.arange(0x61, 0x7b)


def has_letter(text: str) -> bool:
    return LETTER.search(text) is not None or any(map(str.isalpha, text))


def gram_counts(texts: list[str], dim: int = DIM) -> np.ndarray:
    """One row of hashed n-gram counts per text."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    at = np.concatenate(([0], np.cumsum(size + 1)))       # a space before each text and after the last
    src = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    b = _FOLD[src]
    # the second byte of an upper-case Latin-1 letter
    b[1:][(src[:-1] == 0xC3) & (src[1:] >= 0x80) & (src[1:] <= 0x9E)] |= 0x20
    b = b.astype(np.uint32)
    shift = np.uint32(32 - dim.bit_length() + 1)
    two = b[:-1] << np.uint32(8) | b[1:]
    three = two[:-1] << np.uint32(8) | b[2:]
    h2 = ((two + np.uint32(1)) * np.uint32(2246822519)) >> shift
    h3 = (three * np.uint32(2654435761)) >> shift
    h2[two == 0x2020] = dim
    h3[b[1:-1] == 0x20] = dim
    out = np.empty((len(raw), dim), np.float32)
    for i, (a, n) in enumerate(zip(at, size)):
        out[i] = (np.bincount(h2[a:a + n + 1], minlength=dim + 1) + np.bincount(h3[a:a + n], minlength=dim + 1))[:dim]
    return out


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def sample_vectors(texts: list[str], idf: np.ndarray, at_once: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and length bands of the texts that have n-grams, ``at_once``
    texts at a time: only the result is as large as the sample."""
    x, band, n = np.empty((len(texts), len(idf)), np.float32), [], 0
    for at in range(0, len(texts), at_once):
        counts = gram_counts(texts[at:at + at_once])
        size = counts.sum(axis=1)
        counts = counts[size > 0]
        x[n:n + len(counts)] = unit(counts, idf)
        band.append(length_band(size[size > 0]))
        n += len(counts)
    return x[:n], np.concatenate(band or [np.zeros(0, np.int64)])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids; the first ones are chosen farthest-first."""
    first = x.sum(axis=0)
    chosen = [int(np.argmax(x @ first))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        nxt = int(np.argmin(near))
        if near[nxt] > 1 - 1e-6:
            break
        chosen.append(nxt)
        near = np.maximum(near, x @ x[nxt])
    c = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        new = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c, atol=1e-6):
            break
        c = new
    return c


def length_band(n_grams: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n_grams, 1)).astype(np.int64), BANDS - 1)


def cosine_to_others(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The largest cosine of each row with a centroid, its own part taken out
    of the one it belongs to; -inf if nothing else is there."""
    cosine = x @ c.T
    own = np.argmax(cosine, axis=1)
    for j in range(len(c)):
        mine = own == j
        total = x[mine].sum(axis=0)
        dot = x[mine] @ total
        rest = np.sqrt(np.maximum(total @ total - 2 * dot + 1, 1e-12))
        cosine[mine, j] = (dot - 1) / rest if mine.sum() > 1 else -np.inf
    return cosine.max(axis=1)


def floors(band: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """The floor of each length band, from the rows of the nearest bands that
    hold ``FLOOR_ROWS`` together (or all there are)."""
    out = np.zeros(BANDS)
    for k in range(BANDS):
        away = np.abs(band - k)
        reach = next((r for r in range(BANDS) if (away <= r).sum() >= FLOOR_ROWS), BANDS)
        if len(near := cosine[away <= reach]):
            out[k] = np.quantile(near, FLOOR_QUANTILE) * FLOOR_SLACK
    return out


class Centroids:
    def __init__(self, idf: np.ndarray, langs: list[str], matrix: np.ndarray, floor: np.ndarray):
        self.idf, self.langs, self.matrix, self.floor = idf, langs, matrix, floor

    def parts(self) -> tuple:
        """Plain values to broadcast: MAX_LANGS * CENTROIDS vectors at most."""
        return self.idf, self.langs, self.matrix, self.floor

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected) of each text."""
        letters = np.array([has_letter(t) for t in texts], bool)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        counts = gram_counts(texts)
        cosine = unit(counts, self.idf) @ self.matrix.T
        best = np.argmax(cosine, axis=1)
        top = np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0).astype(np.float64)
        rejected = ~letters | (top < self.floor[length_band(counts.sum(axis=1))])
        return ([self.langs[j] if ok else UNKNOWN for j, ok in zip(best, letters)], np.where(letters, top, 0.0), rejected)


def training_sample(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> DataFrame:
    """(lang, text) of at most about ``per_lang`` rows per language outside
    the held-out fold, chosen by the hash of the id."""
    d = documents_of(docs, "doc_id", "lang", "text").filter(F.col("lang").isNotNull() & ~held_out())
    langs = (d.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
             .withColumnRenamed("lang", "l"))
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20))
    return d.join(F.broadcast(langs), (F.col("lang") == F.col("l")) & (u * F.col("n") < F.lit(per_lang << 20))) \
        .select("lang", "text")


def fit(docs: DataFrame, per_lang: int = TRAIN_PER_LANG, centroids: int = CENTROIDS) -> Centroids:
    """Cluster each language's sample in a task of its own; the driver gets
    document frequencies, centroids and floors only."""
    sample = written(training_sample(docs, per_lang).repartition(12), "lang-sample")

    def frequencies(batches):
        df, n = np.zeros(DIM, np.int64), 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                x = gram_counts(pc.fill_null(b.column("text").slice(at, 256), "").to_pylist())
                df += (x > 0).sum(axis=0)
                n += len(x)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n]), "df": pa.array([df.tolist()])})

    parts = sample.mapInArrow(frequencies, "n long, df array<long>").collect()
    n = sum(r.n for r in parts)
    if n == 0:
        return Centroids(np.ones(DIM, np.float32), [], np.zeros((0, DIM), np.float32), np.zeros(BANDS))
    df = np.sum([r.df for r in parts], axis=0)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        x, band = sample_vectors([t or "" for t in pdf["text"].sort_values(na_position="first")], idf)
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "band": [], "cosine": []})
        c = spherical_kmeans(x, centroids)
        own = cosine_to_others(x, c)
        band = band[np.isfinite(own)]
        own = own[np.isfinite(own)]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [v.astype(np.float32).tobytes() for v in c],
                             "band": [band.tolist()] + [[]] * (len(c) - 1), "cosine": [own.tolist()] + [[]] * (len(c) - 1)})

    rows = (sample.groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, band array<long>, cosine array<double>")
            .orderBy("lang", "centroid").collect())
    band = np.concatenate([np.asarray(r.band, np.int64) for r in rows] or [np.zeros(0, np.int64)])
    cosine = np.concatenate([np.asarray(r.cosine, np.float64) for r in rows] or [np.zeros(0)])
    matrix = np.stack([np.frombuffer(r.centroid, np.float32) for r in rows]) if rows else np.zeros((0, DIM), np.float32)
    return Centroids(idf, [r.lang for r in rows], matrix, floors(band, cosine))


def identify(docs: DataFrame, model: Centroids | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row."""
    model = docs.sparkSession.sparkContext.broadcast((model or fit(docs)).parts())

    def predict(batches):
        m = Centroids(*model.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                ids = b.column("doc_id").slice(at, 256)
                lang, score, rejected = m.predict(pc.fill_null(b.column("text").slice(at, 256), "").to_pylist())
                yield pa.RecordBatch.from_arrays([ids, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                                 names=["doc_id", "lang_pred", "score", "rejected"])

    out = documents_of(docs, "doc_id", "text").mapInArrow(
        predict, "doc_id long, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def identified(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, all columns of the input; decided
    where a row is read."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs).parts())

    @F.pandas_udf("boolean")
    def keeps(text: pd.Series) -> pd.Series:
        m, texts, out = Centroids(*model.value), [t or "" for t in text], []
        for at in range(0, len(texts), 256):
            out.append(~m.predict(texts[at:at + 256])[2])
        return pd.Series(np.concatenate(out) if out else np.zeros(0, bool))

    k = fresh(docs, "__lang_kept")
    return docs.withColumn(k, keeps(F.col("text").cast("string"))).filter(F.col(k)).select(*[docs[c] for c in docs.columns])

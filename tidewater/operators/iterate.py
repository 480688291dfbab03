"""Iteration: feedback loops and bulk k-means rounds.

* ``iterate_until``: a general feedback loop over rows -- each round applies
  one step, rows that leave the loop are written out, the others go round
  again.
* ``fibonacci_steps``: the feedback-loop sample (step ``(x, y) -> (y, x+y)``
  until either number reaches the bound) as one Arrow-batched function, for
  batch and streaming columns.
* k-means: each round is one distributed job (assign by nearest centroid,
  mean per cluster with a partial/final aggregate); only the k centroids go
  through the driver between rounds.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tidewater.session import prepare, scratch_path


def taken_step(df: DataFrame, step: Callable[[DataFrame], DataFrame], again: Column, tag: str) -> DataFrame:
    """The rows after a step, with their types, and whether they go on."""
    taken = step(df).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return taken.withColumn(tag, F.coalesce(again, F.lit(False)))


def iterate_until(df: DataFrame, step: Callable[[DataFrame], DataFrame], again: Column) -> DataFrame:
    """Feedback loop: every row takes a step, then leaves the loop unless
    ``again`` holds for it (a null counts as leaving).  ``step`` keeps the
    columns.  Every round is written below the shared checkpoint folder, so
    neither the plan nor what a lost executor costs grows with the number of
    rounds; there is no limit on it.  A stream is run through the loop as far
    as its source goes now (``streaming/feedback.py`` has its parts)."""
    spark = prepare(df.sparkSession)
    path = scratch_path(spark, "iterate")
    if df.isStreaming:
        from tidewater.streaming.feedback import iterate_stream
        return iterate_stream(df, step, again, path, scratch_path(spark, "iterate-ckpt"))
    rounds = []
    while True:
        tagged = taken_step(df, step, again, "__again")
        rounds.append(f"{path}/{len(rounds):06d}")
        tagged.write.parquet(rounds[-1])
        df = spark.read.schema(tagged.schema).parquet(rounds[-1]).filter("__again").drop("__again")
        if df.isEmpty():
            break
    return spark.read.schema(tagged.schema).parquet(*rounds).filter("NOT __again").drop("__again")


def fibonacci_steps(a: Column, b: Column, bound: int = 100) -> Column:
    """Number of steps until ``x >= bound or y >= bound`` (at least one step
    is always taken), in 32-bit arithmetic that wraps around, so every pair
    but (0, 0) gets there; (0, 0), which would go round for ever, and nulls
    give NULL.  The rows of an Arrow batch take their steps together."""

    @pandas_udf("int")
    def steps(x: pd.Series, y: pd.Series) -> pd.Series:
        usable = (x.notna() & y.notna()).to_numpy()
        u = x.fillna(0).to_numpy(np.int64).astype(np.int32)
        v = y.fillna(0).to_numpy(np.int64).astype(np.int32)
        usable &= (u != 0) | (v != 0)
        n = np.zeros(len(u), np.int32)
        active = np.flatnonzero(usable)
        while len(active):
            nxt = u[active] + v[active]
            u[active], v[active] = v[active], nxt
            n[active] += 1
            active = active[(u[active] < bound) & (v[active] < bound)]
        return pd.Series(n, dtype="Int32").where(usable)

    return steps(a.cast("long"), b.cast("long"))


# ------------------------------------------------------------------ k-means
def as_vectors(points: DataFrame, col: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return points.withColumn("__vec", array_to_vector(F.col(col).cast("array<double>")))


def nearest_udf(centroids: list[tuple[int, list[float]]]):
    """Arrow-batched nearest-centroid function: each batch of points becomes
    one ``n x d`` matrix and the squared distances to the k centroids are k
    vectorised numpy passes (memory ``n x d``).  Ties keep the smallest id.
    NULL points give NULL."""
    ordered = sorted(centroids)
    ids = np.array([int(c) for c, _ in ordered], dtype=np.int32)
    cmat = np.array([list(v) for _, v in ordered], dtype=np.float64)

    @pandas_udf("int")
    def assign(points: pd.Series) -> pd.Series:
        out = pd.Series(pd.array([None] * len(points), dtype="Int32"))
        present = points.notna().to_numpy()
        if not present.any():
            return out
        pmat = np.stack(points[present].to_numpy()).astype(np.float64, copy=False)
        if pmat.shape[1] != cmat.shape[1]:
            raise ValueError(f"point dimension {pmat.shape[1]} != centroid dimension {cmat.shape[1]}")
        best = np.full(len(pmat), np.inf)
        arg = np.zeros(len(pmat), dtype=np.int64)
        for j in range(len(cmat)):
            d = pmat - cmat[j]
            d = np.einsum("ij,ij->i", d, d)
            closer = d < best
            best = np.where(closer, d, best)
            arg = np.where(closer, j, arg)
        out[present] = ids[arg]
        return out

    return assign


# Centroid values that travel inside the assignment function (32 MB).
MAX_CENTROID_VALUES = 4_000_000


def kmeans_assign(points: DataFrame, col: str, centroids: list[tuple[int, list[float]]],
                  out: str = "cluster_id") -> DataFrame:
    """Nearest-centroid column.  The centroids travel inside the function;
    only the vector column is shipped to Python, the other columns stay in
    the JVM.  More centroids than ``MAX_CENTROID_VALUES`` values travel in
    blocks, one function per block over the same points: each gives its
    nearest and the distance, and the smallest wins (on equal distance the
    smallest id)."""
    v = F.col(col).cast("array<double>")
    ordered = sorted(centroids)
    per_block = max(1, MAX_CENTROID_VALUES // max(1, len(ordered[0][1]) if ordered else 1))
    if len(ordered) <= per_block:
        return points.withColumn(out, nearest_udf(ordered)(v))
    blocks = [nearest_distance_udf(ordered[i:i + per_block])(v) for i in range(0, len(ordered), per_block)]
    return points.withColumn(out, F.array_min(F.array(*blocks))["id"])


def nearest_distance_udf(centroids: list[tuple[int, list[float]]]):
    """As :func:`nearest_udf`, with the squared distance first."""
    ids, cmat = np.array([c for c, _ in centroids], np.int32), np.array([v for _, v in centroids], np.float64)

    @pandas_udf("d double, id int")
    def assign(points: pd.Series) -> pd.DataFrame:
        best, arg = np.full(len(points), np.nan), np.zeros(len(points), np.int64)
        present = points.notna().to_numpy()
        if present.any():
            pmat = np.stack(points[present].to_numpy()).astype(np.float64, copy=False)
            near, at = np.full(len(pmat), np.inf), np.zeros(len(pmat), np.int64)
            for j in range(len(cmat)):
                d = np.einsum("ij,ij->i", pmat - cmat[j], pmat - cmat[j])
                near, at = np.minimum(near, d), np.where(d < near, j, at)
            best[present], arg[present] = near, at
        return pd.DataFrame({"d": best, "id": pd.Series(ids[arg], dtype="Int32").where(present)})

    return assign


def cluster_means(assigned: DataFrame, col: str, cluster: str = "cluster_id") -> DataFrame:
    """Mean vector and size per cluster (partial/final vector aggregate);
    clusters without points do not appear."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    v = as_vectors(assigned, col)
    return (v.groupBy(cluster)
            .agg(Summarizer.mean(F.col("__vec")).alias("m"), F.count(F.lit(1)).alias("n"))
            .select(cluster, "n", vector_to_array("m").alias("centroid")))


def collect_centroids(means: DataFrame, cluster: str = "cluster_id"):
    """The k centroids, which the next round's functions carry."""
    return sorted((r[0], list(r[1])) for r in means.select(cluster, "centroid").collect())


def kmeans(points: DataFrame, col: str, initial: list[tuple[int, list[float]]], iterations: int = 10):
    """Fixed number of rounds; returns the final centroid list."""
    pts = points.select(F.col(col).cast("array<double>").alias(col)).persist()
    cents = initial
    try:
        for _ in range(iterations):
            cents = collect_centroids(cluster_means(kmeans_assign(pts, col, cents), col))
    finally:
        pts.unpersist()
    return cents


def initial_centroids_by_label(points: DataFrame, col: str, label: str):
    """Seed centroids: the mean vector of each label."""
    means = cluster_means(points.withColumnRenamed(label, "cluster_id"), col)
    return collect_centroids(means)

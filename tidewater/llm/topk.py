"""Exact top-k inner products by Fagin's threshold algorithm.

Every component x becomes the integer floor(64 * x).  The vectors are dealt
into blocks; a block keeps one sorted list per dimension.  A query walks the
lists from the end its sign prefers: rows met in any list are scored in full
(random access), and the walk stops when the threshold, the score of a made-up
row with the current value of every list, is below the k-th best score (at
equality a row with a smaller id could still enter).  Where more than half of
a block has been met and the threshold still holds, the rest of the lists is
read in one go.  The best k of each (query, block) are merged by a window.

The queries meet the blocks in groups: a task holds one block and at most
about ``QUERY_GROUP`` query rows, whatever the numbers of both; blocks and
groups are dealt by a row number, so an id that repeats fills no block.

Scores are exact.  Where a block's products stay below 2^53, float arithmetic
is exact by itself; elsewhere each float score comes with a bound of its error,
the walk stops and prunes by those bounds, and the rows that are left are
scored in whole numbers of any size, which travel as two longs.

Cases: vectors that are null, empty or hold null or non-finite components
take no part, nor do rows without an id; every row of a repeated vec_id is a
candidate of the others, and its rows ask one query together: their best k
scores, none of them with a row of that id; vectors of different lengths are
not compared; a result whose score is no long raises an error, as does a
component whose 64-fold is no finite double.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.llm.common import written

K = 20
BLOCK = 8192
QUERY_GROUP = 8192
SCALE = 64.0
LARGEST = np.finfo(np.float64).max / SCALE
FIRST_DEPTH = 32
LOW_BITS = 60
LOW_MASK = (1 << LOW_BITS) - 1


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, v, row): the components of usable vectors as little-endian
    doubles that are whole numbers, and a number for each row."""
    d = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")) \
        .filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0))

    def pack(batches):
        for b in batches:
            ids, dim, out = [], [], []
            for i, e in zip(b.column("vec_id").to_pylist(), b.column("e")):
                x = e.values
                if x.null_count:
                    continue
                x = x.to_numpy(zero_copy_only=False)
                if np.isfinite(x).all():
                    if np.abs(x).max() > LARGEST:
                        raise ValueError(f"vec_id {i}: a component beyond {LARGEST}")
                    ids.append(i)
                    dim.append(len(x))
                    out.append(np.floor(SCALE * x).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dim, pa.int32()), pa.array(out, pa.binary())],
                                             names=["vec_id", "dim", "v"])

    return d.mapInArrow(pack, "vec_id long, dim int, v binary").withColumn("row", F.monotonically_increasing_id())


def whole_scores(rows: np.ndarray, q: np.ndarray) -> list[int]:
    """Inner products in whole numbers of any size."""
    asked = [int(c) for c in q]
    return [sum(int(a) * c for a, c in zip(r, asked)) for r in rows]


def two_longs(scores) -> tuple[np.ndarray, np.ndarray]:
    """A score as ``high * 2^60 + low``, low from 0.  A high part beyond
    +-2^62, which no long score has, is set to that."""
    if isinstance(scores, np.ndarray):
        s = scores.astype(np.int64)
        return s >> LOW_BITS, s & LOW_MASK
    high = [min(max(s >> LOW_BITS, -2 ** 62), 2 ** 62) for s in scores]
    return np.array(high, np.int64), np.array([s & LOW_MASK for s in scores], np.int64)


class Lists:
    """A block of vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")            # ties go to the smaller id
        self.ids, x = ids[order], x[order]
        self.rows, self.by_dim = x, np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.by_dim, axis=0)

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray | list[int]]]:
        """(row positions, scores) of each query's best k rows without its id."""
        n, d = self.rows.shape
        with np.errstate(over="ignore"):
            size = float(np.abs(self.rows).max()) * float(np.abs(queries).max()) * d if n and len(queries) else 0.0
        exact = size < 2 ** 53
        kind = np.float32 if size < 2 ** 24 else np.float64
        x, q = self.rows.astype(kind), queries.astype(kind)
        unit = 0.0 if exact else (d + 4) * 2.0 ** -51       # error of a sum, as a share of its absolute terms
        depths = [t for t in (FIRST_DEPTH * 4 ** i for i in range(30)) if t < n]
        with np.errstate(over="ignore", invalid="ignore"):
            up, down = np.maximum(q, 0), np.minimum(q, 0)
            bound = np.stack([up @ self.values[n - 1 - t].astype(kind) + down @ self.values[t].astype(kind) for t in depths],
                             axis=1) if depths else None
            if depths and not exact:
                bound = bound + unit * size                 # nan or infinity never stops a walk
            return [self._walk(x, q[i], own[i], k, depths, bound[i] if depths else None, unit) for i in range(len(q))]

    def _walk(self, x, q, own, k, depths, bound, unit):
        n = len(x)
        seen, scored = np.zeros(n, bool), np.zeros(n, bool)
        scored[np.searchsorted(self.ids, own):np.searchsorted(self.ids, own, side="right")] = True
        up_dims, down_dims = np.flatnonzero(q >= 0), np.flatnonzero(q < 0)
        rows, low, high, last = np.zeros(0, np.int64), np.zeros(0, x.dtype), np.zeros(0, x.dtype), 0
        for step in range(len(depths) + 1):
            if step < len(depths) and 2 * np.count_nonzero(seen) <= n:
                t = depths[step]
                seen[self.by_dim[n - t:n - last, up_dims].ravel()] = True
                seen[self.by_dim[last:t, down_dims].ravel()] = True
                last, done = t, False
            else:
                seen[:] = True
                done = True
            new = np.flatnonzero(seen & ~scored)
            scored[new] = True
            score = x[new] @ q
            least = most = score
            if unit:
                error = unit * (np.abs(x[new]) @ np.abs(q))
                known = np.isfinite(score) & np.isfinite(error)
                least, most = np.where(known, score - error, -np.inf), np.where(known, score + error, np.inf)
            rows, low, high = np.concatenate((rows, new)), np.concatenate((low, least)), np.concatenate((high, most))
            if len(low) >= k:
                kth = np.partition(low, len(low) - k)[len(low) - k]
                keep = high >= kth
                rows, low, high = rows[keep], low[keep], high[keep]
            if done or (len(low) >= k and bound[step] < kth):
                break
        if not unit:
            first = np.lexsort((rows, -low))[:k]
            return rows[first], low[first]
        scores = whole_scores(x[rows], q)
        first = sorted(range(len(rows)), key=lambda j: (-scores[j], rows[j]))[:k]
        return rows[first], [scores[j] for j in first]


def top_k(vectors: DataFrame, k: int = K, every: int = 20, block: int = BLOCK, group: int = QUERY_GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k rows of each query, the
    rows whose id is divisible by ``every``."""
    v = written(quantised(vectors), "topk-vectors")
    asks = F.col("vec_id") % every == 0
    n, n_queries = v.agg(F.count("*"), F.count_if(asks)).first()
    n_blocks, n_groups = max(1, -(-n // block)), max(1, -(-n_queries // group))
    left = (v.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))))
    right = (v.filter(asks).withColumn("g", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_groups)).cast("int"))
             .withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))))

    def best(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        q_id, c_id, high, low = [], [], [], []
        for dim, part in asked.groupby("dim"):
            mine = rows[rows["dim"] == dim]
            if not len(mine):
                continue
            matrix = lambda f: np.frombuffer(b"".join(f["v"]), "<f8").reshape(-1, dim)
            lists = Lists(mine["vec_id"].to_numpy(), matrix(mine))
            ids = part["vec_id"].to_numpy()
            for i, (at, s) in zip(ids, lists.top(matrix(part), ids, k)):
                q_id.append(np.full(len(at), i))
                c_id.append(lists.ids[at])
                for out, half in zip((high, low), two_longs(s)):
                    out.append(half)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pd.DataFrame({"query_id": cat(q_id), "vec_id": cat(c_id), "high": cat(high), "low": cat(low)})

    some = (left.groupBy("b", "g").cogroup(right.groupBy("b", "g"))
            .applyInPandas(best, "query_id long, vec_id long, high long, low long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "vec_id"))
    fits = F.col("high").between(-(1 << 63 - LOW_BITS), (1 << 63 - LOW_BITS) - 1)
    score = F.when(fits, F.shiftleft("high", LOW_BITS).bitwiseOR(F.col("low"))).otherwise(
        F.raise_error(F.concat(F.lit("a score beyond 64 bits: query "), F.col("query_id").cast("string"),
                               F.lit(", row "), F.col("vec_id").cast("string"))).cast("long"))
    return some.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))

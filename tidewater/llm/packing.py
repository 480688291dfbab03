"""Packing into optimal length buckets.

The lengths of all documents are counted on a grid (every length up to
``2 * FINE``, above that steps that keep ``FINE`` values per power of two, so
the grid has at most ``FINE * 33`` points however many documents there are).
A cell's candidate bound is the longest length in it.  Dynamic programming over
that histogram chooses at most ``buckets`` upper bounds, among these, with the
least total padding; a cut inside a cell, under 0.2 % wide, is not tried.  Inside a
bucket a batch holds as many sequences as fit the token budget when each is
padded to the bucket's bound (at least one).

``pack_tokens`` measures a text by its tokens (:mod:`token_counts`), the unit
of the budget; ``pack_documents`` by its words.

A document's place in its bucket is the number of documents of lower shards
plus its row number in its own (bucket, shard), so a bucket with a third of
all rows is numbered by as many tasks as there are shards, and only the last
batch of each bucket is not full.

Cases: documents without tokens (words) have length 0 and sit in the first bucket;
repeated rows are packed once each; ties are numbered by doc_id (null last)
and then by length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import documents_of, word_counts, written
from tidewater.llm.token_counts import token_counts

BUCKETS = 16
TOKEN_BUDGET = 65536
FINE = 512
SHARDS = 1024


def grid(length) -> Column:
    """The smallest grid point that is no less than ``length``."""
    n = F.greatest(length, F.lit(1)).cast("long")
    # an upper part of FINE..2*FINE-1 and the rest rounded up
    shift = F.greatest(F.lit(0), F.floor(F.log2(n.cast("double"))).cast("int") - F.lit(int(np.log2(FINE))))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.when(length <= 0, F.lit(0).cast("long")).otherwise((F.floor((n + step - 1) / step) * step).cast("long"))


def best_bounds(values: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds that minimise sum(bound - length).  ``values``: the longest
    length of each grid cell ascending, with the number and the total length of
    its documents.  cost(i, j) of points i..j-1 under bound values[j-1] is
    values[j-1] * documents - length, from prefix sums."""
    n = len(values)
    if n == 0:
        return []
    docs = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    length = np.concatenate([[0], np.cumsum(totals)]).astype(np.float64)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    choice = []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + values[j - 1] * (docs[j] - docs[:j]) - (length[j] - length[:j])
            cut[j] = k = int(np.argmin(cost))
            new[j] = cost[k]
        best = new
        choice.append(cut)
    bounds, j = [], n
    for cut in reversed(choice):
        if j == 0:
            break
        bounds.append(int(values[j - 1]))
        j = int(cut[j])
    return bounds[::-1]


def lengths(docs: DataFrame) -> DataFrame:
    """(doc_id, length): words of each text."""
    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(word_counts(b.column("text")))],
                                             names=["doc_id", "length"])

    return documents_of(docs, "doc_id", "text").mapInArrow(count, "doc_id long, length long")


def pack(sized: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, shards: int = SHARDS) -> DataFrame:
    """(doc_id, length, bucket, bucket_len, padding, batch, slot) for rows
    (doc_id, length)."""
    sized = written(sized.select("doc_id", "length"), "pack-lengths")
    hist = (sized.groupBy(grid(F.col("length")).alias("g"))
            .agg(F.max("length").alias("top"), F.count("*").alias("n"), F.sum("length").alias("t"))
            .orderBy("g").collect())  # at most FINE * 33 rows
    bounds = best_bounds(np.array([r.top for r in hist], np.float64), np.array([r.n for r in hist]),
                         np.array([r.t for r in hist]), buckets)
    bucket, upper = F.lit(len(bounds) - 1), F.lit(bounds[-1] if bounds else 0)
    for i in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("length") <= bounds[i], i).otherwise(bucket)
        upper = F.when(F.col("length") <= bounds[i], bounds[i]).otherwise(upper)
    rows = (sized.withColumn("bucket", bucket.cast("int")).withColumn("bucket_len", upper.cast("long"))
            .withColumn("shard", F.pmod(F.xxhash64("doc_id", "length"), F.lit(shards)).cast("int")))
    in_shard = Window.partitionBy("bucket", "shard").orderBy(F.col("doc_id").isNull(), "doc_id", "length")
    lower = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # at most buckets * shards rows
    first = (rows.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
             .select("bucket", "shard", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("first")))
    at = F.col("first") + F.col("nr") - 1
    cap = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("long")
    return (rows.withColumn("nr", F.row_number().over(in_shard)).join(F.broadcast(first), ["bucket", "shard"])
            .select("doc_id", "length", "bucket", "bucket_len", (F.col("bucket_len") - F.col("length")).alias("padding"),
                    F.floor(at / cap).cast("long").alias("batch"), F.pmod(at, cap).cast("long").alias("slot")))


def pack_documents(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    return pack(lengths(docs), buckets, budget)


def pack_tokens(docs: DataFrame, path: str, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """:func:`pack` by the tokens of the tokenizer file ``path``."""
    return pack(token_counts(docs, path).withColumnRenamed("n_tokens", "length"), buckets, budget)

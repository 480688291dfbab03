"""Mixing sources to target weights by hash-threshold histograms.

Sizes are words.  Each source gets a share of all words by its weight, at
most ``cap`` times its own size (the excess goes to the others by weight).
A document is taken ``floor(target / size of its source)`` times, and once
more if its hash lies below its source's threshold.  The threshold is found
from histograms: words by (source, leading bits of the hash) give the bucket
in which the remaining budget ends, then only the documents of that bucket
are summed by the next bits, until it holds one hash.  Nothing is sorted and
the last pass is a filter on the hash.

Cases: a null source is a source of its own, last in order; documents
without words have size 0 and are taken 0 words; rows that repeat a doc_id
share one hash and so one fate; rows without a doc_id are hashed by text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.llm.common import broadcast_if_small, documents_of, fresh, word_counts, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
SEED = 20240229
# Bits of the 63-bit hash looked at in each round of refinement.
LEVELS = (51, 39, 27, 13, 0)


def unit_hash(doc_id, text):
    """63-bit non-negative hash of a document."""
    key = F.coalesce(doc_id.cast("long"), F.xxhash64(text))
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(SEED)), 1)


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, u, size): one row per document, without its text."""
    d = documents_of(docs, "doc_id", "source", "text") \
        .withColumn("u", unit_hash(F.col("doc_id"), F.col("text")))

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), b.column("u"), pa.array(word_counts(b.column("text")))],
                names=["doc_id", "source", "u", "size"])

    return d.mapInArrow(count, "doc_id long, source string, u long, size long")


def targets(by_source: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds ``target`` to (source, source_size).  Sources in order of
    ``cap * size / weight`` are capped as long as that ratio is no more than
    what a unit of weight still gets; one row per source, so the windows over
    all sources are small."""
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "nr")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    nr = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("nr") - 1) % len(weights) + 1).cast("int"))
    x = (by_source.withColumn("nr", nr).withColumn("w", w)
         .withColumn("most", F.col("source_size").cast("double") * cap)
         .withColumn("ratio", F.col("most") / F.col("w"))
         .withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                     / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
         .withColumn("best", F.max("level").over(everything)))
    return x.select("source", "source_size", F.least(F.col("most"), F.col("best") * F.col("w")).alias("target"))


def thresholds(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, source_size, target, times, below): a document is taken
    ``times`` times, and once more if ``u < below``."""
    state = written(goal.withColumn("times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
                    .withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("times") * F.col("source_size")))
                    .withColumn("below", F.lit(0).cast("long")).withColumn("open", F.col("budget") > 0), "mix-state")
    at = None
    for shift in LEVELS:
        rows = sized.join(broadcast_if_small(state.filter("open").select(F.col("source").alias("s"), "below", "budget")),
                          F.col("source").eqNullSafe(F.col("s")))
        if at is not None:  # only the documents of the bucket in which the budget ends
            rows = rows.filter(F.shiftright("u", at) == F.shiftright("below", at))
        bins = rows.groupBy("source", "budget", F.shiftright("u", shift).alias("bin")) \
            .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
        end = (bins.withColumn("upto", upto).filter(F.col("upto") > F.col("budget"))
               .groupBy("source").agg(F.min_by(F.struct("bin", "words", "upto", "n", "budget"), "bin").alias("e"))
               .select(F.col("source").alias("s"), F.col("e.*")))
        used = F.col("e_upto") - F.col("e_words")
        # one document or one hash is left (or no bits are): take it if that comes nearer to the target
        last = (F.col("e_n") == 1) | F.lit(shift == 0)
        nearer = F.col("e_upto") - F.col("budget") < F.col("budget") - used
        begin = F.shiftleft("e_bin", shift)
        state = state.join(end.select(F.col("s"), *[F.col(c).alias(f"e_{c}") for c in ("bin", "words", "upto", "n")]),
                           F.col("source").eqNullSafe(F.col("s")), "left")
        found = F.col("open") & F.col("e_bin").isNotNull()
        state = written(state.select(
            "source", "source_size", "target", "times",
            F.when(found, F.col("budget") - used).otherwise(F.col("budget")).alias("budget"),
            F.when(found & last & nearer, begin + F.lit((1 << shift) - 1) + 1).when(found, begin)
             .when(F.col("open"), F.lit(2 ** 63 - 1)).otherwise(F.col("below")).alias("below"),
            (found & ~last).alias("open")), "mix-state")
        at = shift
        if state.filter("open").isEmpty():
            break
    return state.select("source", "source_size", "target", "times", "below")


def mix_plan(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> tuple[DataFrame, DataFrame]:
    """``(sizes per document, threshold per source)``, both written."""
    sized = written(sizes(docs), "mix-sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return sized, thresholds(sized, targets(by_source, weights, cap))


def _copies():
    return F.col("times") + F.when(F.col("__u") < F.col("below"), 1).otherwise(0)


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, copies) of every row."""
    sized, goal = mix_plan(docs, weights, cap)
    goal = broadcast_if_small(goal.withColumnRenamed("source", "s"))
    return (sized.withColumnRenamed("u", "__u").join(goal, F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumn("copies", _copies())
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                    "source", "copies"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns of
    the input.  Hash and threshold decide where the row is read."""
    _, goal = mix_plan(docs, weights, cap)
    s, n = fresh(docs, "__mix_source"), fresh(docs, "__mix_copies")
    goal = broadcast_if_small(goal.select(F.col("source").alias(s), "times", "below"))
    times, below = fresh(docs, "__mix_times"), fresh(docs, "__mix_below")
    goal = goal.withColumnsRenamed({"times": times, "below": below})
    u = unit_hash(docs["doc_id"], docs["text"].cast("string"))
    k = F.col(times) + F.when(u < F.col(below), 1).otherwise(0)
    return (docs.join(goal, docs["source"].cast("string").eqNullSafe(F.col(s)))
            .withColumn(n, F.explode(F.array_repeat(F.lit(1), k.cast("int"))))
            .select(*[docs[c] for c in docs.columns]))

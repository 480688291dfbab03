"""Retract changelogs ``(is_add, row)`` of updating results, in batch form.

An updating aggregate emits, per input row, ``(false, old)`` for the result
it replaces (if any) and ``(true, new)``.  These are built from running
values (bucketed, see :mod:`tidewater.plans.sequence`) exploded into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.plans import sequence as S


def changelog_count(df: DataFrame, key: str, order: list[str], bucket: Column | None,
                    carry: list[str] | None = None) -> DataFrame:
    """Retract stream of ``count(*) GROUP BY key`` in arrival order:
    ``(false, n-1)`` (when n > 1) then ``(true, n)`` per row."""
    carry = carry or []
    if df.isStreaming:
        from tidewater.streaming.stateful import changelog_count_stream
        return changelog_count_stream(df, key, order, carry).select(*carry, key, "is_add", "cnt", "step")
    r = S.running_agg(df, [key], order, bucket, [("__n", F.lit(1), "count")])
    changes = F.array(
        F.struct(F.lit(False).alias("is_add"), (F.col("__n") - 1).alias("cnt"), F.lit(0).alias("step")),
        F.struct(F.lit(True).alias("is_add"), F.col("__n").alias("cnt"), F.lit(1).alias("step")))
    out = r.select(*carry, key, F.explode(changes).alias("__c")).filter(F.col("__c.cnt") > 0)
    return out.select(*carry, key, "__c.is_add", "__c.cnt", "__c.step")


def top1_additions(df: DataFrame, key: str, order: list[str], bucket: Column | None, rank_col: str) -> DataFrame:
    """Additions of a retracting top-1 (``row_number() ... rn = 1``, rank
    column descending): a row is added when it ranks strictly above every
    earlier row of its key; ties keep the current holder."""
    if df.isStreaming:
        from tidewater.streaming.stateful import top1_additions_stream
        return top1_additions_stream(df, key, order, rank_col)
    r = S.running_agg(df, [key], order, bucket, [("__best_before", rank_col, "max")], inclusive=False)
    adds = r.filter(F.col("__best_before").isNull() | (F.col(rank_col) > F.col("__best_before")))
    return adds.drop("__best_before").withColumn("is_add", F.lit(True))

"""Sequential per-key rules as parallel plans: the rising-temperature timer
alert and the delta-triggered global window with a time evictor.

Both follow a chain per key (the timer that is armed next, the row that fires
next): the next member is the first one whose time or distance is a fixed
width higher.  ``sequence.chain_reached`` follows it inside balanced ranges
and from one range's exit to the next one's entry.  There is one plan whatever
the size of a key, and the rows of a key are never in one task.  A null key is
a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.plans import sequence as S
from tidewater.session import ensure_checkpoint_dir

END = 2 ** 63 - 1       # later than any row


def _null_free(df: DataFrame, key: str) -> tuple[DataFrame, list[str], Column]:
    """``df`` with null-free key columns, their names, and the key again."""
    enc = S.null_free_keys(df, [key])
    if enc is None:
        raise TypeError(f"key {key} has a type without a zero value")
    d, names = enc
    if names == [key]:
        return d, names, F.col(key)
    d = d.withColumnsRenamed(dict(zip(names, ("__key", "__no_key"))))
    return d.drop(key), ["__key", "__no_key"], F.when(~F.col("__no_key"), F.col("__key")).alias(key)


# ------------------------------------------------------------ rising alert
def rising_alert(df: DataFrame, key: str, ts: str, seq: str, value: str, bucket: Column | None = None,
                 seconds: int = 0, initial: float = 0.0, flush_at_end: bool = True) -> DataFrame:
    """Event-time form of "value rose continuously for ``seconds``".

    Per key, in ``(ts, seq)`` order, with ``last`` starting at ``initial``:
    before a row, a pending deadline ``<= row.ts`` fires (alert at the
    deadline, carrying ``last``); then ``value > last`` arms a timer at
    ``ts + seconds`` if none is pending, ``value < last`` cancels it, equal
    leaves it; ``last = value``.  At the end of input a pending timer fires
    when ``flush_at_end``.  Output: ``(key, alert_ts, last_value)``.
    A streaming input runs the timer-based stateful processor (the end of
    input is a watermark that passes every deadline).

    A falling value resets all state, so a key falls into segments, runs
    without falling values.  In a segment a strictly rising row arms the
    timer; once armed, the next arming row is the first rising row at or
    after the deadline.  The arming rows are thus a chain from the segment's
    first rising row, and an armed deadline D fires iff the first row of the
    key at or after D is in the same segment or opens the next one (or, with
    no such row, the segment is the key's last and the end of input flushes
    it), carrying the value of the row just before.

    Previous value, row number and segment number come from one window over
    balanced buckets plus one row per (key, bucket).  The row that answers a
    deadline brings its segment and previous value along, so rows are never
    joined with each other.
    """
    if df.isStreaming:
        from tidewater.streaming.stateful import rising_alert_stream
        return rising_alert_stream(df, key, ts, seq, value, seconds, initial)
    ensure_checkpoint_dir(df.sparkSession)
    period = F.lit(seconds * 1_000_000).cast("long")
    d = df.select(key, ts, seq, F.col(value).alias("__v"), F.unix_micros(F.col(ts).cast("timestamp")).alias("__us"))
    d, own, back = _null_free(d, key)
    d, bucket = S.bucketed(d, own, [ts, seq], bucket)
    d = d.withColumn(S.BKT, F.coalesce(bucket, F.lit(-(2 ** 63)).cast("long")))
    part = [*own, S.BKT]
    w = Window.partitionBy(*part).orderBy(ts, seq)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    prev = F.lag("__v").over(w)
    d = (d.withColumn("__i", F.row_number().over(w).cast("long")).withColumn("__prev", prev)
         .withColumn("__fall", F.coalesce((F.col("__v") < prev).cast("long"), F.lit(0)))
         .withColumn("__falls", F.sum("__fall").over(upto)))
    ends = F.struct(ts, seq)
    edge = d.groupBy(*part).agg(F.min_by("__v", ends).alias("__head"), F.max_by("__v", ends).alias("__tail"),
                                F.count(F.lit(1)).alias("__c"), F.sum("__fall").alias("__f"))
    along = Window.partitionBy(*own).orderBy(S.BKT)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    last_before = F.coalesce(F.lag("__tail").over(along), F.lit(initial))
    edge = (edge.withColumn("__pv", last_before)
            .withColumn("__ef", F.coalesce((F.col("__head") < F.col("__pv")).cast("long"), F.lit(0)))
            .select(*part, "__pv", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__n0"),
                    (F.coalesce(F.sum(F.col("__f") + F.col("__ef")).over(before), F.lit(0)) + F.col("__ef")).alias("__s0")))
    last = F.when(F.col("__i") == 1, F.col("__pv")).otherwise(F.col("__prev"))
    d = d.join(edge, part).select(*own, "__us", "__v", last.alias("__last"), (F.col("__n0") + F.col("__i")).alias("__n"),
                                  (F.col("__s0") + F.col("__falls")).alias("__seg"))
    d = d.withColumn("__first", (F.col("__v") < F.col("__last")) | (F.col("__n") == 1))
    d = S.written(d, "rising")

    seg = [*own, "__seg"]
    rises = d.filter(F.col("__v") > F.col("__last"))
    arms = S.chain_reached(rises, seg, "__us", "__n", seconds * 1_000_000) if seconds > 0 else rises
    arms = arms.select(*seg, (F.col("__us") + period).alias("__x"))
    points = d.select(*own, "__us", "__n", F.col("__seg").alias("__fseg"), F.col("__last").alias("__fprev"),
                      F.col("__first").alias("__ffirst"))
    # a point after all rows of a key stands for the end of input
    ended = d.groupBy(*own).agg(F.max("__seg").alias("__fseg"), F.max_by("__v", "__n").alias("__fprev"))
    points = points.unionByName(ended.select(*own, F.lit(END).alias("__us"), F.lit(END).alias("__n"), "__fseg", "__fprev",
                                             F.lit(False).alias("__ffirst")))
    first = S.first_at_or_after(points, arms, own, "__us", "__n", "__x", out="__f", carry=["__fseg", "__fprev", "__ffirst"])
    same, end = F.col("__fseg") == F.col("__seg"), F.col("__f") == END
    fires = (F.when(end, same & F.lit(flush_at_end))
             .otherwise(same | ((F.col("__fseg") == F.col("__seg") + 1) & F.col("__ffirst"))))
    return (first.filter(fires)
            .select(back, F.timestamp_micros("__x").cast(dict(df.dtypes)[ts]).alias("alert_ts"),
                    F.col("__fprev").alias("last_value")))


# ------------------------------------------------- delta trigger + evictor
def top_speed_delta(df: DataFrame, key: str, ts: str, seq: str, speed: str, distance_cents: str,
                    threshold_cents: int, evict_seconds: int, bucket: Column | None = None) -> DataFrame:
    """Global window per key with a delta trigger and a time evictor.

    The first row of a key (with a distance) arms the trigger; a later row
    fires when its distance exceeds the distance of the last firing (or
    arming) row by more than the threshold, and becomes the new reference.
    On firing, the window holds the rows with ``ts > fire_ts - evict`` (up to
    the firing row) and the row with the highest speed is emitted (earliest
    on ties).  Distances are integer cents so the comparison is exact; they
    may fall, and rows without one never fire.

    A firing row is always a new maximum of the distance: all rows before it
    are at most ``reference + threshold``.  So the chain can be followed on
    the running maximum D: the next firing row after row i is the first row
    with ``D > D_i + threshold``, and only rows at which D grows are nodes.

    The top speed of a window of the evictor's width is the larger of two
    running maxima: over the firing row's own time block (blocks as wide as
    the evictor) up to the row, and over the block before it from its end
    back to the window's start.  No row is compared with another.
    """
    if threshold_cents < 0:
        raise ValueError("the threshold must not be negative")
    if df.isStreaming:
        from tidewater.streaming.stateful import top_speed_delta_stream
        return top_speed_delta_stream(df, key, ts, seq, speed, distance_cents, threshold_cents, evict_seconds)
    ensure_checkpoint_dir(df.sparkSession)
    width = evict_seconds * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    base = df.select(key, seq, us.alias("__us"), F.col(speed).cast("double").alias("__sp"),
                     F.col(distance_cents).cast("long").alias("__dc"),
                     F.floor(us / F.lit(width)).cast("long").alias("__block"),
                     *([] if bucket is None else [bucket.alias("__bucket")]))
    base, own, back = _null_free(base, key)
    base, bucket = S.bucketed(base, own, ["__us", seq], None if bucket is None else F.col("__bucket"))
    # the row that wins a window: highest speed, then earliest
    row = F.struct(F.col("__sp"), (-F.col("__us")).alias("nu"), (-F.col(seq)).alias("ns"), F.col("__dc"))
    base = base.withColumn("__row", row)
    # time blocks follow the same order, so the running maximum of (block, row)
    # is the best row so far of the row's own block; that of (distance, earliest
    # row with it) also says at which rows the distance grows
    rows = S.running_agg(base, own, ["__us", seq], bucket, [
        ("__n", F.lit(1), "count"), ("__k", F.col("__dc").isNotNull().cast("long"), "sum"),
        ("__far", F.struct("__dc", (-F.col("__us")).alias("nu"), (-F.col(seq)).alias("ns")), "max"),
        ("__best", F.struct("__block", "__row"), "max")])
    grows = ((F.col("__dc") == F.col("__far.__dc")) & (F.col("__us") == -F.col("__far.nu"))
             & (-F.col(seq)).eqNullSafe(F.col("__far.ns")))
    rows = S.written(rows.select(*own, "__n", "__k", "__us", "__block", "__row", "__dc", F.col("__best.__row").alias("__pre"),
                                 grows.alias("__grows")), "speeds")

    # the first row with a distance only arms the trigger
    fired = S.chain_reached(rows.filter("__grows"), own, "__dc", "__n", threshold_cents + 1,
                            carry=["__k", "__us", "__block", "__pre"]).filter("__k > 1")
    # maxima of the block before, from its end back to the window's start (exclusive)
    ask = fired.select(*own, (F.col("__block") - 1).alias("__block"), (F.col("__us") - width).alias("__us"),
                       F.lit(0).alias("__kind"), F.col("__n").alias("__o"), "__pre")
    told = rows.select(*own, "__block", "__us", F.lit(1).alias("__kind"), F.col("__n").alias("__o"), "__row")
    both = told.unionByName(ask, allowMissingColumns=True).withColumn("__back", -F.col("__us"))
    best = (S.running_agg(both, [*own, "__block"], ["__back", "__kind", "__o"], None, [("__suf", "__row", "max")])
            .filter("__kind = 0").withColumn("r", F.greatest("__pre", "__suf")))
    return best.select(back, (-F.col("r.ns")).cast(dict(df.dtypes)[seq]).alias(seq), F.col("r.__sp").alias("speed"),
                       (F.col("r.__dc") / 100.0).alias("distance"),
                       F.timestamp_micros(-F.col("r.nu")).cast(dict(df.dtypes)[ts]).alias("time"))

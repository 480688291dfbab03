"""Event-time windows: tumbling, sliding, session, non-keyed; window join.

Batch and streaming share the same code where Spark allows it: ``window()``
groups are partial/final aggregates in both; streaming inputs only need
``withWatermark`` first (see :mod:`tidewater.streaming.runner`).
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.plans import sequence as S


_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def interval_micros(spec: str) -> int:
    """Microseconds of an interval like ``2500 milliseconds`` or
    ``1 hour 30 minutes``."""
    parts = spec.lower().removeprefix("interval ").split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {spec!r}")
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        us = Fraction(n) * _UNIT_US[unit.rstrip("s")]
        if us.denominator != 1:
            raise ValueError(f"not whole microseconds: {spec!r}")
        total += us.numerator
    if total <= 0:
        raise ValueError(f"not a positive interval: {spec!r}")
    return total


def counter_timestamps(df: DataFrame, seq: str, step_ms: int = 10, start_ms: int = 0,
                       out: str = "ts") -> DataFrame:
    """Event time made by a counter (``start + step * seq`` milliseconds),
    as the punctuated-watermark sample does; with the rows replayed in
    ``seq`` order the stream's watermark advances with every micro-batch."""
    return df.withColumn(out, F.timestamp_millis(F.lit(start_ms) + F.col(seq) * F.lit(step_ms)))


def tumble(df: DataFrame, keys: list[str], ts: str, size: str, aggs: list[Column]) -> DataFrame:
    """Keyed tumbling window aggregate; output has ``window_start`` /
    ``window_end`` next to the keys."""
    w = F.window(F.col(ts), size)
    return (df.groupBy(*keys, w.alias("w")).agg(*aggs)
            .withColumn("window_start", F.col("w.start"))
            .withColumn("window_end", F.col("w.end"))
            .drop("w"))


def _floor_div(x: Column, y: int) -> Column:
    """Floor of a whole-number quotient (exact: no remainder is divided)."""
    return ((x - F.pmod(x, F.lit(y).cast("long"))) / F.lit(y)).cast("long")


def sliding_sum(df: DataFrame, keys: list[str], ts: str, value: str, size: str, slide: str,
                out: str = "total") -> DataFrame:
    """Keyed sliding-window sum, pre-aggregated per pane.

    ``window(ts, size, slide)`` copies every *row* into size/slide windows
    before the shuffle.  Summing per pane first (partial aggregate, one row
    per key and pane; a pane is as wide as the largest interval that divides
    both) and expanding the panes instead moves size/slide rows per pane,
    independent of how many rows a pane holds.

    A streaming input (watermark on ``ts``) sums its panes with Spark's
    tumbling ``window`` first and then the panes of a window, two stateful
    aggregates in append mode.
    """
    size_us, slide_us = interval_micros(size), interval_micros(slide)
    pane_us = gcd(size_us, slide_us)
    if df.isStreaming:
        pane = F.window(F.col(ts), f"{pane_us} microseconds")
        panes = df.groupBy(*keys, pane.alias("__p")).agg(F.sum(value).alias("psum"))
        w = F.window(F.window_time("__p"), f"{size_us} microseconds", f"{slide_us} microseconds")
        return (panes.groupBy(*keys, w.alias("__w")).agg(F.sum("psum").alias(out))
                .select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), out))
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    pane = _floor_div(micros, pane_us)
    panes = df.groupBy(*keys, pane.alias("pane")).agg(F.sum(value).alias("psum"))
    # windows start at multiples of the slide; those that hold a pane start
    # after its end less the size, and no later than the pane
    last = _floor_div(F.col("pane") * pane_us, slide_us)
    first = _floor_div((F.col("pane") + 1) * pane_us - size_us - 1, slide_us) + 1
    expanded = (panes.withColumn("__first", first).withColumn("__last", last).filter("__first <= __last")
                .select(*keys, F.explode(F.sequence("__first", "__last")).alias("wpane"), "psum"))
    start_us = F.col("wpane") * F.lit(slide_us)
    start, end = F.timestamp_micros(start_us), F.timestamp_micros(start_us + F.lit(size_us))
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return (expanded.groupBy(*keys, "wpane").agg(F.sum("psum").alias(out))
            .select(*keys, start.alias("window_start"), end.alias("window_end"), out))


def on_arrival(df: DataFrame, out: str = "arrival") -> DataFrame:
    """Stamp rows with the time at which they are processed, for windows in
    processing time.  Results depend on the clock, so registered queries use
    an arrival column of the data instead."""
    return df.withColumn(out, F.current_timestamp())


def session_windows(df: DataFrame, keys: list[str], ts: str, seq: str, gap_seconds: float,
                    aggs: list[Column], bucket: Column | None = None) -> DataFrame:
    """Keyed session windows: a new session starts when the gap to the
    previous event of the key is larger than ``gap_seconds`` (events exactly
    ``gap`` apart stay together).  Output: keys, ``session_start`` (first
    event time), ``session_end`` (last event time + gap) and ``aggs``.

    One bucketing, one window over (key, bucket): the gaps inside a bucket
    and their running number.  A row per (key, bucket), with its first and
    last event time and its number of gaps, says whether the bucket's first
    event starts a session and how many started before.  Then a plain
    partial/final aggregate per ``(key, session)``: a key with a third of the
    rows is spread over its buckets.

    A streaming input uses Spark's ``session_window`` (merging sessions in
    the state store); it needs a watermark on ``ts`` and emits a session
    once the watermark passes its end.
    """
    gap_micros = int(round(gap_seconds * 1_000_000))
    if df.isStreaming:
        sw = F.session_window(F.col(ts), f"{gap_micros} microseconds")
        return (df.groupBy(*keys, sw.alias("__s")).agg(F.min(ts).alias("session_start"), *aggs)
                .withColumn("session_end", F.col("__s.end")).drop("__s"))
    d, bucket = S.bucketed(df, keys, [ts, seq], bucket)
    d = (d.withColumn(S.BKT, F.coalesce(bucket, F.lit(-(2 ** 63)).cast("long")))
         .withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp"))))
    d, own = S.null_free_keys(d, keys) or (d, keys)
    part = [*own, S.BKT]
    w = Window.partitionBy(*part).orderBy(ts, seq)
    gap = F.coalesce((F.col("__us") - F.lag("__us").over(w) > gap_micros).cast("int"), F.lit(0))
    d = d.withColumn("__gap", gap).withColumn("__local", F.sum("__gap").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    edge = d.groupBy(*part).agg(F.min("__us").alias("__lo"), F.max("__us").alias("__hi"),
                                F.sum("__gap").alias("__gaps"))
    along = Window.partitionBy(*own).orderBy(S.BKT)
    opens = F.coalesce((F.col("__lo") - F.lag("__hi").over(along) > gap_micros).cast("int"), F.lit(1))
    edge = (edge.withColumn("__opens", opens)
            .select(*part, (F.sum(F.col("__opens") + F.col("__gaps")).over(along.rowsBetween(Window.unboundedPreceding, 0))
                            - F.col("__gaps")).alias("__before")))
    gap_iv = F.make_dt_interval(secs=F.lit(gap_micros / 1_000_000).cast("decimal(18,6)"))
    both = d.join(edge, part) if own != keys else S._null_safe_join(d, edge, part)
    return (both.withColumn("__session", F.col("__before") + F.col("__local"))
            .groupBy(*keys, "__session")
            .agg(F.min(ts).alias("session_start"), (F.max(ts) + gap_iv).alias("session_end"), *aggs)
            .drop("__session"))


def heavy_keys(df: DataFrame, keys: list[str], share: float, counters: int = 1000) -> DataFrame:
    """The keys that more than ``share`` of all rows have, and perhaps some
    that a little fewer have, at most 2 / share in all.  Every task keeps a
    summary of ``counters`` keys (Misra-Gries: when there are more, the
    smallest counts are subtracted from all), so a count is too low by at most
    1 / counters of the task's rows; the summaries add up."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    if counters < 2 / share:
        raise ValueError("too few counters for the share")
    shape = df.select(*keys).schema.add("__n", "long").add("__rows", "long")

    def summary(batches):
        held, rows = None, 0
        for b in batches:
            rows += b.num_rows
            t = pa.Table.from_batches([b]).append_column("__n", pa.array(np.ones(b.num_rows, np.int64)))
            t = t if held is None else pa.concat_tables([held, t])
            t = t.group_by(keys).aggregate([("__n", "sum")]).rename_columns([*keys, "__n"])
            if t.num_rows > counters:
                n = t.column("__n").to_numpy()
                rest = n - np.partition(n, -counters - 1)[-counters - 1]
                t = t.set_column(t.num_columns - 1, "__n", pa.array(rest)).filter(pc.greater(pc.field("__n"), 0))
            held = t.combine_chunks()
        if held is not None:
            seen = np.zeros(held.num_rows, np.int64)
            seen[:1] = rows
            yield from held.append_column("__rows", pa.array(seen)).to_batches()

    from tidewater.plans import sequence as S
    told = S.written(df.select(*keys).mapInArrow(summary, shape), "heavy")
    rows = told.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    return (told.groupBy(*keys).agg(F.sum("__n").alias("__n"))
            .filter(F.col("__n") > (share - 1 / counters) * rows).select(*keys))


def window_join(left: DataFrame, right: DataFrame, key: str, ts_left: str, ts_right: str, size: str,
                share: float = 0.01, salts: int = 64) -> DataFrame:
    """Windowed inner join: same key and same tumbling window; every
    matching pair of the window is emitted.  An equi-join on
    ``(key, window_start)``.

    A (key, window) with more than ``share`` of the left rows is split: its
    left rows are dealt over ``salts`` parts, its right rows are copied to
    each.  There are at most 2 / share of them, so their list is broadcast.
    Streams use the plain join."""
    lw = left.withColumn("window_start", F.window(F.col(ts_left), size).start)
    rw = right.withColumn("window_start", F.window(F.col(ts_right), size).start)
    if left.isStreaming or right.isStreaming:
        return lw.join(rw, [key, "window_start"], "inner")
    pair = [key, "window_start"]
    hot = F.broadcast(heavy_keys(lw, pair, share).withColumn("__hot", F.lit(True)))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    part = F.when(F.col("__hot"), F.pmod(row, F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    lw = lw.join(hot, pair, "left").withColumn("__part", part).drop("__hot")
    rw = rw.join(hot, pair, "left").withColumn("__part", F.explode(copies)).drop("__hot")
    return lw.join(rw, [*pair, "__part"], "inner").drop("__part")

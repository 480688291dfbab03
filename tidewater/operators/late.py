"""Late rows of event-time windows.

Spark drops rows behind the watermark silently.  The reference routes
"too late" rows of a tumbling window to a side output and lets rows that are
late but within the allowed lateness update their window again.

Rule (bounded out-of-orderness watermark, per arrival): after the rows that
arrived before row r, the watermark is ``max_ts - delay``.  Row r is *too
late* iff its window's end plus the allowed lateness is at or before that
watermark:  ``window_end + lateness <= max(ts of earlier arrivals) - delay``.

Plan: the running maximum of event time over arrival order is global (not
keyed), so it is computed in two levels -- a maximum per arrival bucket, a
prefix maximum over the small bucket table, and a local running maximum
inside each bucket.  No window without a partition.

On a stream the same rule holds per record: inside a micro-batch the running
maximum is taken over the batch's arrival order, on top of the maximum carried
from earlier batches.  However the input is cut into batches, the rows that
are put aside are those of the batch form.

*Punctuated watermarks* are carried by marked rows: a marker sets the
watermark to its value, a window closes when a marker reaches its end, and
rows for a closed window are late.  The same scan finds the watermark before
each row.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.operators.accumulators import Accumulator
from tidewater.plans import sequence as S
from tidewater.sinks.versions import KEPT, commit, newest_before


def mark_late(df: DataFrame, ts: str, arrival_order: list[str], arrival_bucket: Column | None,
              size_seconds: int, delay_seconds: int, lateness_seconds: int, flag: str = "too_late",
              carried: int | None = None) -> DataFrame:
    """``df`` with the flag.  ``carried``: largest event time (microseconds)
    of rows that arrived before all of ``df``."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    size_us = size_seconds * 1_000_000
    d = df.withColumn("__ts_us", us)
    with_max = S.running_agg(d, [], arrival_order, arrival_bucket, [("__max_before", "__ts_us", "max")],
                             inclusive=False)
    win_end = (F.floor(F.col("__ts_us") / F.lit(size_us)) + 1) * F.lit(size_us)
    before = F.greatest(F.col("__max_before"), F.lit(carried).cast("long"))
    late = win_end + F.lit(lateness_seconds * 1_000_000) <= before - F.lit(delay_seconds * 1_000_000)
    return with_max.withColumn(flag, F.coalesce(late, F.lit(False))).drop("__ts_us", "__max_before")


def split_late(df: DataFrame, ts: str, arrival_order: list[str], arrival_bucket: Column | None,
               size_seconds: int, delay_seconds: int, lateness_seconds: int) -> tuple[DataFrame, DataFrame]:
    """``(on_time, too_late)``; on-time rows include the late-but-allowed ones."""
    m = mark_late(df, ts, arrival_order, arrival_bucket, size_seconds, delay_seconds, lateness_seconds, "__late")
    return m.filter(~F.col("__late")).drop("__late"), m.filter(F.col("__late")).drop("__late")


def split_late_stream(stream: DataFrame, ts: str, size_seconds: int, delay_seconds: int,
                      lateness_seconds: int, on_time_path: str, late_path: str, state_path: str,
                      checkpoint: str, trigger: dict | None = None, *, arrival_order: list[str]):
    """Streaming side output for too-late rows, by the rule per record:
    ``arrival_order`` is the order of the rows inside a micro-batch, batches
    arrive one after the other.

    The largest event time so far is a one-row table versioned by
    ``batch_id`` below ``state_path``; both outputs are written into
    ``batch_id=`` folders, so a replayed batch overwrites exactly what it
    wrote before (idempotent sink).  Rows on time also carry ``seen_us``, the
    largest event time of the batches before theirs."""
    spark = stream.sparkSession

    def split(batch: DataFrame, batch_id: int) -> None:
        m = _carried(spark, state_path, batch_id)
        tagged = mark_late(batch, ts, arrival_order, None, size_seconds, delay_seconds, lateness_seconds, "__late", m)
        tagged = tagged.persist()
        try:
            (tagged.filter(~F.col("__late")).drop("__late").withColumn("seen_us", F.lit(m).cast("long"))
             .write.mode("overwrite").parquet(f"{on_time_path}/batch_id={batch_id}"))
            tagged.filter(F.col("__late")).drop("__late").write.mode("overwrite").parquet(
                f"{late_path}/batch_id={batch_id}")
            bmax = tagged.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp")))).first()[0]
        finally:
            tagged.unpersist()
        # state last: a batch that fails earlier starts over with the old maximum
        _carry(spark, max((v for v in (m, bmax) if v is not None), default=None), state_path, batch_id)

    w = stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _carried(spark, path: str, batch_id: int) -> int | None:
    """The value that the last batch before this one carried on."""
    place = newest_before(spark, path, batch_id)
    return None if place is None else spark.read.parquet(place).first()[0]


def _carry(spark, value: int | None, path: str, batch_id: int) -> None:
    commit(spark.createDataFrame([(value,)], "us long").coalesce(1), path, batch_id, KEPT)


# ------------------------------------------------- windows that are updated
def late_updates_stream(on_time: DataFrame, keys: list[str], ts: str, size_seconds: int, delay_seconds: int,
                        lateness_seconds: int, acc: Accumulator, result: str) -> DataFrame:
    """Tumbling windows with allowed lateness on a stream of the rows that
    :func:`split_late_stream` found on time, with its ``batch_id`` and
    ``seen_us``: a window is emitted for the batch that brings its first rows and again, with
    the new result, for every later batch that brings rows for it.  Columns:
    keys, window_start, those of ``result``, batch_id, revision: the number of
    the window's emission, of which the highest holds.

    State of a key: a map from window to the accumulator's state, and an
    event-time timer per window, which removes it when no row can change it
    any more.  So the state has the windows that are open, and a batch reads
    and writes only the windows it changes.

    The last result of each window does not depend on how this query cuts its
    own input (a file stream takes the files in the order in which they were
    written): its watermark only decides when a window is dropped and follows
    ``seen_us``, so files of one batch may come in any order and in several
    micro-batches."""
    import pickle

    import pandas as pd
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.streaming import StatefulProcessor
    size_us = size_seconds * 1_000_000
    types = dict(on_time.dtypes)
    names = [f.name for f in T._parse_datatype_string(result).fields]

    class Windows(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.windows = handle.getMapState("windows", "start_us long", "partial binary, revision int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            partial, revision, out = {}, {}, {}
            chunks = [part for pdf in rows for part in pdf.groupby(["batch_id", "tw_start"])]
            for (batch, start), part in sorted(chunks, key=lambda x: x[0]):
                start = int(start)
                if start not in partial:
                    if self.windows.containsKey((start,)):
                        raw, revision[start] = self.windows.getValue((start,))
                        partial[start] = pickle.loads(bytes(raw))
                    else:
                        partial[start], revision[start] = acc.zero(), 0
                        # open until the watermark, held back by the lateness too, passes the end
                        self.handle.registerTimer((start + size_us) // 1000)
                partial[start] = acc.add(partial[start], pa.RecordBatch.from_pandas(part, preserve_index=False))
                if (at := (int(batch), start)) not in out:      # one emission per window, batch and micro-batch
                    revision[start] += 1
                out[at] = [(*key, start, *r, int(batch), revision[start]) for r in acc.finish(partial[start])]
            for start, state in partial.items():
                self.windows.updateValue((start,), (pickle.dumps(state), revision[start]))
            if out:
                yield pd.DataFrame([r for rs in out.values() for r in rs],
                                   columns=[*keys, "tw_us", *names, "batch_id", "revision"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.windows.removeKey((expiredTimerInfo.getExpiryTimeInMs() * 1000 - size_us,))
            return iter([])

        def close(self) -> None:
            pass

    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = (on_time.withColumn("batch_id", F.col("batch_id").cast("long"))
         .withColumn("tw_start", F.floor(us / F.lit(size_us)).cast("long") * size_us)
         .withColumn("tw_mark", F.timestamp_micros(F.coalesce("seen_us", F.lit(1))))
         .withWatermark("tw_mark", f"{delay_seconds + lateness_seconds} seconds"))
    out = d.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=Windows(), outputMode="Update", timeMode="EventTime",
        outputStructType=", ".join(f"`{k}` {types[k]}" for k in keys) + f", tw_us long, {result}, batch_id long, revision int")
    return out.select(*keys, F.timestamp_micros("tw_us").cast(types[ts]).alias("window_start"), *names, "batch_id", "revision")


# ------------------------------------------------- punctuated watermarks
def _before_marks(df: DataFrame, ts: str, arrival_order: list[str], marker: Column, size_us: int, carried: int | None) -> DataFrame:
    """``df`` with ``__start`` of its window, ``__mark`` (a marker's watermark)
    and ``__late``."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.withColumn("__mark", F.unix_micros(marker.cast("timestamp"))) \
        .withColumn("__start", F.floor(us / F.lit(size_us)).cast("long") * size_us)
    d = S.running_agg(d, [], arrival_order, None, [("__before", "__mark", "max")], inclusive=False)
    mark = F.greatest(F.col("__before"), F.lit(carried).cast("long"))
    return d.withColumn("__late", F.coalesce(F.col("__start") + size_us <= mark, F.lit(False))).drop("__before")


def punctuated_windows(df: DataFrame, keys: list[str], ts: str, arrival: str, marker: Column, size_seconds: int,
                       aggs: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Tumbling windows under punctuated watermarks: ``marker`` is the
    watermark (timestamp) that a row carries, null for rows that are none,
    ``arrival`` the number by which rows arrive.  A marker takes effect after
    its own row; a lower one than before changes nothing.

    Returns the closed windows (keys, window_start, aggregates, closed_by: the
    arrival number of the marker that reached the window's end) and the late
    rows.  Windows that no marker has reached are not emitted; rows without
    event time are in no window."""
    size_us = size_seconds * 1_000_000
    d = S.written(_before_marks(df, ts, [arrival], marker, size_us, None), "marked")
    windows = d.filter(~F.col("__late") & F.col("__start").isNotNull()).groupBy(*keys, "__start").agg(*aggs)
    marks = d.filter(F.col("__mark").isNotNull()).groupBy(F.col("__mark").alias("t")).agg(F.min(arrival).alias("n"))
    # of equal or higher marks the first to arrive: only marks that raise the watermark
    marks = S.running_agg(marks, [], ["n"], None, [("high", "t", "max")], inclusive=False) \
        .filter(F.col("high").isNull() | (F.col("t") > F.col("high"))).select("t", "n")
    ends = windows.select("__start").distinct().withColumn("x", F.col("__start") + size_us)
    closed = S.first_at_or_after(marks, ends, [], "t", "n", "x", out="closed_by").filter(F.col("closed_by").isNotNull())
    kind = dict(df.dtypes)[ts]
    out = windows.join(closed.select("__start", "closed_by"), "__start")
    return (out.select(*keys, F.timestamp_micros("__start").cast(kind).alias("window_start"),
                       *[c for c in windows.columns if c not in (*keys, "__start")], "closed_by"),
            d.filter("__late").select(*df.columns))


def punctuated_windows_stream(stream: DataFrame, keys: list[str], ts: str, arrival: str, marker: Column, size_seconds: int,
                              aggs: list[Column], merges: list[Column], out_path: str, late_path: str, state_path: str,
                              checkpoint: str, trigger: dict | None = None):
    """The same on a stream, whatever its cut into micro-batches.  State: the
    watermark and the partial results of the windows it has not reached
    (``aggs`` over rows, ``merges`` the aggregates of the same names over
    partial results), versioned by batch; a batch writes the windows that
    close and its late rows into ``batch_id=`` folders (without closed_by)."""
    size_us = size_seconds * 1_000_000
    spark = stream.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        m = _carried(spark, f"{state_path}/mark", batch_id)
        old = newest_before(spark, f"{state_path}/windows", batch_id)
        d = _before_marks(batch, ts, [arrival], marker, size_us, m).persist()
        try:
            d.filter("__late").select(*batch.columns).write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
            new = d.agg(F.max("__mark")).first()[0]
            new = max((v for v in (m, new) if v is not None), default=None)
            part = d.filter(~F.col("__late") & F.col("__start").isNotNull()).groupBy(*keys, "__start").agg(*aggs)
            known = part if old is None else spark.read.parquet(old).unionByName(part)
            merged = S.written(known.groupBy(*keys, "__start").agg(*merges), "open-windows")
        finally:
            d.unpersist()
        done = F.lit(False) if new is None else F.col("__start") + size_us <= F.lit(new)
        kind = dict(batch.dtypes)[ts]
        (merged.filter(done).select(*keys, F.timestamp_micros("__start").cast(kind).alias("window_start"),
                                    *[c for c in merged.columns if c not in (*keys, "__start")])
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))
        commit(merged.filter(~done), f"{state_path}/windows", batch_id, KEPT)
        _carry(spark, new, f"{state_path}/mark", batch_id)

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()

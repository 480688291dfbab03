"""Joins beyond plain equi-joins: as-of (latest model) and concurrent
external lookups."""

from __future__ import annotations

import contextlib
import queue
import threading
import time
from collections import deque
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.plans import sequence as S
from tidewater.plans.broadcast import fits_broadcast
from tidewater.sinks.versions import KEPT, commit, newest_before


def asof_backward(data: DataFrame, ts: str, right: DataFrame, right_ts: str, broadcast: bool | None = None) -> DataFrame:
    """Pair each data row with the latest ``right`` row whose ``right_ts`` is
    at or before the row's ``ts`` (left outer: no earlier right row => NULLs).
    ``right_ts`` must be unique.

    ``right`` is usually a small, slowly changing table (models).  If it fits
    a broadcast, its sorted times are an index that gives each data row the
    number of its right row (a binary search over one column), and the join is
    a broadcast equi-join on that number; whatever lies between two right rows
    costs nothing.  Otherwise both sides become one sequence in time order and
    the latest right row is a running maximum over balanced buckets: no time
    range, however busy, is one task.  ``broadcast`` forces one of the two;
    they give the same rows.
    """
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    r = S.written(right.withColumn("__from", us(right_ts)).filter(F.col("__from").isNotNull()), "asof-right")
    if not (fits_broadcast(r) if broadcast is None else broadcast):
        return _asof_merged(data, ts, r, us)
    starts = r.select("__from").orderBy("__from").toPandas()["__from"].to_numpy("int64")  # the bound of fits_broadcast
    index = data.sparkSession.sparkContext.broadcast(starts)

    @F.pandas_udf("long")
    def latest(t: pd.Series) -> pd.Series:
        at = index.value.searchsorted(t.fillna(0).to_numpy("int64"), side="right") - 1
        return pd.Series(at).where(t.notna().to_numpy() & (at >= 0))

    number = pd.DataFrame({"__from": starts, "__i": range(len(starts))})
    r = r.join(F.broadcast(data.sparkSession.createDataFrame(number, "__from long, __i long")), "__from").drop("__from")
    d = data.withColumn("__di", latest(us(ts)))
    return d.join(F.broadcast(r), F.col("__di") == F.col("__i"), "left").drop("__di", "__i")


def _asof_merged(data: DataFrame, ts: str, r: DataFrame, us) -> DataFrame:
    cols = [c for c in r.columns if c != "__from"]
    model = F.struct("__from", *cols)
    row = F.struct(*[F.col(f"`{c}`") for c in data.columns])
    points = r.select(F.col("__from").alias("__at"), F.lit(0).alias("__kind"), model.alias("__model"))
    asked = data.select(us(ts).alias("__at"), F.lit(1).alias("__kind"), row.alias("__row"))
    both = points.unionByName(asked, allowMissingColumns=True)
    seen = S.running_agg(both, [], ["__at", "__kind"], None, [("__last", "__model", "max")]).filter("__kind = 1")
    # rows without a time meet no right row
    last = F.when(F.col("__at").isNotNull(), F.col("__last"))
    return seen.withColumn("__last", last).select("__row.*", *[F.col(f"__last.{c}").alias(c) for c in cols])


def async_lookup(df: DataFrame, key_col: str, id_col: str, lookup: Callable[[object], str],
                 capacity: int = 20, timeout_s: float = 10.0, ordered: bool = True,
                 out_col: str = "result", position_col: str | None = None) -> DataFrame:
    """Concurrent external lookups per partition, at most ``capacity`` in
    flight: as many threads take the rows one after another, at a cost per row
    that does not depend on how many are in flight.  Each lookup has ``timeout_s`` from the moment it starts; one that
    takes longer, or fails, fails the task, so Spark retries it.  ``ordered``
    emits results in input order, unordered as they complete; requests stay
    in flight across Arrow batches.  Output: ``(id_col, out_col)`` and, if
    named, ``position_col``: the place at which a row came out of its
    partition.

    ``lookup`` is called once per row from threads that are started once per
    partition (the rich function's ``open``) and end after it (``close``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        todo: queue.SimpleQueue = queue.SimpleQueue()    # (place, id, key), or the event at the end of a batch
        done: deque = deque()                # (place, id, result), in the order of completion
        began: list = [None] * capacity      # since when each thread is at its lookup
        failed: list = []
        held: dict = {}                      # ordered: results that wait for an earlier one
        placed = emitted = 0

        def work(me: int) -> None:
            while (item := todo.get()) is not None:
                if isinstance(item, threading.Event):
                    item.set()
                    continue
                at, i, k = item
                began[me] = start = time.monotonic()
                try:
                    got = lookup(k)
                    if time.monotonic() - start > timeout_s:
                        raise TimeoutError(f"lookup took longer than {timeout_s} s")
                    done.append((at, i, got))
                except BaseException as e:  # raised again by the task's own thread
                    failed.append(e)
                    return
                finally:
                    began[me] = None

        def check() -> None:
            if failed:
                raise failed[0]
            now = time.monotonic()
            if any(b is not None and now - b > timeout_s for b in began):
                raise TimeoutError(f"lookup took longer than {timeout_s} s")

        def out() -> pd.DataFrame:
            """Results that may be emitted now."""
            nonlocal emitted
            ready = []
            for _ in range(len(done)):
                at, i, got = done.popleft()
                if ordered:
                    held[at] = i, got
                else:
                    ready.append((i, got))
            while emitted + len(ready) in held:
                ready.append(held.pop(emitted + len(ready)))
            frame = pd.DataFrame({id_col: [i for i, _ in ready], out_col: [r for _, r in ready]})
            if position_col:
                frame[position_col] = range(emitted, emitted + len(ready))
            emitted += len(ready)
            return frame

        threads = [threading.Thread(target=work, args=(n,), daemon=True) for n in range(capacity)]
        for t in threads:
            t.start()
        try:
            for pdf in batches:
                for k, i in zip(pdf[key_col].tolist(), pdf[id_col].tolist()):
                    todo.put((placed, i, k))
                    placed += 1
                started = threading.Event()      # set once all rows before it have started
                todo.put(started)
                while not started.wait(min(timeout_s, 0.1)):
                    check()
                check()
                if len(frame := out()):
                    yield frame
            for _ in threads:
                todo.put(None)
            for t in threads:
                while t.is_alive():
                    t.join(min(timeout_s, 0.1))
                    check()
            check()
            if len(frame := out()):
                yield frame
        finally:
            with contextlib.suppress(queue.Empty):
                while True:
                    todo.get_nowait()
            for _ in threads:
                todo.put(None)

    id_type = dict(df.dtypes)[id_col]
    place = f", {position_col} long" if position_col else ""
    return df.select(id_col, key_col).mapInPandas(run, f"{id_col} {id_type}, {out_col} string{place}")


def key_mod_label(k) -> str:
    """Sample lookup of the reference's client: ``"key" + (k % 10)``."""
    return "key" + str(int(k) % 10)


def latest_model_predict_stream(stream: DataFrame, id_col: str, ts: str, value: str, window_seconds: int,
                                out_path: str, model_path: str, checkpoint: str,
                                trigger: dict | None = None, retention_seconds: int | None = None):
    """Streaming latest-model enrichment.  The model of a tumbling window is
    the mean of ``value`` over it, available from the window's end; every
    row is paired with the newest available model.

    Per micro-batch (``foreachBatch``): the batch's per-window partial sums
    and counts are merged into a small model table (one version per
    ``batch_id``), then the batch's rows are as-of joined against it.  With
    in-order input a window is complete before any row at or after its end
    arrives, so predictions equal the batch result.  Outputs and model
    versions are keyed by ``batch_id``, so a replayed batch rewrites them.

    The model table is bounded: it keeps the windows that end within
    ``retention_seconds`` (default: one window) of the newest event time, and
    the newest model before those, which is what rows up to that late need.
    Rows that come later still may miss their model."""
    spark = stream.sparkSession
    w_us = window_seconds * 1_000_000
    keep_us = w_us if retention_seconds is None else retention_seconds * 1_000_000

    def step(batch: DataFrame, batch_id: int) -> None:
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        part = (batch.groupBy((F.floor(us / F.lit(w_us)) * F.lit(w_us)).alias("w_us"))
                .agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n")))
        prev = newest_before(spark, model_path, batch_id)
        merged = part if prev is None else (spark.read.parquet(prev).unionByName(part).groupBy("w_us")
                                            .agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
        merged = S.written(merged, "models")
        models = (merged.select(F.timestamp_micros(F.col("w_us") + F.lit(w_us)).cast(dict(batch.dtypes)[ts])
                                .alias("model_ts"),
                                F.round(F.col("s") / F.col("n"), 6).alias("prediction")))
        pred = asof_backward(batch.select(id_col, ts), ts, models, "model_ts")
        pred.select(id_col, "model_ts", "prediction").write.mode("overwrite").parquet(
            f"{out_path}/batch_id={batch_id}")
        # state last: a batch that fails earlier starts over
        newest = batch.agg(F.max(us)).first()[0]
        before = merged.agg(F.max("w_us")).first()[0]
        horizon = max((v for v in (newest, before) if v is not None), default=0) - keep_us
        last_closed = merged.filter(F.col("w_us") + w_us <= horizon).agg(F.max("w_us")).first()[0]
        kept = merged if last_closed is None else merged.filter(F.col("w_us") >= last_closed)
        commit(kept.coalesce(1), model_path, batch_id, KEPT)

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()

"""Streaming forms of the keyed operators: ``transformWithStateInPandas``
(state kinds: ``transformWithState``) processors with value / list / map state and event-time timers.

Each processor sorts the rows of its key inside a micro-batch by the
operator's order columns, so results do not depend on how a batch was read.
A key's rows of one micro-batch are in memory at once; the trigger's limit
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds them.
State lives in the configured state store (RocksDB) and is checkpointed with
the query; restarting from the checkpoint resumes with the same state.
``seed`` tables, one row per key, give a new query the state that another has
left (``streaming/retained.py`` reads them from its checkpoint).
"""

from __future__ import annotations

import math
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _sorted_rows(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(order, kind="stable")


def _seeded(seed: DataFrame | None, key: str) -> dict:
    return {} if seed is None else {"initialState": seed.groupBy(key)}


def _number(v, kind=float):
    return None if pd.isna(v) else kind(v)


# ---------------------------------------------------------------- jump alert
class JumpAlertProcessor(StatefulProcessor):
    """Emit ``(key, last, current)`` when ``|current - last| > threshold``;
    ``initial`` (if given) is the value-state default the first row is
    compared with."""

    def __init__(self, key: str, value: str, order: list[str], threshold: float, initial: float | None):
        self.key, self.value, self.order = key, value, order
        self.threshold, self.initial = threshold, initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "v double")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.last.update((_number(initialState["last"].iloc[0]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import numpy as np
        pdf = _sorted_rows(rows, self.order)
        last = self.last.get()[0] if self.last.exists() else self.initial
        vals = pdf[self.value].to_numpy(dtype=float)
        if len(vals) == 0:
            return
        prev = np.concatenate([[np.nan if last is None else last], vals[:-1]])
        hit = np.abs(vals - prev) > self.threshold       # NaN (no previous) compares False
        self.last.update((float(vals[-1]),))
        if hit.any():
            yield pdf[hit].assign(last_value=prev[hit])

    def close(self) -> None:
        pass


def jump_alert_stream(df: DataFrame, key: str, order: list[str], value: str, threshold: float,
                      initial: float | None = None, seed: DataFrame | None = None) -> DataFrame:
    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=JumpAlertProcessor(key, value, order, threshold, initial),
        outputStructType=f"{fields}, last_value double", outputMode="Append", timeMode="None", **_seeded(seed, key))


# ----------------------------------------------------- running count changelog
class RunningCountProcessor(StatefulProcessor):
    """Per input row: ``(false, n-1)`` when n > 1, then ``(true, n)`` -- the
    retract changelog of ``count(*) GROUP BY key``."""

    def __init__(self, key: str, order: list[str], carry: list[str]):
        self.key, self.order, self.carry = key, order, carry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import numpy as np
        pdf = _sorted_rows(rows, self.order)
        n0 = self.count.get()[0] if self.count.exists() else 0
        if len(pdf) == 0:
            return
        base = pdf[[self.key, *self.carry]].reset_index(drop=True)
        n = n0 + np.arange(1, len(base) + 1, dtype=np.int64)
        adds = base.assign(is_add=True, cnt=n, step=np.int32(1), __o=2 * np.arange(len(base)) + 1)
        retracts = base.assign(is_add=False, cnt=n - 1, step=np.int32(0), __o=2 * np.arange(len(base)))[n > 1]
        self.count.update((int(n[-1]),))
        yield pd.concat([retracts, adds]).sort_values("__o", kind="stable").drop(columns="__o")

    def close(self) -> None:
        pass


def changelog_count_stream(df: DataFrame, key: str, order: list[str], carry: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    fields = ", ".join(f"`{c}` {types[c]}" for c in [key, *carry])
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RunningCountProcessor(key, order, carry),
        outputStructType=f"{fields}, is_add boolean, cnt long, step int", outputMode="Append", timeMode="None")


# -------------------------------------------------------------- rising alert
class RisingAlertProcessor(StatefulProcessor):
    """Event-time rising alert.  State: ``last`` value (default
    ``initial``) and the pending ``deadline``.  A deadline reached by a
    later row of the same key fires inside ``handleInputRows`` (so results
    do not depend on where micro-batches are cut); only the trailing
    deadline is kept as a registered timer, fired by the watermark."""

    def __init__(self, key: str, us_col: str, seq: str, value: str, seconds: int, initial: float):
        self.key, self.us, self.seq, self.value = key, us_col, seq, value
        self.period_us = seconds * 1_000_000
        self.initial = initial

    @staticmethod
    def _timer_ms(deadline_us: int) -> int:
        # timers are in milliseconds; the deadline itself is kept exact
        return -((-deadline_us) // 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("st", "last double, deadline_us long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        last, deadline = _number(initialState["last"].iloc[0]), _number(initialState["deadline_us"].iloc[0], int)
        self.state.update((last, deadline))
        if deadline is not None:
            self.handle.registerTimer(self._timer_ms(deadline))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted_rows(rows, [self.us, self.seq])
        last, deadline = (self.state.get() if self.state.exists() else (self.initial, None))
        registered = deadline          # the only timer that can exist for this key
        out = []
        for t_us, v in zip(pdf[self.us].to_numpy(), pdf[self.value].to_numpy(dtype=float)):
            t_us = int(t_us)
            if deadline is not None and deadline <= t_us:
                out.append((key[0], deadline, last))
                deadline = None
            if v > last and deadline is None:
                deadline = t_us + self.period_us
            elif v < last and deadline is not None:
                deadline = None
            last = float(v)
        # timers fire only when the watermark passes them after this call,
        # so only the trailing deadline needs one: one delete / register
        # per key and batch instead of one per arm or cancel
        if registered != deadline:
            if registered is not None:
                self.handle.deleteTimer(self._timer_ms(registered))
            if deadline is not None:
                self.handle.registerTimer(self._timer_ms(deadline))
        self.state.update((last, deadline))
        if out:
            yield pd.DataFrame(out, columns=[self.key, "alert_us", "last_value"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, deadline = self.state.get()
        if deadline is not None and self._timer_ms(deadline) == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((last, None))
            yield pd.DataFrame([(key[0], deadline, last)], columns=[self.key, "alert_us", "last_value"])

    def close(self) -> None:
        pass


def rising_alert_stream(df: DataFrame, key: str, ts: str, seq: str, value: str, seconds: int,
                        initial: float = 0.0, delay: str = "0 seconds", seed: DataFrame | None = None) -> DataFrame:
    """Input must be a stream with ``ts`` of TIMESTAMP type."""
    d = (df.select(key, ts, seq, value).withWatermark(ts, delay)
         .withColumn("tw_us", F.unix_micros(F.col(ts))))
    key_type = dict(df.dtypes)[key]
    out = d.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RisingAlertProcessor(key, "tw_us", seq, value, seconds, initial),
        outputStructType=f"{key} {key_type}, alert_us long, last_value double",
        outputMode="Append", timeMode="EventTime", **_seeded(seed, key))
    return out.select(key, F.timestamp_micros("alert_us").alias("alert_ts"), "last_value")


# -------------------------------------------------------------- state kinds
class StateKindsProcessor(StatefulProcessor):
    """Exercises the four keyed-state kinds: value (previous value, then
    update), list (add, add all, replace, read), map (contains, get, put) and
    a reducing cell (running maximum).  Emits per row
    ``(key, previous, list_size, had_marker, running_max)``.

    Each state is read and written once per key and micro-batch (every state
    call is a round trip to the state store).  The processor takes plain rows:
    most keys have few of them in a micro-batch, and data frames of a few rows
    cost far more than the rows.  A null or NaN value is emitted as null, and so
    is every running maximum after it."""

    def __init__(self, key: str, value: str, order: list[str]):
        self.key, self.value, self.order = key, value, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.val = handle.getValueState("value", "v double")
        self.lst = handle.getListState("list", "i int")
        self.map = handle.getMapState("map", "k string", "v double")
        self.red = handle.getValueState("reduce", "v double")
        self.out = Row(self.key, "previous", "list_size", "had_marker", "running_max")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.val.update((_number(initialState["last"]),))
        self.lst.put([(1,)] * int(initialState["list_size"]))
        if initialState["markers"]:
            self.map.updateValue(("marker",), (0.0,))
        self.red.update((_number(initialState["running_max"]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # the columns are key, value and the order; plain tuples are faster than named fields
        got = sorted(map(tuple, rows), key=lambda r: [(v is None or v != v, v) for v in r[2:]])
        values = [math.nan if r[1] is None else float(r[1]) for r in got]
        if not values:
            return
        previous, high = (s.get() for s in (self.val, self.red))
        previous, high = previous and previous[0], high and high[0]
        self.val.update((values[-1],))
        # add, add-all, then replace the whole list: one element remains
        self.lst.appendValue((1,))
        self.lst.appendList([(1,)])
        self.lst.put([(1,)])
        size = sum(1 for _ in self.lst.get())
        had = self.map.containsKey(("marker",))
        if had:
            self.map.getValue(("marker",))
        self.map.updateValue(("marker",), (0.0,))
        for v in values:
            high = v if high is None or v > high or v != v else high
            yield self.out(key[0], _number(previous), size, had, _number(high))
            previous, had = v, True
        self.red.update((high,))

    def close(self) -> None:
        pass


def state_kinds_stream(df: DataFrame, key: str, value: str, order: list[str], seed: DataFrame | None = None) -> DataFrame:
    key_type = dict(df.dtypes)[key]
    return df.select(F.col(key), F.col(value).cast("double"), *order).groupBy(key).transformWithState(
        statefulProcessor=StateKindsProcessor(key, value, order),
        outputStructType=f"{key} {key_type}, previous double, list_size int, had_marker boolean, running_max double",
        outputMode="Append", timeMode="None", **_seeded(seed, key))


# ------------------------------------------------------ row frame (last k+1)
class RowsFrameProcessor(StatefulProcessor):
    """``count / sum / avg`` over ``ROWS BETWEEN k PRECEDING AND CURRENT ROW``
    per key: list state keeps the previous ``k`` values."""

    def __init__(self, key: str, value: str, order: list[str], preceding: int, carry: list[str]):
        self.key, self.value, self.order, self.k, self.carry = key, value, order, preceding, carry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("buf", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted_rows(rows, self.order)
        import numpy as np
        buf = [r[0] for r in self.buf.get()] if self.buf.exists() else []
        v = np.concatenate([np.array(buf, dtype=float), pdf[self.value].to_numpy(dtype=float)])
        # frames of k + 1 values, the missing ones before the first row as 0
        frames = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(self.k), v]), self.k + 1)[len(buf):]
        cnt = np.minimum(np.arange(len(buf), len(v)) + 1, self.k + 1)
        if self.k:
            self.buf.put([(float(x),) for x in v[max(0, len(v) - self.k):]])
        out = pdf[[self.key, *self.carry]].assign(cnt=cnt.astype(np.int64), total=frames.sum(axis=1))
        yield out.assign(avg_value=out["total"] / out["cnt"])

    def close(self) -> None:
        pass


def rows_frame_stream(df: DataFrame, key: str, order: list[str], value: str, preceding: int,
                      carry: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    fields = ", ".join(f"`{c}` {types[c]}" for c in [key, *carry])
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RowsFrameProcessor(key, value, order, preceding, carry),
        outputStructType=f"{fields}, cnt long, total double, avg_value double",
        outputMode="Append", timeMode="None")


# ------------------------------------------------- sliding count window
class CountWindowProcessor(StatefulProcessor):
    """Every ``slide``-th row of a key emits the sum of its last ``size``
    rows: a ring of at most ``size`` values in list state plus the row
    count in value state."""

    def __init__(self, key: str, value: str, order: list[str], size: int, slide: int):
        self.key, self.value, self.order, self.size, self.slide = key, value, order, size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("ring", "v double")
        self.n = handle.getValueState("n", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted_rows(rows, self.order)
        import numpy as np
        buf = [r[0] for r in self.buf.get()] if self.buf.exists() else []
        n = self.n.get()[0] if self.n.exists() else 0
        v = np.concatenate([np.array(buf, dtype=float), pdf[self.value].to_numpy(dtype=float)])
        # only the rows that fire look back over their window
        fire = np.arange(n + 1, n + 1 + len(v) - len(buf))
        fire = fire[fire % self.slide == 0]
        ends = fire - n + len(buf)
        total = [float(v[max(0, e - self.size):e].sum()) for e in ends]
        self.buf.put([(float(x),) for x in v[max(0, len(v) - self.size):]])
        self.n.update((n + len(v) - len(buf),))
        if len(fire):
            yield pd.DataFrame({self.key: [key[0]] * len(fire), "n": fire, "total": total})

    def close(self) -> None:
        pass


def count_window_stream(df: DataFrame, key: str, order: list[str], value: str, size: int, slide: int) -> DataFrame:
    key_type = dict(df.dtypes)[key]
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=CountWindowProcessor(key, value, order, size, slide),
        outputStructType=f"{key} {key_type}, n long, total double", outputMode="Append", timeMode="None")


# ------------------------------------------------ generic running reduce
class RunningReduceProcessor(StatefulProcessor):
    """Keyed running reduce with an arbitrary function ``fn(acc, row) ->
    acc`` over dict rows; emits the accumulator after every input row."""

    def __init__(self, order: list[str], fn, columns: list[str], state_schema: str):
        self.order, self.fn, self.columns, self.state_schema = order, fn, columns, state_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted_rows(rows, self.order)
        acc = dict(zip(self.columns, self.acc.get())) if self.acc.exists() else None
        out = []
        for rec in pdf[self.columns].to_dict("records"):
            acc = rec if acc is None else self.fn(acc, rec)
            out.append(dict(acc))
        self.acc.update(tuple(acc[c] for c in self.columns))
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def running_reduce_stream(df: DataFrame, key: str, order: list[str], fn) -> DataFrame:
    """Streaming running reduce: output rows have the input's columns."""
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RunningReduceProcessor(order, fn, df.columns, schema),
        outputStructType=schema, outputMode="Append", timeMode="None")


# ------------------------------------------------- tumbling count window
class TumblingCountProcessor(StatefulProcessor):
    """Every ``size`` rows of a key emit once.  Rows of the open window wait
    in list state (fewer than ``size``)."""

    KINDS = {"min": "min", "max": "max", "sum": "sum", "count": "count", "first": "first", "last": "last"}

    def __init__(self, key: str, order: list[str], size: int, aggs: dict[str, tuple[str, str]], fields: list[tuple[str, str]]):
        self.key, self.order, self.size, self.aggs, self.fields = key, order, size, aggs, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", ", ".join(f"`{c}` {t}" for c, t in self.fields))
        self.n = handle.getValueState("n", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import numpy as np
        cols = [c for c, _ in self.fields]
        new = _sorted_rows(rows, self.order)[cols]
        held = pd.DataFrame(list(self.open.get()), columns=cols) if self.open.exists() else new.iloc[:0]
        pdf = pd.concat([held, new], ignore_index=True) if len(held) else new.reset_index(drop=True)
        n = self.n.get()[0] if self.n.exists() else 0
        whole = len(pdf) // self.size
        block = np.arange(len(pdf)) // self.size
        if whole:
            done = pdf[block < whole]
            grouped = done.groupby(block[:len(done)])
            out = pd.DataFrame({name: grouped[c].agg(self.KINDS[kind]) for name, (c, kind) in self.aggs.items()})
            yield out.assign(**{self.key: key[0], "window_no": n + 1 + np.arange(whole)})[
                [self.key, "window_no", *self.aggs]]
        rest = [tuple(r) for r in pdf[block >= whole].itertuples(index=False)]
        self.open.put(rest) if rest else self.open.clear()
        self.n.update((n + whole,))

    def close(self) -> None:
        pass


def tumbling_count_window_stream(df: DataFrame, key: str, order: list[str], size: int,
                                 aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """``aggs``: output name -> (column, kind), kind one of min, max, sum,
    count, first, last (in the order of ``order``)."""
    types = dict(df.dtypes)
    fields = [(c, types[c]) for c in dict.fromkeys(c for c, _ in aggs.values())]
    out = ", ".join(f"`{name}` {'long' if kind == 'count' else types[c]}" for name, (c, kind) in aggs.items())
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=TumblingCountProcessor(key, order, size, aggs, fields),
        outputStructType=f"`{key}` {types[key]}, window_no long, {out}", outputMode="Append", timeMode="None")


# ------------------------------------------------------- additions of a top 1
class Top1AdditionsProcessor(StatefulProcessor):
    """Rows that rank strictly above every earlier row of their key."""

    def __init__(self, order: list[str], rank: str):
        self.order, self.rank = order, rank

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import numpy as np
        pdf = _sorted_rows(rows, self.order)
        v = pdf[self.rank].to_numpy(dtype=float)
        best = self.best.get()[0] if self.best.exists() else -np.inf
        before = np.fmax.accumulate(np.concatenate([[best], v]))
        adds = pdf[v > before[:-1]]
        self.best.update((float(before[-1]),))
        if len(adds):
            yield adds.assign(is_add=True)

    def close(self) -> None:
        pass


def top1_additions_stream(df: DataFrame, key: str, order: list[str], rank: str) -> DataFrame:
    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=Top1AdditionsProcessor(order, rank),
        outputStructType=f"{fields}, is_add boolean", outputMode="Append", timeMode="None")


# ------------------------------------------------- delta trigger + evictor
class TopSpeedProcessor(StatefulProcessor):
    """Delta trigger with a time evictor: the reference distance in value
    state, the rows that a later window can still hold in list state."""

    def __init__(self, key: str, seq: str, threshold: int, evict_us: int):
        self.key, self.seq, self.threshold, self.evict_us = key, seq, threshold, evict_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ref = handle.getValueState("ref", "d long")
        self.rows = handle.getListState("rows", "us long, seq long, sp double, dc long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import numpy as np
        new = _sorted_rows(rows, ["tw_us", self.seq])[["tw_us", self.seq, "tw_sp", "tw_dc"]].set_axis(
            ["us", "seq", "sp", "dc"], axis=1)
        held = pd.DataFrame(list(self.rows.get()) if self.rows.exists() else [], columns=new.columns)
        pdf = pd.concat([held, new], ignore_index=True) if len(held) else new.reset_index(drop=True)
        us, sp = pdf["us"].to_numpy(np.int64), pdf["sp"].to_numpy(float)
        d = pdf["dc"].to_numpy(float)
        high = np.fmax.accumulate(np.concatenate([[-np.inf], d[len(held):]]))[1:]
        ref = self.ref.get()[0] if self.ref.exists() else None
        at = 0
        if ref is None and (known := np.flatnonzero(~np.isnan(d[len(held):]))).size:
            at, ref = int(known[0]) + 1, int(d[len(held) + known[0]])
        out = []
        while ref is not None:
            # the running maximum over the new rows finds the next firing row
            i = max(at, int(np.searchsorted(high, ref + self.threshold, side="right")))
            if i >= len(high):
                break
            row = len(held) + i
            first = int(np.searchsorted(us, us[row] - self.evict_us, side="right"))
            best = first + int(np.nanargmax(sp[first:row + 1]))
            out.append((key[0], int(pdf["seq"].iloc[best]), sp[best], d[best] / 100.0, int(us[best])))
            ref, at = int(d[row]), i + 1
        if ref is not None:
            self.ref.update((ref,))
        keep = us > us[-1] - self.evict_us
        self.rows.put([(int(a), int(b), float(c), None if np.isnan(e) else int(e)) for a, b, c, e in zip(
            us[keep], pdf["seq"].to_numpy()[keep], sp[keep], d[keep])])
        if out:
            yield pd.DataFrame(out, columns=[self.key, self.seq, "speed", "distance", "tw_time"])

    def close(self) -> None:
        pass


def top_speed_delta_stream(df: DataFrame, key: str, ts: str, seq: str, speed: str, distance_cents: str,
                           threshold_cents: int, evict_seconds: int) -> DataFrame:
    types = dict(df.dtypes)
    d = df.select(key, F.col(seq).cast("long").alias(seq), F.unix_micros(F.col(ts).cast("timestamp")).alias("tw_us"),
                  F.col(speed).cast("double").alias("tw_sp"), F.col(distance_cents).cast("long").alias("tw_dc"))
    out = d.groupBy(key).transformWithStateInPandas(
        statefulProcessor=TopSpeedProcessor(key, seq, threshold_cents, evict_seconds * 1_000_000),
        outputStructType=f"`{key}` {types[key]}, `{seq}` long, speed double, distance double, tw_time long",
        outputMode="Append", timeMode="None")
    return out.select(key, F.col(seq).cast(types[seq]).alias(seq), "speed", "distance",
                      F.timestamp_micros("tw_time").cast(types[ts]).alias("time"))

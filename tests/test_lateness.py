"""Lateness on streams: any cut into micro-batches gives the batch answer, and
state holds the open windows only."""

import random
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewater.operators import late as L
from tidewater.operators import timewindows as TW
from tidewater.operators.accumulators import Accumulator
from tidewater.session import scratch_path
from tidewater.streaming.runner import replay_as_files, run_available_now

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not import the tests
SIZE, DELAY, LATENESS = 15, 3, 20


class MinAndCount(Accumulator):
    def zero(self):
        return None, 0

    def add(self, state, rows):
        return self.merge(state, (float(np.min(rows.column("temperature").to_numpy())), rows.num_rows))

    def merge(self, state, other):
        low = [x for x in (state[0], other[0]) if x is not None]
        return min(low, default=None), state[1] + other[1]

    def finish(self, state):
        return [state]


@pytest.fixture(scope="module")
def arrivals(spark):
    """Readings that arrive out of order: most nearly in time, some late but
    allowed, some too late; a burst that jumps ahead."""
    rng = random.Random(5)
    rows, now = [], 0.0
    for i in range(160):
        now += rng.choice([0, 1, 2, 3]) + (60 if i == 80 else 0)
        back = rng.choice([0] * 6 + [5, 15, 30, 70])
        rows.append((i, rng.choice("abc"), max(0, int(now) - back), round(rng.random() * 50, 2)))
    return spark.createDataFrame(rows, "event_id long, id string, sec long, temperature double") \
        .withColumn("ts", F.timestamp_seconds("sec"))


def replayed(spark, df, cuts):
    path = replay_as_files(spark, df, "event_id", cuts, scratch_path(spark, "replay"), files=2)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("cuts", [1, 2, 7])
def test_side_output_does_not_depend_on_the_cut(spark, arrivals, cuts):
    on_time, late = L.split_late(arrivals, "ts", ["event_id"], None, SIZE, DELAY, LATENESS)
    paths = [scratch_path(spark, n) for n in ("ontime", "late", "state", "ckpt")]
    L.split_late_stream(replayed(spark, arrivals, cuts), "ts", SIZE, DELAY, LATENESS, *paths,
                        arrival_order=["event_id"]).awaitTermination()
    assert rows_of(spark.read.parquet(paths[1]), "event_id") == rows_of(late, "event_id") != []
    assert rows_of(spark.read.parquet(paths[0]), "event_id") == rows_of(on_time, "event_id")


@pytest.mark.parametrize("cuts", [1, 4, 9])
def test_windows_are_updated_until_they_close(spark, arrivals, cuts):
    on_time, _ = L.split_late(arrivals, "ts", ["event_id"], None, SIZE, DELAY, LATENESS)
    want = TW.tumble(on_time, ["id"], "ts", f"{SIZE} seconds", [F.min("temperature").alias("low"), F.count("*").alias("n")])
    paths = [scratch_path(spark, n) for n in ("ontime", "late", "state", "ckpt")]
    L.split_late_stream(replayed(spark, arrivals, cuts), "ts", SIZE, DELAY, LATENESS, *paths,
                        arrival_order=["event_id"]).awaitTermination()
    kept = spark.readStream.schema(f"{', '.join(f'{c} {t}' for c, t in arrivals.dtypes)}, seen_us long, batch_id int") \
        .option("maxFilesPerTrigger", 3).parquet(paths[0])
    updates = L.late_updates_stream(kept, ["id"], "ts", SIZE, DELAY, LATENESS, MinAndCount(), "low double, n long")
    out, place = scratch_path(spark, "updates"), scratch_path(spark, "updates-ckpt")
    q = (updates.writeStream.outputMode("update").option("checkpointLocation", place).trigger(availableNow=True)
         .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/b={i}")).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    last = got.groupBy("id", "window_start").agg(F.max_by(F.struct("low", "n"), "revision").alias("r")) \
        .select("id", "window_start", "r.*")
    cols = ["id", "window_start", "low", "n"]
    assert rows_of(last, *cols) == rows_of(want, *cols)
    # an emission for each batch that brings rows for a window
    touched = spark.read.parquet(paths[0]).select("batch_id", "id", (F.floor(F.col("sec") / SIZE) * SIZE).alias("s"))
    shown = got.select("batch_id", "id", F.unix_seconds("window_start").alias("s"))
    assert rows_of(shown.distinct(), "batch_id", "id", "s") == rows_of(touched.distinct(), "batch_id", "id", "s")
    assert got.count() == got.select("id", "window_start", "revision").distinct().count()
    # what the state still holds are the windows that the batches before the last have not closed
    state = spark.read.format("statestore").option("path", place).option("stateVarName", "windows").load()
    held = [r[0] for r in state.select("user_map_key.start_us" if "user_map_key" in state.columns else "key.start_us").collect()]
    last_seen = spark.read.parquet(paths[0]).agg(F.max("seen_us")).first()[0]
    if cuts == 1:
        assert len(held) == want.count()
    else:
        assert 0 < len(held) < want.count()
        assert all(s + SIZE * 1_000_000 > last_seen - (DELAY + LATENESS) * 1_000_000 for s in held)


@pytest.mark.parametrize("cuts", [1, 3, 8])
def test_punctuated_watermark_closes_windows(spark, arrivals, cuts):
    marker = F.when(F.col("event_id") % 9 == 0, F.col("ts"))
    aggs = [F.min("temperature").alias("low"), F.count("*").alias("n")]
    closed, late = L.punctuated_windows(arrivals, ["id"], "ts", "event_id", marker, SIZE, aggs)
    # row by row
    mark, windows, put_aside, want = -1, {}, [], []
    for r in sorted(arrivals.collect(), key=lambda r: r.event_id):
        start = r.sec // SIZE * SIZE
        if start + SIZE <= mark:
            put_aside.append((r.event_id,))
        else:
            windows.setdefault((r.id, start), []).append(r.temperature)
        if r.event_id % 9 == 0 and r.sec > mark:
            mark = r.sec
            for k in [k for k in windows if k[1] + SIZE <= mark]:
                t = windows.pop(k)
                want.append((k[0], k[1], min(t), len(t), r.event_id))
    sec = lambda df: df.withColumn("start", F.unix_seconds("window_start"))
    assert rows_of(sec(closed), "id", "start", "low", "n", "closed_by") == sorted(want)
    assert rows_of(late, "event_id") == put_aside != []
    paths = [scratch_path(spark, n) for n in ("closed", "late", "state", "ckpt")]
    L.punctuated_windows_stream(replayed(spark, arrivals, cuts), ["id"], "ts", "event_id", marker, SIZE, aggs,
                                [F.min("low").alias("low"), F.sum("n").alias("n")], *paths).awaitTermination()
    got = sec(spark.read.parquet(paths[0]))
    assert rows_of(got, "id", "start", "low", "n") == sorted(w[:4] for w in want)
    assert rows_of(spark.read.parquet(paths[1]), "event_id") == put_aside
    # the state has the windows that are still open, in at most three versions
    from tidewater.sinks.versions import committed, newest_before
    state = f"{paths[2]}/windows"
    assert spark.read.parquet(newest_before(spark, state, 10 ** 6)).count() == len(windows)
    assert len(committed(spark, state)) <= 3

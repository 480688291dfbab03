"""Feedback loops on streams: the answer of the batch loop, whatever the cut;
restarts and replays neither lose a row nor output one twice."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators.iterate import iterate_until
from tidewater.session import scratch_path
from tidewater.sinks.versions import KEPT
from tidewater.streaming import feedback as FB
from tidewater.streaming.runner import replay_as_files

def again():
    return (F.col("x") < 100) & (F.col("y") < 100)


def step(d):
    return d.select("id", F.col("y").alias("x"), (F.col("x") + F.col("y")).alias("y"),
                    F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.col("n") + 1).alias("n"))


@pytest.fixture(scope="module")
def pairs(spark):
    rows = spark.range(0, 300).select("id", (F.col("id") % 90 + 1).alias("x"), (F.col("id") % 7).alias("y"), F.lit(0).alias("n"))
    odd = spark.createDataFrame([(300, None, 1, 0), (301, 5, None, 0), (302, 3, 4, 0), (302, 3, 4, 0)], rows.schema)
    return rows.unionByName(odd)


def stream_of(spark, df, cuts):
    src = replay_as_files(spark, df, "id", cuts, scratch_path(spark, "loop-replay"), files=1)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)


def rows_of(df):
    return sorted(map(tuple, df.select("id", "x", "y", "n").collect()), key=str)


@pytest.mark.parametrize("cuts", [1, 9])
def test_stream_gives_the_rows_of_the_batch_loop(spark, pairs, cuts):
    got = iterate_until(stream_of(spark, pairs, cuts), step, again())
    want = iterate_until(pairs, step, again())
    assert want.count() == 304 and rows_of(got) == rows_of(want)
    assert want.agg(F.max("n")).first()[0] > 9          # more rounds than micro-batches


def test_empty_stream(spark, pairs):
    assert iterate_until(stream_of(spark, pairs.limit(0), 1), step, again()).count() == 0


def test_restart_and_replay(spark, pairs):
    src, place, ckpt = (scratch_path(spark, n) for n in ("loop-src", "loop", "loop-ckpt"))
    stream = lambda: spark.readStream.schema(pairs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    first, second = pairs.filter("id < 150"), pairs.filter("id >= 150")
    first.repartition(3).write.parquet(src)
    q = FB.start_loop(stream(), step, again(), place, ckpt, availableNow=True)
    q.awaitTermination()
    assert FB.finished(spark, place, pairs.schema).count() < first.count()      # some are still in the loop
    # the last micro-batch, replayed as after a lost driver
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{ckpt}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())
    assert fs.delete(jvm.org.apache.hadoop.fs.Path(f"{ckpt}/commits/{last}"), False)
    second.repartition(4).write.mode("append").parquet(src)
    got = FB.iterate_stream(stream(), step, again(), place, ckpt)
    assert rows_of(got) == rows_of(iterate_until(pairs, step, again()))
    # another run has nothing to do; buffers do not pile up
    assert rows_of(FB.iterate_stream(stream(), step, again(), place, ckpt)) == rows_of(got)
    waiting = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{place}/v=*/{FB.AGAIN}=true"))
    assert len(waiting) <= KEPT

"""The user-defined source resumes at its offset; the keyed table is compacted."""

from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sources.row_groups import read_row_groups, run_until_read
from tidewater.streaming.runner import COMPACT, replay_as_files, run_keyed_updates


def test_row_groups_resume_at_the_offset(spark):
    place, out, ckpt = (scratch_path(spark, n) for n in ("groups", "groups-out", "groups-ckpt"))
    spark.range(0, 5000).withColumn("v", F.col("id") * 2).repartition(3).write.option("parquet.block.size", 4096) \
        .option("parquet.page.size", 1024).parquet(place)
    run_until_read(read_row_groups(spark, place, "id long"), out, ckpt)
    assert spark.read.parquet(out).count() == 5000
    # a second run with nothing new, and one after more files came
    run_until_read(read_row_groups(spark, place, "id long"), out, ckpt)
    spark.range(5000, 5100).withColumn("v", F.lit(0).cast("long")).write.mode("append").parquet(place)
    run_until_read(read_row_groups(spark, place, "id long"), out, ckpt)
    got = spark.read.parquet(out)
    assert got.columns == ["id"] and got.count() == 5100 and got.distinct().count() == 5100
    assert got.agg(F.min("id"), F.max("id")).first()[:] == (0, 5099)


def test_keyed_table_stays_bounded(spark):
    n = 2 * COMPACT + 3
    e = spark.range(n * 4).select(F.col("id").alias("event_id"), (F.col("id") % 3).alias("k"))
    src = replay_as_files(spark, e, "event_id", n, scratch_path(spark, "keyed-replay"), files=1)
    counts = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src) \
        .groupBy("k").agg(F.count("*").alias("cnt"))
    place = scratch_path(spark, "keyed")
    got = run_keyed_updates(spark, counts, ["k"], place)
    want = e.groupBy("k").agg(F.count("*").alias("cnt"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(place)
    names = [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    assert len([x for x in names if x.startswith("batch_id=")]) <= 2 * COMPACT
    assert "batch_id=0" not in names

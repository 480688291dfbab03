"""The transactional stream sink: rows of whole micro-batches only, bounded
folders, replays that add nothing."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sinks import manifest as M
from tidewater.streaming.runner import spread_as_files


def local(path):
    return path.removeprefix("file:")


def stream_of(spark, src, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(src)


def test_rows_of_failed_tasks_stay_invisible(spark):
    place, ckpt, flag = (scratch_path(spark, n) for n in ("sink", "sink-ckpt", "sink-flag"))
    df = spark.range(0, 400).select("id", F.col("id").cast("string").alias("s"))
    src = spread_as_files(df, 2, scratch_path(spark, "sink-src"), files=2)
    stream = stream_of(spark, src, df.schema)

    @F.udf("long")
    def fails_late(i):
        import os
        if i == 399 and not os.path.exists(flag):
            raise ValueError("a task dies midway")
        return i

    query = lambda: M.write_manifest_table(stream.withColumn("id", fails_late("id")), place, ckpt, availableNow=True)
    with pytest.raises(Exception, match="dies midway"):
        query().awaitTermination()
    seen = {r.id for r in M.read_manifest_table(spark, place, df.schema).collect()}
    open(flag, "w").close()
    query().awaitTermination()
    got = M.read_manifest_table(spark, place, df.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    assert sum(n for _, n in M.Place(local(place)).live()) == 400
    # whole micro-batches before the one that failed, and none of its rows
    first = [f"{place}/data/{f}" for f, _ in M.Place(local(place))._get("batch-0")["files"]]
    ids = {r.id for r in spark.read.parquet(*first).collect()}
    assert seen == (set() if 399 in ids else ids)
    # what the dead task left goes with the next cleaning
    M.Place(local(place)).clean(0.0)
    assert {f.base_name for f in M.Place(local(place))._listed(M.Place(local(place)).data)} == {
        f for f, _ in M.Place(local(place)).live()}


def test_replayed_batch_adds_nothing(tmp_path):
    import pyarrow as pa
    place = M.Place(str(tmp_path))
    place.create()
    writer = M.ManifestWriter(str(tmp_path), 0.0)
    batch = pa.RecordBatch.from_pydict({"a": [1, 2]})
    first, again, dead = (writer.write(iter([batch])) for _ in range(3))
    assert writer.write(iter([])).files == []
    writer.commit([first], 0)
    writer.commit([again, None], 0)
    assert place.live() == [tuple(first.files[0])]
    writer.abort([dead, None], 1)
    names = {f.base_name for f in place._listed(place.data)}
    assert names == {first.files[0][0]} and pq.read_table(f"{place.data}/{first.files[0][0]}").num_rows == 2


def test_folders_stay_bounded(tmp_path):
    import pyarrow as pa
    place, writer = M.Place(str(tmp_path)), M.ManifestWriter(str(tmp_path), 0.0)
    n = 5 * M.MERGE + 3
    for b in range(n):
        writer.write(iter([pa.RecordBatch.from_pydict({"a": [-1]})]))         # an attempt that was lost
        writer.commit([writer.write(iter([pa.RecordBatch.from_pydict({"a": [b]})]))], b)
    single, merged = place.batches()
    assert len(single) <= 2 * M.MERGE and len(merged) <= 2
    assert len(place.live()) == n and len(place._listed(place.data)) <= n + M.MERGE
    rows = [pq.read_table(f"{place.data}/{f}")["a"][0].as_py() for f, _ in place.live()]
    assert sorted(rows) == list(range(n))
    writer.commit([writer.write(iter([pa.RecordBatch.from_pydict({"a": [0]})]))], 3)    # long since merged
    assert len(place.live()) == n


def test_table_without_batches_is_empty(spark, tmp_path):
    assert M.read_manifest_table(spark, str(tmp_path / "none"), spark.range(1).schema).count() == 0

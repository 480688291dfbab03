"""Feedback loops over streams: rows that are not done go round again with the
next micro-batch.

A micro-batch takes its new rows and the rows of the loop buffer one step
further and writes them as one version of a table below ``place``, parted by
whether a row goes round again: that part is the buffer of the next
micro-batch, the other is output.  A replayed micro-batch reads the buffer of
the version before its own and overwrites its own, so no row is lost or output
twice.  Buffers that no replay can need are removed; what stays is the output
and at most ``KEPT`` buffers.

A micro-batch costs one step of the rows that are in the loop.  Between two of
them the buffer waits: on a stream that pauses, ``drain`` finishes it.

Cases: a null condition counts as done; a step keeps the columns, whose types
are cast back; repeated rows are rows of their own; an empty stream gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewater.operators.iterate import iterate_until, taken_step
from tidewater.session import prepare
from tidewater.sinks.versions import KEPT, _files, committed, newest_before, version_path

AGAIN = "__again"


def _part(spark: SparkSession, version: str, again: bool) -> str | None:
    """Folder of one part of a version, if it has such rows."""
    path = f"{version}/{AGAIN}={str(again).lower()}"
    fs, p = _files(spark, path)
    return path if fs.exists(p) else None


def _write(tagged: DataFrame, place: str, version: int) -> None:
    spark = tagged.sparkSession
    tagged.write.mode("overwrite").partitionBy(AGAIN).parquet(version_path(place, version))
    for old in [v for v in committed(spark, place) if v <= version][:-KEPT]:
        if dead := _part(spark, version_path(place, old), True):
            fs, p = _files(spark, dead)
            fs.delete(p, True)


def buffered(spark: SparkSession, place: str, schema: StructType, before: int) -> DataFrame | None:
    """The rows in the loop at the newest version below ``before``."""
    newest = newest_before(spark, place, before)
    path = newest and _part(spark, newest, True)
    return spark.read.schema(schema).parquet(path) if path else None


def start_loop(stream: DataFrame, step: Callable[[DataFrame], DataFrame], again: Column, place: str, checkpoint: str,
               **trigger) -> StreamingQuery:
    """Start the loop; ``trigger`` is that of the query.  Micro-batch n is
    version 2n, the drain after it 2n + 1."""
    spark, schema = prepare(stream.sparkSession), stream.schema

    def turn(batch: DataFrame, batch_id: int) -> None:
        waiting = buffered(spark, place, schema, 2 * batch_id)
        _write(taken_step(batch if waiting is None else batch.unionByName(waiting), step, again, AGAIN), place, 2 * batch_id)

    return (stream.writeStream.foreachBatch(turn).option("checkpointLocation", checkpoint).trigger(**trigger).start())


def drain(spark: SparkSession, place: str, schema: StructType, step: Callable[[DataFrame], DataFrame], again: Column) -> None:
    """Take the rows that are in the loop of a stopped query to their end."""
    done = committed(spark, place)
    if done and done[-1] % 2 == 0 and (waiting := buffered(spark, place, schema, done[-1] + 1)) is not None:
        _write(iterate_until(waiting, step, again).withColumn(AGAIN, F.lit(False)), place, done[-1] + 1)


def finished(spark: SparkSession, place: str, schema: StructType) -> DataFrame:
    """The rows that have left the loop, of whole versions only."""
    paths = [p for v in committed(spark, place) if (p := _part(spark, version_path(place, v), False))]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def iterate_stream(stream: DataFrame, step: Callable[[DataFrame], DataFrame], again: Column, place: str,
                   checkpoint: str) -> DataFrame:
    """Run what the source has now through the loop, to the end of every row;
    run again, it goes on with what came since."""
    q = start_loop(stream, step, again, place, checkpoint, availableNow=True)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    drain(stream.sparkSession, place, stream.schema, step, again)
    return finished(stream.sparkSession, place, stream.schema)

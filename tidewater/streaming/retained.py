"""Reading the state that a stopped query has left in its checkpoint, and
giving it to another query.

``state_variables`` lists what a checkpoint holds, ``read_state`` and
``read_timers`` read one variable or the registered timers as a table -- one
task per partition of the state store, so nothing passes through the driver.
``*_seed`` bring the variables of an operator's keys together, one row per key,
in the shape that the operator's ``seed`` argument takes; a seeded query goes on
as if it had seen the rows of the first one, under a checkpoint, a trigger or a
number of state partitions of its own.

The structs stay whole (``key.id``, ``value.v``), so no names can clash.  A
checkpoint without a committed micro-batch is an error of the reader; a variable
without values, or an operator without timers, gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def state_variables(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator_id, operator, partitions, last_batch, state, kind) of every
    state variable of a checkpoint's user-defined operators."""
    held = F.from_json("operatorProperties",
                       "stateVariables array<struct<stateName string, stateVariableType string>>")["stateVariables"]
    return (spark.read.format("state-metadata").load(checkpoint)
            .select(F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator"),
                    F.col("numPartitions").alias("partitions"), F.col("maxBatchId").alias("last_batch"),
                    F.inline(held).alias("state", "kind")))


def _store(spark: SparkSession, operator: int, batch: int | None):
    r = spark.read.format("statestore").option("operatorId", operator)
    return r if batch is None else r.option("batchId", batch)


def read_state(spark: SparkSession, checkpoint: str, name: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(key, value) of a value state, (key, list_element) of a list state,
    (key, user_map_key, user_map_value) of a map state, after the last
    micro-batch or after ``batch``, as long as that is retained."""
    return _store(spark, operator, batch).option("stateVarName", name).load(checkpoint).drop("partition_id")


def read_timers(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(key, expiration_timestamp_ms) of the timers that have not fired."""
    return _store(spark, operator, batch).option("readRegisteredTimers", "true").load(checkpoint).drop("partition_id")


def jump_alert_seed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, last) of a jump alert's keys."""
    return read_state(spark, checkpoint, "last").select("key.*", F.col("value.v").alias("last"))


def rising_alert_seed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, last, deadline_us) of a rising alert's keys; the deadline of a
    registered timer, else null."""
    return read_state(spark, checkpoint, "st").select("key.*", "value.last", "value.deadline_us")


def state_kinds_seed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, last, list_size, markers, running_max): the four states of each
    key, brought together by one shuffle of their keys."""
    nothing = F.lit(None)
    part = lambda name, last, i, marker, high: read_state(spark, checkpoint, name).select(
        "key", last.cast("double").alias("last"), i.cast("int").alias("i"),
        marker.cast("string").alias("marker"), high.cast("double").alias("high"))
    rows = (part("value", F.col("value.v"), nothing, nothing, nothing)
            .unionByName(part("list", nothing, F.col("list_element.i"), nothing, nothing))
            .unionByName(part("map", nothing, nothing, F.col("user_map_key.k"), nothing))
            .unionByName(part("reduce", nothing, nothing, nothing, F.col("value.v"))))
    return rows.groupBy("key").agg(F.max("last").alias("last"), F.count("i").alias("list_size"),
                                   F.count("marker").alias("markers"), F.max("high").alias("running_max")) \
        .select("key.*", "last", "list_size", "markers", "running_max")

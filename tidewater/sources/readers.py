"""File and message readers, and decoders for string payloads.

All parsing is native (``split``/``from_json``/``from_csv`` + casts), so it
runs inside whole-stage codegen and works the same on a static and a
streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text file(s) as lines in a ``value`` column (file or file-stream)."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.text(path)


def rows(spark: SparkSession, data: list, schema: str | StructType) -> DataFrame:
    """In-memory rows with an explicit schema (typed records, untyped rows,
    NULLs and dates); meant for small literal inputs."""
    return spark.createDataFrame(data, schema)


def same_rows(df: DataFrame, expected: list[tuple] | DataFrame) -> bool:
    """Result set equals ``expected`` as a set.  Both differences are
    computed by Spark (``exceptAll`` of the distinct rows); only two counts
    reach the driver, so the result may be any size."""
    exp = expected if isinstance(expected, DataFrame) else \
        df.sparkSession.createDataFrame(expected, df.schema)
    a, b = df.distinct(), exp.select(*df.columns).distinct()
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def read_delimited(spark: SparkSession, path: str, schema: str | StructType, sep: str = ",",
                   positions: list[int] | None = None, header: bool = False) -> DataFrame:
    """Delimited text mapped onto ``schema``; with ``positions`` only those
    0-based fields are kept, in order, and get the schema's names/types.

    The file is read as all-string columns and only the wanted positions are
    projected and cast; the CSV reader prunes the rest.
    """
    sch = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    raw = spark.read.option("sep", sep).option("header", header).csv(path)
    cols = raw.columns
    pos = positions if positions is not None else list(range(len(sch.fields)))
    return raw.select(*[F.col(cols[p]).cast(f.dataType).alias(f.name) for p, f in zip(pos, sch.fields)])


def register_csv(spark: SparkSession, name: str, path: str, schema: str | StructType,
                 sep: str = ",", header: bool = False) -> DataFrame:
    """CSV table with a declared schema, registered under ``name``."""
    df = spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)
    df.createOrReplaceTempView(name)
    return df


def parse_readings(lines: DataFrame, col: str = "value", mode: str = "fail") -> DataFrame:
    """``"id, epoch_seconds, temperature"`` -> ``(id string, time_stamp long,
    temperature double)``; fields are trimmed.  ``mode='drop'`` removes lines
    that do not parse; ``'fail'`` raises on them (ANSI casts)."""
    parts = F.split(F.col(col), ",")
    id_ = F.trim(parts.getItem(0))
    if mode == "drop":
        ts = F.expr(f"try_cast(trim(split({col}, ',')[1]) AS BIGINT)")
        temp = F.expr(f"try_cast(trim(split({col}, ',')[2]) AS DOUBLE)")
        out = lines.select(id_.alias("id"), ts.alias("time_stamp"), temp.alias("temperature"),
                           F.size(parts).alias("__n"))
        return out.filter((F.col("__n") == 3) & F.col("time_stamp").isNotNull()
                          & F.col("temperature").isNotNull()).drop("__n")
    ts = F.trim(F.element_at(parts, 2)).cast("long")
    temp = F.trim(F.element_at(parts, 3)).cast("double")
    strict_ts = F.when(ts.isNull(), F.raise_error(F.concat(F.lit("bad reading: "), F.col(col)))).otherwise(ts)
    return lines.select(id_.alias("id"), strict_ts.alias("time_stamp"), temp.alias("temperature"))


def parse_tuple(lines: DataFrame, col: str, schema: str | StructType) -> DataFrame:
    """Bracketed tuples ``"(a,b,...)"`` -> typed columns of ``schema``."""
    sch = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    body = F.expr(f"substring({col}, 2, length({col}) - 2)")
    parts = F.split(body, ",")
    return lines.select(*[F.trim(parts.getItem(i)).cast(f.dataType).alias(f.name)
                          for i, f in enumerate(sch.fields)])


def parse_json(df: DataFrame, col: str, schema: str | StructType) -> DataFrame:
    """JSON strings -> struct fields (missing fields are NULL)."""
    return df.select(F.from_json(F.col(col), schema).alias("__j")).select("__j.*")


def decode_csv(df: DataFrame, schema: str, col: str = "value", sep: str = ",") -> DataFrame:
    """Message payloads as CSV records with a declared schema."""
    return df.select(F.from_csv(F.col(col), schema, {"sep": sep}).alias("__r")).select("__r.*")


def decode_json(df: DataFrame, schema: str, col: str = "value") -> DataFrame:
    return parse_json(df, col, schema)


def read_topic_lines(spark: SparkSession, servers: str, topic: str,
                     starting_offsets: str = "latest", fmt: str = "kafka", options: dict | None = None) -> DataFrame:
    """Message topic as a stream of string ``value``s.  The connector jar is
    not bundled here; tests use a file stream with the same ``value``
    column."""
    return (spark.readStream.format(fmt)
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .options(**(options or {}))
            .load()
            .select(F.col("value").cast("string").alias("value")))

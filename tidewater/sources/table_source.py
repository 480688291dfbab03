"""Declared table over a message stream: payload format, schema, computed
columns and an event-time watermark, registered under a name.

This is the Python counterpart of a ``CREATE TABLE ... WITH (connector)``
declaration; it composes DataFrame calls and parses no DDL of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewater.sources.readers import decode_csv, decode_json


def table_source(raw: DataFrame, name: str, schema: str, computed: dict[str, str] | None = None,
                 watermark: tuple[str, str] | None = None, fmt: str = "json",
                 value_col: str = "value") -> DataFrame:
    """``raw`` holds string payloads in ``value_col`` (a topic or file
    stream, or a static DataFrame).  ``computed`` maps new column -> SQL
    expression (``to_timestamp(x)``, ``current_timestamp()`` for a
    processing-time column).  The watermark is only applied to streams."""
    if fmt == "json":
        t = decode_json(raw, schema, value_col)
    elif fmt == "csv":
        t = decode_csv(raw, schema, value_col)
    else:
        raise ValueError(f"unsupported payload format {fmt!r}")
    for col, expr in (computed or {}).items():
        t = t.withColumn(col, F.expr(expr))
    if watermark and t.isStreaming:
        t = t.withWatermark(*watermark)
    t.createOrReplaceTempView(name)
    return t

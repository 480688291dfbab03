"""Size-checked broadcast.

A side is broadcast only when its size is proven to be under a bound, in rows
and in bytes; otherwise the caller's shuffle plan is used.  The check is a
cheap job over an already small, usually aggregated and checkpointed,
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Ceilings for a broadcast side.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 32 << 20


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most so many rows and bytes (of its rows as
    text); at most ``max_rows + 1`` rows are looked at."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes

"""Helpers shared by the operators: Arrow text buffers as numpy arrays,
state that survives from task to task in a Python worker, written
intermediate tables and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewater.session import prepare, scratch_path

# Bytes of text that one round of numpy work handles; a longer single text is
# a round of its own.
SLICE_BYTES = 2 << 20

# Rows of (id, small values) that may be broadcast: about 100 MB when hashed.
MAX_BROADCAST_ROWS = 1_000_000

# The characters [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first_row, end_row, utf8_bytes, offsets)`` for consecutive rows of a
    string array, nulls as empty; offsets start at 0 in each slice."""
    col = pc.fill_null(col, "")
    n = len(col)
    if n == 0:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, obuf, dbuf = col.buffers()
    off = np.frombuffer(obuf, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(dbuf, np.uint8) if dbuf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mask of the bytes that begin a word ``[^\\x20\\x09-\\x0D]+`` (no word
    crosses from one text into the next)."""
    space = IS_SPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    start[first] = ~space[first]
    return start


def word_ends(data: np.ndarray, off: np.ndarray, start: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where the words that begin at ``start``, of texts ``doc``, end: at the
    next space or at the end of the text."""
    stop = np.flatnonzero(np.append(IS_SPACE[data], True))
    return np.minimum(stop[np.searchsorted(stop, start)], off[doc + 1]) if len(start) else start


# Random 64-bit values of the bytes in hashes.
_CODE = np.random.default_rng(1).integers(1, 2 ** 63, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run starts[i]:ends[i] (ascending, disjoint)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    power = np.cumprod(np.full(int(length.max()), 0x5851F42D4C957F2D, np.uint64))
    gap = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, gap)
    inside = place < np.repeat(length, gap)
    run = np.zeros(len(data) + 1, np.uint64)
    term = np.where(inside, _CODE[data[starts[0]:]] * power[np.minimum(place, len(power) - 1)], np.uint64(0))
    np.cumsum(term, out=run[starts[0] + 1:])
    return mixed(run[ends] - run[starts] + length.astype(np.uint64))


def per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set bytes in each text."""
    run = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=run[1:])
    return run[off[1:]] - run[off[:-1]]


def word_counts(col: pa.Array) -> np.ndarray:
    """Words of each text of a string array."""
    out = np.zeros(len(col), np.int64)
    for a, b, data, off in text_slices(col):
        out[a:b] = per_row(word_starts(data, off), off)
    return out


def worker_state(name: str, make):
    """An object kept by the Python worker from task to task (code is shipped
    by value, so module globals are not)."""
    import sys
    import types
    home = sys.modules.setdefault("_tidewater_worker", types.ModuleType("_tidewater_worker"))
    store = home.__dict__.setdefault("store", {})
    if name not in store:
        store[name] = make()
    return store[name]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and later jobs read only the
    columns they need.  It is deleted when the application ends."""
    spark = prepare(df.sparkSession)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow written table for broadcast only if it has at most
    ``rows`` rows; a larger one is left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents_of(docs: DataFrame, *cols: str) -> DataFrame:
    """The named columns, ``doc_id`` as long and the others as string."""
    return docs.select(*[F.col(c).cast("long" if c == "doc_id" else "string").alias(c) for c in cols])


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's digits is divisible by 5 (a null id counts as the
    empty text, whose crc32 is 0)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def id_order(doc_id: str = "doc_id"):
    """Sort key for ids: ascending, null last."""
    return F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("d"))

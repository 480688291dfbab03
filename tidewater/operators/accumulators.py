"""User-given accumulators and reductions on any size of group.

An :class:`Accumulator` is a state with ``zero``, ``add`` (rows of one key in
one Arrow batch), ``merge`` and ``finish``, which returns the result rows: one
for an aggregate function, any number for a table aggregate.

``accumulate`` runs it with partial merging: every task keeps one state per
key it meets (no row is shuffled), the pickled states are merged by key and
salt, then by key.  A key with a third of all rows is as many states as there
are tasks, merged by ``fan`` tasks and then by one; no task ever sees the rows
of a group.  On a stream the state of a key lives in the state store with the
rows shown last, and each batch emits the difference as retractions and
additions.

``running_reduce`` is the running form for an associative function: a prefix
scan over balanced ranges of (keys, order).  One pass scans each range, the
totals at the ranges' ends (two small rows each) are folded, and the second
pass applies the carried value to the rows of a range's first key.  The
function works on numpy arrays, so a batch of n rows takes log2(n) calls.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewater.plans import sequence as S

HELD_KEYS = 10_000                # states a task keeps before it hands them on
FAN = 16                          # tasks that merge the states of one key first


class Accumulator:
    """A user's aggregate.  ``add`` and ``merge`` must give the same state
    whatever the order and the cut of the rows; states are pickled."""

    def zero(self):
        raise NotImplementedError

    def add(self, state, rows: pa.RecordBatch):
        raise NotImplementedError

    def merge(self, state, other):
        raise NotImplementedError

    def finish(self, state) -> list[tuple]:
        raise NotImplementedError


def _codes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """A number for each row: rows with equal keys (null equals null) have
    the same."""
    code = np.zeros(batch.num_rows, np.int64)
    for k in keys:
        enc = batch.column(k).dictionary_encode(null_encoding="encode")
        code = code * (len(enc.dictionary) + 1) + enc.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    return code


def _by_key(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    code = _codes(batch, keys)
    order = np.argsort(code, kind="stable")
    cut = np.flatnonzero(np.diff(code[order])) + 1
    sorted_rows = batch.take(pa.array(order))
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
        if a < b:
            part = sorted_rows.slice(a, b - a)
            yield tuple(part.column(k)[0].as_py() for k in keys), part


def _same(a: tuple | None, b: tuple) -> bool:
    return a is not None and all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _state_schema(df: DataFrame, keys: list[str]) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + [T.StructField("__state", T.BinaryType())])


def partial_states(df: DataFrame, keys: list[str], acc: Accumulator, held: int = HELD_KEYS) -> DataFrame:
    """(keys, __state): the state of each key in each task."""
    schema = _state_schema(df, keys)

    def out(states):
        cols = [[k[i] for k in states] for i in range(len(keys))] + [[pickle.dumps(s) for s in states.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[*keys, "__state"])

    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def add(batches):
        states: dict[tuple, object] = {}
        for b in batches:
            for key, rows in _by_key(b, keys):
                states[key] = acc.add(states[key] if key in states else acc.zero(), rows)
            if len(states) > held:
                yield out(states)
                states = {}
        if states:
            yield out(states)

    return df.mapInArrow(add, schema)


def _merged(batches, keys: list[str], acc: Accumulator) -> Iterator[tuple[tuple, object]]:
    """(key, state) of rows that are sorted by key, one key at a time."""
    key, state = None, None
    for b in batches:
        cols = [b.column(k).to_pylist() for k in keys]
        for *k, raw in zip(*cols, b.column("__state").to_pylist()):
            if _same(key, tuple(k)):
                state = acc.merge(state, pickle.loads(raw))
            else:
                if key is not None:
                    yield key, state
                key, state = tuple(k), pickle.loads(raw)
    if key is not None:
        yield key, state


def accumulate(df: DataFrame, keys: list[str], acc: Accumulator, result: str, fan: int = FAN,
               held: int = HELD_KEYS) -> DataFrame:
    """(keys, result columns): the rows of ``acc.finish`` per key.  ``result``
    is a schema string.  ``fan`` 0 leaves the salted merge out, for inputs
    whose keys are many and small.

    A stream (one key column) gives a changelog: the same columns with
    ``is_add``; the rows shown before that no longer hold are retracted.

    Cases: a null key is a key; nulls in other columns reach ``add``; an empty
    table gives no rows."""
    if df.isStreaming:
        (key,) = keys
        return _accumulate_stream(df, key, acc, result)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = _state_schema(df, keys)
    states = partial_states(df, keys, acc, held)
    if fan:
        salted = states.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(fan)))

        def merge(batches):
            for key, state in _merged((b.drop_columns(["__salt"]) for b in batches), keys, acc):
                yield pa.RecordBatch.from_pylist([dict(zip(keys, key), __state=pickle.dumps(state))], arrow_schema)

        from pyspark.sql.pandas.types import to_arrow_schema
        arrow_schema = to_arrow_schema(schema)
        states = salted.repartition(n, *keys, "__salt").sortWithinPartitions(*keys).mapInArrow(merge, schema)

    fields = T._parse_datatype_string(result).fields
    final = T.StructType([df.schema[k] for k in keys] + fields)
    from pyspark.sql.pandas.types import to_arrow_schema as arrow_of
    final_arrow = arrow_of(final)

    def finish(batches):
        rows: list[tuple] = []
        for key, state in _merged(batches, keys, acc):
            rows += [(*key, *r) for r in acc.finish(state)]
            if len(rows) > 1000:
                yield _rows(rows, final_arrow)
                rows = []
        if rows:
            yield _rows(rows, final_arrow)

    return states.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(finish, final)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# ------------------------------------------------------------ on streams
def _accumulate_stream(df: DataFrame, key: str, acc: Accumulator, result: str) -> DataFrame:
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor
    names = [f.name for f in T._parse_datatype_string(result).fields]

    class Accumulate(StatefulProcessor):
        """State: the accumulator's, and the rows shown last."""

        def init(self, handle):
            self.state = handle.getValueState("state", "s binary, shown binary")

        def handleInputRows(self, k, rows, timerValues):
            if self.state.exists():
                state, shown = (pickle.loads(bytes(x)) for x in self.state.get())
            else:
                state, shown = acc.zero(), []
            for pdf in rows:
                state = acc.add(state, pa.RecordBatch.from_pandas(pdf, preserve_index=False))
            now = [tuple(r) for r in acc.finish(state)]
            self.state.update((pickle.dumps(state), pickle.dumps(now)))
            gone, new = Counter(shown), Counter(now)
            out = [(k[0], *r, False) for r in (gone - new).elements()] + [(k[0], *r, True) for r in (new - gone).elements()]
            if out:
                yield pd.DataFrame(out, columns=[key, *names, "is_add"])

        def close(self):
            pass

    kind = dict(df.dtypes)[key]
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=Accumulate(), outputStructType=f"`{key}` {kind}, {result}, is_add boolean",
        outputMode="Append", timeMode="None")


# ------------------------------------------------------------ from SQL text
def register_accumulator(spark: SparkSession, name: str, acc: Accumulator, key: str, key_type: str, result: str) -> None:
    """The accumulator for SQL text, with partial merging, as two table
    functions::

        SELECT * FROM <name>_merge(TABLE(SELECT * FROM <name>_partial(TABLE(input))) PARTITION BY <key>)

    ``<name>_partial`` gives a state per key and task, ``<name>_merge`` sees
    only states."""
    from pyspark.sql.functions import udtf
    rows_at_once = 4096

    class Partial:
        def __init__(self):
            self.states, self.rows = {}, []

        def eval(self, row):
            self.rows.append(row.asDict())
            if len(self.rows) >= rows_at_once:
                self.flush()

        def flush(self):
            if self.rows:
                for k, part in _by_key(pa.RecordBatch.from_pylist(self.rows), [key]):
                    self.states[k] = acc.add(self.states[k] if k in self.states else acc.zero(), part)
            self.rows = []

        def terminate(self):
            self.flush()
            for (k,), s in self.states.items():
                yield k, pickle.dumps(s)

    class Merge:
        def __init__(self):
            self.key, self.state = None, None

        def eval(self, row):
            other = pickle.loads(bytes(row["__state"]))
            self.key = row[key]
            self.state = (other,) if self.state is None else (acc.merge(self.state[0], other),)

        def terminate(self):
            if self.state is not None:
                for r in acc.finish(self.state[0]):
                    yield (self.key, *r)

    spark.udtf.register(f"{name}_partial", udtf(Partial, returnType=f"`{key}` {key_type}, __state binary"))
    spark.udtf.register(f"{name}_merge", udtf(Merge, returnType=f"`{key}` {key_type}, {result}"))


# ------------------------------------------------------------ running reduce
Columns = dict[str, np.ndarray]


def _values(col: pa.Array) -> np.ndarray:
    """A column as numpy values; one with nulls as objects, None for null."""
    if col.null_count:
        out = np.empty(len(col), object)
        out[:] = col.to_pylist()
        return out
    return col.to_numpy(zero_copy_only=False)


def scan(cols: Columns, place: np.ndarray, fn: Callable[[Columns, Columns], Columns]) -> Columns:
    """Inclusive prefix scan by doubling: ``place`` is each row's position in
    its run; runs are independent."""
    cols, d = {c: x.copy() for c, x in cols.items()}, 1
    while (at := np.flatnonzero(place >= d)).size:
        got = fn({c: x[at - d] for c, x in cols.items()}, {c: x[at] for c, x in cols.items()})
        for c, x in cols.items():
            x[at] = got[c]
        d *= 2
    return cols


def _applied(carry: dict, cols: Columns, at: np.ndarray, fn) -> None:
    """Put a carried value before the rows ``at``."""
    if len(at):
        left = {}
        for c, x in cols.items():
            left[c] = np.empty(len(at), x.dtype if carry[c] is not None else object)
            left[c][:] = carry[c]
        got = fn(left, {c: x[at] for c, x in cols.items()})
        for c in cols:
            if got[c].dtype == object and cols[c].dtype != object:
                cols[c] = cols[c].astype(object)
            cols[c][at] = got[c]


def running_reduce(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[Columns, Columns], Columns],
                   columns: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``columns`` replaced by the running reduction per key in
    the given order: the first row of a key keeps its values, a later one has
    ``fn(result of the row before, own values)``.

    ``fn`` takes and returns dicts of numpy arrays (one element a row) and
    must be associative; it need not be commutative.  Columns that hold nulls
    reach it as object arrays.  A function that is not associative can be
    brought into this form by columns that describe a row's effect (for
    ``y = a * y + b`` the pair a, b).

    Cases: a null key is a key; rows that are equal in the order are taken in
    any order; an empty table gives no rows.  A stream keeps the last result
    of each key (one key column) and sorts the rows of a micro-batch."""
    if df.isStreaming:
        (key,) = keys
        return _running_reduce_stream(df, key, order, fn, columns)
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = T.StructType([T.StructField("__head", T.BooleanType()), T.StructField("__first", T.BooleanType()),
                          T.StructField("__last", T.BooleanType())])
    arrow = to_arrow_schema(T.StructType(df.schema.fields + marks.fields))
    value = {c: arrow.field(c).type for c in columns}

    def local(batches):
        key, carry, head, first, held = None, None, True, True, None
        for b in batches:
            if b.num_rows == 0:
                continue
            code = _codes(b, keys)
            new = np.append(True, np.diff(code) != 0)
            place = np.arange(len(code)) - np.maximum.accumulate(np.where(new, np.arange(len(code)), 0))
            cols = scan({c: _values(b.column(c)) for c in columns}, place, fn)
            run_key = tuple(b.column(k)[0].as_py() for k in keys)
            one = int(np.flatnonzero(new)[1]) if new.sum() > 1 else len(code)
            if _same(key, run_key):
                _applied(carry, cols, np.arange(one), fn)
            elif key is not None:
                head = False
            heads = np.zeros(len(code), bool)
            heads[:one] = head
            if one < len(code):
                head = False
            key = tuple(b.column(k)[-1].as_py() for k in keys)
            carry = {c: x[-1] for c, x in cols.items()}
            firsts = np.zeros(len(code), bool)
            firsts[0], first = first, False
            out = {c: b.column(c) if c not in value else pa.array(cols[c], value[c], from_pandas=False) for c in df_columns}
            batch = [*out.values(), pa.array(heads), pa.array(firsts)]
            if held is not None:
                yield pa.RecordBatch.from_arrays([*held, pa.array(np.zeros(len(held[0]), bool))], schema=arrow)
            held = batch
        if held is not None:
            last = np.zeros(len(held[0]), bool)
            last[-1] = True
            yield pa.RecordBatch.from_arrays([*held, pa.array(last)], schema=arrow)

    df_columns = df.columns
    ranged = (df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
              .mapInArrow(local, T.StructType(df.schema.fields + marks.fields))
              .withColumn("__range", F.spark_partition_id()))
    ranged = S.written(ranged, "running-reduce")
    # the first and the last row of each range
    ends = ranged.filter("__first or __last").select("__range", *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                                                     *[F.col(c).alias(f"__v{i}") for i, c in enumerate(columns)],
                                                     "__head", "__first", "__last").orderBy("__range", F.desc("__first")).collect()
    carries: dict[int, dict] = {}
    key, total = None, None
    for r in ends:
        k = tuple(r[f"__k{i}"] for i in range(len(keys)))
        if r["__first"] and _same(key, k):
            carries[r["__range"]] = total
        if r["__last"]:
            own = {c: r[f"__v{i}"] for i, c in enumerate(columns)}
            if r["__head"] and r["__range"] in carries:       # the whole range is one key that goes on
                one = {c: np.array([x], object if x is None else None) for c, x in own.items()}
                _applied(carries[r["__range"]], one, np.arange(1), fn)
                own = {c: x[0] for c, x in one.items()}
            key, total = k, own
    known = spark.sparkContext.broadcast(carries)

    def carried(batches):
        for b in batches:
            at_range = b.column("__range").to_numpy(zero_copy_only=False)
            head = b.column("__head").to_numpy(zero_copy_only=False)
            cols = {c: _values(b.column(c)).copy() for c in columns}
            for r in np.unique(at_range[head]).tolist():
                if r in known.value:
                    _applied(known.value[r], cols, np.flatnonzero(head & (at_range == r)), fn)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[c], value[c], from_pandas=False) if c in value else b.column(c) for c in df_columns],
                names=df_columns)

    return ranged.mapInArrow(carried, df.schema)


def _running_reduce_stream(df: DataFrame, key: str, order: list[str], fn, columns: list[str]) -> DataFrame:
    from pyspark.sql.streaming import StatefulProcessor
    types = dict(df.dtypes)
    state = ", ".join(f"`{c}` {types[c]}" for c in columns)

    class RunningReduce(StatefulProcessor):
        def init(self, handle):
            self.last = handle.getValueState("last", state)

        def handleInputRows(self, k, rows, timerValues):
            from tidewater.streaming.stateful import _sorted_rows
            pdf = _sorted_rows(rows, order).reset_index(drop=True)
            if len(pdf) == 0:
                return
            cols = {c: pdf[c].to_numpy().copy() for c in columns}
            cols = scan(cols, np.arange(len(pdf)), fn)
            if self.last.exists():
                _applied(dict(zip(columns, self.last.get())), cols, np.arange(len(pdf)), fn)
            self.last.update(tuple(x[-1].item() if isinstance(x[-1], np.generic) else x[-1] for x in cols.values()))
            yield pdf.assign(**cols)

        def close(self):
            pass

    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RunningReduce(), outputStructType=", ".join(f"`{c}` {t}" for c, t in df.dtypes),
        outputMode="Append", timeMode="None")

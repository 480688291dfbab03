"""Two-level keyed scans: running aggregates and "previous rows" context.

Window functions partitioned by a key put every row of that key into one
task.  When one key holds a third of the data that task is the whole job.
The helpers here split each key's sequence into buckets that are monotone in
the order (an id range or a time range) and work in two levels:

* inside ``(key, bucket)``: an ordinary window, run in parallel;
* across buckets: a tiny table with one row per ``(key, bucket)`` (or ``k``
  rows per bucket for row context) carries what earlier buckets contribute.

Both results are exact; nothing depends on how rows land in partitions.

By default the buckets are balanced (:func:`balanced_bucket`): row ranges of
(key, order) of about equal size, so neither a hot key nor a burst in time
makes a large bucket, and the bucket table has about one row per key plus one
per range.  A caller may pass its own ``bucket`` column, which must be
non-decreasing along ``order`` within a key (:func:`seq_bucket`,
:func:`time_bucket`), for instance one balanced bucketing shared by several
steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

BKT = "_bkt"
RANGE = "_range"
GHOST = "_ghost"


def seq_bucket(col: str | Column, width: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c / F.lit(width)).cast("long")


def time_bucket(col: str | Column, seconds: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the columns as Parquet below the shared
    checkpoint folder and read them back, so that later steps read only what
    they need and a lost executor costs one step.  Columns that cannot be null
    stay so.  The folder is deleted when the application ends."""
    from tidewater.session import prepare, scratch_path
    spark = prepare(df.sparkSession)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    cols = []
    for f in df.schema.fields:
        zero = None if f.nullable else _zero(f.dataType)
        cols.append(F.col(f"`{f.name}`") if zero is None else F.coalesce(F.col(f"`{f.name}`"), zero).alias(f.name))
    return spark.read.schema(df.schema).parquet(path).select(*cols)


def balanced_bucket(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None,
                    name: str = "_rbkt") -> tuple[DataFrame, Column]:
    """Buckets that are balanced whatever the key or time distribution:
    range-partition on ``keys + order`` (Spark samples the boundaries) and
    use the partition index, which is non-decreasing along the order within
    every key.  The result is written below the shared checkpoint folder, so
    every later branch of the plan sees the same buckets.
    Returns ``(df_with_bucket, bucket_column)``."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = (df.repartitionByRange(n, *keys, *order)
           .withColumn(name, F.spark_partition_id().cast("long")))
    return written(out, "buckets"), F.col(name)


def _null_safe_join(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"__r_{c}"]) for c in cols])
    return left.join(r, cond, "inner").drop(*[f"__r_{c}" for c in cols])


def _zero(dt):
    if isinstance(dt, (T.NumericType, T.BooleanType, T.StringType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dt)
    return None


def null_free_keys(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]] | None:
    """Columns that identify ``cols`` null-safely and hold no NULL: a
    non-nullable column stands for itself, a nullable one becomes the pair
    ``(coalesce(c, zero), isnull(c))``.  Partitioning a window and joining on
    these plain columns lets the sort-merge join reuse the window's hash
    partitioning (an ``eqNullSafe`` join hashes rewritten expressions and
    shuffles the big side again).  ``None`` if a type has no zero value."""
    fields = {f.name: f for f in df.schema.fields}
    out, names = df, []
    for i, c in enumerate(cols):
        f = fields[c]
        if not f.nullable:
            names.append(c)
            continue
        z = _zero(f.dataType)
        if z is None:
            return None
        out = (out.withColumn(f"__nv{i}", F.coalesce(F.col(c), z))
               .withColumn(f"__nn{i}", F.col(c).isNull()))
        names += [f"__nv{i}", f"__nn{i}"]
    return out, names


def bucketed(df: DataFrame, keys: list[str], order: list[str],
             bucket: Column | None) -> tuple[DataFrame, Column]:
    """``df`` and its buckets: the caller's, else balanced ones."""
    return (df, bucket) if bucket is not None else balanced_bucket(df, keys, order, name=RANGE)


def running_agg(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None,
                specs: list[tuple[str, str | Column, str]], inclusive: bool = True, write_carry: bool = False) -> DataFrame:
    """Add running aggregates per ``keys`` along ``order``.  With
    ``write_carry`` what buckets carry over (one row per key and bucket) is
    written first, so its size decides how it is joined.

    ``specs`` = ``[(out_name, column, kind)]`` with kind in ``sum``, ``count``,
    ``max``, ``min`` (over rows up to and including the current one, or
    strictly before it when ``inclusive`` is False) and ``first`` (value of
    the first row of the key).
    """
    df, bucket = bucketed(df, keys, order, bucket)
    # a NULL bucket (NULL order value) becomes the smallest long: it still
    # sorts first, and the bucket column needs no null-safe encoding
    d = df.withColumn(BKT, F.coalesce(bucket, F.lit(-(2 ** 63)).cast("long")))
    enc = null_free_keys(d, keys + [BKT])
    if enc is None:
        part, kpart, join = keys + [BKT], keys, None
    else:
        d, part = enc
        kpart, join = part[:-1] if part[-1] == BKT else part[:-2], part
    ordc = [F.col(o) for o in order]
    lo = 0 if inclusive else -1
    w_local = Window.partitionBy(*part).orderBy(*ordc).rowsBetween(Window.unboundedPreceding, lo)
    w_first = Window.partitionBy(*part).orderBy(*ordc)

    bucket_aggs, local_cols, finals = [], [], []
    for name, c, kind in specs:
        col = F.col(c) if isinstance(c, str) else c
        if kind in ("sum", "count"):
            v = F.lit(1).cast("long") if kind == "count" else col
            local_cols.append(F.sum(v).over(w_local).alias(f"{name}__loc"))
            bucket_aggs.append(F.sum(v).alias(f"{name}__bkt"))
        elif kind in ("max", "min"):
            fn = F.max if kind == "max" else F.min
            local_cols.append(fn(col).over(w_local).alias(f"{name}__loc"))
            bucket_aggs.append(fn(col).alias(f"{name}__bkt"))
        elif kind == "first":
            local_cols.append(F.first(col).over(w_first.rowsBetween(Window.unboundedPreceding, 0))
                              .alias(f"{name}__loc"))
            bucket_aggs.append(F.min_by(col, F.struct(*ordc)).alias(f"{name}__bkt"))
        else:
            raise ValueError(f"unknown running aggregate kind {kind!r}")
        finals.append((name, kind))

    local = d.select("*", *local_cols)
    # Bucket totals: Catalyst prunes the window from this branch and plans a
    # partial aggregate before the shuffle, so only one row per map task and
    # (key, bucket) moves.
    carry_bkt = [] if BKT in part else [F.first(BKT).alias(BKT)]
    per_bucket = local.groupBy(*part).agg(*carry_bkt, *bucket_aggs)
    w_prev = Window.partitionBy(*kpart).orderBy(BKT).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*kpart).orderBy(BKT).rowsBetween(Window.unboundedPreceding, 0)
    offs = [F.col(c) for c in dict.fromkeys(part + [BKT])]
    for name, kind in finals:
        b = F.col(f"{name}__bkt")
        if kind in ("sum", "count"):
            offs.append(F.sum(b).over(w_prev).alias(f"{name}__off"))
        elif kind == "max":
            offs.append(F.max(b).over(w_prev).alias(f"{name}__off"))
        elif kind == "min":
            offs.append(F.min(b).over(w_prev).alias(f"{name}__off"))
        else:  # first
            offs.append(F.first(b).over(w_all).alias(f"{name}__off"))
    offsets = per_bucket.select(*offs)

    if join is None:
        out = _null_safe_join(local, offsets, keys + [BKT])
    else:
        offsets = offsets.drop(*[c for c in offsets.columns if c not in join and not c.endswith("__off")])
        out = local.join(written(offsets, "carry") if write_carry else offsets, join, "inner")
    for name, kind in finals:
        loc, off = F.col(f"{name}__loc"), F.col(f"{name}__off")
        if kind in ("sum", "count"):
            val = F.coalesce(off, F.lit(0)) + F.coalesce(loc, F.lit(0))
        elif kind == "max":
            val = F.greatest(off, loc)
        elif kind == "min":
            val = F.least(off, loc)
        else:
            val = off
        out = out.withColumn(name, val)
    drop = [c for c in out.columns if c.endswith("__loc") or c.endswith("__off")
            or c.startswith("__nv") or c.startswith("__nn")]
    return out.drop(*drop, BKT, RANGE)


def with_preceding(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None,
                   k: int) -> DataFrame:
    """Return ``df`` plus, for every ``(key, bucket)``, up to ``k`` "ghost"
    copies of the rows that precede the bucket in key order.  Ghost rows
    carry ``_ghost = true``; all rows carry ``_bkt``.

    A window ``partitionBy(keys + ['_bkt']).orderBy(order)`` over the result
    then sees up to ``k`` earlier rows of the key even at bucket edges
    (``lag``, ``rowsBetween(-k, 0)``); filter ghosts out afterwards.
    """
    df, bucket = bucketed(df, keys, order, bucket)
    d = df.withColumn(BKT, bucket)
    cols = d.columns
    ordc = [F.col(o) for o in order]
    w_desc = Window.partitionBy(*keys, BKT).orderBy(*[c.desc() for c in ordc])
    # Last k rows of every bucket; Spark plans this as a partial group limit
    # before the shuffle, so only k rows per bucket and map task move.
    tails = d.withColumn("__r", F.row_number().over(w_desc)).filter(F.col("__r") <= k).drop("__r")
    w_t = Window.partitionBy(*keys).orderBy(F.col(BKT), *ordc)
    w_in = Window.partitionBy(*keys, BKT).orderBy(*ordc)
    rec = F.struct(*[F.col(c) for c in cols])
    ctx = (tails
           .withColumn("__prev", F.collect_list(rec).over(w_t.rowsBetween(-k, -1)))
           .withColumn("__first", F.row_number().over(w_in) == 1)
           .filter(F.col("__first") & (F.size("__prev") > 0))
           .select(F.col(BKT).alias("__target"), F.explode("__prev").alias("__g"))
           .select("__g.*", "__target")
           .withColumn(BKT, F.col("__target")).drop("__target")
           .withColumn(GHOST, F.lit(True)))
    return d.withColumn(GHOST, F.lit(False)).unionByName(ctx.select(*cols, GHOST))


def drop_ghosts(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(GHOST)).drop(GHOST, BKT, RANGE)


def first_at_or_after(points: DataFrame, queries: DataFrame, keys: list[str], t: str, n: str, x: str,
                      out: str = "first_n", carry: list[str] = (), partitions: int | None = None) -> DataFrame:
    """For every query row, the smallest ``n`` among ``points`` of the same
    key with ``t >= x`` (NULL if none) and that point's ``carry`` columns;
    ``n`` must increase with ``t``.

    Points and queries are merged into one sequence in *descending* time
    (a point at the query's own time comes first), cut into balanced
    range-partition buckets, and scanned with a running minimum."""
    pts = points.select(*keys, (-F.col(t)).alias("__nt"), F.lit(0).alias("__k"), F.col(n).cast("long").alias("__o"),
                        F.struct(F.col(n).cast("long").alias(out), *carry).alias("__pt"))
    qcols = [c for c in queries.columns if c not in keys]
    qs = queries.select(*keys, (-F.col(x)).alias("__nt"), F.lit(1).alias("__k"),
                        F.monotonically_increasing_id().alias("__o"), *qcols)
    merged = pts.unionByName(qs, allowMissingColumns=True)
    merged, bkt = balanced_bucket(merged, keys, ["__nt", "__k", "__o"], partitions)
    scanned = running_agg(merged, keys, ["__nt", "__k", "__o"], bkt, [("__found", "__pt", "min")])
    return scanned.filter(F.col("__k") == 1).select(*keys, *qcols, *[F.col(f"__found.{c}").alias(c) for c in (out, *carry)])


def _links(run, x, width):
    """Per node (sorted by run, then x): the next node, the first of its run
    with x at least ``width`` above (-1 if none), and the last node of its
    chain."""
    import numpy as np
    n = len(x)
    # nodes and what they look for in one order; a node comes after those that look for its x
    order = np.lexsort((np.repeat([1, 0], n), np.concatenate((x, x + width)), np.concatenate((run, run))))
    before = np.cumsum(order < n)
    nxt = np.empty(n, np.int64)
    asks = order >= n
    nxt[order[asks] - n] = before[asks]
    here = (nxt < n) & (run[np.minimum(nxt, n - 1)] == run)
    nxt = np.where(here, nxt, -1)
    last = np.where(here, nxt, np.arange(n))
    while (last[last] != last).any():
        last = last[last]
    return nxt, last


def chain_reached(nodes: DataFrame, keys: list[str], x: str, n: str, width: int, partitions: int | None = None,
                  carry: list[str] = ()) -> DataFrame:
    """The chain of each key: its first node, then always the first node whose
    ``x`` is at least ``width`` > 0 higher.  ``x`` (long) must not fall with
    ``n``.  Returns (keys, x, n) and the ``carry`` columns of the nodes on the
    chains.

    Nodes are cut into balanced ranges of (keys, x, n).  Inside a range a
    node's chain is followed to its end with numpy.  A range's first key may
    go on from the range before; only nodes up to ``width`` above its first
    one, and the next, can be where a chain enters.  These entries alone, with
    the ends of their chains in the range, are brought together by key and
    streamed through in order, from one range's exit to the next one's entry:
    a few rows a range (all of a range's nodes only where ``width`` exceeds
    what it spans).  At most one entry of a range is on the chain; with these,
    one number a range, a second pass marks the nodes."""
    from itertools import chain

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    spark = nodes.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shape = T.StructType([nodes.schema[k] for k in keys] + [T.StructField(c, T.LongType()) for c in ("__x", "__n")]
                         + [nodes.schema[c] for c in carry])
    out_shape = T.StructType(shape.fields + [T.StructField("__exit", T.LongType()), T.StructField("__kind", T.IntegerType())])

    def runs_of_batches(batches):
        """The rows of each run of equal keys in each batch."""
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                code = b.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            cut = [0, *np.flatnonzero(new).tolist(), b.num_rows]
            for a, z in zip(cut, cut[1:]):
                yield pa.Table.from_batches([b.slice(a, z - a)])

    def whole(batches, run_keys):
        """The nodes of a task (narrow, one balanced range) and the number of
        the run of equal keys that each is in."""
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        run = np.zeros(t.num_rows, bool)
        for k in run_keys:
            code = pc.dictionary_encode(t.column(k).combine_chunks(), null_encoding="encode").indices.to_numpy()
            run[1:] |= code[1:] != code[:-1]
        return t, np.cumsum(run), t.column("__x").to_numpy()

    def follow(batches):
        first = next(batches, None)
        if first is None:
            return
        t, run, v = whole(chain([first], batches), keys)
        _, end = _links(run, v, width)
        # 1: where a chain may enter the range; 2: head of the last run, which may go on; 0: neither
        kind = np.zeros(len(v), np.int32)
        size = int(np.searchsorted(run, 0, side="right"))
        kind[:min(size, int(np.searchsorted(v[:size], v[0] + width, side="right")) + 1)] = 1
        head = int(np.searchsorted(run, run[-1]))
        kind[head] = kind[head] or 2
        yield from t.append_column("__exit", pa.array(v[end])).append_column("__kind", pa.array(kind)).to_batches()

    d = nodes.select(*keys, F.col(x).cast("long").alias("__x"), F.col(n).cast("long").alias("__n"), *carry)
    ranged = (d.repartitionByRange(count, *keys, "__x", "__n").sortWithinPartitions(*keys, "__x", "__n")
              .mapInArrow(follow, out_shape).withColumn("__range", F.spark_partition_id()))
    ranged = written(ranged, "chain-ranges")

    def enter(batches):
        """Where the chains enter ranges: the entries in order, followed from
        exit to the next entry."""
        key, target = None, None
        for run in runs_of_batches(batches):
            v, exits = run.column("__x").to_numpy(), run.column("__exit").to_numpy()
            own = tuple(run.column(k)[0].as_py() for k in keys)
            if own != key:
                key, target = own, v[0]
            at, hit = 0, []
            while (at := at + int(np.searchsorted(v[at:], target))) < len(v):
                hit.append(at)
                target = exits[at] + width
            if hit:
                yield from run.take(pa.array(hit)).filter(pc.field("__kind") == 1).select(["__range", "__n"]).to_batches()

    entries = ranged.filter("__kind > 0").drop(*carry).repartition(count, *keys).sortWithinPartitions(*keys, "__x", "__n")
    entry = entries.mapInArrow(enter, "__range int, __n long").collect()       # at most one of each range
    starts = spark.sparkContext.broadcast({r["__range"]: r["__n"] for r in entry})

    def mark(batches):
        first = next(batches, None)
        if first is None:
            return
        t, run, v = whole(chain([first], batches), ["__range", *keys])
        nxt, _ = _links(run, v, width)
        nxt = nxt.tolist()
        at_range, number = t.column("__range").to_numpy(), t.column("__n").to_numpy()
        heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        on_chain = []
        for h, z in zip(heads.tolist(), [*heads[1:].tolist(), len(v)]):
            if h == 0 or at_range[h] != at_range[h - 1]:
                # the first run of a range starts where the chain enters it, if it does
                begin = starts.value.get(int(at_range[h]))
                h = -1 if begin is None else h + int(np.searchsorted(number[h:z], begin))
            while h >= 0:
                on_chain.append(h)
                h = nxt[h]
        yield from t.take(pa.array(on_chain, pa.int64())).select(shape.names).to_batches()

    # one task has whole ranges; runs are of (range, key)
    spread = ranged.select("__range", *shape.names).repartition(count, "__range") \
        .sortWithinPartitions("__range", *keys, "__x", "__n")
    return spread.mapInArrow(mark, shape).withColumnsRenamed({"__x": x, "__n": n})

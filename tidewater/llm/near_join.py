"""Exact n-gram Jaccard join by universe partitioning and pigeonhole.

A document's set holds its distinct ``WORDS``-word shingles (64-bit hashes; a
shorter text is one shingle).  Two sets of sizes s <= t link when their
Jaccard similarity is at least 0.8, so they differ in at most (s + t) / 9
shingles, at most ``h(s) = s // 4``.

*Size bands.*  Bands grow by a half; the pairs of a band are those whose
smaller set lies in it.  A set belongs to its own band and, if it is no more
than 1.25 times the largest size of the band below, to that one too.

*Segments.*  In a band shingles are hashed into m segments, and a set is
indexed by the part of it that falls into each segment.  The band's scheme is
the one that costs less, by the rows it writes and the share of segments too
small to tell sets apart:

* plain: ``h + 1 + slack`` segments, of which linked sets have at least
  ``1 + slack`` in common;
* one-deletion: ``h // 2 + 1`` segments, of which linked sets have one that
  differs in at most one shingle; each part is indexed with all its
  one-shingle deletions.

*Cost-based allocation.*  A segment that more than ``POPULAR`` sets share is
skipped by all of them.  A set may skip as many as its slack; one with more
popular segments (boilerplate, large groups of near copies) is allocated
one-deletion segments, about twice as wide, in that band, with a slack of
their own; and one that is still over it gets one-deletion segments without
slack, of which none is skipped.  As a linked pair has ``1 + slack`` segments
in common, one of them is left at a level unless both sets go on to the next.

*Verification.*  Pairs whose parity sketches (a few bits per shingle) differ in
more than (s + t) / 9 bits cannot link and are ruled out first; the others are
verified by their whole shingle sets.  A bucket's sets are compared with its smallest id first; after
the links found so far are turned into components, what remains are pairs of a
bucket that lie in different components.  All of those are compared, so no
link that could join two components is lost, and a bucket of near copies costs
as many comparisons as it has sets.

Exact copies are one set throughout (128 bits and the size tell sets apart).

Cases: null or empty texts have no shingles and link with nothing; rows that
repeat a doc_id are one document, linked where any of its texts is; a row
without a doc_id has its shingles counted, but links join ids, so its
component is null.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import (broadcast_if_small, documents_of, fresh, mixed, run_hashes, text_slices, word_ends,
                                  word_starts, written)

WORDS = 5
POPULAR = 32
SKETCH_BITS = 0.6
SMALL_SEGMENT_COST = 8.0
SLICE = 1 << 19                   # bytes of text whose shingles are in a worker's memory at once, a longer text alone

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ------------------------------------------------------------------ shingles
def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)``: the distinct shingle hashes of each text,
    ascending, and where each text's begin."""
    n = len(off) - 1
    data = _LOWER[data]
    start = np.flatnonzero(word_starts(data, off))
    doc = np.searchsorted(off, start, side="right") - 1
    code = run_hashes(data, start, word_ends(data, off, start, doc))
    count = np.bincount(doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    full = max(len(code) - WORDS + 1, 0)
    whole = doc[:full] == doc[len(doc) - full:]
    at = np.flatnonzero(whole)
    h = code[at]
    for k in range(1, WORDS):
        h = mixed(h * np.uint64(0x2545F4914F6CDD1D) + code[at + k])
    hs, ds = [h], [doc[at]]
    for k in range(1, WORDS):
        few = np.flatnonzero(count == k)
        g = code[first[few]] + np.uint64(k)
        for j in range(1, k):
            g = mixed(g * np.uint64(0x2545F4914F6CDD1D) + code[first[few] + j])
        hs.append(mixed(g))
        ds.append(few)
    h, d = np.concatenate(hs), np.concatenate(ds)
    order = np.argsort(h)
    order = order[np.argsort(d[order].astype(np.uint16 if n < 65536 else np.int64), kind="stable")]
    h, d = h[order], d[order]
    new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))[:len(h)]
    h, d = h[new], d[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(d, minlength=n))))


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    run = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=run[1:])
    return run[bounds[1:]] - run[bounds[:-1]]


def set_keys(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    a = mixed(_sums(mixed(h ^ np.uint64(0xA5A5A5A55A5A5A5A)), bounds))
    b = mixed(_sums(mixed(h * np.uint64(0x9FB21C651E98DF25)), bounds))
    return a.view(np.int64), b.view(np.int64)


def parity_sketches(h: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """One bit string per set, of a power of two of at least 64 and
    ``SKETCH_BITS`` times its size: bit p is the parity of the number of its
    shingles that hash to p.  Two sets' strings differ in no more bits than
    the sets differ in shingles."""
    size = np.diff(bounds)
    bits = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(SKETCH_BITS * size, 1))).astype(np.int64))
    base = np.concatenate(([0], np.cumsum(bits)))
    of = np.repeat(np.arange(len(size)), size)
    at = (mixed(h * np.uint64(0xC2B2AE3D27D4EB4F)) & (bits[of] - 1).astype(np.uint64)).astype(np.int64)
    raw = np.packbits((np.bincount(base[of] + at, minlength=base[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [raw[i // 8:j // 8] for i, j in zip(base[:-1], base[1:])]


def parity_words(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The same with 256 bits for every set, as four int64 columns: what a
    join condition can compare."""
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = of * 256 + (mixed(h * np.uint64(0xC2B2AE3D27D4EB4F)) & np.uint64(255)).astype(np.int64)
    odd = (np.bincount(at, minlength=256 * (len(bounds) - 1)) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8").reshape(-1, 4)


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits that differ, after folding the longer string to the shorter."""
    if len(a) < len(b):
        a, b = b, a
    x, n = int.from_bytes(a, "little"), 8 * len(a)
    while n > 8 * len(b):
        n //= 2
        x = (x ^ (x >> n)) & ((1 << n) - 1)
    return (x ^ int.from_bytes(b, "little")).bit_count()


# ------------------------------------------------------------- bands, schemes
def _bands() -> np.ndarray:
    low = [1]
    while low[-1] < 2 ** 40:
        low.append(max(low[-1] + 1, -(-low[-1] * 3 // 2)))
    return np.array(low, np.int64)


LOW = _bands()
HIGH = LOW[1:] - 1


def differing(s):
    """Most shingles in which a set of size s and a larger linked one differ."""
    return s // 4


def slack(s):
    return (15 * differing(s) + 99) // 100 + 1


def plain_segments(s):
    return differing(s) + 1 + slack(s)


def wide_segments(s):
    return differing(s) // 2 + 1


def _cost(size: int, segments: int, rows: int) -> float:
    x = size / segments
    return rows * (1 + SMALL_SEGMENT_COST * np.exp(-x) * (1 + x))


def wide_slack(s):
    return (s >= 32) * ((15 * (differing(s) // 2) + 99) // 100 + 1)


PLAIN = np.array([_cost(u, plain_segments(u), plain_segments(u)) <= _cost(u, wide_segments(u), u + wide_segments(u))
                  for u in HIGH.tolist()])


def index_rows(h: np.ndarray, bounds: np.ndarray, own: np.ndarray, wide: np.ndarray | None,
               level: int) -> tuple[np.ndarray, np.ndarray]:
    """``(set index, signature)`` of sets in their own band (``own``) or the
    band below.  ``wide``: None for each band's scheme (level 1), else the
    sets that get one-deletion segments, with slack (level 2) or without
    (level 3).  A signature is 62 bits of hash, whether it is of the own band,
    whether it is of a deletion."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    band = np.searchsorted(LOW, size, side="right") - 1 - (~own)
    use = (size >= 4) & (band >= 0)
    band = np.maximum(band, 0)
    # in the band below only up to 1.25 times its largest size, and pairs need 4 shingles
    use &= (HIGH[band] >= 4) & (own | (4 * size <= 5 * HIGH[band]))
    plain = PLAIN[band] if wide is None else np.zeros(n, bool)
    if wide is not None:
        use &= wide
    top = HIGH[band]
    spare = wide_slack if level == 2 else (lambda s: 0)
    m = np.where(plain, plain_segments(top), wide_segments(top) + spare(top))
    e = np.where(use, np.minimum(np.where(plain, plain_segments(size), wide_segments(size) + spare(size)), m), 0)
    base = np.concatenate(([0], np.cumsum(e)))
    of = np.repeat(np.arange(n), size)
    seg = (mixed(h * np.uint64(0xD6E8FEB86659FD93)) % m[of].astype(np.uint64)).astype(np.int64)
    inside = seg < e[of]
    of, seg, token = of[inside], seg[inside], mixed(h[inside] + np.uint64(0x632BE59BD9B4E019))
    part = np.zeros(base[-1], np.uint64)
    np.add.at(part, base[of] + seg, token)
    owner = np.repeat(np.arange(n), e)
    place = (np.arange(base[-1]) - base[owner]).astype(np.uint64)
    # each band, level and scheme has keys of its own
    space = mixed(band[owner].astype(np.uint64) << np.uint64(40) | place << np.uint64(3) | np.uint64(2 * level)
                  | plain[owner].astype(np.uint64))
    flag = np.where(own, np.uint64(2), np.uint64(0)) if own.ndim else np.uint64(2)
    sign = lambda x, o: (mixed(x) & ~np.uint64(3)) | flag[o]
    rows = sign(part + space, owner)
    d = ~plain[of]
    where = base[of[d]] + seg[d]
    deleted = sign(part[where] - token[d] + space[where], of[d]) | np.uint64(1)
    return np.concatenate((owner, of[d])), np.concatenate((rows, deleted)).view(np.int64)


def signatures(h: np.ndarray, bounds: np.ndarray, wide: np.ndarray | None = None,
               level: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, values)``: the signatures of each set.  ``wide[:, 0]`` and
    ``wide[:, 1]``: sets that need one-deletion segments in the band below and
    in their own."""
    n = len(bounds) - 1
    both = [index_rows(h, bounds, np.full(n, own), None if wide is None else wide[:, int(own)], level) for own in (False, True)]
    owner, value = (np.concatenate(x) for x in zip(*both))
    order = np.argsort(owner, kind="stable")
    return np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))), value[order]


# ------------------------------------------------------------------- Spark side
def _sets_of(batches):
    for b in batches:
        for first, end, data, off in text_slices(b.column("text"), SLICE):
            yield b.slice(first, end - first), *shingle_sets(data, off)


def describe_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s1, s2, sketch, p0..p3): size, key and parity sketches of
    each document's set."""
    def describe(batches):
        for b, h, bounds in _sets_of(batches):
            s1, s2 = set_keys(h, bounds)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(bounds)), pa.array(s1), pa.array(s2),
                 pa.array(parity_sketches(h, bounds), pa.binary()), *[pa.array(p) for p in parity_words(h, bounds).T.copy()]],
                names=["doc_id", "n", "s1", "s2", "sketch", "p0", "p1", "p2", "p3"])

    return documents_of(docs, "doc_id", "text").mapInArrow(
        describe, "doc_id long, n long, s1 long, s2 long, sketch binary, p0 long, p1 long, p2 long, p3 long")


def texts_of(docs: DataFrame, rich: DataFrame) -> DataFrame:
    """(doc_id, text, flags) of the sets (node, flags)."""
    d = documents_of(docs, "doc_id", "text")
    return d.join(broadcast_if_small(rich), F.col("doc_id") == F.col("node")).select("doc_id", "text", "flags")


def set_signatures(d: DataFrame, level: int = 1) -> DataFrame:
    """(node, s1, s2, sigs) of documents with an id.  Above level 1 the input
    has flags: one-deletion segments in the band below (1), the own band
    (2)."""
    some = level > 1
    if not some:
        d = documents_of(d, "doc_id", "text").filter(F.col("doc_id").isNotNull())

    def sign(batches):
        for b, h, bounds in _sets_of(batches):
            s1, s2 = set_keys(h, bounds)
            wide = None
            if some:
                flags = b.column("flags").to_numpy(zero_copy_only=False)
                wide = np.column_stack(((flags & 1) > 0, (flags & 2) > 0))
            offsets, values = signatures(h, bounds, wide, level)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s1), pa.array(s2),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], names=["node", "s1", "s2", "sigs"])

    return d.mapInArrow(sign, "node long, s1 long, s2 long, sigs array<long>")


def _bucketed(sigs: DataFrame) -> DataFrame:
    """One row per signature, those of a bucket together: parts before
    deletions, then by node."""
    rows = sigs.select("node", F.explode("sigs").alias("sig"))
    n = int(sigs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.shiftright("sig", 2)
    return rows.repartition(n, key).sortWithinPartitions(key, F.col("sig").bitwiseAND(1), "node")


BUCKET = "key long, node long, deletion boolean, own boolean, pivot long, popular boolean"


def _bucket_rows(key, node, sig, pivot, popular):
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(node), pa.array((sig & 1) == 1), pa.array((sig & 2) == 2),
         pa.array(np.where(popular, 0, pivot)), pa.array(popular)],
        names=["key", "node", "deletion", "own", "pivot", "popular"])


def shared_buckets(sigs: DataFrame, popular: int) -> DataFrame:
    """The rows of buckets that several sets share, with the bucket's smallest
    whole part as pivot; buckets of deletions only are dropped, as no pair is
    due to them.  Rows of a bucket with more than ``popular`` rows are marked
    popular.  The rows arrive sorted, whole parts first; a bucket that is open
    at the end of a batch is carried over, at most ``popular + 1`` rows of
    it."""
    def scan(batches):
        node, sig = np.zeros(0, np.int64), np.zeros(0, np.int64)
        over = None                        # key of a bucket that is known to be popular (or to be dropped)
        dropped = False
        for b in batches:
            node = np.concatenate((node, b.column("node").to_numpy(zero_copy_only=False)))
            sig = np.concatenate((sig, b.column("sig").to_numpy(zero_copy_only=False)))
            yield from emit(node, sig, over, dropped, False)
            key = sig >> 2
            if len(key):
                last = int(np.searchsorted(key, key[-1]))
                if over is not None and key[-1] == over:
                    last = len(key)
                elif len(key) - last > popular or sig[last] & 1:
                    dropped = bool(sig[last] & 1)
                    if not dropped:
                        yield _bucket_rows(key[last:], node[last:], sig[last:], node[last:], np.ones(len(key) - last, bool))
                    over, last = key[-1], len(key)
                node, sig = node[last:], sig[last:]
        yield from emit(node, sig, over, dropped, True)

    def emit(node, sig, over, dropped, final):
        key = sig >> 2
        if not len(key):
            return
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(first, len(key)))
        run = np.repeat(np.arange(len(first)), count)
        whole = (sig[first] & 1) == 0
        again = np.zeros(len(first), bool) if over is None else key[first] == over
        busy = ((count > popular) & whole & ~again) | (again & (not dropped))
        keep = busy | ((count > 1) & whole & ~again)
        if not final and not again[-1]:
            keep[-1] = False               # still open
        at = keep[run]
        if at.any():
            yield _bucket_rows(key[at], node[at], sig[at], node[first][run][at], busy[run][at])

    return _bucketed(sigs).mapInArrow(scan, BUCKET)


def wide_buckets(sigs: DataFrame) -> DataFrame:
    """As :func:`shared_buckets` for one-deletion segments alone: buckets of
    any size, of which only the first row waits for a second one."""
    def scan(batches):
        key0 = pivot0 = None               # bucket open at the end of the last batch, its pivot (None: deletions only)
        held = None                        # its first row, if it is still alone
        for b in batches:
            node = b.column("node").to_numpy(zero_copy_only=False)
            sig = b.column("sig").to_numpy(zero_copy_only=False)
            if held is not None:
                node, sig, held, key0 = np.append(held[0], node), np.append(held[1], sig), None, None
            key = sig >> 2
            if not len(key):
                continue
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            count = np.diff(np.append(first, len(key)))
            whole = (sig[first] & 1) == 0
            pivot = node[first].copy()
            keep = whole & (count > 1)
            if key0 is not None and key[0] == key0:      # goes on from the last batch
                keep[0], pivot[0] = pivot0 is not None, pivot0 or 0
                whole[0] = keep[0]
            elif len(first) == 1 and count[0] == 1 and whole[0]:
                held = (node[-1:], sig[-1:])
            if len(first) > 1 and count[-1] == 1 and whole[-1]:
                held = (node[-1:], sig[-1:])
            key0, pivot0 = key[-1], (int(pivot[-1]) if whole[-1] else None)
            run = np.repeat(np.arange(len(first)), count)
            at = keep[run]
            if at.any():
                yield _bucket_rows(key[at], node[at], sig[at], pivot[run][at], np.zeros(int(at.sum()), bool))

    return _bucketed(sigs).mapInArrow(scan, BUCKET)


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that size and parity sketch do not rule out: linked sets
    differ in at most (s + t) / 9 shingles, and the sketches in no more bits."""
    of = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}"))
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * 80
    both = pairs.join(of("b"), "b").join(of("a"), "a").filter(near)

    def compare(batches):
        for b in batches:
            most = np.asarray(b.column("na")) + np.asarray(b.column("nb"))
            keep = [9 * sketch_distance(x, y) <= m for x, y, m in zip(
                b.column("ka").to_pylist(), b.column("kb").to_pylist(), most.tolist())]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long").distinct()


def verified(candidates: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link.  Those that the sketches leave are
    compared by whole shingle sets: each meets the set of b, then that of a;
    a set with many partners is split by the join."""
    pairs = written(possible(candidates, sets), "near-possible")
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-nodes")
    d = documents_of(docs, "doc_id", "text").join(broadcast_if_small(nodes), F.col("doc_id") == F.col("node"), "left_semi")

    def gather(batches):
        for b, h, bounds in _sets_of(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(h.view(np.int64)))],
                names=["node", "h"])

    sets = written(d.mapInArrow(gather, "node long, h array<long>"), "near-shingles")
    left = sets.select(F.col("node").alias("a"), F.col("h").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("h").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return (pairs.join(right, "b").join(left, "a")
            .filter(100 * both >= 80 * (F.size("ha") + F.size("hb") - both)).select("a", "b").distinct())


def contracted(links: DataFrame) -> DataFrame:
    """Links (a < b) that connect the same nodes: a node's link to its
    smallest neighbour stays, its other smaller neighbours are linked to that
    one instead.  Sets that share several partners keep one link each."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    ends = F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b"))))
    return links.join(least, "b").select(ends.alias("e")).select("e.a", "e.b").filter("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for nodes with links.  After
    contracting the links twice, each round takes the smallest label of the neighbours, hands it to the node's
    own label too, and follows labels once, so paths shrink geometrically."""
    for _ in range(2):
        links = written(contracted(written(links, "near-links")), "near-links")
    edges = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    label = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("comp")), "near-labels")
    while True:
        near = (edges.join(label, edges["b"] == label["node"]).groupBy("a").agg(F.min("comp").alias("m"))
                .join(label, F.col("a") == label["node"]).select("node", "comp", F.least("m", "comp").alias("m")))
        near = written(near, "near-step")
        hooked = (near.select("node", F.col("m").alias("comp"))
                  .unionByName(near.select(F.col("comp").alias("node"), F.col("m").alias("comp")))
                  .groupBy("node").agg(F.min("comp").alias("comp")))
        hooked = written(hooked, "near-hooked")
        up = hooked.select(F.col("node").alias("p"), F.col("comp").alias("pc"))
        new = written(hooked.join(up, F.col("comp") == F.col("p"), "left")
                      .select("node", F.least("comp", "pc").alias("comp")), "near-labels")
        changed = new.join(label.withColumnRenamed("comp", "old"), "node").filter("comp <> old")
        if changed.isEmpty():
            return new
        label = new


def _pairs(a, b):
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    sets = written(describe_sets(docs), "near-sets")
    classes = (sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("n", "s1", "s2")
               .agg(F.min("doc_id").alias("rep"), F.count("*").alias("k")).filter("k > 1").drop("k"))
    classes = written(classes, "near-classes")
    # one document of each class is indexed
    signed = set_signatures(docs).join(broadcast_if_small(classes.drop("n")), ["s1", "s2"], "left") \
        .filter(F.col("rep").isNull() | (F.col("rep") == F.col("node"))).select("node", "sigs")
    shared = written(shared_buckets(signed, POPULAR), "near-buckets")
    size = sets.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.min("n").alias("n"))
    plain = _is_plain(F.col("n"), F.col("own"))
    least = F.ceil(F.col("n") * 4 / 5).cast("long")       # of the smallest set that could link
    h = F.floor(least / 4)
    rich = written(_over(shared, size, F.when(plain, F.floor((h * 15 + 99) / 100) + 1).otherwise(0)), "near-rich")
    texts = written(texts_of(docs, rich), "near-rich-texts")
    wide = written(shared_buckets(set_signatures(texts, 2).select("node", "sigs"), POPULAR), "near-wide")
    spare = F.when(least >= 32, F.floor((F.floor(h / 2) * 15 + 99) / 100) + 1).otherwise(0)
    dense = written(_over(wide, size, spare), "near-dense")
    last = written(wide_buckets(set_signatures(texts_of(texts, dense), 3).select("node", "sigs")), "near-last")
    buckets = reduce(DataFrame.unionByName, [x.filter(~F.col("popular")).drop("popular") for x in (shared, wide, last)])

    star = written(buckets.filter("pivot <> node").select(*_pairs("pivot", "node")).distinct(), "near-star")
    links = written(verified(star, sets, docs), "near-verified")
    comp = components(links)
    # what the buckets still hold: pairs of different components
    label = F.coalesce("comp", "node")
    rows = written(buckets.join(comp.withColumnRenamed("node", "id"), F.col("node") == F.col("id"), "left")
                   .select("key", "node", "deletion", label.alias("comp")).distinct(), "near-labelled")
    mixed_keys = rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("key")
    open_rows = rows.join(written(mixed_keys, "near-mixed"), "key", "left_semi")
    facts = ["n", "p0", "p1", "p2", "p3"]
    open_rows = written(open_rows.join(sets.select(F.col("doc_id").alias("id"), *facts), F.col("node") == F.col("id")).drop("id"),
                        "near-open")
    other = open_rows.withColumnsRenamed({c: f"{c}2" for c in open_rows.columns if c != "key"})
    apart = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"p{i}2"))) for i in range(1, 4)),
                F.bit_count(F.col("p0").bitwiseXOR(F.col("p02"))))
    # what size and the short parity sketch rule out is never a row of the join
    near = (F.col("comp") < F.col("comp2")) & ~(F.col("deletion") & F.col("deletion2")) & (9 * apart <= F.col("n") + F.col("n2")) \
        & (100 * F.least("n", "n2") >= 80 * F.greatest("n", "n2"))
    rest = open_rows.join(other, "key").filter(near).select(*_pairs("node", "node2")).distinct()
    rest = written(rest.join(star, ["a", "b"], "left_anti"), "near-rest")
    comp = components(links.unionByName(verified(rest, sets, docs)))

    member = sets.join(classes, ["n", "s1", "s2"], "left").withColumn("node", F.coalesce("rep", "doc_id"))
    out = member.join(comp.withColumnRenamed("node", "id"), F.col("node") == F.col("id"), "left")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(linked, F.coalesce("comp", "node")).otherwise(F.col("doc_id")).alias("component_id"))


def _over(buckets: DataFrame, size: DataFrame, may) -> DataFrame:
    """(node, flags) of the sets with more popular parts than they ``may``
    skip in the band below (1), in their own (2)."""
    skipped = buckets.filter("popular").groupBy("node", "own").agg(F.count("*").alias("k"))
    return (skipped.join(size, F.col("node") == F.col("id")).filter(F.col("k") > may)
            .groupBy("node").agg(F.sum(F.when(F.col("own"), 2).otherwise(1)).cast("int").alias("flags")))


def _is_plain(n, own):
    """Whether the band of a set of size n (its own, or the one below) has
    plain segments: bands up to some size are one-deletion."""
    first = int(LOW[np.flatnonzero(PLAIN)[0]])
    assert PLAIN[np.flatnonzero(PLAIN)[0]:].all()
    second = int(LOW[np.flatnonzero(PLAIN)[0] + 1])
    return F.when(own, n >= first).otherwise(n >= second)


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest id of their component, all columns
    of the input; documents that link with nothing stay."""
    found = near_duplicates(docs).filter(F.col("component_id") != F.col("doc_id"))
    x = fresh(docs, "__near")
    gone = written(found.select(F.col("doc_id").alias(x)).distinct(), "near-gone")
    return docs.join(broadcast_if_small(gone), docs["doc_id"].cast("long") == F.col(x), "left_anti")

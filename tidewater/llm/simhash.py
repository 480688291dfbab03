"""SimHash near duplicates by covering locality-sensitive hashing.

*Fingerprint.*  A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``WORDS`` words joined by one space, repeats included (a shorter text is one
shingle).  A bit of the fingerprint is 1 if it is set in more than half of the
shingles' XXH64 values (UTF-8, seed 42).

*Covering masks.*  Bit i carries the non-zero vector ``i % 7 + 1`` of
GF(2)^3; table v (1..7) keeps the bits whose vector has an odd number of ones
in common with v, 36 or 37 of the 64.  Two or fewer differing bits span at
most two dimensions, so some v is orthogonal to all their vectors: in that
table the pair agrees on every kept bit.  Every pair within the radius thus
meets in a bucket; nothing depends on chance.

*Buckets.*  Equal fingerprints are one class throughout, so a bucket holds
distinct fingerprints.  In a bucket of at most ``BUCKET`` the pairs are
compared.  Members of a larger one (thousands of near copies) are not paired:
each is hashed to the balls around itself and around its one-bit flips in the
bits the bucket's mask leaves free.  Two fingerprints within two bits share a
ball, and all members of a ball are within two bits of each other, at most 65,
so the ball's members are linked to its smallest one.  No link is lost and
the work stays linear in the size of the bucket.

A hot class (a third of all rows with one fingerprint) is counted by partial
aggregates; classes with more than 1/``HOT`` of the rows, at most ``HOT`` of
them, are joined by broadcast, the others have no hot key.

Cases: null, empty and blank texts have fingerprint zero and link like any
other; a row without a doc_id takes part in links, its component is the
smallest id reachable (null if no row reachable has one); repeated rows are
one class; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import broadcast_if_small, documents_of, written
from tidewater.llm.near_join import components

WORDS = 3
SEED = 42
RADIUS = 2
BUCKET = 32
HOT = 10_000
CHUNK = 1 << 16                   # hashes whose bits are counted at once


# ------------------------------------------------------------ fingerprints
def shingle_hashes(text: str) -> list[int]:
    """XXH64 of every shingle of a text, repeats included."""
    import xxhash
    words = text.encode().lower().split()      # bytes: A-Z only, and only the six ASCII spaces split
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= WORDS:
        return [xxhash.xxh64_intdigest(line, SEED)]
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(start[:len(words) - WORDS + 1].tolist(), end[WORDS - 1:].tolist())]


def fingerprint(hashes: list[int]) -> int:
    """The fingerprint as a signed 64-bit number."""
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), CHUNK):
        raw = h[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    def make(batches):
        for b in batches:
            fp = [fingerprint(shingle_hashes(t.as_py() or "")) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return documents_of(docs, "doc_id", "text").mapInArrow(make, "doc_id long, fp long")


# ------------------------------------------------------------ covering masks
def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The kept bits of each table."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((i % vectors + 1) & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_fingerprints(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b), a < b, that connect the same fingerprints as all pairs
    within ``RADIUS`` bits do; ``fps`` has distinct values ``fp``."""
    tables = [F.struct(F.lit(t).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
              for t, m in enumerate(masks())]
    rows = fps.select("fp", F.explode(F.array(*tables)).alias("e")).select("e.t", "e.key", "fp")
    shared = written(rows.groupBy("t", "key").agg(F.count("*").alias("k")).filter("k > 1"), "simhash-buckets")

    small = rows.join(broadcast_if_small(shared.filter(F.col("k") <= bucket).drop("k")), ["t", "key"])
    small = written(small, "simhash-members")
    pairs = (small.join(small.withColumnRenamed("fp", "fp2"), ["t", "key"])
             .filter((F.col("fp") < F.col("fp2")) & (_distance("fp", "fp2") <= RADIUS))
             .select(F.col("fp").alias("a"), F.col("fp2").alias("b")))

    large = rows.join(broadcast_if_small(shared.filter(F.col("k") > bucket).drop("k")), ["t", "key"])
    free = F.element_at(F.array(*[F.lit(_signed(~m & (1 << 64) - 1)) for m in masks()]), F.col("t").cast("int") + 1)
    loose = large.withColumn("free", free).groupBy("fp").agg(F.bit_or("free").alias("free"))
    flips = [F.when(F.col("free").bitwiseAND(F.lit(_signed(1 << i))) != 0, F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))))
             for i in range(64)]
    balls = loose.select("fp", F.explode(F.array_compact(F.array(F.col("fp"), *flips))).alias("ball"))
    # a ball has at most 65 members
    star = (balls.groupBy("ball").agg(F.collect_list("fp").alias("f")).filter(F.size("f") > 1)
            .select(F.array_min("f").alias("a"), F.explode("f").alias("b")).filter("a <> b"))
    return pairs.unionByName(star).distinct()


# ------------------------------------------------------------ classes
def simhash_components(docs: DataFrame, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = written(fingerprints(docs), "simhash-rows")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("k")), "simhash-classes")
    comp = components(near_fingerprints(classes.select("fp"), bucket))
    member = classes.join(comp.withColumnRenamed("node", "id"), F.col("fp") == F.col("id"), "left") \
        .select("fp", "least", "k", F.coalesce("comp", "fp").alias("comp"))
    member = written(member, "simhash-members")
    # only components of several fingerprints have to be gathered
    joint = member.join(comp.select(F.col("comp").alias("c")).distinct(), F.col("comp") == F.col("c"), "left_semi")
    smallest = joint.groupBy("comp").agg(F.min("least").alias("least2"))
    named = written(member.join(smallest, "comp", "left")
                    .select("fp", "k", F.coalesce("least2", "least").alias("component_id")), "simhash-named")
    limit = rows.count() / hot
    heavy = named.filter(F.col("k") > limit).select("fp", "component_id")         # at most ``hot`` rows
    light = named.filter(F.col("k") <= limit).select("fp", "component_id")
    marked = rows.join(F.broadcast(heavy.select(F.col("fp").alias("h"))), F.col("fp") == F.col("h"), "left")
    out = (rows.join(F.broadcast(heavy), "fp")
           .unionByName(marked.filter(F.col("h").isNull()).select("doc_id", "fp").join(light, "fp")))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Exact duplicates by progressive refinement.

Texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  Rows are grouped by the length of that normalised text;
those that share it with another row are grouped by length and a hash of the
first ``PREFIX`` bytes; only rows that still have a partner are grouped by the
SHA-256 of the whole.  Grouping moves a few numbers per row, never a text, and
every count is partially aggregated, so a group of copies of any size is one
counter per task.  In the general form the whole content is read again for
surviving rows only; a caller that wants the digest of every row
(``digest_all``) gets it from the first scan.

Of equal texts the row with the most code points in the original text stays,
then the one with the smallest doc_id (null last).

Cases: a null text is an empty one; empty texts equal each other; rows that
repeat a doc_id count in ``group_size`` and share one decision.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import SPACES, broadcast_if_small, documents_of, fresh, written

# UTF-8 bytes of the normalised text that the second step hashes.
PREFIX = 256


def keys(docs: DataFrame, digest_all: bool) -> DataFrame:
    """(doc_id, chars, length, prefix, sha): one narrow row per document."""
    d = documents_of(docs, "doc_id", "text").withColumn("chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))

    def narrow(batches):
        import xxhash
        for b in batches:
            length, prefix, sha = [], [], []
            for text in pc.fill_null(b.column("text"), "").cast(pa.binary()):
                norm = text.as_py().translate(None, SPACES)
                length.append(len(norm))
                prefix.append(xxhash.xxh64_intdigest(norm[:PREFIX]) >> 1)
                sha.append(hashlib.sha256(norm).hexdigest() if digest_all else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("chars"), pa.array(length, pa.int64()), pa.array(prefix, pa.int64()),
                 pa.array(sha, pa.string())], names=["doc_id", "chars", "length", "prefix", "sha"])

    return d.mapInArrow(narrow, "doc_id long, chars long, length long, prefix long, sha string")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, length, sha) from whole texts."""
    def whole(batches):
        for b in batches:
            norm = [t.as_py().translate(None, SPACES) for t in pc.fill_null(b.column("text"), "").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in norm], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in norm], pa.string())], names=["doc_id", "length", "sha"])

    return documents_of(docs, "doc_id", "text").mapInArrow(whole, "doc_id long, length long, sha string")


def survivors(rows: DataFrame, on: list[str]) -> DataFrame:
    """Rows that share ``on`` with another row.  The shared keys are a written
    table, so the join has a shuffle of its own on both sides and a key with
    many rows is split."""
    shared = written(rows.groupBy(*on).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "dedup-shared")
    return rows.join(shared, on, "left_semi")


def duplicate_groups(docs: DataFrame, digest_all: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(all_rows, rows, groups)``: a narrow row per document; those of them
    that have a digest (all with ``digest_all``, else the survivors of length
    and prefix); and one row (length, sha, keep_id, group_size) per text that
    occurs more than once."""
    all_rows = rows = written(keys(docs, digest_all), "dedup-keys")
    left = survivors(survivors(rows, ["length"]), ["length", "prefix"])
    if not digest_all:
        ids = written(left.drop("sha"), "dedup-left")
        wanted = broadcast_if_small(ids.select(F.col("doc_id").alias("__want")).distinct())
        d = documents_of(docs, "doc_id", "text")
        sha = digests(d.join(wanted, F.col("doc_id").eqNullSafe(F.col("__want")), "left_semi"))
        sha = sha.distinct().withColumnsRenamed({"doc_id": "__d", "length": "__l"})
        rows = left = written(sha.join(ids, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("length") == F.col("__l")))
                              .drop("__d", "__l"), "dedup-sha")
    groups = (left.groupBy("length", "sha")
              .agg(F.count("*").alias("group_size"),
                   F.min_by("doc_id", F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"))).alias("keep_id"))
              .filter("group_size > 1"))
    return all_rows, rows, groups


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    _, rows, groups = duplicate_groups(docs, digest_all=True)
    both = rows.join(written(groups, "dedup-groups"), ["length", "sha"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return both.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                       F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns of the input.  Rows that repeat
    both doc_id and text stay once (the greatest row in column order)."""
    all_rows, rows, groups = duplicate_groups(docs)
    members = written(rows.join(written(groups, "dedup-groups"), ["length", "sha"])
                      .select("doc_id", "keep_id", "sha"), "dedup-members")
    x, h, gone_sha = fresh(docs, "__dup"), fresh(docs, "__sha"), fresh(docs, "__gone_sha")
    again = written(all_rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias(x)),
                    "dedup-repeated")
    gone = members.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias(x)) \
        .unionByName(again).distinct()
    gone = broadcast_if_small(written(gone, "dedup-gone"))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(x))
    once = docs.join(gone, same, "left_anti")
    if again.isEmpty():
        return once
    # repeated ids: their rows are few; decide per (doc_id, text)
    norm = F.sha2(F.regexp_replace(F.coalesce(docs["text"].cast("string"), F.lit("")), "[ \\t\\n\\x0B\\f\\r]", ""), 256)
    few = docs.join(broadcast_if_small(again), same, "left_semi").withColumn(h, norm)
    drop = members.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))) \
        .select(F.col("doc_id").alias(x), F.col("sha").alias(gone_sha)).distinct()
    few = few.join(drop, same & (F.col(h) == F.col(gone_sha)), "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    few = few.groupBy("doc_id", h).agg(F.max_by(whole, F.struct(F.length("text"), F.to_json(whole))).alias(x)).select(f"{x}.*")
    return once.unionByName(few)

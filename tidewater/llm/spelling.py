"""Spelling variants: words one edit apart, found with bidirectional FM-index
search schemes (:mod:`fm_index`).

*Words.*  Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased; a run
whose crc32 with its document's id is divisible by ``EVERY`` loses one letter.
Each task counts its words before they are shuffled.  Words of at least
``LETTERS`` code points and ``OCCURRENCES`` occurrences are the vocabulary.

*Blocks.*  The vocabulary is cut into blocks of about ``BLOCK`` words twice:
by ranges of the words (for the search that matches the left half exactly) and
of the reversed words (right half).  All words with a given left half lie in
one range, so a query goes to the blocks its half's range meets, usually one;
a half that very many words share spans several blocks, each of which is
searched.  A task builds the index of a block and streams the queries through
it.  The driver sees only the bounds of the blocks, at most ``MAX_BLOCKS`` a
side (beyond that blocks grow).

*Forms.*  A word's form is its near word of the largest count (ties: smallest
in code-point order) if that is at least ``TIMES`` its own; following forms
multiplies the count, so a chain to the root has at most log5(count) steps,
and pointer doubling takes log2 of that.

Cases: null and empty texts have no words; a null doc_id counts as the empty
text before the colon; repeated rows count each; an empty table, or one
without frequent words, gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import broadcast_if_small, documents_of, written
from tidewater.llm.fm_index import Vocabulary

LETTERS = 6
OCCURRENCES = 5
EVERY = 199
TIMES = 5
BLOCK = 1 << 15
MAX_BLOCKS = 1 << 14
QUERIES = 1 << 13                 # searched at once
HELD = 500_000                    # words a task counts before it hands them on

# U+00C0 to U+00FF in UTF-8 are C3 80 to C3 BF
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")


def words_of(doc_id: int | None, text: str) -> Counter:
    """The words of a text (bytes) with their number."""
    start = zlib.crc32(("" if doc_id is None else str(doc_id)).encode() + b":")
    out: Counter = Counter()
    for run, n in Counter(_RUN.findall(text.encode().lower())).items():
        h = zlib.crc32(run, start)
        if h % EVERY == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1:]).encode()
        # every code point beyond ASCII has two bytes
        if len(run) - run.count(b"\xc3") >= LETTERS:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n) of the words with at least ``occurrences``."""
    def count(batches):
        seen: Counter = Counter()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()),
                                               pa.array(seen.values(), pa.int64())], names=["word", "n"])

        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                seen.update(words_of(i, t.as_py() or ""))
                if len(seen) > HELD:
                    yield batch()
                    seen.clear()
        yield batch()

    return (documents_of(docs, "doc_id", "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences))


# ------------------------------------------------------------------ search
def blocks_of(words: DataFrame, key, n_blocks: int, name: str) -> tuple[DataFrame, list]:
    """(block, word, n) in ranges of ``key``, and each block's number, least
    and greatest key."""
    cut = written(words.withColumn("key", key).repartitionByRange(n_blocks, "key")
                  .select(F.spark_partition_id().alias("block"), "key", "word", "n"), f"spelling-{name}")
    ends = cut.groupBy("block").agg(F.min("key").alias("a"), F.max("key").alias("z")).orderBy("block").collect()
    return cut.select("block", "word", "n"), [tuple(r) for r in ends]


def queries_of(words: DataFrame, side: str, ends: list) -> DataFrame:
    """(block, word, n): each word for every block with keys that begin with
    its half."""
    number, least, greatest = zip(*ends) if ends else ((), (), ())

    def send(batches):
        for b in batches:
            to, row = [], []
            for i, w in enumerate(b.column("word").to_pylist()):
                half = w[:len(w) // 2] if side == "left" else w[:len(w) // 2 - 1 if len(w) % 2 == 0 else len(w) // 2:-1]
                # the first block that ends at or after the half, the last that begins with or before it
                first, last = bisect_left(greatest, half), bisect_right(least, half + "\U0010ffff")
                to += number[first:last]
                row += [i] * (last - first)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), b.column("word").take(at), b.column("n").take(at)],
                                             names=["block", "word", "n"])

    return words.mapInArrow(send, "block int, word string, n long")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, near, near_n): all pairs of words of the written vocabulary
    that differ by one inserted, deleted or replaced code point, both ways; a
    pair may occur twice."""
    n_blocks = min(MAX_BLOCKS, -(-max(words.count(), 1) // block))
    rows = None
    for i, (side, key) in enumerate((("left", F.col("word")), ("right", F.reverse("word")))):
        index, ends = blocks_of(words, key, n_blocks, side)
        both = index.withColumn("query", F.lit(False)).unionByName(
            queries_of(words, side, ends).withColumn("query", F.lit(True)))
        both = both.withColumn("block", F.col("block") + i * n_blocks)
        rows = both if rows is None else rows.unionByName(both)

    def search(batches):
        at, index, words, counts = None, None, [], []

        def found(asked, n):
            nonlocal index
            if index is None:
                index = Vocabulary(words)
                order = sorted(range(len(words)), key=words.__getitem__)
                counts[:] = [counts[i] for i in order]
            q, x = index.near(asked, "left" if at < n_blocks else "right")
            return pa.RecordBatch.from_arrays(
                [pa.array([asked[i] for i in q.tolist()], pa.string()), pa.array(np.array(n, np.int64)[q]),
                 pa.array([index.words[i] for i in x.tolist()], pa.string()), pa.array(np.array(counts, np.int64)[x])],
                names=["word", "n", "near", "near_n"])

        for b in batches:
            blocks = b.column("block").to_numpy(zero_copy_only=False)
            asks = b.column("query").to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(asks) != 0)) + 1
            for i, j in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows]):
                if i == j:
                    continue
                if blocks[i] != at:
                    at, index, words, counts = int(blocks[i]), None, [], []
                w, n = b.column("word").slice(i, j - i).to_pylist(), b.column("n").slice(i, j - i).to_pylist()
                if not asks[i]:
                    words += w
                    counts += n
                else:
                    for k in range(0, len(w), QUERIES):
                        yield found(w[k:k + QUERIES], n[k:k + QUERIES])

    return (rows.repartitionById(2 * n_blocks, "block").sortWithinPartitions("block", "query")
            .mapInArrow(search, "word string, n long, near string, near_n long"))


# ------------------------------------------------------------------ forms
def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last one."""
    step = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = step.select(F.col("word").alias("w"), F.col("root").alias("r"))
        new = step.join(broadcast_if_small(up), F.col("root") == F.col("w"), "left") \
            .select("word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved"))
        new = written(new, "spelling-roots")
        if new.filter("moved").isEmpty():
            return new.drop("moved")
        step = new.drop("moved")


def spelling_variants(docs: DataFrame, occurrences: int = OCCURRENCES, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    words = written(vocabulary(docs, occurrences), "spelling-words")
    pairs = near_words(words, block).groupBy("word", "near").agg(F.first("near_n").alias("near_n"))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("most"),
                                     F.min_by("near", F.struct(-F.col("near_n"), "near")).alias("best"))
    is_form = F.col("most") >= times * F.col("n")
    out = written(words.join(best, "word", "left")
                  .select("word", F.when(is_form, F.col("best")).alias("form"), "n",
                          F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                          F.when(is_form, F.col("most")).alias("form_n")), "spelling-forms")
    root = roots(out.filter(F.col("form").isNotNull())).withColumnRenamed("word", "w")
    return (out.join(broadcast_if_small(root), F.col("word") == F.col("w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))

"""Token ids of all documents in wavelet-matrix shard files.

Texts are encoded where they are read (``add_special_tokens=False``, the end
id appended), the ids go to the shard range of their doc_id, each task sorts
its range and writes one Parquet part whose rows are shards: the doc ids, the
token counts and one compressed wavelet matrix (see :mod:`wavelet`) with
token access, counting and occurrence lookup.  A shard is closed at
``SHARD_TOKENS`` tokens, so a task holds one shard's ids at a time.

The BPE file used lower-cases, drops white space and encodes each word on its
own, so a word has the same ids in every text: each worker keeps the ids of
the words it has met and lets the library encode the new ones in batches.
Texts with characters beyond ASCII and the Latin-1 letters (whose lower case
and composition need no context), or with the text of a special token, go to
the library whole.

Order: ascending doc_id, null last, rows that repeat a doc_id by their ids.
Null and empty texts hold only the end id.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.llm.common import broadcast_if_small, documents_of, worker_state, written

END_ID = 2
SHARD_TOKENS = 1 << 21
BATCH = 512                       # texts split before their new words are encoded
CACHE = 1_200_000                   # words whose ids a worker keeps
WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
PLAIN = re.compile(r"[\t-\r -~À-ÿ]*")


class WordIds:
    """Ids of texts as little-endian bytes, two per id if all ids fit."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.lib = Tokenizer.from_file(path)
        self.width = id_width(vocabulary_bits(path))
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        # ids that end a word, if the model marks them
        suffix = json.loads(self.lib.to_str())["model"].get("end_of_word_suffix")
        self.ends = np.zeros(1 << vocabulary_bits(path), bool)
        if suffix:
            self.ends[[i for token, i in self.lib.get_vocab().items() if token.endswith(suffix)]] = True

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.width).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def new_words(self, words: list[str]) -> list[bytes]:
        """Ids of many words: encoded as one text, which costs the library
        less, and cut after the ids that end a word."""
        out = []
        for at in range(0, len(words), 2000):
            block = words[at:at + 2000]
            ids = np.frombuffer(self.library([" ".join(block)])[0], self.width)
            end = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(end) == len(block) and end[-1] == len(ids):
                raw, w = ids.tobytes(), ids.itemsize
                out += [raw[w * a:w * b] for a, b in zip([0, *end], end)]
            else:
                out += self.library(block)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [PLAIN.fullmatch(t) is not None and not any(x in t for x in self.special) for t in texts]
        split = [WORD.findall(t.lower()) if p else () for t, p in zip(texts, plain)]
        if len(self.words) > CACHE:
            self.words.clear()
        if new := list(set().union(*split).difference(self.words)):
            letters = [w for w in new if w.isalpha()]
            other = [w for w in new if not w.isalpha()]
            self.words.update(zip(letters, self.new_words(letters)))
            self.words.update(zip(other, self.library(other)))
        ids = self.words.__getitem__
        out = [b"".join(map(ids, words)) for words in split]
        for i, p in enumerate(plain):
            if not p:
                out[i] = self.library([texts[i]])[0]
        return out


def vocabulary_bits(path: str) -> int:
    """Planes needed for every id of a tokenizer file."""
    from tokenizers import Tokenizer
    return max(1, (Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1).bit_length())


def id_width(bits: int) -> str:
    return "<u2" if bits <= 16 else "<u4"


def encoded(docs: DataFrame, path: str, bounds: list[int], end_id: int = END_ID) -> DataFrame:
    """(part, doc_id, ids): little-endian ids of each document with the end
    id; part is the place of doc_id among the bounds."""
    cuts = np.asarray(bounds, np.int64)

    def encode(batches):
        coder = worker_state(f"word-ids:{path}", lambda: WordIds(path))
        tail = np.asarray([end_id], coder.width).tobytes()
        for b in batches:
            ids, text = b.column("doc_id"), pc.fill_null(b.column("text"), "")
            part = np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right").astype(np.int32)
            part[ids.is_null().to_numpy(zero_copy_only=False)] = len(cuts)
            for at in range(0, b.num_rows, BATCH):
                out = [x + tail for x in coder.encode(text.slice(at, BATCH).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[at:at + BATCH]), ids.slice(at, BATCH), pa.array(out, pa.binary())],
                    names=["part", "doc_id", "ids"])

    return documents_of(docs, "doc_id", "text").mapInArrow(encode, "part int, doc_id long, ids binary")


def write_shards(docs: DataFrame, path: str, bits: int, end_id: int = END_ID) -> DataFrame:
    """The written shard table: (part, seq, n_docs, n_tokens, doc_ids, counts, matrix)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts).alias("q")).first().q
    bounds = sorted(set(cuts or []))
    width = np.dtype(id_width(bits))

    def shards(batches):
        from tidewater.llm.wavelet import WaveletMatrix
        part, seq, ids, rows, held = None, 0, [], [], 0

        def close():
            tokens = np.frombuffer(b"".join(rows), width)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_docs": pa.array([len(ids)], pa.int64()), "n_tokens": pa.array([len(tokens)], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "counts": pa.array([[len(r) // width.itemsize for r in rows]], pa.list_(pa.int64())),
                "matrix": pa.array([WaveletMatrix.build(tokens, bits).to_bytes()], pa.binary())})

        for b in batches:
            for p, d, x in zip(b.column("part").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids")):
                x = x.as_py()
                if rows and (p != part or held + len(x) > SHARD_TOKENS * width.itemsize):
                    yield close()
                    seq, ids, rows, held = seq + 1 if p == part else 0, [], [], 0
                part = p
                ids.append(d)
                rows.append(x)
                held += len(x)
        if rows:
            yield close()

    spread = encoded(docs, path, bounds, end_id).repartition(parts, "part") \
        .sortWithinPartitions("part", F.col("doc_id").isNull(), "doc_id", "ids")
    return written(spread.mapInArrow(shards, "part int, seq int, n_docs long, n_tokens long, doc_ids array<long>, "
                                             "counts array<long>, matrix binary"), "token-shards")


def read_shards(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the shard files."""
    def decode(batches):
        from tidewater.llm.wavelet import WaveletMatrix
        for b in batches:
            for r in range(b.num_rows):
                tokens = WaveletMatrix.from_bytes(b.column("matrix")[r].as_py()).decode()
                counts = np.asarray(b.column("counts")[r].values, np.int64)
                end = np.cumsum(counts)
                raw = memoryview(tokens.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(end - counts, end)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, b.column("part")[r].as_py(), np.int32)),
                     pa.array(np.full(n, b.column("seq")[r].as_py(), np.int32)),
                     b.column("doc_ids")[r].values, pa.array(end - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = files.select("part", "seq", "doc_ids", "counts", "matrix") \
        .mapInArrow(decode, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    base = written(files.select("part", "seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("base")),
                   "token-bases")
    return rows.join(broadcast_if_small(base), ["part", "seq"]) \
        .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    return write_shards(docs, path, vocabulary_bits(path), end_id)

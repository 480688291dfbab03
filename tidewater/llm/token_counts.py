"""Token counts by a map-side two-tier lookup.

The token count of a text is the sum over its pre-tokens, as a byte-level BPE
never merges across them.  Tier one is a broadcast table of at most
``TABLE`` frequent pre-tokens with their lengths; tier two is a cache in each
Python worker, filled by encoding the pre-tokens that the table lacks, in
batches.  Only a text's counts leave the task: no pre-token of the corpus is
shuffled.

The table comes from a sample of about ``SAMPLE_DOCS`` documents chosen by
the hash of their id.  It only decides what is looked up and what is encoded
once per worker; the counts do not depend on it.

A worker has one :class:`PieceLengths` per tokenizer file, whichever calls use
it; its cache is emptied when another call begins and when it is full.  New
pre-tokens of a space and letters are encoded as one text, which costs the
library less, and cut by the bytes of their tokens.

Texts that hold the text of an added token (``<|endoftext|>``) or rare
characters (``AGREED``) are encoded whole by the library, as are all texts if
the tokenizer is not a plain byte-level one.  Null and empty texts have 0 tokens; repeated rows are counted
each.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import documents_of, worker_state

LIMIT = 1024
TABLE = 1 << 16
SAMPLE_DOCS = 4096
CACHE = 600_000                   # pre-tokens, about 80 MB
# The classes of PATTERN for texts of these characters only,
# which the faster module splits.
LETTER, NUMBER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PLAIN = re.compile("[\\t\\n\\r -~\u00a1-\u024f]*")
PLAIN_PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^\s{LETTER}{NUMBER}]+|\s+(?!\S)|\s+")
WORD = re.compile(f" [{LETTER}]+")
BLOCK = 1000                      # pre-tokens encoded as one text
# Characters whose Unicode class (letter, number, space, other) is the same in
# the library and in the regex module; texts with others, which newer Unicode
# versions assign, are encoded whole.
AGREED = (r"\u0000-\u0557\u05d0-\u06ff\u0900-\u0b7f\u0e00-\u0eff\u1e00-\u206f\u20a0-\u20bf\u2100-\u218b\u2190-\u23ff"
          r"\u2460-\u27ff\u3000-\u303f\u3041-\u3096\u30a0-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7a3\ue000-\ufa6d"
          r"\uff00-\uffef\U0001f300-\U0001f64f\U0001f680-\U0001f6ff\U0001f900-\U0001f9ff")
BATCH = 256                       # texts split before their new pre-tokens are encoded


class PieceLengths:
    """Splits texts into pre-tokens and knows their lengths."""

    def __init__(self, path: str):
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.lib = Tokenizer.from_file(path)
        spec = json.loads(self.lib.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                         and not pre.get("add_prefix_space"))
        self.agreed = regex.compile(f"[{AGREED}]*").fullmatch
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.pattern = regex.compile(PATTERN).findall
        # a byte-level token has one character per byte
        self.bytes = np.zeros(self.lib.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in self.lib.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = len(token)
        self.call, self.frequent, self.cache = None, {}, {}

    def begin(self, call: str, frequent: dict[str, int]) -> None:
        """Empty the cache if another call used it."""
        if call != self.call:
            self.call, self.frequent, self.cache = call, frequent, dict(frequent)

    def split(self, text: str) -> list[str]:
        return PLAIN_PIECES.findall(text) if PLAIN.fullmatch(text) else self.pattern(text)

    def encode_lengths(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def piece_lengths(self, pieces: list[str]) -> dict[str, int]:
        """Lengths of pre-tokens: those of a space and letters stay apart in
        one text."""
        words, rest = [], []
        for p in pieces:
            (words if WORD.fullmatch(p) else rest).append(p)
        out = dict(zip(rest, self.encode_lengths(rest)))
        for at in range(0, len(words), BLOCK):
            block = words[at:at + BLOCK]
            (e,) = self.lib.encode_batch_fast(["".join(block)], add_special_tokens=False)
            end = np.cumsum(self.bytes[e.ids])
            cut = np.cumsum([len(w.encode()) for w in block])
            out.update(zip(block, np.diff(np.searchsorted(end, cut, side="right"), prepend=0).tolist()))
        return out

    def counts(self, texts: list[str]) -> list[int]:
        plain = [self.by_piece and PLAIN.fullmatch(t) is not None for t in texts]
        whole = [not (p or self.by_piece and self.agreed(t)) or any(s in t for s in self.special)
                 for t, p in zip(texts, plain)]
        pieces = [[] if w else PLAIN_PIECES.findall(t) if p else self.pattern(t) for t, p, w in zip(texts, plain, whole)]
        if len(self.cache) > CACHE:
            self.cache = dict(self.frequent)
        if new := list(set().union(*pieces).difference(self.cache)):
            self.cache.update(self.piece_lengths(new))
        length = self.cache.__getitem__
        out = [sum(map(length, p)) for p in pieces]
        for i, w in enumerate(whole):
            if w:
                out[i] = self.encode_lengths([texts[i]])[0]
        return out


def frequent_pieces(docs: DataFrame, path: str, table: int = TABLE, sample_docs: int = SAMPLE_DOCS) -> dict[str, int]:
    """Lengths of at most ``table`` pre-tokens that are frequent in a sample."""
    d = documents_of(docs, "doc_id", "text")
    every = max(1, d.count() // sample_docs)
    sample = d.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(every)) == 0)

    def tally(batches):
        pieces = worker_state(f"pieces:{path}", lambda: PieceLengths(path))
        seen: Counter = Counter()
        for b in batches:
            for t in b.column("text").to_pylist():
                seen.update(pieces.split(t or ""))
        top = seen.most_common(table)
        yield pa.RecordBatch.from_pydict({"piece": pa.array([p for p, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    top = (sample.mapInArrow(tally, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(table).collect())
    words = [r.piece for r in top]
    return dict(zip(words, PieceLengths(path).encode_lengths(words))) if words else {}


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, table: int = TABLE,
                 sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path, table, sample_docs))
    call = os.urandom(8).hex()

    def count(batches):
        pieces = worker_state(f"pieces:{path}", lambda: PieceLengths(path))
        pieces.begin(call, frequent.value)
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            for at in range(0, b.num_rows, BATCH):
                part = text.slice(at, BATCH)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, BATCH), pc.binary_length(part).cast(pa.int64()),
                     pa.array(pieces.counts(part.to_pylist()), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return documents_of(docs, "doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)

"""Alignment of two tokenizers' tokens over the same bytes.

A encodes space + text (byte-level BPE), B the text (pieces; it adds the space
itself).  Byte offsets at which tokens of both end cut a text into groups; an
A and a B occurrence are linked if their byte ranges overlap; the count of an
id pair is the number of documents that hold it linked.

*Segments.*  Both tokenizers start a new token at a single space between two
other characters (checked from B's vocabulary when it is loaded), so such
places are ends of groups whatever the text.  A text is cut there, a worker
keeps the alignment of the segments it has met, and new segments are encoded
and aligned together as one text.  Segments whose bytes the tokenizers do not
give back make their whole text be aligned as one piece.

*Identity map.*  ``same[a]`` is the B id of the same bytes as A id a.  Links
(a, same[a]), all those of exact one-to-one groups, are counted in vectors of
the length of A's vocabulary, one a task.  Only the other pairs, of irregular
groups, are counted by a shuffle of partial aggregates.

*Scores.*  The count of every document's links needs the pair counts again.
The vectors, each A id's highest count and the pairs with more than 1 /
``FREQUENT`` of all (document, pair) rows, at most ``FREQUENT`` of them, are
broadcast; the links that are left, of rare pairs, meet their counts in a
join that has no hot key.

Cases: texts that are null, empty, or whose A or B tokens do not join to
space + text have no tokens: zeros and an empty string; rows that repeat a
doc_id or have none are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import broadcast_if_small, documents_of, worker_state, written
from tidewater.llm.token_counts import AGREED

FREQUENT = 500_000
BATCH = 256                       # texts cut before their new segments are encoded
KEPT = 5_000_000                  # characters of segments that a worker keeps
BLOCK = 50_000                    # characters of new segments encoded as one text


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Ragged:
    """Arrays of different lengths in one growing numpy array."""

    def __init__(self, dtype):
        self.data, self.end, self.n = np.zeros(1024, dtype), np.zeros(1024, np.int64), 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used = self.end[self.n - 1] if self.n else 0
        while used + len(values) > len(self.data):
            self.data = np.concatenate((self.data, np.zeros_like(self.data)))
        while self.n + len(lengths) > len(self.end):
            self.end = np.concatenate((self.end, np.zeros_like(self.end)))
        self.data[used:used + len(values)] = values
        self.end[self.n:self.n + len(lengths)] = used + np.cumsum(lengths)
        self.n += len(lengths)

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(values, lengths)`` of the arrays ``at``, one after the other."""
        start = np.where(at > 0, self.end[np.maximum(at, 1) - 1], 0)
        length = self.end[at] - start
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        return self.data[np.repeat(start, length) + place], length


class Aligner:
    """The two tokenizers, their bytes, and the segments met so far."""

    def __init__(self, path_a: str, path_b: str):
        import regex
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        char, size = _byte_of_char(), self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = bytes(char[c] for c in token) if all(c in char for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        first: dict[bytes, int] = {}
        for i in sorted(range(len(pieces)), key=self.b.is_byte):       # a piece before the byte it spells
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                first.setdefault(self.bytes_b[i], i)
        self.same = np.array([first.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # digits of each id and what follows it: "," or the end of its side of a group
        self.digits = ([f"{i}," for i in range(size)] + [f"{i}|" for i in range(size)]
                       + [f"{i}," for i in range(len(pieces))] + [f"{i};" for i in range(len(pieces))])
        crossing = any("▁" in p.lstrip("▁") for p in pieces)
        inner = rf"(?<=[{AGREED}])(?<!\s)(?= [{AGREED}])(?! \s)"
        self.cut = (lambda t: [t]) if crossing else regex.compile(inner).split
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.kept = 0
        self.links = Ragged(np.int64)
        self.facts = np.zeros((1024, 4), np.int64)     # bad, n_a, n_b, n_groups

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """A's ids of a text that starts with a space, B's ids of the rest,
        and whether both give the text back."""
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:], num_threads=1)
        raw = text.encode()
        ok = (b"".join(map(self.bytes_a.__getitem__, a)) == raw) and (b"".join(map(self.bytes_b.__getitem__, b)) == raw)
        return np.array(a, np.int64), np.array(b, np.int64), ok

    def align(self, a: np.ndarray, b: np.ndarray, cuts: np.ndarray):
        """Alignment of the tokens a and b of texts that end at the byte
        offsets ``cuts``: link keys and their number per text, numbers of A
        tokens, B tokens and groups per text, the texts' groups."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        # between two neighbouring ends lies one A and one B token: a link
        ends = np.union1d(end_a, end_b)
        key = a[np.searchsorted(end_a, ends)] * len(self.bytes_b) + b[np.searchsorted(end_b, ends)]
        per_text = lambda e: np.diff(np.searchsorted(e, cuts, side="right"), prepend=0)
        # the tokens in the order of the groups' text: by group, A before B
        ga, gb = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
        na = len(self.bytes_a)
        code = np.concatenate((a + na * last_a, 2 * na + b + len(self.bytes_b) * last_b))
        order = np.argsort(np.concatenate((2 * ga, 2 * gb + 1)), kind="stable")
        text = list(map(self.digits.__getitem__, code[order].tolist()))
        tokens = per_text(end_a) + per_text(end_b)
        stop = np.cumsum(tokens).tolist()
        groups = ["".join(text[i:j])[:-1] for i, j in zip([0, *stop], stop)]
        return key, per_text(ends), per_text(end_a), per_text(end_b), per_text(both), groups

    def add(self, segments: list[str]) -> None:
        """Encode and align new segments, all as one text if that gives the
        text back, else one by one."""
        a, b, ok = self.ids("".join(segments))
        if not ok and len(segments) > 1:
            half = len(segments) // 2
            self.add(segments[:half])
            self.add(segments[half:])
            return
        n, at = len(segments), len(self.groups)
        while at + n > len(self.facts):
            self.facts = np.concatenate((self.facts, np.zeros_like(self.facts)))
        if ok:
            key, links, n_a, n_b, n_groups, groups = self.align(a, b, np.cumsum([len(s.encode()) for s in segments]))
            self.links.extend(key, links)
            self.facts[at:at + n] = np.column_stack((np.zeros(n, np.int64), n_a, n_b, n_groups))
            self.groups += groups
        else:
            self.links.extend(np.zeros(0, np.int64), np.zeros(1, np.int64))
            self.facts[at] = (1, 0, 0, 0)
            self.groups.append("")
        self.index.update(zip(segments, range(at, at + n)))
        self.kept += sum(map(len, segments))

    def texts(self, texts: list[str]):
        """Facts, link keys (with their number per text) and groups of texts,
        empty for those without tokens."""
        if self.kept > KEPT:
            self.clear()
        cut = [self.cut(" " + t) if t else [] for t in texts]
        # a segment that is not given back: its text is one segment
        for again in (False, True):
            new = dict.fromkeys(s for c in cut for s in c if s not in self.index)
            size = 0
            block: list[str] = []
            for s in new:
                if self.cut(f" a{s} a") != [" a", s, " a"]:      # its ends are not places to cut
                    self.add([s])
                    continue
                block.append(s)
                size += len(s)
                if size > BLOCK:
                    self.add(block)
                    block, size = [], 0
            if block:
                self.add(block)
            at = [[self.index[s] for s in c] for c in cut]
            if again or not self.facts[list(chain.from_iterable(at)), 0].any():
                break
            cut = [["".join(c)] if any(self.facts[i, 0] for i in x) else c for c, x in zip(cut, at)]
        flat = np.array(list(chain.from_iterable(at)), np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in at])
        facts = np.zeros((len(texts), 4), np.int64)
        np.add.at(facts, doc, self.facts[flat])
        key, length = self.links.gather(flat)
        return facts, key, np.repeat(doc, length), [";".join(map(self.groups.__getitem__, x)) for x in at]


ROW = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "same array<int>, same_times array<int>, pairs array<long>, times array<int>")


def _lists(values: np.ndarray, doc: np.ndarray, n: int, dtype) -> pa.ListArray:
    """The values of each of n documents (doc ascending) as lists."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, dtype))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: its numbers, its distinct links of the identity
    map (A ids) and its other distinct id pairs (a * size of B + b), both with
    the number of their occurrences."""
    def align(batches):
        w = worker_state(f"alignment:{path_a}:{path_b}", lambda: Aligner(path_a, path_b))
        size = len(w.bytes_b)
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            for at in range(0, b.num_rows, BATCH):
                part = text.slice(at, BATCH).to_pylist()
                n = len(part)
                facts, key, doc, groups = w.texts(part)
                space = len(w.bytes_a) * size
                both, times = np.unique(doc * space + key, return_counts=True)
                d, k = both // space, both % space
                same = w.same[k // size] == k % size
                sha = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, BATCH), pa.array(facts[:, 1]), pa.array(facts[:, 2]), pa.array(facts[:, 3]),
                     pa.array(np.bincount(doc, minlength=n)), pa.array(sha, pa.string()),
                     _lists(k[same] // size, d[same], n, pa.int32()), _lists(times[same], d[same], n, pa.int32()),
                     _lists(k[~same], d[~same], n, pa.int64()), _lists(times[~same], d[~same], n, pa.int32())],
                    names=[c.split()[0] for c in ROW.split(", ")])

    return documents_of(docs, "doc_id", "text").mapInArrow(align, ROW)


def identity_counts(rows: DataFrame) -> DataFrame:
    """(a, n): documents with the link (a, same[a]), summed in one vector a
    task."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            ids = b.column("same").flatten().to_numpy(zero_copy_only=False)
            part = np.bincount(ids, minlength=len(total))
            part[:len(total)] += total
            total = part
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["a", "n"])

    return rows.select("same").mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def scored(rows: DataFrame, size_b: int, frequent: int = FREQUENT) -> DataFrame:
    """``rows`` of :func:`aligned` (written) with n_best and count_sum."""
    spark = rows.sparkSession
    pairs = written(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "align-pairs")
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first().t
    same = identity_counts(rows).toPandas()                                       # at most A's vocabulary
    best_pair = pairs.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("n").alias("n")).toPandas()
    size_a = int(max([*same["a"], *best_pair["a"], 0])) + 1
    n_same, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    n_same[same["a"].to_numpy(int)] = same["n"]
    best[best_pair["a"].to_numpy(int)] = best_pair["n"]
    best = np.maximum(best, n_same)
    often = F.col("n") * frequent > total                                         # at most ``frequent`` rows
    known = pairs.filter(often).orderBy("pair").toPandas()
    table = spark.sparkContext.broadcast((n_same, best, known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64)))

    def score(batches):
        n_same, best, pair, n_pair = table.value
        for b in batches:
            n = b.num_rows
            out = [np.zeros(n, np.int64), np.zeros(n, np.int64)]

            def add(col, times, ids, count):
                doc = np.repeat(np.arange(n), np.diff(b.column(col).offsets.to_numpy()))
                t = b.column(times).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                c = count(ids)
                np.add.at(out[0], doc, np.where(c[0] == best[c[1]], t, 0) * c[2])
                np.add.at(out[1], doc, c[0] * t * c[2])
                return doc, t, c[2]

            a = b.column("same").flatten().to_numpy(zero_copy_only=False)
            add("same", "same_times", a, lambda x: (n_same[x], x, np.ones(len(x), np.int64)))
            k = b.column("pairs").flatten().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(pair, k), max(len(pair) - 1, 0))
            hit = pair[at] == k if len(pair) else np.zeros(len(k), bool)
            c = n_pair[at] if len(pair) else np.zeros(len(k), np.int64)
            doc, t, _ = add("pairs", "times", k, lambda x: (np.where(hit, c, 0), x // size_b, hit.astype(np.int64)))
            rest = [_lists(x[~hit], doc[~hit], n, y) for x, y in ((k, pa.int64()), (t, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(x) for x in keep] + [pa.array(out[0]), pa.array(out[1]), *rest],
                                             names=[*keep, "n_best", "count_sum", "rare", "rare_times"])

    keep = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    shape = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, "
             "count_sum long, rare array<long>, rare_times array<long>")
    out = written(rows.mapInArrow(score, shape), "align-scored")
    top = F.broadcast(spark.createDataFrame(list(enumerate(best.tolist())), "a long, top long"))   # A's vocabulary
    rare = (out.filter(F.size("rare") > 0)
            .select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("r"))
            .select("row", F.col("r.rare").alias("pair"), F.col("r.rare_times").alias("t"))
            .join(pairs.filter(~often), "pair")
            .withColumn("a", F.expr(f"pair div {size_b}")).join(top, "a")
            .groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("top"), F.col("t")).otherwise(0)).alias("b2"),
                                F.sum(F.col("n") * F.col("t")).alias("s2")))
    return (out.drop("rare", "rare_times").join(broadcast_if_small(written(rare, "align-rare")), "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                    (F.col("n_best") + F.coalesce("b2", F.lit(0))).cast("long").alias("n_best"),
                    (F.col("count_sum") + F.coalesce("s2", F.lit(0))).cast("long").alias("count_sum"), "groups_sha256"))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256) of every row."""
    import sentencepiece
    rows = aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return scored(written(rows, "align-rows"), size_b, frequent)

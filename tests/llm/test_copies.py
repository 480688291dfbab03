"""Exact and near duplicates."""

import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402
from tidewater.llm import exact_dedup, near_join  # noqa: E402


def test_exact_dedup(odd, sample):
    for docs in (odd, sample):
        want = plain.exact([(r.doc_id, r.text) for r in docs.collect()])
        got = exact_dedup.exact_dedup(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            assert (r.keep_id, r.group_size, r.kept) == want[r.doc_id, r.text_sha256]


def test_survivors_are_read_again(odd, sample):
    """The general form, which reads only survivors, finds the same groups."""
    for docs in (odd, sample):
        *_, a = exact_dedup.duplicate_groups(docs, digest_all=True)
        *_, b = exact_dedup.duplicate_groups(docs)
        cols = ["length", "sha", "group_size", "keep_id"]
        assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def test_deduplicated(odd, sample):
    for docs in (odd, sample):
        want = {k for k, (_, _, kept) in plain.exact([(r.doc_id, r.text) for r in docs.collect()]).items() if kept}
        got = exact_dedup.deduplicated(docs)
        assert got.columns == docs.columns
        assert sorted(map(str, [(r.doc_id) for r in got.collect()])) == sorted(str(i) for i, _ in want)


def mutated(rng, n):
    """Groups of near copies around the threshold, shared passages, short
    texts."""
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for g in range(n):
        base = [f"g{g}w{i}" for i in range(rng.choice([5, 6, 8, 12, 20, 40, 90, 250]))]
        if g % 3 == 0:
            base = passage + base
        for c in range(rng.choice([1, 2, 3, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                at = rng.randrange(len(w))
                w[at:at + rng.choice([0, 1, 1])] = [f"m{rng.randrange(10 ** 6)}"]
            docs.append(" ".join(w) if rng.random() < 0.9 else " ".join(w).upper())
    return docs


@pytest.mark.parametrize("popular", [2, near_join.POPULAR])
def test_near_duplicates(spark, odd, sample, monkeypatch, popular):
    """Also with so few sets a segment may have that most groups need the
    one-deletion index."""
    monkeypatch.setattr(near_join, "POPULAR", popular)
    texts = mutated(random.Random(popular), 60)
    docs = (odd.filter("doc_id is not null").select("doc_id", "text")
            .unionByName(sample.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
            .unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")))
    want = plain.near([(r.doc_id, r.text) for r in docs.collect()])
    got = near_join.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_duplicates_of_odd_rows(odd):
    got = near_join.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert sorted(r.n_shingles for r in got if r.doc_id is None) == [0, 1]
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = near_join.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    component = {r.doc_id: r.component_id for r in got}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(r.doc_id) for r in odd.collect() if component[r.doc_id] == r.doc_id)


def test_buckets_over_many_batches(spark):
    """A bucket that spans Arrow batches is one bucket."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    sigs = spark.createDataFrame([(n, [(k << 2) | 2 | (n == 3) for k in (1, 2, 3 + n, 90)]) for n in range(1, 30)]
                                 + [(40, [(91 << 2) | 2]), (41, [(91 << 2) | 2])], "node long, sigs array<long>")
    seen = []
    try:
        for size in (1, 2, 7, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            seen.append((sorted(map(str, near_join.shared_buckets(sigs, 5).collect())),
                         sorted(map(str, near_join.wide_buckets(sigs).collect()))))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert all(s == seen[0] for s in seen)
    narrow, broad = seen[0]
    assert sum("popular=True" in r for r in narrow) == 3 * 29 and sum("key=91," in r for r in narrow) == 2
    assert len(broad) == 3 * 29 + 2


def test_linked_sets_share_what_the_pigeonhole_promises():
    """Random pairs at or above the threshold: enough common parts at every
    level, and sketches no further apart than the sets."""
    rng = np.random.default_rng(4)
    fresh = iter(rng.integers(1, 2 ** 63, 800_000, dtype=np.uint64))
    linked = 0
    for _ in range(1200):
        s = int(rng.choice([4, 5, 6, 9, 13, 20, 31, 40, 90, 200, 600, 1500]) * rng.uniform(1, 1.5))
        a = [next(fresh) for _ in range(s)]
        change = int(rng.integers(0, s // 8 + 2))
        b = a[:s - change] + [next(fresh) for _ in range(int(rng.integers(0, change + 2)))]
        common, union = s - change, len(b) + change
        if not b or 100 * common < 80 * union:
            continue
        linked += 1
        sets = [np.sort(np.array(x, np.uint64)) for x in (a, b)]
        h, bounds = np.concatenate(sets), np.array([0, s, s + len(b)])
        x, y = near_join.parity_sketches(h, bounds)
        words = near_join.parity_words(h, bounds)
        assert near_join.sketch_distance(x, y) <= union - common
        assert int(np.bitwise_count((words[0] ^ words[1]).view(np.uint64)).sum()) <= union - common
        if change == 0 and len(b) == s:
            continue
        both = np.ones((2, 2), bool)
        small = min(s, len(b))
        band = int(np.searchsorted(near_join.LOW, small, side="right")) - 1
        for level, wide in ((1, None), (2, both), (3, both)):
            offsets, values = near_join.signatures(h, bounds, wide, level)
            one, two = values[:offsets[1]], values[offsets[1]:]
            plain = {int(v) >> 2 for v in one if not v & 1} & {int(v) >> 2 for v in two if not v & 1}
            keys = ({int(v) >> 2 for v in one if not v & 1} & {int(v) >> 2 for v in two}) | (
                {int(v) >> 2 for v in one} & {int(v) >> 2 for v in two if not v & 1})
            if level == 1 and near_join.PLAIN[band]:
                assert len(plain) >= 1 + near_join.slack(small)
            elif level == 2:
                assert len(keys) >= 1 + near_join.wide_slack(small)
            else:
                assert keys
    assert linked > 400


def test_no_rows(none):
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.deduplicated(none).count() == 0
    assert near_join.near_duplicates(none).count() == 0
    assert near_join.without_near_duplicates(none).columns == none.columns


def test_shingles_of_a_batch_are_held_in_small_parts():
    """A worker describes at most SLICE bytes of texts at once, and loses none."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": [f"w{i} " * 3000 for i in range(300)]})
    parts = [(b.num_rows, b.column("text").to_pylist(), len(bounds)) for b, _, bounds in near_join._sets_of([batch])]
    assert sum(n for n, _, _ in parts) == 300 and all(k == n + 1 for n, _, k in parts)
    assert all(sum(map(len, texts)) <= 1 << 19 for _, texts, _ in parts)

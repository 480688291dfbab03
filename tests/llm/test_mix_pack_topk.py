"""Mixing, packing and exact top-k against plain versions."""

import itertools
import os
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402
from tidewater.llm import mixing, packing, topk  # noqa: E402


# -------------------------------------------------------------------- mixing
def check_mix(docs):
    got = mixing.mix(docs).collect()
    rows = docs.collect()
    size = Counter()
    for r in rows:
        size[r.source] += len(plain.words(r.text))
    goal = plain.targets(dict(size))
    assert sorted((plain.id_key(r.doc_id), r.size) for r in got) == sorted(
        (plain.id_key(r.doc_id), len(plain.words(r.text))) for r in rows)
    taken, biggest = Counter(), Counter()
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - goal[r.source]) < 1e-6 * max(1, goal[r.source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    for s in size:
        assert abs(taken[s] - goal[s]) <= biggest[s]
    assert sorted(map(str, mixing.mix(docs.repartition(5)).collect())) == sorted(map(str, got))  # reruns agree
    return got


def test_mix(sample):
    check_mix(sample)


def test_mix_of_odd_rows(odd, none):
    check_mix(odd.filter("doc_id <> 15 or doc_id is null"))
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_targets_reshare_what_is_above_the_cap(spark):
    for sizes in ({"a": 1, "b": 1000, "c": 10}, {"a": 5, "b": 5, "c": 900, "d": 2, None: 50}, {"a": 0, "b": 7}, {"x": 3}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = plain.targets({s: n for s, n in sizes.items()}) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mixed_documents_are_the_copies(sample, odd):
    for docs in (sample, odd):
        rows = mixing.mixed_documents(docs)
        assert rows.columns == docs.columns
        want = Counter()
        for r in mixing.mix(docs).collect():
            want[r.doc_id] += r.copies
        assert Counter(r.doc_id for r in rows.collect()) == +want


# ------------------------------------------------------------------- packing
def best_padding(lengths, buckets):
    points = sorted(set(lengths))
    cost = lambda bounds: sum(min(b for b in bounds if b >= n) - n for n in lengths)
    return min(cost((*cut, points[-1])) for k in range(min(buckets, len(points)))
               for cut in itertools.combinations(points[:-1], k))


def test_bounds_are_optimal():
    rng = np.random.default_rng(2)
    for n, buckets in ((1, 3), (5, 2), (9, 3), (12, 4), (30, 3)):
        lengths = rng.integers(0, 40, n)
        values, counts = np.unique(lengths, return_counts=True)
        bounds = packing.best_bounds(values.astype(float), counts, values * counts, buckets)
        got = sum(min(b for b in bounds if b >= x) - x for x in lengths.tolist())
        assert len(bounds) <= buckets and got == best_padding(lengths.tolist(), buckets)


def check_packs(rows, budget, buckets):
    assert len({r.bucket_len for r in rows}) <= buckets
    batches = Counter((r.bucket, r.batch) for r in rows)
    places = {(r.bucket, r.batch, r.slot) for r in rows}
    assert len(places) == len(rows)
    for r in rows:
        assert 0 <= r.padding == r.bucket_len - r.length
        assert r.slot < batches[r.bucket, r.batch]
        assert r.bucket_len * batches[r.bucket, r.batch] <= max(budget, r.bucket_len)
    for b in {r.bucket for r in rows}:  # only a bucket's last batch is not full
        sizes = [n for (k, _), n in sorted(batches.items()) if k == b]
        assert len(set(sizes[:-1])) <= 1 and sizes[-1] <= sizes[0]
        assert sorted({r.batch for r in rows if r.bucket == b}) == list(range(len(sizes)))


@pytest.mark.parametrize("budget", [1, 3000])
def test_packing(sample, odd, none, budget):
    for docs in (sample, odd):
        rows = packing.pack_documents(docs, buckets=5, budget=budget).collect()
        assert sorted((plain.id_key(r.doc_id), r.length) for r in rows) == sorted(
            (plain.id_key(r.doc_id), len(plain.words(r.text))) for r in docs.collect())
        check_packs(rows, budget, 5)
    assert packing.pack_documents(none).count() == 0


def test_query_and_stage_pack_by_tokens(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    import corpus_pipeline
    from tidewater.llm.queries import QUERIES
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sf = "/root/testdata/sf0.001"
    unspaced = spark.createDataFrame([(i, "漢字かな交じり文" * 500) for i in range(1000, 1040)], "doc_id long, text string")
    odd = odd.select("doc_id", "text").union(unspaced)
    for docs, packed in ((spark.read.parquet(f"{sf}/documents.parquet"), QUERIES["op7_packing"](spark, sf)),
                         (odd, corpus_pipeline.pack(spark, odd, sf))):
        rows = packed.collect()
        tokens = sorted((plain.id_key(r.doc_id), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
        assert sorted((plain.id_key(r.doc_id), r.length) for r in rows) == tokens
        check_packs(rows, packing.TOKEN_BUDGET, packing.BUCKETS)
    assert corpus_pipeline.pack(spark, none, sf).count() == 0


def test_bounds_are_lengths_of_documents(spark):
    rng = np.random.default_rng(4)
    sized = [1, 5, 700, 1025, 1027, 4099, 4111, 65537, *rng.integers(1025, 10 ** 6, 40).tolist()]
    rows = packing.pack(spark.createDataFrame(list(enumerate(sized)), "doc_id long, length long"), buckets=4).collect()
    check_packs(rows, packing.TOKEN_BUDGET, 4)
    assert {r.bucket_len for r in rows} <= set(sized) and max(r.bucket_len for r in rows) == max(sized)


def test_grid(spark):
    d = spark.range(0, 5000).union(spark.createDataFrame([(10 ** 6 + i,) for i in range(50)] + [(2 ** 31,)], "id long"))
    for r in d.select("id", packing.grid(F.col("id")).alias("g")).collect():
        assert r.g >= r.id and (r.id > 1024 or r.g == r.id) and r.g - r.id < max(1, r.id / 500)


def test_one_length_for_all(spark):
    docs = spark.range(0, 500).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = packing.pack_documents(docs, budget=30).collect()
    assert {r.padding for r in rows} == {0} and {r.bucket_len for r in rows} == {3}
    check_packs(rows, 30, 16)


# --------------------------------------------------------------------- top-k
def best(rows, k=20, every=20):
    """From (id, whole numbers) pairs; the rows of an id ask together, and
    none of them is a candidate."""
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(x, y)), j) for i, x in rows if i == q
                        for j, y in rows if j != q and len(x) == len(y))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def usable(e):
    return e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e)


def test_top_k(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, np.floor(64 * np.array(r.embedding, float)).astype(int).tolist()) for r in vectors.collect()]
    for block, group in ((8192, 8192), (60, 7)):
        got = topk.top_k(vectors, block=block, group=group).collect()
        assert sorted(map(tuple, got)) == best(rows)


def test_top_k_with_ties_and_odd_vectors(spark, none):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), 1.0, -0.5]) for i in range(100)] + [
        (100, None), (120, [1.0, None, 2.0]), (140, [nan, 1.0, 1.0]), (160, [inf, 0.0, 0.0]), (180, []), (None, [1.0, 1.0, 1.0]),
        (200, [1.0, 2.0]), (201, [0.5, -2.0]), (7, [9.0, 9.0, 9.0]), (220, [1e6, -1e6, 3.0]), (221, [1e9, 1e9, 1e9])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in ("dim", "v", "b", "g")])
    want = best([(i, np.floor(64 * np.array(e)).tolist()) for i, e in rows if i is not None and usable(e)])
    for block in (8192, 16):
        assert sorted(map(tuple, topk.top_k(vectors, block=block).collect())) == want
    assert topk.top_k(vectors.limit(0)).count() == 0


def test_top_k_with_large_components_and_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(size=4) * 10.0 ** rng.integers(-1, 3 if i % 20 == 0 else 7)).tolist())
            for i in rng.integers(0, 60, 300)]
    rows += [(1003, [1e12, 1.0, 0.0, 0.0]), (1001, [1e11, 0.0, 0.0, 0.0]), (20, [1e3, 1e3, 0.0, 0.0]), (20, [1e3, 1e3, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = best([(i, np.floor(64 * np.array(e)).tolist()) for i, e in rows])
    assert any(r[3] > 2 ** 53 for r in want) and len({r[0] for r in want}) == 3
    for block, group in ((8192, 8192), (50, 3)):
        assert sorted(map(tuple, topk.top_k(vectors, block=block, group=group).collect())) == want


def test_top_k_says_when_a_score_is_no_long(spark):
    far = spark.createDataFrame([(0, [1e12, 1e12]), (1, [1e12, 0.0]), (2, [1e11, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(far).collect()
    away = far.filter("vec_id > 0").union(spark.createDataFrame([(20, [0.0, 1.0])], far.schema))
    assert sorted(map(tuple, topk.top_k(away).collect())) == [(20, 1, 1, 0), (20, 2, 2, 0)]


def test_whole_scores_order_rows_that_floats_cannot():
    q = np.array([[2.0 ** 60, 1.0]])
    x = np.array([[2.0 ** 60, float(i)] for i in (3, 9, 1, 7)] + [[-2.0 ** 60, 5.0]])
    at, scores = topk.Lists(np.arange(5), x).top(q, np.array([99]), 3)[0]
    assert at.tolist() == [1, 3, 0] and scores == [2 ** 120 + 9, 2 ** 120 + 7, 2 ** 120 + 3]
    high, low = topk.two_longs(scores)
    assert [int(h) * 2 ** 60 + int(v) for h, v in zip(high, low)] == scores

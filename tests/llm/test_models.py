"""Personal data, quality, language: whole texts, held-out accuracy, odd rows."""

import hashlib
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402
from tidewater.llm import language, pii, quality  # noqa: E402
from tidewater.llm.boosting import boost  # noqa: E402
from tidewater.llm.common import text_slices  # noqa: E402


@pytest.fixture(scope="module")
def larger(spark):
    sf = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


# ------------------------------------------------------------- personal data
def test_base_spans_of_random_texts():
    rng = random.Random(5)
    for alphabet, size in (("aZ09@@..+-% ()1234567é\n_", 40), ("0123456789 -.+", 60), ("4111 ", 40)):
        for _ in range(4000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, size)))
            assert pii.base_spans(t) == plain.base_spans(t), t


def test_long_runs_take_linear_time():
    for t in ("a" * 10 ** 6, "1" * 10 ** 6, "+1 " * 200_000, "a@" * 100_000, "1." * 200_000, "1 -" * 200_000):
        pii.candidates(t)
        pii.base_spans(t)


def test_pii_query_rows(spark, odd, larger):
    docs = larger[0].select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = pii.find_pii(docs).collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    want = sorted((plain.id_key(r.doc_id), hashlib.sha256(",".join(
        f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain.base_spans(r.text)).encode()).hexdigest()) for r in rows)
    assert sorted((plain.id_key(r.doc_id), r.base_sha256) for r in got) == want
    for r in got:
        assert len(r.spans.split(",")) == (r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added or 1)
    # clean documents gain next to nothing
    assert sum(r.n_added for r in got) <= 0.01 * sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got)


def test_spelt_forms_are_added(spark, larger):
    model = pii.fit(larger[0])
    texts = [(1, "write to jane.doe (at) example (dot) org please"), (2, "the host 10[.]20[.]30[.]40 is down"),
             (3, "order 20240101-123456 of version 1.2"), (4, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_pii(docs, model).collect()}
    assert got == {1: "email:9:40", 2: "ip:9:26", 3: "", 4: ""}
    clean = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    assert clean[1] == "write to [EMAIL] please" and clean[3] == texts[2][1] and clean[4] is None


def test_candidates_of_any_length():
    for n in (1, 63, 64, 65, 70, 300):
        a = "x" * n
        spelt = f"to {a}.b (at) {a} (dot) {a}" + " [dot] k" * n
        assert (3, 0, len(spelt)) in pii.candidates(spelt + " !")
        plain_form = f"<{a}@{a}{a}.é>"
        assert (1, 0, len(plain_form) - 1) in pii.candidates(plain_form)
    assert {(k, a, b) for a, k, b in pii.candidates("a@b@c")} == {(0, 0, 3), (0, 2, 5)}


def test_a_small_sample_calibrates_every_kind_it_shows(spark):
    """A dozen examples of a kind are enough; a kind that never occurs adds nothing."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    texts = [f"mail {word()}@{word()}.org or {word()} @{word()} at {word()}@{word()}" for _ in range(12)]
    texts += [f"host 10.{i}.3.{i * 7} and version {i}.2.{i + 300}.4" for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, thresholds = pii.fit(docs)
    assert model is not None and thresholds[0] <= 1 and thresholds[1] <= 1 and thresholds[2] == 2 and thresholds[3] == 2
    got = pii.find_pii(docs, (model, thresholds)).collect()
    assert all(r.n_spans == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added for r in got)
    assert pii.fit(docs, max_candidates=1)[1] == [2.0] * 4
    assert pii.train(np.zeros((3, 4)), np.array([True, False, False])) == (None, [2.0] * 4)


def test_every_candidate_is_learnt_from(spark):
    """Descriptions are counted over all documents, whatever their number, and
    coarser ones still count every candidate."""
    spelt = "to jane (at) example (dot) org"
    texts = [f"mail a{'b' * (i % 150)}@example.org {i % 10 ** 4}" for i in range(24_000)] + [spelt] * 6000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cells = pii.described(docs)
    base = sum(len(set(pii.base_spans(t)) & set(pii.candidates(t))) for t in texts)
    total = lambda c: tuple(c.groupBy().sum("pos", "neg").first())
    assert total(cells) == (base, 6000) and base == 24_000
    for bins in (16, 2, 1):
        fewer = pii.coarser(cells, bins)
        assert total(fewer) == (base, 6000) and fewer.count() < cells.count()
        kinds = fewer.selectExpr("slice(x, 1, 4) k", "pos", "neg").groupBy("k").sum("pos", "neg").collect()
        assert [tuple(r) for r in kinds] == [([1, 0, 0, 0], base, 6000)]
    model, thresholds = pii.fit(docs, max_candidates=40)
    assert model is not None and thresholds[0] <= 1


def test_weights_count_as_copies():
    rng = np.random.default_rng(3)
    x, n = rng.integers(0, 6, (200, 5)).astype(float), rng.integers(1, 9, 200)
    x[:, 0] = 1
    y = x[:, 1] + x[:, 2] > rng.integers(2, 9, 200)
    one, two = pii.train(np.repeat(x, n, axis=0), np.repeat(y, n)), pii.train(x, y, n)
    assert np.allclose(one[1], two[1]) and all(np.allclose(a, b) for a, b in zip(one[0], two[0]))
    assert pii.parts_of(np.array([4, 1, 2])).tolist() == [[2, 1, 1], [0, 1, 0], [1, 0, 1]]
    v = np.arange(0, 5000)
    r = pii.rounded_up(v)
    assert (r[:65] == v[:65]).all() and (r >= v).all() and (r <= v * 33 / 32 + 1).all() and (pii.rounded_up(r) == r).all()


def test_trees_learn_an_interaction():
    x = np.random.default_rng(0).random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    assert ((boost(x, y).probability(x) > 0.5) == y).mean() > 0.95


# ------------------------------------------------------------------- quality
def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_quality_on_held_out_labels(larger):
    docs, labels = larger
    got = quality.score_quality(docs, labels)
    assert got.count() == docs.count()
    rows = got.filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    assert auc(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.99
    assert (rows["predicted"] == rows["quality"]).mean() > 0.97
    assert rows.loc[rows["quality"] == 1, "predicted"].mean() > 0.99
    prior = got.first().class_prior
    assert abs(prior - labels.agg(F.avg("quality")).first()[0]) < 0.15


def test_quality_never_reads_held_out_labels(larger):
    docs, labels = larger
    docs, labels = docs.limit(1500), labels
    wrong = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (dict(quality.score_quality(docs, x).select("doc_id", "score").collect()) for x in (labels, wrong))
    assert one == two


def test_quality_where_all_documents_are_labelled(larger):
    docs, labels = larger
    labels = labels.join(docs.select("doc_id"), "doc_id")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = quality.score_quality(docs, labels).filter("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    assert auc(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.98
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95 and rows["score"].nunique() > 10


def plain_risk(w, pos, unl, prior):
    """The non-negative unbiased risk, row by row."""
    loss = lambda z, y: float(np.log1p(np.exp(-y * z)))
    margin = lambda cell: sum(w[c] for c in cell) + w[-1]
    as_pos = sum(loss(margin(c), 1) for c in pos) / len(pos)
    as_neg = sum(loss(margin(c), -1) for c in pos) / len(pos)
    rest = sum(loss(margin(c), -1) for c in unl) / len(unl) - prior * as_neg
    return prior * as_pos + max(0.0, rest)


def test_quality_minimises_the_risk_of_the_direct_formula():
    rng = np.random.default_rng(2)
    pos, unl = rng.integers(0, 3, (40, 1)), rng.integers(0, 5, (60, 1))
    prior, size = 0.4, 6
    w = quality.non_negative_risk(pos, unl, prior, size)
    at = plain_risk(w, pos, unl, prior)
    assert at < plain_risk(np.zeros(size), pos, unl, prior) - 0.05
    # no random direction leads to a clearly smaller risk
    tries = [plain_risk(w + rng.normal(0, scale, size), pos, unl, prior) for scale in (0.05, 0.3, 1, 3) for _ in range(100)]
    assert at <= min(tries) + 0.02


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1), (4, 1), (7, 0), (16, 1)], "doc_id long, quality int")
    got = quality.score_quality(odd, labels.select("*", F.lit("?").alias("text"))).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(none, labels).count() == 0
    bare = quality.score_quality(odd, labels.limit(0)).collect()
    assert {r.score for r in bare} == {0.5}


def test_features_do_not_depend_on_the_slice():
    col = pa.array(["", None, "  a b", "\n\n x\ny y", " ", "é é", "word", "A B! A B! |", "x" * 50] * 3)
    whole = np.concatenate([quality.features(d, o) for _, _, d, o in text_slices(col)])
    alone = np.concatenate([quality.features(d, o) for i in range(len(col)) for _, _, d, o in text_slices(col.slice(i, 1))])
    assert np.allclose(whole, alone) and not np.isnan(whole).any()


# ------------------------------------------------------------------ language
def test_language_on_held_out_rows(larger):
    docs, _ = larger
    got = language.identify(docs)
    rows = got.join(docs, "doc_id").filter("held_out").select("lang", "lang_pred", "score", "rejected").toPandas()
    assert (rows["lang"] == rows["lang_pred"]).mean() > 0.99
    assert rows["score"].between(0, 1).all() and rows["rejected"].mean() < 0.005


def test_language_never_reads_held_out_rows(sample):
    wrong = sample.withColumn("lang", F.when(language.held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(x).collect()} for x in (sample, wrong))
    assert one == two


def test_language_of_odd_rows(odd, none):
    rows = {(r.doc_id, r.text): r for r in odd.collect()}
    got = language.identify(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    for i in (4, 5, 6, 7):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    learned = {lang for (i, t), r in rows.items() if (lang := r.lang) and not plain.held_out(i)}
    assert {r.lang_pred for r in got} <= learned | {"und"}
    assert language.identify(none).count() == 0
    assert {r.lang_pred for r in language.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language.identified(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id in (4, 5, 6, 7)").isEmpty()


def test_far_texts_are_rejected(spark, larger):
    model = language.fit(larger[0])
    assert model.predict(["жизнь прожить не поле перейти " * 200])[2].all()


def test_short_far_texts_are_rejected_in_each_band(spark, larger):
    model = language.fit(larger[0])
    assert (model.floor > 0).all()
    far = ["жизньпрожитьнеполеперейти", "漢字かな交じり文を書くのは難しい", "ηζωήείναιωραίαότανέχειήλιο"]
    texts = [(f * 20)[a:a + n] for f in far for a in range(8) for n in (1, 2, 4, 8, 16, 32, 64, 100, 200)]
    band, rejected = language.length_band(language.gram_counts(texts).sum(axis=1)), model.predict(texts)[2]
    for k in range(2, 10):  # a letter that is no ASCII letter has five n-grams at least
        # hashes of so few n-grams meet those of a language by chance
        assert rejected[band == k].mean() >= (0.9 if k < 4 else 1), k
    rng = random.Random(3)
    letters = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(n)) for n in (40, 80, 160) for _ in range(100)]
    assert model.predict(letters)[2].mean() > 0.9


def test_short_texts_of_the_languages_are_kept(larger):
    short = larger[0].filter(F.length("text") < 250)
    model = language.fit(larger[0])
    rows = language.identify(short, model).filter("held_out and lang_pred <> 'und'").collect()
    assert len(rows) > 50 and sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_floors_pool_neighbouring_bands():
    band, cosine = np.array([2] * 60 + [3] * 60 + [7] * 100), np.array([0.4] * 60 + [0.2] * 60 + [0.8] * 100)
    floor = language.floors(band, cosine) / language.FLOOR_SLACK
    assert np.allclose(floor[[0, 2, 3, 4]], 0.2) and np.allclose(floor[[7, 8, 15]], 0.8)
    assert np.allclose(language.floors(band[:3], cosine[:3]), 0.4 * language.FLOOR_SLACK)
    assert not language.floors(band[:0], cosine[:0]).any()


def test_a_row_is_not_its_own_neighbour():
    x = np.eye(3, dtype=np.float32)[[0, 0, 1]]
    got = language.cosine_to_others(x, np.eye(3, dtype=np.float32)[:2])
    assert np.allclose(got, [1, 1, 0])
    assert np.isneginf(language.cosine_to_others(x[2:], x[2:])).all()


def test_language_sample_is_vectorised_in_pieces():
    """A language's sample never needs several times its own vectors."""
    import tracemalloc

    import numpy as np
    from tidewater.llm import language as L
    texts = [f"word{i} some more words " * 60 for i in range(1200)] + [""]
    idf = np.linspace(1, 2, L.DIM).astype(np.float32)
    tracemalloc.start()
    x, band = L.sample_vectors(texts, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    counts = L.gram_counts(texts[:-1])
    assert np.array_equal(x, L.unit(counts, idf)) and np.array_equal(band, L.length_band(counts.sum(axis=1)))
    assert peak < 2.5 * x.nbytes

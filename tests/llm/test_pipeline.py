"""The pipeline, stage by stage, against plain versions; guards."""

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import plain  # noqa: E402
import corpus_pipeline  # noqa: E402
from tidewater.llm import language, mixing  # noqa: E402
from tidewater.llm.common import written  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, sample):
    docs = sample
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), "test-stage")
        before, after = docs.collect(), out.collect()
        if name != "pack":
            assert out.columns == docs.columns
            whole = {tuple(r) for r in before}
            assert all(tuple(r) in whole for r in after)
        ids = sorted(r.doc_id for r in after)
        if name == "language":
            drop = {r.doc_id for r in language.identify(docs).filter("rejected").collect()}
            assert ids == sorted(r.doc_id for r in before if r.doc_id not in drop)
        elif name == "exact":
            kept = plain.exact([(r.doc_id, r.text) for r in before])
            assert ids == sorted(i for (i, _), (_, _, keep) in kept.items() if keep)
        elif name == "near":
            comp = plain.near([(r.doc_id, r.text) for r in before])
            assert ids == sorted(i for i, (_, c) in comp.items() if c == i)
        elif name == "mix":
            want = Counter({r.doc_id: r.copies for r in mixing.mix(docs).collect()})
            assert Counter(ids) == +want
        else:
            assert ids == sorted(r.doc_id for r in before)
        docs = out


def test_odd_rows_and_no_rows(spark, odd, none):
    ids = lambda d: Counter(r.doc_id for r in d.collect())
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, SF), "test-odd")
            if name == "pack":
                assert ids(out) == ids(docs)
            else:
                assert out.columns == docs.columns
                assert ids(out).keys() <= ids(docs).keys()
            if name == "language":
                assert not {4, 5, 6, 7} & ids(out).keys()               # null, empty, blank, without a letter
            elif name == "exact" and docs.count():
                assert max(ids(out).values()) == 1                      # rows that repeat id and text stay once
                assert sum(i in ids(out) for i in (20, 25)) <= 1 and not {10, 13} <= ids(out).keys()
            docs = out
    assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "bucket", "batch", "slot"} <= set(rows[0].asDict())


def test_queries_and_oracles(spark):
    import duckdb
    import __spark_entry__ as entry
    from tidewater.llm.queries import ORACLE, QUERIES
    from tools.check_oracle import digest
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SF)
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert digest(cols, cur.fetchall())[0] == digest(df.columns, [tuple(r) for r in df.collect()])[0]

"""Plan-shape checks: the properties that matter at scale, read from the
physical plan of small inputs."""

from pyspark.sql import functions as F

from tidewater.operators import iterate as IT
from tidewater.plans import sequence as S


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_agg_shuffle_join_keeps_window_partitioning(spark):
    """With broadcast off, the join of rows and bucket offsets must hash on
    the window's own columns: the big side is shuffled once, only the small
    offsets table moves again.  NULL keys still get their own running count."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in names]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(k, i) for i in range(40) for k in ("a", None, "b")]
        df = spark.createDataFrame(rows, "k string, i long")
        out = S.running_agg(df, ["k"], ["i"], S.seq_bucket("i", 7), [("n", F.lit(1), "count")])
        plan = _plan(out)
        got = sorted((r.k or "", r.i, r.n) for r in out.collect())
        assert got == sorted((k or "", i, i + 1) for k, i in rows)
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in zip(names, old):
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in plan or "SortMergeJoin" in final
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("coalesce(" in line for line in exchanges)


def test_kmeans_assignment_ships_only_the_vector(spark):
    pts = spark.createDataFrame([(1, [0.0, 0.0], "x"), (2, [5.0, 5.0], "y"), (3, None, "z")],
                                "id long, v array<double>, tag string")
    out = IT.kmeans_assign(pts, "v", [(7, [4.0, 4.0]), (3, [0.5, 0.5]), (9, [0.5, 0.5])])
    assert sorted((r.id, r.cluster_id) for r in out.collect()) == [(1, 3), (2, 7), (3, None)]
    py = [line for line in _plan(out).splitlines() if "ArrowEvalPython" in line]
    assert py and "tag" not in py[0]


def test_sequential_queries_scan_once_and_exchange_little(spark):
    """The final plan of a sequential query reads bucketed rows, not the
    source again, and has few exchanges even if nothing is broadcast."""
    import re
    import __spark_entry__ as entry
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = [spark.conf.get(k, None) for k in names]
    most = {"session_sum": 5, "rising_alert": 5, "top_speed_delta": 5, "running_wordcount": 4, "late_side_output": 4,
            "jump_alert": 3, "over_rows_2_preceding": 3, "changelog_count": 4}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, bound in most.items():
            plan = _plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
            assert len(re.findall(r"(?<!Reused)Exchange (?:hash|range|Single)", plan)) <= bound, name
            assert "testdata" not in plan, name
    finally:
        for k, v in zip(names, old):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_splits_scan_the_input_once(spark):
    import __spark_entry__ as entry
    for name in ("split_then_union", "connect_comap", "tokenize_variants"):
        plan = _plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert plan.count("FileScan") == 1, name

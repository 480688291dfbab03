"""Operators on small hand-worked fixtures (expected values worked out from
the stated rules)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import aggregates as A
from tidewater.operators import changelog as CL
from tidewater.operators import countwindows as CW
from tidewater.operators import folds as FO
from tidewater.operators import iterate as IT
from tidewater.operators import keyed as K
from tidewater.operators import late as L
from tidewater.operators import relational as R
from tidewater.operators import timewindows as TW
from tidewater.plans import sequence as S

ORDER = ["ts", "seq"]


def bucket(width_s=2):
    # tiny buckets so every two-level scan crosses bucket edges
    return S.time_bucket("ts", width_s)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_filters(sensors):
    assert sensors.filter(F.col("id") == "sensor_1").count() == 3
    assert R.prefix_filter(sensors, "id", "sensor_1").count() == 4


def test_split_and_comap(sensors):
    high, low = R.split_by_threshold(sensors, "temperature", 37.0)
    assert sorted(r.temperature for r in high.collect()) == [37.6, 38.3, 39.6]
    assert low.count() == 4
    high30, low30 = R.split_by_threshold(sensors, "temperature", 30.0)
    assert (high30.count(), low30.count()) == (7, 0)
    out = R.connect_comap(high, low, lambda d: d.select("id", "temperature", F.lit("warning").alias("status")),
                          lambda d: d.select("id", F.lit("healthy").alias("status")))
    st = [r.status for r in out.collect()]
    assert st.count("warning") == 3 and st.count("healthy") == 4
    assert all(r.temperature is None for r in out.filter("status = 'healthy'").collect())


def test_running_reduce(sensors):
    r = K.running_reduce_latest_step(sensors, "id", ORDER, bucket(), "time_stamp", 10)
    assert rows(r.filter("id = 'sensor_1'"), "time_stamp", "temperature") == [
        (1612523073, 35.6), (1612523083, 39.6), (1612523093, 36.6)]
    assert rows(r.filter("id = 'sensor_10'"), "time_stamp") == [(1612523073,)]


def test_tumble_min_last(sensors):
    r = TW.tumble(sensors, ["id"], "ts", "15 seconds",
                  [F.min("temperature").alias("m"), F.max_by("ts", "seq").alias("last")])
    got = {(x.id, int(x.window_start.timestamp()) % 1000): (x.m, int(x.last.timestamp()) % 1000)
           for x in r.collect()}
    assert got == {("sensor_1", 70): (35.6, 75), ("sensor_10", 70): (36.6, 73), ("sensor_2", 85): (36.1, 91),
                   ("sensor_3", 115): (37.6, 129), ("sensor_4", 130): (38.3, 135)}


def test_tumble_count_avg_end(sensors):
    r = TW.tumble(sensors, ["id"], "ts", "10 seconds",
                  [F.count("id").alias("c"), F.round(F.avg("temperature"), 6).alias("a")])
    got = {x.id: (x.c, x.a, int(x.window_end.timestamp()) % 1000) for x in r.collect()}
    assert got == {"sensor_1": (3, 37.266667, 80), "sensor_10": (1, 36.6, 80), "sensor_2": (1, 36.1, 100),
                   "sensor_3": (1, 37.6, 130), "sensor_4": (1, 38.3, 140)}


def test_rows_two_preceding(sensors):
    r = K.rows_frame(sensors, ["id"], ORDER, bucket(1), 2,
                     {"c": lambda w: F.count("id").over(w),
                      "a": lambda w: F.round(F.avg("temperature").over(w), 6)})
    assert rows(r.filter("id = 'sensor_1'"), "seq", "c", "a") == [(1, 1, 35.6), (2, 2, 37.6), (3, 3, 37.266667)]


def test_jump_alerts(sensors):
    assert K.jump_alert(sensors, "id", ORDER, bucket(), "temperature", 10.0).count() == 0
    z = K.jump_alert(sensors, "id", ORDER, bucket(), "temperature", 10.0, initial=0.0)
    assert rows(z, "id", "last_value") == [(i, 0.0) for i in
                                           ["sensor_1", "sensor_10", "sensor_2", "sensor_3", "sensor_4"]]


def test_top2(sensors):
    r = A.top_n_filled(sensors, ["id"], "temperature", 2)
    got = rows(r, "id", "temp", "rank")
    assert ("sensor_1", 39.6, 1) in got and ("sensor_1", 36.6, 2) in got
    assert ("sensor_4", 38.3, 1) in got and ("sensor_4", 0.0, 2) in got
    assert len(got) == 10


def test_java_hash(sensors):
    r = sensors.select("id", T.scaled_hash("id", 2).alias("h")).distinct()
    assert dict((x.id, x.h) for x in r.collect()) == {
        "sensor_1": -1770738192, "sensor_10": 941720992, "sensor_2": -1770738190,
        "sensor_3": -1770738188, "sensor_4": -1770738186}


def test_lateral_split(sensors):
    r = sensors.select("id", F.explode(T.split_drop_trailing("id", "_")).alias("w")).withColumn("n", F.length("w"))
    assert rows(r.filter("id = 'sensor_10'"), "w", "n") == [("10", 2), ("sensor", 6)]


def test_changelog_count(sensors):
    r = CL.changelog_count(sensors, "id", ORDER, bucket(1), carry=["seq"])
    got = [(x.is_add, x.cnt) for x in sorted(r.filter("id = 'sensor_1'").collect(), key=lambda x: (x.seq, x.step))]
    assert got == [(True, 1), (False, 1), (True, 2), (False, 2), (True, 3)]


def test_upsert_latest(sensors):
    from tidewater.sinks.upsert import latest_per_key
    r = latest_per_key(sensors, ["id"], ORDER)
    assert dict((x.id, x.temperature) for x in r.collect()) == {
        "sensor_1": 36.6, "sensor_10": 36.6, "sensor_2": 36.1, "sensor_3": 37.6, "sensor_4": 38.3}


def test_split_drop_trailing_shapes(spark):
    df = spark.createDataFrame([("a_b__",), ("",), ("___",), ("_a",), (None,)], "s string")
    got = [r[0] for r in df.select(T.split_drop_trailing("s", "_")).collect()]
    assert got == [["a", "b"], [""], [], ["", "a"], None]


def test_semicolon_wordcount_counts_header(spark):
    # The three-line semicolon CSV resource.
    lines = spark.createDataFrame([("name;age;job",), ("Jorge;30;Developer",), ("Bob;32;Developer",)], "value string")
    r = lines.select(F.explode(T.split_drop_trailing("value", ";")).alias("w")).groupBy("w").count()
    got = dict((x.w, x["count"]) for x in r.collect())
    assert got["Developer"] == 2 and got["name"] == 1 and len(got) == 8


def test_session_windows(spark):
    data = [("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1), ("c", 6, 1), ("a", 10, 1), ("c", 11, 1)]
    df = (spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "seq long, key string, ms long, n int")
          .withColumn("ts", F.timestamp_millis("ms")))
    r = TW.session_windows(df, ["key"], "ts", "seq", 0.003, [F.sum("n").alias("n")], bucket=S.time_bucket("ts", 1))
    got = sorted((x.key, int(x.session_start.timestamp() * 1000), x.n) for x in r.collect())
    assert got == [("a", 1, 1), ("a", 10, 1), ("b", 1, 3), ("c", 6, 1), ("c", 11, 1)]


def test_session_windows_gap_rule(spark):
    df = (spark.createDataFrame([(1, "k", 0), (2, "k", 600), (3, "k", 1201), (4, "k", 1800)],
                                "seq long, key string, s long")
          .withColumn("ts", F.timestamp_seconds("s")))
    r = TW.session_windows(df, ["key"], "ts", "seq", 600, [F.count(F.lit(1)).alias("c")], bucket=S.time_bucket("ts", 500))
    # 0 and 600 are exactly one gap apart (same session); 1201 starts a new one
    assert sorted(x.c for x in r.collect()) == [2, 2]


def test_orders_union(spark):
    a = spark.createDataFrame([(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], "user long, product string, amount int")
    b = spark.createDataFrame([(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], "user long, product string, amount int")
    s1 = spark.sql("SELECT * FROM {a} WHERE amount > 2 UNION ALL SELECT * FROM {b} WHERE amount < 2", a=a, b=b)
    assert rows(s1, "product", "amount") == [("beer", 1), ("beer", 3), ("diaper", 4)]
    s2 = R.union_all(a, b).filter("amount > 2")
    assert rows(s2, "product") == [("beer",), ("diaper",), ("pen",), ("rubber",)]


def test_latest_rows(spark):
    df = spark.createDataFrame([(1, "hello", 10, "2022-03-03 12:00:00"), (1, "world", None, "2022-03-03 13:00:00")],
                               "f0 int, f1 string, f2 int, f3 string")
    assert A.last_non_null(df, ["f0"], ["f3"], ["f1", "f2"]).collect()[0][1:] == ("world", 10)
    assert tuple(A.last_row(df, ["f0"], ["f3"], ["f1", "f2"]).collect()[0])[1:] == ("world", None)
    df2 = df.withColumn("ord", F.to_timestamp("f3")).withColumn("seq", F.monotonically_increasing_id())
    adds = CL.top1_additions(df2.withColumn("rank", F.unix_seconds("ord")), "f0", ["ord", "seq"],
                             S.time_bucket("ord", 3600), "rank")
    assert adds.count() == 2


def test_getting_started_golden(spark):
    # The six literal customers of the getting-started program.
    raw = spark.createDataFrame([
        ("Guillermo Smith", dt.date(1992, 12, 12), "4081 Valley Road", "08540", "New Jersey", "m", True, 0, 78, 3),
        ("Valeria Mendoza", dt.date(1970, 3, 28), "1239  Rainbow Road", "90017", "Los Angeles", "f", True, 9, 39, 0),
        ("Leann Holloway", dt.date(1989, 5, 21), "2359 New Street", "97401", "Eugene", None, True, None, None, None),
        ("Brandy Sanders", dt.date(1956, 5, 26), "4891 Walkers-Ridge-Way", "73119", "Oklahoma City", "m", False, 9, 39, 0),
        ("John Turner", dt.date(1982, 10, 2), "2359 New Street", "60605", "Chicago", "m", True, 12, 39, 0),
        ("Ellen Ortega", dt.date(1985, 6, 18), "2448 Rodney STreet", "85023", "Phoenix", "f", True, 0, 78, 3),
    ], "a string, b date, c string, d string, e string, f string, g boolean, h int, i int, j int")
    cust = R.rename_all(R.select_range(raw, 1, 7), "name", "date_of_birth", "street", "zip_code", "city",
                        "gender", "has_newsletter")
    stats = cust.agg(F.count(F.lit(1)).alias("n"),
                     (F.sum(F.year("date_of_birth")) / F.count("date_of_birth")).cast("int").alias("y")).first()
    assert (stats.n, stats.y) == (6, 1979)
    young = (cust.filter(F.col("gender").isNotNull()).filter(F.col("has_newsletter") == True)  # noqa: E712
             .filter(F.col("date_of_birth") >= F.lit("1980-01-01").cast("date"))
             .select(F.upper("name").alias("name"), "date_of_birth",
                     T.normalize_address("street", "zip_code", "city").alias("address")))
    assert set(tuple(r) for r in young.collect()) == {
        ("GUILLERMO SMITH", dt.date(1992, 12, 12), "4081 VALLEY ROAD, 08540, NEW JERSEY"),
        ("JOHN TURNER", dt.date(1982, 10, 2), "2359 NEW STREET, 60605, CHICAGO"),
        ("ELLEN ORTEGA", dt.date(1985, 6, 18), "2448 RODNEY STREET, 85023, PHOENIX"),
    }


def test_window_join(spark):
    g = (spark.createDataFrame([("tom", 0, 3), ("tom", 1999, 4), ("bob", 2000, 5)], "name string, ms long, grade int")
         .withColumn("gts", F.timestamp_millis("ms")).drop("ms"))
    s = (spark.createDataFrame([("tom", 500, 100), ("bob", 1999, 200), ("bob", 3999, 300)],
                               "name string, ms long, salary int")
         .withColumn("sts", F.timestamp_millis("ms")).drop("ms"))
    r = TW.window_join(g, s, "name", "gts", "sts", "2 seconds")
    assert rows(r, "name", "grade", "salary") == [("bob", 5, 300), ("tom", 3, 100), ("tom", 4, 100)]


def test_top_speed_delta(spark):
    cars = spark.createDataFrame([(0, 50, 0.0, 0), (0, 55, 30.0, 1000), (0, 45, 60.0, 2000),
                                  (0, 40, 110.0, 13000), (0, 60, 111.0, 14000)],
                                 "car_id int, speed int, distance double, ms long")
    cars = (cars.withColumn("ts", F.timestamp_millis("ms")).withColumn("seq", F.col("ms"))
            .withColumn("dc", F.round(F.col("distance") * 100).cast("long")))
    r = FO.top_speed_delta(cars, "car_id", "ts", "seq", "speed", "dc", threshold_cents=5000, evict_seconds=10)
    assert rows(r, "speed", "distance", "seq") == [(55.0, 30.0, 1000), (60.0, 111.0, 14000)]


def test_fibonacci(spark):
    pairs = [(10, 7), (1, 1), (49, 49), (0, 0), (None, 1), (-10 ** 7, -1), (-1, 0), (-2 ** 31, 2 ** 31 - 1)]
    df = spark.createDataFrame(pairs, "a int, b int")

    def plain(a, b, bound):
        wrap = lambda x: (x + 2 ** 31) % 2 ** 32 - 2 ** 31
        if a is None or (a, b) == (0, 0):
            return None
        n = 0
        while n == 0 or (a < bound and b < bound):
            a, b, n = b, wrap(a + b), n + 1
        return n

    for bound in (100, 2 ** 30):
        got = [r.n for r in df.select(IT.fibonacci_steps(F.col("a"), F.col("b"), bound).alias("n")).collect()]
        assert got == [plain(a, b, bound) for a, b in pairs]
    assert [plain(a, b, 100) for a, b in pairs][:4] == [5, 10, 2, None]


def test_iterate_until(spark):
    """The feedback loop over rows equals the closed function; a row goes
    round as often as it needs."""
    df = spark.createDataFrame([(1, 10, 7, 0), (2, 1, 1, 0), (3, 49, 49, 0), (4, 200, 1, 0)], "id int, x int, y int, n int")
    step = lambda d: d.select("id", F.col("y").alias("x"), (F.col("x") + F.col("y")).alias("y"), (F.col("n") + 1).alias("n"))
    out = IT.iterate_until(df, step, (F.col("x") < 100) & (F.col("y") < 100))
    assert out.columns == df.columns and rows(out, "id", "n") == [(1, 5), (2, 10), (3, 2), (4, 1)]
    down = IT.iterate_until(spark.createDataFrame([(25,), (3,)], "k int"), lambda d: d.select((F.col("k") - 1).alias("k")),
                            F.col("k") > 0)
    assert rows(down, "k") == [(0,), (0,)]
    assert IT.iterate_until(df.limit(0), step, F.col("x") < 100).count() == 0


def test_map_with_setup_opens_and_closes(spark):
    from tidewater.operators.rich import map_with_setup
    from tidewater.session import scratch_path
    log = scratch_path(spark, "life").removeprefix("file:")

    def open_():
        import os
        import uuid
        os.makedirs(log, exist_ok=True)
        name = f"{log}/{uuid.uuid4().hex}"
        open(name, "w").write("open")
        return name

    def close(name):
        open(name, "a").write(" closed")

    def fail(name, pdf):
        if (pdf["id"] == 7).any():
            raise ValueError("bad row")
        return pdf

    df = spark.range(0, 6).repartition(3)
    assert map_with_setup(df, open_, fail, "id long", close).count() == 6
    with pytest.raises(Exception):
        map_with_setup(spark.range(7, 8).coalesce(1), open_, fail, "id long", close).count()
    import glob
    states = [open(f).read() for f in glob.glob(f"{log}/*")]
    assert len(states) >= 4 and set(states) == {"open closed"}


def test_late_rows(spark):
    df = (spark.createDataFrame([(1, "s", 0, 5.0), (2, "s", 20, 6.0), (3, "s", 3, 4.0), (4, "s", 90, 7.0),
                                 (5, "s", 2, 1.0)], "seq long, id string, t long, temp double")
          .withColumn("ts", F.timestamp_seconds("t")))
    on_time, late = L.split_late(df, "ts", ["seq"], S.seq_bucket("seq", 2), 15, 3, 60)
    assert [r.seq for r in late.collect()] == [5]
    agg = TW.tumble(on_time, ["id"], "ts", "15 seconds", [F.min("temp").alias("m")])
    first = [r.m for r in agg.collect() if int(r.window_start.timestamp()) == 0]
    assert first == [4.0]


def test_count_windows(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("seq"), F.lit("k").alias("key"),
                                     F.col("id").cast("double").alias("v"))
    r = CW.sliding_count_window_sum(df, ["key"], ["seq"], S.seq_bucket("seq", 64), "v", size=250, slide=150)
    got = rows(r, "n", "total")
    # n=150: rows 1..150; n=300: rows 51..300; ... n=900: rows 651..900
    assert got[0] == (150, float(sum(range(1, 151))))
    assert got[1] == (300, float(sum(range(51, 301))))
    assert [g[0] for g in got] == [150, 300, 450, 600, 750, 900]
    t = CW.tumbling_count_window(df, ["key"], ["seq"], S.seq_bucket("seq", 64), 10, [F.min("v").alias("m")])
    assert t.count() == 100


def test_rising_alert(spark):
    df = (spark.createDataFrame([(1, "s", 0, 1.0), (2, "s", 3, 2.0), (3, "s", 5, 2.0), (4, "s", 12, 3.0),
                                 (5, "s", 13, 1.0), (6, "s", 14, 4.0)], "seq long, id string, t long, v double")
          .withColumn("ts", F.timestamp_seconds("t")))
    # armed at 0 (1.0 > 0.0) -> fires at 10 before the row at 12 (last = 2.0);
    # re-armed at 12, cancelled at 13 by the fall; armed at 14 -> flushed at 24
    for bucket in (None, S.time_bucket("ts", 4)):
        r = FO.rising_alert(df, "id", "ts", "seq", "v", bucket, seconds=10)
        got = [(int(x.alert_ts.timestamp()), x.last_value) for x in r.orderBy("alert_ts").collect()]
        assert got == [(10, 2.0), (24, 4.0)]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_with_preceding_matches_plain_lag(spark, k):
    from pyspark.sql import Window
    df = spark.range(0, 200).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("key"),
                                    ((F.col("id") * 7919) % 101).cast("double").alias("v"))
    ctx = S.with_preceding(df, ["key"], ["seq"], S.seq_bucket("seq", 17), k)
    w = Window.partitionBy("key", S.BKT).orderBy("seq")
    got = S.drop_ghosts(ctx.withColumn("p", F.lag("v", k).over(w)))
    ref = df.withColumn("p", F.lag("v", k).over(Window.partitionBy("key").orderBy("seq")))
    assert rows(got, "seq", "p") == rows(ref, "seq", "p")


def test_sql_function_surface(spark, sensors):
    from tidewater.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    sensors.createOrReplaceTempView("sensor")
    h = dict((r.id, r.h) for r in spark.sql("SELECT DISTINCT id, hash_code(id, 2) AS h FROM sensor").collect())
    assert h["sensor_1"] == -1770738192 and h["sensor_10"] == 941720992
    words = spark.sql("SELECT id, word, length FROM sensor, LATERAL split_words(id, '_') WHERE id = 'sensor_10'")
    assert rows(words, "word", "length") == [("10", 2), ("sensor", 6)]
    avg = spark.sql("SELECT id, avg_temp(temperature) AS a FROM sensor GROUP BY id").collect()
    assert round(dict((r.id, r.a) for r in avg)["sensor_1"], 6) == 37.266667
    addr = spark.sql("SELECT normalize_address('2448 Rodney STreet', '85023', 'Phoenix') AS a").first().a
    assert addr == "2448 RODNEY STREET, 85023, PHOENIX"


def plain_top_speed(data, threshold, evict):
    """(key, seq of the top row) per firing, row by row."""
    out = []
    for key in {k for k, *_ in data}:
        ref, seen = None, []
        for _, t, seq, sp, d in sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2])):
            seen.append((t, seq, sp))
            if d is None:
                continue
            if ref is None:
                ref = d
            elif d - ref > threshold:
                ref = d
                window = [r for r in seen if r[0] > t - evict]
                out.append((key, max(window, key=lambda r: (r[2], -r[0], -r[1]))[1]))
    return sorted(out, key=str)


def plain_rising(data, seconds):
    out = []
    for key in {k for k, *_ in data}:
        last, deadline = 0.0, None
        for _, t, _, v in sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2])):
            if deadline is not None and deadline <= t:
                out.append((key, deadline, last))
                deadline = None
            if v > last and deadline is None:
                deadline = t + seconds
            elif v < last:
                deadline = None
            last = v
        if deadline is not None:
            out.append((key, deadline, last))
    return sorted(out, key=str)


def hot_rows(n=3000, seed=1):
    """(key, t, seq): one key holds 90 % of the rows, one is NULL, times tie."""
    import random
    rng = random.Random(seed)
    keys = ["hot"] * 18 + ["cold", None]
    return [(rng.choice(keys), rng.randrange(n // 2), i, rng) for i in range(n)]


@pytest.mark.parametrize("falling", [False, True])
def test_top_speed_equals_row_by_row(spark, falling):
    """Hot, NULL and small keys; distances that grow, fall or are missing."""
    total, data = {}, []
    for k, t, i, rng in sorted(hot_rows(), key=lambda r: (r[1], r[2])):
        total[k] = total.get(k, 0) + rng.randrange(-60 if falling else 0, 90)
        data.append((k, t, i, float(rng.randrange(50)), None if rng.random() < 0.02 else total[k]))
    df = spark.createDataFrame(data, "k string, t long, seq long, sp double, d long").withColumn("ts", F.timestamp_seconds("t"))
    got = FO.top_speed_delta(df, "k", "ts", "seq", "sp", "d", threshold_cents=500, evict_seconds=37)
    want = plain_top_speed(data, 500, 37)
    assert sorted(((r.k, r.seq) for r in got.collect()), key=str) == want and len(want) > 5
    # distances may fall: the cents steps of a short example
    steps = [10, 60, -80, 30, 70, -20, 90, 5, 60]
    short = [("a", i, i, float(s), sum(steps[:i + 1]) * 100) for i, s in enumerate(steps)]
    df = spark.createDataFrame(short, "k string, t long, seq long, sp double, d long").withColumn("ts", F.timestamp_seconds("t"))
    got = FO.top_speed_delta(df, "k", "ts", "seq", "sp", "d", threshold_cents=5000, evict_seconds=100)
    assert sorted(((r.k, r.seq) for r in got.collect()), key=str) == plain_top_speed(short, 5000, 100)


def test_rising_alert_equals_row_by_row(spark):
    data = []
    level = {}
    for k, t, i, rng in sorted(hot_rows(2000, 5), key=lambda r: (r[1], r[2])):
        level[k] = max(0.0, level.get(k, 1.0) + rng.choice([0, 0, 1, 1, 1, 1, 1, 1, -3]))
        data.append((k, t, i, level[k]))
    df = spark.createDataFrame(data, "k string, t long, seq long, v double").withColumn("ts", F.timestamp_seconds("t"))
    got = FO.rising_alert(df, "k", "ts", "seq", "v", seconds=5)
    want = plain_rising(data, 5)
    assert sorted(((r.k, int(r.alert_ts.timestamp()), r.last_value) for r in got.collect()), key=str) == want and len(want) > 20


def test_balanced_bucket_hot_key(spark):
    """One key holds most rows: balanced buckets split it, results exact."""
    from pyspark.sql import Window
    df = spark.range(0, 3000).select(F.col("id").alias("seq"),
                                     F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("key"),
                                     (F.col("id") % 13).cast("long").alias("v"))
    b, col = S.balanced_bucket(df, ["key"], ["seq"], partitions=8)
    assert b.filter("key = 99").select("_rbkt").distinct().count() > 1
    got = S.running_agg(b, ["key"], ["seq"], col, [("s", "v", "sum")])
    ref = df.withColumn("s", F.sum("v").over(Window.partitionBy("key").orderBy("seq")))
    assert rows(got, "seq", "s") == rows(ref, "seq", "s")


# The embedded k-means sample (4 centroids, 40 points).
KMEANS_CENTROIDS = [(1, -31.85, -44.77), (2, 35.16, 17.46), (3, -5.16, 21.93), (4, -24.06, 6.81)]
KMEANS_POINTS = [
    (-14.22, -48.01), (-22.78, 37.10), (56.18, -42.99), (35.04, 50.29), (-9.53, -46.26),
    (-34.35, 48.25), (55.82, -57.49), (21.03, 54.64), (-13.63, -42.26), (-36.57, 32.63),
    (50.65, -52.40), (24.48, 34.04), (-2.69, -36.02), (-38.80, 36.58), (24.00, -53.74),
    (32.41, 24.96), (-4.32, -56.92), (-22.68, 29.42), (59.02, -39.56), (24.47, 45.07),
    (5.23, -41.20), (-23.00, 38.15), (44.55, -51.50), (14.62, 59.06), (7.41, -56.05),
    (-26.63, 28.97), (47.37, -44.72), (29.07, 51.06), (0.59, -31.89), (-39.09, 20.78),
    (42.97, -48.98), (34.36, 49.08), (-21.91, -49.01), (-46.68, 46.04), (48.52, -43.67),
    (30.05, 49.25), (4.03, -43.56), (-37.85, 41.72), (38.24, -48.32), (20.83, 57.85),
]


def test_kmeans_sample_ten_rounds(spark):
    pts = spark.createDataFrame([([x, y],) for x, y in KMEANS_POINTS], "v array<double>")
    cents = IT.kmeans(pts, "v", [(c, [x, y]) for c, x, y in KMEANS_CENTROIDS], iterations=10)
    got = {c: (round(v[0], 3), round(v[1], 3)) for c, v in cents}
    assert got == {1: (-4.904, -45.118), 2: (46.732, -48.337), 3: (26.636, 47.53), 4: (-32.843, 35.964)}
    sizes = IT.kmeans_assign(pts, "v", cents).groupBy("cluster_id").count()
    assert sorted(r["count"] for r in sizes.collect()) == [10, 10, 10, 10]


# The embedded word-count text (35 lines of verse).
VERSE = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
    "And by opposing end them?--To die,--to sleep,--",
    "No more; and by a sleep to say we end",
    "The heartache, and the thousand natural shocks",
    "That flesh is heir to,--'tis a consummation",
    "Devoutly to be wish'd. To die,--to sleep;--",
    "To sleep! perchance to dream:--ay, there's the rub;",
    "For in that sleep of death what dreams may come,",
    "When we have shuffled off this mortal coil,",
    "Must give us pause: there's the respect",
    "That makes calamity of so long life;",
    "For who would bear the whips and scorns of time,",
    "The oppressor's wrong, the proud man's contumely,",
    "The pangs of despis'd love, the law's delay,",
    "The insolence of office, and the spurns",
    "That patient merit of the unworthy takes,",
    "When he himself might his quietus make",
    "With a bare bodkin? who would these fardels bear,",
    "To grunt and sweat under a weary life,",
    "But that the dread of something after death,--",
    "The undiscover'd country, from whose bourn",
    "No traveller returns,--puzzles the will,",
    "And makes us rather bear those ills we have",
    "Than fly to others that we know not of?",
    "Thus conscience does make cowards of us all;",
    "And thus the native hue of resolution",
    "Is sicklied o'er with the pale cast of thought;",
    "And enterprises of great pith and moment,",
    "With this regard, their currents turn awry,",
    "And lose the name of action.--Soft you now!",
    "The fair Ophelia!--Nymph, in thy orisons",
    "Be all my sins remember'd.",
]


def test_verse_wordcount_and_count_window(spark):
    lines = spark.createDataFrame(list(enumerate(VERSE)), "line_no long, line string")
    toks = (lines.select("line_no", F.posexplode(T.words("line", keep_empty=False)).alias("pos", "word"))
            .withColumn("one", F.lit(1.0)))
    assert toks.count() == 287
    counts = dict((r.word, r["count"]) for r in toks.groupBy("word").count().collect())
    assert len(counts) == 170
    assert [counts[w] for w in ("the", "to", "of", "and", "that", "a")] == [22, 15, 15, 12, 7, 5]
    # sliding count window 250 / 150 per word: no word reaches 150 rows
    toks = toks.withColumn("seq", F.col("line_no") * 1000 + F.col("pos"))
    assert CW.sliding_count_window_sum(toks, ["word"], ["seq"], S.seq_bucket("seq", 5000), "one",
                                       size=250, slide=150).count() == 0


def test_english_tweets_running_counts(spark):
    from tidewater.sources.readers import parse_json
    tweets = ['{"text": "Quick Start", "user": {"lang": "en"}}'] * 3 + [
        '{"text": "Quick Start", "user": {"lang": "de"}}',   # not English
        '{"text": "Quick Start"}',                            # no user
        '{"user": {"lang": "en"}}']                            # no text
    df = spark.createDataFrame(list(enumerate(tweets)), "seq long, value string")
    parsed = df.select("seq", F.col("value")).withColumn("j", F.from_json("value", "text string, user struct<lang: string>"))
    english = parsed.filter((F.col("j.user.lang") == "en") & F.col("j.text").isNotNull())
    toks = english.select("seq", F.posexplode(F.split(F.col("j.text"), "[ \t\n\r\f]+")).alias("pos", "t")) \
        .select("seq", "pos", F.lower("t").alias("word"))
    r = K.running_count(toks, ["word"], ["seq", "pos"], S.seq_bucket("seq", 1), "n")
    assert rows(r, "word", "n") == [("quick", 1), ("quick", 2), ("quick", 3),
                                    ("start", 1), ("start", 2), ("start", 3)]
    assert parse_json(df, "value", "text string").count() == 6


def test_word_frequency_sql_and_having(spark):
    words = spark.createDataFrame([("hello", 1), ("hello", 1), ("ciao", 1)], "word string, frequency long")
    words.createOrReplaceTempView("word_counts")
    total = spark.sql("SELECT word, SUM(frequency) AS frequency FROM word_counts GROUP BY word")
    assert rows(total, "word", "frequency") == [("ciao", 1), ("hello", 2)]
    having = words.groupBy("word").agg(F.sum("frequency").alias("frequency")).filter(F.col("frequency") == 2)
    assert rows(having, "word", "frequency") == [("hello", 2)]


def test_counter_timestamps_window_all(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "seq").withColumn("v", F.lit(1.0))
    t = TW.counter_timestamps(df, "seq", step_ms=10)
    r = TW.tumble(t, [], "ts", "5 seconds", [F.count(F.lit(1)).alias("n")])
    assert sorted(x.n for x in r.collect()) == [500, 500]


def test_sequential_operators_with_a_hot_key(spark):
    """One key with 90 % of the rows and a NULL key: every operator over its
    balanced buckets equals a plain window."""
    from pyspark.sql import Window
    from tidewater.operators import changelog as CL
    data = [(k, t, i, float(rng.randrange(40))) for k, t, i, rng in hot_rows(1500, 9)]
    df = spark.createDataFrame(data, "k string, t long, seq long, v double").withColumn("ts", F.timestamp_seconds("t"))
    order, w = ["ts", "seq"], Window.partitionBy("k").orderBy("ts", "seq")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    same = lambda got, want, *cols: sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    assert same(K.running_count(df, ["k"], order, None, "n"), df.withColumn("n", F.count("*").over(upto)), "seq", "n")
    assert same(K.jump_alert(df, "k", order, None, "v", 10.0),
                df.withColumn("last_value", F.lag("v").over(w)).filter(F.abs(F.col("v") - F.col("last_value")) > 10),
                "seq", "last_value")
    assert same(K.rows_frame(df, ["k"], order, None, 2, {"a": lambda s: F.sum("v").over(s)}),
                df.withColumn("a", F.sum("v").over(w.rowsBetween(-2, 0))), "seq", "a")
    assert same(CL.top1_additions(df, "k", order, None, "v"),
                df.withColumn("b", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)))
                .filter("b is null or v > b"), "seq")
    assert CL.changelog_count(df, "k", order, None, carry=["seq"]).filter("is_add").count() == len(data)
    gap = F.coalesce((F.col("t") - F.lag("t").over(w) > 3).cast("int"), F.lit(1))
    plain = df.withColumn("g", gap).withColumn("s", F.sum("g").over(upto)).groupBy("k", "s").agg(F.count("*").alias("c"), F.min("ts").alias("session_start"))
    assert same(TW.session_windows(df, ["k"], "ts", "seq", 3, [F.count("*").alias("c")]), plain, "k", "c", "session_start")
    n = df.withColumn("n", F.row_number().over(w))
    tiny = n.withColumn("v", F.col("v") * 1e-12)
    slid = CW.sliding_count_window_sum(tiny.drop("n"), ["k"], order, None, "v", size=25, slide=10)
    want = tiny.withColumn("total", F.sum("v").over(w.rowsBetween(-24, 0))).filter("n % 10 = 0")
    rnd = F.round(F.col("total") * 1e12, 6).alias("r")
    assert same(slid.select("k", "n", rnd), want.select("k", F.col("n").cast("long").alias("n"), rnd), "k", "n", "r")
    full = n.withColumn("blk", F.floor((F.col("n") - 1) / 7)).groupBy("k", "blk").agg(F.count("*").alias("c"), F.min("v").alias("m")).filter("c = 7")
    assert same(CW.tumbling_count_window(df, ["k"], order, None, 7, [F.min("v").alias("m")]), full, "k", "m")


def test_as_of_join_broadcast_and_merged(spark):
    from tidewater.operators.joins import asof_backward
    data = spark.range(0, 400).select(F.col("id"), F.timestamp_seconds((F.col("id") * 37) % 500).alias("ts")) \
        .union(spark.createDataFrame([(999, None)], "id long, ts timestamp"))
    models = spark.createDataFrame([(t, float(t)) for t in (50, 51, 200, 203, 400)], "t long, p double") \
        .select(F.timestamp_seconds("t").alias("mts"), "p")
    times = [50, 51, 200, 203, 400]
    want = sorted((i, max((float(t) for t in times if t <= (i * 37) % 500), default=None)) for i in range(400))
    for broadcast in (True, False, None):
        got = asof_backward(data, "ts", models, "mts", broadcast=broadcast)
        assert sorted((r.id, r.p) for r in got.collect() if r.id != 999) == want
        assert got.filter("id = 999").first().p is None


def test_kmeans_blocks_of_centroids(spark, monkeypatch):
    pts = spark.createDataFrame([([x, y],) for x, y in KMEANS_POINTS] + [(None,)], "v array<double>")
    cents = [(i, [float(i * 7 % 50 - 25), float(i * 11 % 60 - 30)]) for i in range(20)] + [(30, [-25.0, -30.0])]
    whole = rows(IT.kmeans_assign(pts, "v", cents).select(F.coalesce("cluster_id", F.lit(-1)).alias("c"), F.to_json(F.struct("v")).alias("v")), "v", "c")
    monkeypatch.setattr(IT, "MAX_CENTROID_VALUES", 6)
    assert rows(IT.kmeans_assign(pts, "v", cents).select(F.coalesce("cluster_id", F.lit(-1)).alias("c"), F.to_json(F.struct("v")).alias("v")), "v", "c") == whole


def test_intervals():
    assert TW.interval_micros("2500 milliseconds") == 2_500_000
    assert TW.interval_micros("1 hour 30 minutes") == 5_400_000_000
    assert TW.interval_micros("INTERVAL 0.5 seconds") == 500_000
    for bad in ("", "5", "0 seconds", "0.5 microseconds"):
        with pytest.raises(ValueError):
            TW.interval_micros(bad)

"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement computes the same result as the Spark query of the same name
directly from the parquet views, written independently of the Spark plan
(plain window functions, recursive CTEs and list functions).
"""

from __future__ import annotations

SENSOR = "(SELECT event_id, 'sensor_' || CAST(user_id AS VARCHAR) AS id, ts, value AS temperature FROM events)"

WORDS = r"""(SELECT unnest(string_split_regex(lower(text), '\W+')) AS word FROM documents)"""

LINES = r"""(SELECT doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM documents)"""


def _split_drop_trailing(expr: str, pattern: str) -> str:
    """JVM split result shape in DuckDB: drop trailing empty strings."""
    stripped = f"regexp_replace({expr}, '(?:{pattern})+$', '')"
    return (f"(CASE WHEN {stripped} = '' THEN (CASE WHEN {expr} = '' THEN [''] ELSE []::VARCHAR[] END) "
            f"ELSE string_split_regex({stripped}, '{pattern}') END)")


def _java_hash(expr: str) -> str:
    h = (f"list_reduce(list_transform(string_split({expr}, ''), lambda x: unicode(x)::BIGINT), "
         f"lambda a, x: (CASE WHEN x > 65535 THEN a * 961 + (55296 + ((x - 65536) >> 10)) * 31 + 56320 + ((x - 65536) & 1023) "
         f"ELSE a * 31 + x END) % 4294967296, 0::BIGINT)")
    return h


def _int32(expr: str) -> str:
    m = f"((({expr}) % 4294967296 + 4294967296) % 4294967296)"
    return f"CAST(CASE WHEN {m} >= 2147483648 THEN {m} - 4294967296 ELSE {m} END AS INTEGER)"


def _normalize(expr: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(upper({expr}), '\\W', ' ', 'g'), '\\s+', ' ', 'g'))")


ORACLE: dict[str, str] = {}

ORACLE["tpch_q3"] = """
SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
       CAST(o_orderdate AS DATE) AS o_orderdate, 0 AS o_shippriority
FROM customer, orders, lineitem
WHERE c_mktsegment = 'AUTOMOBILE' AND c_custkey = o_custkey AND l_orderkey = o_orderkey
  AND CAST(o_orderdate AS DATE) < DATE '1995-03-12' AND CAST(l_shipdate AS DATE) > DATE '1995-03-12'
GROUP BY l_orderkey, o_orderdate
ORDER BY revenue DESC, o_orderdate"""

ORACLE["select_filter"] = "SELECT event_id, user_id, value AS amount FROM events WHERE event_type = 'click'"

ORACLE["column_range"] = ("SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance "
                          "FROM customer")

ORACLE["prefix_filter"] = f"SELECT event_id, id, temperature FROM {SENSOR} s WHERE id LIKE 'sensor\\_1%' ESCAPE '\\'"

ORACLE["count_by_key"] = "SELECT user_id, count(event_id) AS cnt FROM events GROUP BY user_id"

ORACLE["global_count_avg_year"] = """
SELECT count(*) AS n_orders, CAST(sum(year(o_orderdate)) // count(year(o_orderdate)) AS INTEGER) AS avg_year
FROM orders"""

_A = "(SELECT user_id AS \"user\", event_type AS product, value AS amount FROM events WHERE event_type = 'click')"
_B = "(SELECT user_id AS \"user\", event_type AS product, value AS amount FROM events WHERE event_type = 'view')"
ORACLE["union_all_filtered"] = f"SELECT * FROM {_A} a WHERE amount > 30 UNION ALL SELECT * FROM {_B} b WHERE amount < 5"
ORACLE["union_all_then_filter"] = f"SELECT * FROM (SELECT * FROM {_A} a UNION ALL SELECT * FROM {_B} b) u WHERE amount > 30"

ORACLE["split_high_low"] = (f"SELECT event_id, id, temperature, CASE WHEN temperature > 37.0 THEN 'high' ELSE 'low' END AS side "
                            f"FROM {SENSOR} s")
ORACLE["split_then_union"] = f"SELECT event_id, id, temperature FROM {SENSOR} s"
ORACLE["connect_comap"] = (f"SELECT event_id, id, temperature, 'warning' AS status FROM {SENSOR} s WHERE temperature > 37.0 "
                           f"UNION ALL SELECT event_id, id, NULL::DOUBLE AS temperature, 'healthy' AS status "
                           f"FROM {SENSOR} s WHERE NOT (temperature > 37.0)")

ORACLE["wordcount_batch"] = f"SELECT word, count(*) AS cnt FROM {WORDS} w WHERE word <> '' GROUP BY word"
ORACLE["wordcount_sql"] = f"SELECT word, CAST(sum(1) AS BIGINT) AS frequency FROM {WORDS} w WHERE word <> '' GROUP BY word"
ORACLE["having_filter"] = f"SELECT word, count(*) AS frequency FROM {WORDS} w WHERE word <> '' GROUP BY word HAVING count(*) = 2"


def _variant(name: str, pattern: str, lower: bool, drop_empty: bool) -> str:
    src = "lower(line)" if lower else "line"
    where = "WHERE token <> ''" if drop_empty else ""
    return (f"SELECT '{name}' AS variant, token FROM (SELECT unnest({_split_drop_trailing(src, pattern)}) AS token "
            f"FROM {LINES} l) t {where}")


ORACLE["tokenize_variants"] = (
    "SELECT variant, token, count(*) AS cnt FROM ("
    + " UNION ALL ".join([_variant("word", r"\W+", True, True), _variant("space", " ", False, False),
                          _variant("ws", r"\s", False, False), _variant("comma", ",", False, False),
                          _variant("semicolon", ";", False, False)])
    + ") v GROUP BY variant, token")

ORACLE["json_english_wordcount"] = r"""
SELECT word, count(*) AS cnt FROM (
  SELECT lower(regexp_replace(t, '\s', '', 'g')) AS word
  FROM (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS t FROM documents
        WHERE lang = 'en' AND text IS NOT NULL) x) y
WHERE word <> '' GROUP BY word"""

ORACLE["wordcount_semicolon"] = """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(['c_custkey', 'c_name', 'c_mktsegment']) AS word
  UNION ALL SELECT CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_name FROM customer
  UNION ALL SELECT c_mktsegment FROM customer) w
GROUP BY word"""

_NULLABLE = ("(SELECT user_id, ts, event_id, event_type, CASE WHEN event_type = 'click' THEN value END AS click_value "
             "FROM events)")
ORACLE["last_non_null"] = f"""
SELECT user_id,
  arg_max(event_type, ts) FILTER (WHERE event_type IS NOT NULL) AS event_type,
  arg_max(click_value, ts) FILTER (WHERE click_value IS NOT NULL) AS click_value
FROM {_NULLABLE} n GROUP BY user_id"""
ORACLE["last_row_value"] = f"""
SELECT user_id, event_type, click_value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {_NULLABLE} n) x
WHERE rn = 1"""
ORACLE["dedup_keep_last"] = """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) x WHERE rn = 1"""
ORACLE["upsert_latest_by_key"] = f"""
SELECT id, temperature FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn FROM {SENSOR} s) x
WHERE rn = 1"""
ORACLE["top2_per_key"] = f"""
WITH r AS (SELECT id, temperature, row_number() OVER (PARTITION BY id ORDER BY temperature DESC) AS rk FROM {SENSOR} s),
     slots AS (SELECT k.id, t.rk FROM (SELECT DISTINCT id FROM {SENSOR} s2) k, (VALUES (1), (2)) t(rk))
SELECT slots.id, greatest(coalesce(r.temperature, 0.0), 0.0) AS temp, CAST(slots.rk AS INTEGER) AS rank
FROM slots LEFT JOIN r ON slots.id = r.id AND slots.rk = r.rk"""
ORACLE["udaf_avg"] = f"SELECT id, round(sum(temperature) / count(temperature), 6) AS avg_temp FROM {SENSOR} s GROUP BY id"

ORACLE["java_hash"] = (f"SELECT event_id, id, {_int32('CAST(' + _int32(_java_hash('id')) + ' AS BIGINT) * 2 - 1000')} AS hash_code, "
                       f"{_int32('CAST(' + _int32(_java_hash("id || '😀'")) + ' AS BIGINT) * 2 - 1000')} AS wide_hash "
                       f"FROM {SENSOR} s")
ORACLE["normalize_address"] = (
    f"SELECT c_custkey, {_normalize('c_name')} || ', ' || {_normalize('n_name')} || ', ' || {_normalize('c_mktsegment')} "
    f"AS address FROM customer JOIN nation ON c_nationkey = n_nationkey")
ORACLE["lateral_split"] = (f"SELECT event_id, id, word, CAST(length(word) AS INTEGER) AS length FROM "
                           f"(SELECT event_id, id, unnest({_split_drop_trailing('id', '_')}) AS word FROM {SENSOR} s) x")
ORACLE["getting_started"] = (
    f"SELECT upper(c_name) AS name, c_acctbal AS balance, "
    f"{_normalize('c_name')} || ', ' || {_normalize('c_mktsegment')} || ', ' || {_normalize('n_name')} AS address "
    f"FROM customer JOIN nation ON c_nationkey = n_nationkey "
    f"WHERE c_mktsegment IS NOT NULL AND c_acctbal > 0 AND c_acctbal >= 5000.0")

# ------------------------------------------------------------ time windows
ORACLE["tumble_min_reduce"] = f"""
SELECT id, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       min(temperature) AS min_temp, arg_max(ts, event_id) AS last_ts
FROM {SENSOR} s GROUP BY ALL"""

ORACLE["tumble_wordcount"] = """
SELECT event_type AS word, time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL"""

ORACLE["sliding_sum"] = """
SELECT user_id, ws AS window_start, ws + INTERVAL '50 minutes' AS window_end, round(sum(value), 6) AS total
FROM (SELECT user_id, value, time_bucket(INTERVAL '10 minutes', ts) - to_minutes(10 * r.i) AS ws
      FROM events, (SELECT range AS i FROM range(5)) r) x
GROUP BY user_id, ws"""

# windows of 2500 ms every 500 ms over event times scaled from minutes to seconds
ORACLE["sliding_sum_millis"] = """
SELECT user_id, make_timestamp(w * 500000) AS window_start, make_timestamp(w * 500000 + 2500000) AS window_end,
       round(sum(value), 6) AS total
FROM (SELECT user_id, value, unnest(range(ms // 500 - 4, ms // 500 + 1)) AS w
      FROM (SELECT user_id, value, epoch_us(ts) // 60000 AS ms FROM events) e) x
GROUP BY user_id, w"""

ORACLE["session_sum"] = """
WITH g AS (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                   OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL '600 seconds'
                 THEN 1 ELSE 0 END AS st FROM events),
s AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sno FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '600 seconds' AS session_end,
       count(*) AS cnt, round(sum(value), 6) AS total
FROM s GROUP BY user_id, sno"""

ORACLE["window_all_model"] = """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       count(*) AS n, round(avg(value), 6) AS model
FROM events GROUP BY ALL"""

ORACLE["table_tumble_count_avg"] = f"""
SELECT id, count(id) AS cnt, round(avg(temperature), 6) AS avg_temp,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end
FROM {SENSOR} s GROUP BY id, time_bucket(INTERVAL '1 hour', ts)"""

ORACLE["minby_tumble"] = """
SELECT user_id, window_start, event_id, value FROM (
  SELECT user_id, time_bucket(INTERVAL '1 hour', ts) AS window_start, event_id, value,
         row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL '1 hour', ts) ORDER BY value, event_id) AS rn
  FROM events) x WHERE rn = 1"""

ORACLE["ddl_tumble_sum"] = """
SELECT time_bucket(INTERVAL '1 hour', date_trunc('second', ts)) AS hour_start,
       time_bucket(INTERVAL '1 hour', date_trunc('second', ts)) + INTERVAL '1 hour' AS hour_end,
       event_type, round(sum(value), 6) AS total
FROM events WHERE event_type IS NOT NULL
GROUP BY event_type, time_bucket(INTERVAL '1 hour', date_trunc('second', ts))"""

ORACLE["window_join"] = """
SELECT g.user_id AS name, time_bucket(INTERVAL '1 hour', g.ts) AS window_start, g.value AS grade, s.value AS salary
FROM (SELECT * FROM events WHERE event_type = 'click') g
JOIN (SELECT * FROM events WHERE event_type = 'view') s
  ON g.user_id = s.user_id AND time_bucket(INTERVAL '1 hour', g.ts) = time_bucket(INTERVAL '1 hour', s.ts)"""

ORACLE["count_window_sliding"] = """
SELECT event_type, n, round(total, 6) AS total FROM (
  SELECT event_type, row_number() OVER w AS n,
         sum(value) OVER (w ROWS BETWEEN 249 PRECEDING AND CURRENT ROW) AS total
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)) x
WHERE n % 150 = 0"""

ORACLE["count_window_tumbling"] = """
SELECT user_id, min(value) AS min_temp, arg_max(ts, event_id) AS last_ts, blk + 1 AS window_no FROM (
  SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS blk FROM events) x
GROUP BY user_id, blk HAVING count(*) = 10"""

_ARRIVALS = """(SELECT event_id, user_id, ts, value,
    ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL '2 hours' ELSE INTERVAL '0 hours' END AS arrival,
    epoch_us(ts) AS ts_us FROM events)"""
_LATE_FLAG = f"""(SELECT *, coalesce(
      (ts_us // 900000000 + 1) * 900000000 + 3600000000
        <= max(ts_us) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 180000000,
      false) AS too_late
  FROM {_ARRIVALS} a)"""
ORACLE["late_side_output"] = f"SELECT event_id, user_id, ts, value FROM {_LATE_FLAG} l WHERE too_late"
ORACLE["late_updates"] = f"""
SELECT user_id, min(value) AS min_temp, count(*) AS cnt, time_bucket(INTERVAL '15 minutes', ts) AS window_start
FROM {_LATE_FLAG} l WHERE NOT too_late GROUP BY user_id, time_bucket(INTERVAL '15 minutes', ts)"""

# --------------------------------------------------------------- keyed scans
_LAGGED = f"""(SELECT *, lag(temperature) OVER (PARTITION BY id ORDER BY ts, event_id) AS last_value FROM {SENSOR} s)"""
ORACLE["jump_alert"] = f"SELECT event_id, id, last_value, temperature FROM {_LAGGED} l WHERE abs(temperature - last_value) > 10.0"
ORACLE["jump_alert_default_zero"] = f"""
SELECT event_id, id, coalesce(last_value, 0.0) AS last_value, temperature FROM {_LAGGED} l
WHERE abs(temperature - coalesce(last_value, 0.0)) > 10.0"""
ORACLE["running_reduce"] = f"""
SELECT event_id, id,
  CAST(floor(epoch(first_value(ts) OVER w)) AS BIGINT) + 10 * (row_number() OVER w - 1) AS time_stamp, temperature
FROM {SENSOR} s WINDOW w AS (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""
ORACLE["running_wordcount"] = r"""
SELECT doc_id, CAST(pos AS INTEGER) AS pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS cnt
FROM (SELECT doc_id, unnest(t) AS word, unnest(generate_series(0, len(t) - 1)) AS pos
      FROM (SELECT doc_id, string_split_regex(lower(text), '\W+') AS t FROM documents) a) b
WHERE word <> ''"""
_RC = f"""(SELECT event_id, id, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS n FROM {SENSOR} s)"""
ORACLE["changelog_count"] = f"""
SELECT event_id, id, false AS is_add, n - 1 AS cnt, 0 AS step FROM {_RC} r WHERE n > 1
UNION ALL SELECT event_id, id, true AS is_add, n AS cnt, 1 AS step FROM {_RC} r"""
ORACLE["changelog_adds_top1"] = f"""
SELECT event_id, id, temperature, true AS is_add FROM (
  SELECT *, max(temperature) OVER (PARTITION BY id ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM {SENSOR} s) x
WHERE best IS NULL OR temperature > best"""
ORACLE["over_rows_2_preceding"] = f"""
SELECT event_id, id, count(id) OVER w AS cnt, round(avg(temperature) OVER w, 6) AS avg_temp
FROM {SENSOR} s WINDOW w AS (PARTITION BY id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
ORACLE["over_rows_named_window"] = f"""
SELECT event_id, id, ts, count(id) OVER w AS cnt, round(avg(temperature) OVER w, 6) AS avg_temp
FROM {SENSOR} s WINDOW w AS (PARTITION BY id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

# -------------------------------------------------------- sources and sinks
ORACLE["src_text_lines"] = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"
ORACLE["src_delimited"] = ("SELECT l_orderkey AS id, l_extendedprice AS extdprice, l_discount AS discount, "
                           "CAST(l_shipdate AS DATE) AS shipdate FROM lineitem")
ORACLE["src_csv_table"] = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'"
ORACLE["parse_readings"] = ("SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, CAST(floor(epoch(ts)) AS BIGINT) AS time_stamp, "
                            "value AS temperature FROM events")
ORACLE["parse_tuple"] = "SELECT user_id AS a, event_id AS b, value AS v FROM events"
ORACLE["kafka_style_csv_filter"] = (
    "SELECT event_id, user_id, event_type, value AS amount, "
    "concat_ws(',', event_id, user_id, event_type, CAST(value AS VARCHAR)) AS value "
    "FROM events WHERE event_type = 'click'")
ORACLE["kafka_value_encode"] = (
    "SELECT event_id, 'SensorReading(sensor_' || CAST(user_id AS VARCHAR) || ',' || "
    "CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) || ',' || CAST(value AS VARCHAR) || ')' AS value FROM events")
ORACLE["json_documents"] = (
    "SELECT event_id, CAST(json_object('sensor_id', 'sensor_' || CAST(user_id AS VARCHAR), "
    "'temperature', CAST(value AS VARCHAR), 'ts', CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)) AS VARCHAR) AS doc "
    "FROM events")
ORACLE["catalog_roundtrip"] = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"
ORACLE["sink_delimited_roundtrip"] = ORACLE["wordcount_batch"]
ORACLE["sink_stream_files"] = "SELECT event_id, user_id, value FROM events"
ORACLE["sink_manifest_stream"] = ORACLE["sink_stream_files"]
ORACLE["stream_wordcount"] = f"""
SELECT word, count(*) AS cnt FROM (
  SELECT unnest({_split_drop_trailing('line', ' ')}) AS word FROM {LINES} l WHERE line <> '') w
GROUP BY word"""
ORACLE["map_partition_setup"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
ORACLE["async_enrich_unordered"] = "SELECT event_id, 'key' || CAST(user_id % 10 AS VARCHAR) AS result FROM events"
ORACLE["async_enrich_ordered"] = ("SELECT event_id, 'key' || CAST(user_id % 10 AS VARCHAR) AS result, "
                                  "row_number() OVER (ORDER BY event_id) - 1 AS position FROM events")

# ------------------------------------------------------------- iteration
ORACLE["iterate_fibonacci"] = """
WITH RECURSIVE it(event_id, a, b, x, y, n) AS (
  SELECT event_id, CAST(ceil(value) AS BIGINT), user_id + 1, CAST(ceil(value) AS BIGINT), user_id + 1, 0 FROM events
  UNION ALL
  SELECT event_id, a, b, y, x + y, n + 1 FROM it WHERE n = 0 OR (x < 100 AND y < 100))
SELECT event_id, a, b, n FROM it WHERE n > 0 AND NOT (x < 100 AND y < 100)"""

_PTS = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"


def _means(assign_sql: str, rnd: bool) -> str:
    inner = (f"SELECT cid, dim, avg(x) AS m, count(*) AS n FROM (SELECT a.cid, generate_subscripts(p.v, 1) AS dim, "
             f"unnest(p.v) AS x FROM ({assign_sql}) a JOIN {_PTS} p USING (vec_id)) z GROUP BY cid, dim")
    val = "round(m, 6)" if rnd else "m"
    return f"SELECT cid, max(n) AS n, list({val} ORDER BY dim) AS c FROM ({inner}) y GROUP BY cid"


def _assign(cent_sql: str) -> str:
    return (f"SELECT vec_id, cid FROM (SELECT p.vec_id, c.cid, row_number() OVER (PARTITION BY p.vec_id "
            f"ORDER BY list_distance(p.v, c.c), c.cid) AS rn FROM {_PTS} p, ({cent_sql}) c) q WHERE rn = 1")


_SEED = _means(f"SELECT vec_id, label AS cid FROM {_PTS} s", False)
ORACLE["kmeans_assign"] = f"SELECT vec_id, CAST(cid AS INTEGER) AS cluster_id FROM ({_assign(_SEED)}) a"
ORACLE["kmeans_step"] = (f"SELECT CAST(cid AS INTEGER) AS cluster_id, n, c AS centroid "
                         f"FROM ({_means(_assign(_SEED), True)}) m")
_ROUNDS = ", ".join(f"c{i} AS MATERIALIZED ({_means(_assign(f'SELECT * FROM c{i - 1}'), False)})" for i in range(1, 10))
ORACLE["kmeans_centroids"] = (f"WITH c0 AS MATERIALIZED ({_SEED}), {_ROUNDS} SELECT CAST(cid AS INTEGER) AS cluster_id, c AS centroid "
                              f"FROM ({_means(_assign('SELECT * FROM c9'), True)}) m")

ORACLE["latest_model_predict"] = """
WITH m AS (SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS model_ts, round(avg(value), 6) AS prediction
           FROM events GROUP BY 1)
SELECT e.event_id, m.model_ts, m.prediction FROM events e ASOF LEFT JOIN m ON e.ts >= m.model_ts"""

# ----------------------------------------------------------------- folds
ORACLE["rising_alert"] = f"""
WITH RECURSIVE r AS (
  SELECT id, ts, temperature AS v, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS n FROM {SENSOR} s),
st(id, n, last, deadline, alert_ts, alert_last) AS (
  SELECT DISTINCT id, CAST(0 AS BIGINT), CAST(0.0 AS DOUBLE), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP),
         CAST(NULL AS DOUBLE) FROM r
  UNION ALL
  SELECT r.id, r.n, r.v,
    CASE WHEN r.v > st.last AND (st.deadline IS NULL OR st.deadline <= r.ts) THEN r.ts + INTERVAL '6 hours'
         WHEN r.v < st.last THEN NULL
         WHEN st.deadline IS NOT NULL AND st.deadline <= r.ts THEN NULL
         ELSE st.deadline END,
    CASE WHEN st.deadline IS NOT NULL AND st.deadline <= r.ts THEN st.deadline END,
    CASE WHEN st.deadline IS NOT NULL AND st.deadline <= r.ts THEN st.last END
  FROM st JOIN r ON r.id = st.id AND r.n = st.n + 1)
SELECT id, alert_ts, alert_last AS last_value FROM st WHERE alert_ts IS NOT NULL
UNION ALL
SELECT id, deadline AS alert_ts, last AS last_value FROM (
  SELECT st.*, row_number() OVER (PARTITION BY id ORDER BY n DESC) AS k FROM st) f
WHERE k = 1 AND deadline IS NOT NULL"""

ORACLE["top_speed_delta"] = """
WITH RECURSIVE r AS (
  SELECT user_id AS car_id, event_id, ts, value AS speed,
         sum(CAST(round(value * 100) AS BIGINT)) OVER w AS dc, row_number() OVER w AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
st(car_id, n, ref, fired) AS (
  SELECT car_id, n, dc, false FROM r WHERE n = 1
  UNION ALL
  SELECT r.car_id, r.n, CASE WHEN r.dc - st.ref > 5000 THEN r.dc ELSE st.ref END, r.dc - st.ref > 5000
  FROM st JOIN r ON r.car_id = st.car_id AND r.n = st.n + 1),
fires AS (SELECT r.car_id, r.ts AS fire_ts FROM st JOIN r USING (car_id, n) WHERE st.fired),
cand AS (
  SELECT f.car_id, f.fire_ts, w.event_id, w.speed, w.dc, w.ts,
         row_number() OVER (PARTITION BY f.car_id, f.fire_ts ORDER BY w.speed DESC, w.ts, w.event_id) AS k
  FROM fires f JOIN r w ON w.car_id = f.car_id AND w.ts <= f.fire_ts AND w.ts > f.fire_ts - INTERVAL '10 hours')
SELECT car_id, event_id, speed, dc / 100.0 AS distance, ts AS time FROM cand WHERE k = 1"""

# ------------------------------------------------------ SQL function surface
ORACLE["sql_hash_code"] = ORACLE["java_hash"]
ORACLE["sql_lateral_split"] = ORACLE["lateral_split"]
ORACLE["sql_normalize_address"] = ORACLE["normalize_address"]

ORACLE["state_kinds"] = f"""
SELECT id, lag(temperature) OVER w AS previous, CAST(1 AS INTEGER) AS list_size,
       row_number() OVER w > 1 AS had_marker,
       max(temperature) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max
FROM {SENSOR} s WINDOW w AS (PARTITION BY id ORDER BY ts, event_id)"""

ORACLE["state_seeded"] = ORACLE["state_kinds"]
ORACLE["iterate_stream"] = ORACLE["iterate_fibonacci"]

ORACLE["state_retained"] = f"""
SELECT id, temperature AS last, CAST(1 AS BIGINT) AS list_size, CAST(1 AS BIGINT) AS markers, running_max
FROM (SELECT id, temperature, max(temperature) OVER (PARTITION BY id) AS running_max,
             row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS place FROM {SENSOR} s)
WHERE place = 1"""

# y = 3 * y + cents modulo a prime, as a sum with powers of 3 and its inverse
ORACLE["running_reduce_any"] = f"""
WITH RECURSIVE r AS (
  SELECT event_id, id, CAST(round(temperature * 100) AS BIGINT) AS c,
         row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS n FROM {SENSOR}),
p AS (
  SELECT CAST(1 AS BIGINT) AS n, CAST(3 AS BIGINT) AS up, CAST(666669 AS BIGINT) AS down
  UNION ALL
  SELECT n + 1, up * 3 % 1000003, down * 666669 % 1000003 FROM p WHERE n < (SELECT max(n) FROM r)),
s AS (
  SELECT event_id, id, up, sum(c % 1000003 * down % 1000003) OVER (PARTITION BY id ORDER BY r.n) AS t
  FROM r JOIN p ON r.n = p.n)
SELECT event_id, id, CAST(t % 1000003 * up % 1000003 AS BIGINT) AS state FROM s
"""

ORACLE["udaf_accumulate"] = """
SELECT event_type, count(value) AS n, round(sum(CAST(round(value * 100) AS BIGINT)) / count(value) / 100, 6) AS mean,
       (max(CAST(round(value * 100) AS BIGINT)) - min(CAST(round(value * 100) AS BIGINT))) / 100 AS spread
FROM events GROUP BY event_type
"""

ORACLE["sql_udaf_merge"] = f"""
SELECT id, count(temperature) AS n, round(sum(CAST(round(temperature * 100) AS BIGINT)) / count(temperature) / 100, 6) AS mean,
       (max(CAST(round(temperature * 100) AS BIGINT)) - min(CAST(round(temperature * 100) AS BIGINT))) / 100 AS spread
FROM {SENSOR} GROUP BY id
"""

ORACLE["table_agg_heavy_bins"] = """
SELECT event_type, bin, cnt FROM (
  SELECT event_type, bin, cnt, sum(cnt) OVER (PARTITION BY event_type) AS total FROM (
    SELECT event_type, CAST(floor(value / 10) AS BIGINT) AS bin, count(*) AS cnt
    FROM events WHERE value IS NOT NULL GROUP BY ALL))
WHERE 100 * cnt >= 5 * total
"""

# punctuated watermarks: the largest mark of the rows that arrived before
_MARKED = """
WITH e AS (SELECT event_id, user_id, value, CASE WHEN event_id % 7 = 3 THEN ts - INTERVAL 5 HOUR ELSE ts END AS ts FROM events),
m AS (SELECT *, CASE WHEN event_id % 20 = 0 THEN ts END AS mark, time_bucket(INTERVAL '1 hour', ts) AS window_start FROM e),
b AS (SELECT *, max(mark) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM m),
l AS (SELECT *, coalesce(window_start + INTERVAL 1 HOUR <= before, false) AS late FROM b)"""
ORACLE["punctuated_windows"] = _MARKED + """,
w AS (SELECT user_id, window_start, min(value) AS low, count(*) AS cnt FROM l WHERE NOT late GROUP BY ALL),
c AS (SELECT s.window_start, min(m.event_id) AS closed_by FROM (SELECT DISTINCT window_start FROM w) s
      JOIN m ON m.mark >= s.window_start + INTERVAL 1 HOUR GROUP BY ALL)
SELECT user_id, window_start, low, cnt, closed_by FROM w JOIN c USING (window_start)"""
ORACLE["punctuated_late_rows"] = _MARKED + " SELECT event_id, user_id, value, ts FROM l WHERE late"

ORACLE["src_row_groups"] = "SELECT event_id, user_id, event_type, value FROM events"

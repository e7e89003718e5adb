"""SQL for DuckDB that returns the rows of the registered queries. January 2024 lies in winter time: New York is UTC - 5 hours."""

from __future__ import annotations


def session(t: str) -> str:
    m = f"(hour({t} - INTERVAL 5 HOUR) * 60 + minute({t} - INTERVAL 5 HOUR))"
    return f"CASE WHEN {m} >= 240 AND {m} < 570 THEN 'PRE_MARKET' WHEN {m} >= 570 AND {m} < 960 THEN 'REGULAR' WHEN {m} >= 960 AND {m} < 1200 THEN 'AFTER_HOURS' ELSE 'OVERNIGHT' END"


def occurrence(t: str, label: str) -> str:
    return f"CASE WHEN {label} = 'OVERNIGHT' AND hour({t} - INTERVAL 5 HOUR) < 4 THEN CAST({t} - INTERVAL 5 HOUR AS DATE) - 1 ELSE CAST({t} - INTERVAL 5 HOUR AS DATE) END"


def digest(*values: str) -> str:
    return "sha256(concat_ws(chr(31), " + ", ".join(f"coalesce(length({v}) || '=' || {v}, '~')" for v in values) + "))"


def instant(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def minute_bars(code: str) -> str:
    return f"""m0 AS (SELECT CAST({code} AS VARCHAR) AS code, date_trunc('minute', ts) AS t, first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close, count(*)::DOUBLE AS volume
  FROM events GROUP BY 1, 2), m AS (SELECT *, CAST(t - INTERVAL 5 HOUR AS DATE) AS day, {session("t")} AS session FROM m0)"""


B = """b AS (SELECT event_type AS code, date_trunc('hour', ts) AS t, first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
  last(value ORDER BY ts, event_id) AS close, count(*)::DOUBLE AS volume FROM events GROUP BY 1, 2)"""
CAP = f"""{B}, cap AS (SELECT code, t, CAST(t - INTERVAL 5 HOUR AS DATE) AS day, {session("t")} AS session, open, high, low, close,
  volume + CASE WHEN k = 2 AND hour(t) = 13 THEN 1 ELSE 0 END AS volume, k, 'run-' || k || '-' || CAST(t - INTERVAL 5 HOUR AS DATE) AS run,
  TIMESTAMP '2024-02-01' + k * INTERVAL 1 HOUR AS ingested_at, 'file-' || k || '-' || CAST(t - INTERVAL 5 HOUR AS DATE) AS file, sha256('bytes of file-' || k || '-' || CAST(t - INTERVAL 5 HOUR AS DATE)) AS hash
  FROM b, (VALUES (0), (1), (2)) v(k) WHERE (hour(t) + k) % 11 <> 0),
bent0 AS (SELECT *, hour(t) AS h, day(day) AS d, t + CASE WHEN hour(t) = 11 AND day(day) % 6 = 2 THEN INTERVAL 30 MINUTE WHEN hour(t) = 18 AND day(day) % 10 = 0 THEN INTERVAL 30 SECOND ELSE INTERVAL 0 SECOND END AS nt FROM cap),
bent AS (SELECT code, day, run, file, k, ingested_at, nt AS t, CASE WHEN (h = 12 AND d % 6 = 3) OR d = 26 THEN NULL WHEN h = 14 AND d % 6 = 5 THEN nt + INTERVAL 1 HOUR ELSE nt END AS tm, CASE WHEN h = 15 AND d % 6 = 0 THEN day + 1 ELSE day END AS mday,
  CASE WHEN h = 10 AND d % 6 = 1 THEN 'NIGHT' ELSE session END AS session, CASE WHEN h = 17 AND d % 8 = 0 THEN 'QFQ' ELSE 'NONE' END AS adj, CASE WHEN h = 7 AND d % 3 = 0 THEN NULL ELSE open END AS open, CASE WHEN h = 8 AND d % 3 = 0 THEN low - 1 ELSE high END AS high, low, close,
  CASE WHEN code = 'view' AND d % 9 = 0 THEN NULL WHEN h = 9 AND d % 4 = 0 THEN -1 ELSE volume END AS volume FROM bent0, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR (h = 13 AND d % 6 = 4))"""
RUNS = f"""{CAP}, runs AS (SELECT DISTINCT run, day, k, CASE WHEN k = 0 AND day(day) % 4 = 0 THEN 'RTH' ELSE 'ALL' END AS session,
  CASE WHEN k = 0 THEN 'SUCCESS' WHEN k = 1 THEN CASE WHEN day(day) % 8 = 0 THEN 'PARTIAL' ELSE 'FAILED' END ELSE CASE WHEN day(day) % 5 = 0 THEN 'RUNNING' ELSE 'SUCCESS' END END AS status,
  ingested_at + INTERVAL 10 MINUTE AS finished_at FROM cap WHERE NOT (k = 1 AND day(day) % 7 = 0)),
bad AS (SELECT run FROM runs WHERE k = 2 AND day(day) % 3 = 0),
good AS (SELECT * FROM runs WHERE status IN ('SUCCESS', 'PARTIAL') AND session = 'ALL' AND run NOT IN (SELECT run FROM bad)),
days AS (SELECT DISTINCT day FROM cap WHERE dayofweek(day) BETWEEN 1 AND 5),
complete AS (SELECT DISTINCT code, day FROM cap WHERE run IN (SELECT run FROM good)),
present AS (SELECT DISTINCT code, day FROM cap)"""
REASONS = f"""{RUNS}, item AS (SELECT DISTINCT code, cap.day, cap.run, CASE WHEN runs.status IS NULL THEN 'ORPHANED_RUN' WHEN cap.run IN (SELECT run FROM bad) THEN 'QUALITY_FAIL'
  WHEN status = 'FAILED' THEN 'RUN_FAILED' WHEN status = 'RUNNING' THEN 'RUN_RUNNING' WHEN runs.session <> 'ALL' THEN 'RUN_METADATA_MISMATCH' END AS reason FROM cap LEFT JOIN runs ON runs.run = cap.run),
why AS (SELECT code, day, list(DISTINCT list_position(['RUN_STATUS_UNKNOWN', 'ORPHANED_RUN', 'QUALITY_FAIL', 'RUN_FAILED', 'RUN_RUNNING', 'RUN_METADATA_MISMATCH'], reason)) AS r FROM item WHERE reason IS NOT NULL GROUP BY 1, 2),
whys AS (SELECT code, day, list_transform(list_sort(r), lambda i: ['RUN_STATUS_UNKNOWN', 'ORPHANED_RUN', 'QUALITY_FAIL', 'RUN_FAILED', 'RUN_RUNNING', 'RUN_METADATA_MISMATCH'][i]) AS reasons FROM why)"""
STATES = f"""{REASONS}, states AS (SELECT s.code, days.day, CASE WHEN c.code IS NOT NULL THEN 'COMPLETE' WHEN p.code IS NOT NULL THEN 'INCOMPLETE' ELSE 'MISSING' END AS state
  FROM (SELECT DISTINCT code FROM cap UNION SELECT 'unseen') s CROSS JOIN days LEFT JOIN complete c ON c.code = s.code AND c.day = days.day LEFT JOIN present p ON p.code = s.code AND p.day = days.day)"""
CHOSEN = f"""{STATES}, files AS (SELECT code, cap.day, cap.run, file, good.finished_at, max(ingested_at) AS ingested_at, count(*) AS n FROM cap JOIN good ON good.run = cap.run GROUP BY ALL),
chosen AS (SELECT * FROM files QUALIFY row_number() OVER (PARTITION BY code, day ORDER BY ingested_at DESC, finished_at DESC, run DESC, file DESC) = 1),
aud AS (SELECT b.* FROM bent b JOIN chosen c ON c.code = b.code AND c.day = b.day AND c.run = b.run),
s1 AS (SELECT *, {session("t")} AS own, {occurrence("t", session("t"))} AS own_date FROM aud),
s2 AS (SELECT *, CASE WHEN lag(own || own_date) OVER w = own || own_date THEN 0 ELSE 1 END AS new FROM s1 WINDOW w AS (PARTITION BY code, day ORDER BY t)),
s3 AS (SELECT *, sum(new) OVER (PARTITION BY code, day ORDER BY t)::BIGINT AS segment FROM s2),
s4 AS (SELECT *, lag(t) OVER (PARTITION BY code, day, segment ORDER BY t) AS before FROM s3),
s5 AS (SELECT *, (epoch(t) - epoch(before))::BIGINT AS delta FROM s4),
seg AS (SELECT code, day, segment, min(own) AS session, min(t) AS first_time, max(t) AS last_time, count(*) AS row_count, count(*) FILTER (delta <= 0 OR delta % 3600 <> 0) AS grid_violations,
  count(*) FILTER (delta > 3600 AND delta % 3600 = 0) AS gap_count, coalesce(sum(CASE WHEN delta > 3600 AND delta % 3600 = 0 THEN delta // 3600 - 1 END), 0)::BIGINT AS missing_bars FROM s5 GROUP BY 1, 2, 3),
c0 AS (SELECT *, count(*) OVER (PARTITION BY code, day, t) AS same FROM s5),
c1 AS (SELECT code, day, bool_or(tm IS NOT NULL) AS timed, ((count(tm) = 0)::INT + (count(open) = 0)::INT + (count(high) = 0)::INT + (count(low) = 0)::INT + (count(close) = 0)::INT + (count(volume) = 0)::INT + (count(session) = 0)::INT + (count(mday) = 0)::INT) AS required,
  count(*) FILTER (adj <> 'NONE') AS meta, count(*) FILTER (tm IS NULL) AS valid, count(*) FILTER (tm <> t) AS zone, count(*) FILTER (tm IS NOT NULL AND mday IS DISTINCT FROM CAST(t - INTERVAL 5 HOUR AS DATE)) AS mdate, count(*) FILTER (tm IS NOT NULL AND session IS DISTINCT FROM own) AS label,
  count(*) FILTER (session NOT IN ('OVERNIGHT', 'PRE_MARKET', 'REGULAR', 'AFTER_HOURS')) AS scope, count(*) FILTER (same > 1) AS dup, count(*) FILTER (second(t) <> 0) AS minute, count(*) FILTER (delta <= 0 OR delta % 3600 <> 0) AS off, count(*) FILTER (delta > 3600 AND delta % 3600 = 0) AS gap FROM c0 GROUP BY 1, 2),
chk0 AS (SELECT code, day, timed, unnest(['REQUIRED_COLUMNS', 'NON_EMPTY', 'EXACT_REQUEST_METADATA', 'VALID_TIMESTAMPS', 'TIMEZONE_INSTANT_CONSISTENCY', 'MARKET_CALENDAR_DATE_CONSISTENCY', 'SESSION_LABEL_CONSISTENCY', 'REQUESTED_SESSION_SCOPE',
  'DUPLICATE_TIMESTAMPS', 'MINUTE_BOUNDARY_ALIGNMENT', 'DELTA_GRID_ALIGNMENT', 'INTERNAL_GAPS']) AS check_name, unnest([required, 0, meta, valid, zone, mdate, label, scope, dup, minute, off, gap]) AS n, unnest(range(1, 13)) AS i FROM c1),
chk AS (SELECT code, day, check_name, CASE WHEN i > 4 AND NOT timed THEN 'INFO' WHEN n = 0 THEN 'PASS' WHEN i = 12 THEN 'WARN' ELSE 'FAIL' END AS result, CASE WHEN i > 4 AND NOT timed THEN 0 ELSE n END AS mismatch_count,
  CASE WHEN i > 4 AND NOT timed THEN 'NOT_EVALUATED' WHEN i = 8 AND n > 0 THEN 'NIGHT: ' || n ELSE '' END AS details FROM chk0)"""
RANKED = f"""{CAP}, ranked AS (SELECT *, {digest("'MARKET_BARS'", "code", "'60m'", "'NONE'", instant("t"))} AS key, row_number() OVER (PARTITION BY code, t ORDER BY ingested_at DESC, run DESC, hash DESC) AS rank FROM cap),
bars AS (SELECT *, {digest("key", "run", "hash", "'1'", "'1'")} AS version, t + INTERVAL 1 HOUR AS available FROM ranked WHERE rank = 1)"""
GAPS = f"""{RANKED}, g0 AS (SELECT *, lag(t) OVER w AS before, lag(version) OVER w AS before_version, lag(available) OVER w AS before_available, lag(ingested_at) OVER w AS before_archived
  FROM bars WINDOW w AS (PARTITION BY code, day, session ORDER BY t)),
gaps AS (SELECT *, (epoch(t) - epoch(before))::BIGINT // 3600 - 1 AS missing, {digest("'gap'", "'MARKET_BARS'", "code", "'60m'", "'NONE'", "day::VARCHAR", "session", instant("before"), instant("t"))} AS gap_id FROM g0 WHERE epoch(t) - epoch(before) > 3600)"""
SEGMENTS = f"""{RANKED}, c1 AS (SELECT *, CASE WHEN epoch(t) - epoch(lag(t) OVER (PARTITION BY code, day, session ORDER BY t)) = 3600 THEN 0 ELSE 1 END AS new FROM bars),
c2 AS (SELECT *, sum(new) OVER (PARTITION BY code, day, session ORDER BY t) AS segment FROM c1),
c3 AS (SELECT *, row_number() OVER (PARTITION BY code, day, session, segment ORDER BY t) - 1 AS pos, count(*) OVER (PARTITION BY code, day, session, segment) AS n FROM c2)"""
REQUESTS = f"""{SEGMENTS}, req AS (SELECT *, t - INTERVAL 2 HOUR AS f0, t + INTERVAL 1 HOUR AS f1, t + INTERVAL 1 HOUR AS l0, t + INTERVAL 3 HOUR AS l1 FROM c3 WHERE pos >= 2 AND pos + 2 < n),
reqs AS (SELECT {digest("code", "'60m'", "'NONE'", "'ALL'", "day::VARCHAR", instant("f0"), instant("f1"), instant("l0"), instant("l1"))} AS sample_key, * FROM req)"""
FEATURES = f"""{REQUESTS}, fw AS (SELECT code, t, version, open, high, low, close, volume, available, lag(close, 2) OVER w AS c2, lag(close, 1) OVER w AS c1, lag(volume, 2) OVER w AS v2, lag(volume, 1) OVER w AS v1,
  lead(close, 2) OVER w AS y, lead(available, 2) OVER w AS y_end, lead(high, 1) OVER w AS h1, lead(high, 2) OVER w AS h2, lead(low, 1) OVER w AS l1, lead(low, 2) OVER w AS l2 FROM c3 WINDOW w AS (PARTITION BY code, day, session, segment ORDER BY t)),
fv AS (SELECT reqs.sample_key, reqs.code, reqs.day, reqs.f1 AS feature_window_close, y_end, round(f.close / c2 - 1, 9) + 0.0 AS simple_return, round(ln(f.close / c2), 9) + 0.0 AS log_return, round((c2 + c1 + f.close) / 3, 9) + 0.0 AS rolling_mean,
  round(sqrt((pow(c2 - (c2 + c1 + f.close) / 3, 2) + pow(c1 - (c2 + c1 + f.close) / 3, 2) + pow(f.close - (c2 + c1 + f.close) / 3, 2)) / 3), 9) + 0.0 AS rolling_std,
  round((v1 + f.volume) / 2, 9) + 0.0 AS rolling_volume_mean, round(f.volume / ((v2 + v1) / 2), 9) + 0.0 AS volume_ratio, round(f.high - f.low, 9) + 0.0 AS candle_range, round(f.close - f.open, 9) + 0.0 AS candle_body,
  round(y / f.close - 1, 9) + 0.0 AS forward_return, sign(y - f.close)::DOUBLE AS forward_direction, round(greatest(0, greatest(h1, h2) / f.close - 1), 9) + 0.0 AS favorable, round(least(0, least(f.l1, f.l2) / f.close - 1), 9) + 0.0 AS adverse
  FROM reqs JOIN fw f ON f.code = reqs.code AND f.t = reqs.t)"""
SPLITS = f"""{FEATURES}, sp0 AS (SELECT *, CAST(feature_window_close - INTERVAL 5 HOUR AS DATE) AS d FROM fv),
sp1 AS (SELECT *, CASE WHEN d <= DATE '2024-01-12' THEN 'TRAIN' WHEN d <= DATE '2024-01-19' THEN 'VALIDATION' WHEN d <= DATE '2024-01-26' THEN 'TEST' END AS nominal FROM sp0),
sp2 AS (SELECT *, CASE nominal WHEN 'TRAIN' THEN TIMESTAMP '2024-01-13 05:00:00' WHEN 'VALIDATION' THEN TIMESTAMP '2024-01-20 05:00:00' END AS edge FROM sp1),
sp3 AS (SELECT *, CASE WHEN nominal IS NULL THEN 'FEATURE_CLOSE_AFTER_TEST_END' WHEN y_end >= edge THEN 'ACTUAL_LABEL_END_CROSSES_' || nominal || '_BOUNDARY' END AS reason FROM sp2),
sp AS (SELECT *, CASE WHEN reason IS NULL THEN 'ASSIGNED' WHEN reason LIKE 'ACTUAL%' THEN 'PURGED' ELSE 'EXCLUDED' END AS status, CASE WHEN reason IS NULL THEN nominal END AS final FROM sp3)"""
CAL = """cal0 AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), span AS (SELECT min(d) AS a, max(d) AS b FROM cal0),
cal AS (SELECT d, a, b, TIMESTAMP '2024-01-01' AS stamp, 'cal-1' AS run, 'WHOLE' AS kind FROM cal0, span
  UNION ALL SELECT d, a + 100, b - 100, TIMESTAMP '2024-02-01', 'cal-2', CASE WHEN day(d) = 1 THEN 'MORNING' ELSE 'WHOLE' END FROM cal0, span WHERE day(d) <> 7 AND d BETWEEN a + 100 AND b - 100),
snap AS (SELECT DISTINCT a, b, stamp, run FROM cal), pick AS (SELECT x.d, snap.run FROM (SELECT DISTINCT d FROM cal) x JOIN snap ON x.d BETWEEN snap.a AND snap.b QUALIFY row_number() OVER (PARTITION BY x.d ORDER BY stamp DESC, run DESC) = 1),
lat AS (SELECT cal.* FROM cal JOIN pick ON pick.d = cal.d AND pick.run = cal.run)"""
RANGES = """r0 AS (SELECT o_custkey % 200 AS k, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INT) AS b FROM orders),
r1 AS (SELECT *, max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r0),
r2 AS (SELECT *, sum(CASE WHEN a <= reach + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM r1),
merged AS (SELECT k, min(a) AS a, max(b) AS b FROM r2 GROUP BY k, island)"""


def _contracts() -> str:
    out = []
    for n, (run, name, lot, at) in enumerate((("o1", "p_name", "p_size", "2024-01-02"), ("o2", "upper(p_name)", "p_size + 1", "2024-01-03"))):
        out.append(f"""o{n} AS (SELECT 'US.' || upper(regexp_extract(p_brand, '^([A-Za-z]+)', 1)) || '240119' || CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END || lpad((p_partkey % 500 * 1000)::VARCHAR, 6, '0') AS option_code, {name} AS option_name,
  CASE WHEN p_partkey % 7 = 0 THEN 'US.' || upper(regexp_extract(p_brand, '^([A-Za-z]+)', 1)) WHEN p_partkey % 11 = 0 THEN 'US.OTHER' ELSE 'US.BRAND' END AS underlying_code,
  CASE WHEN p_partkey % 3 = 0 THEN 'CALL' WHEN p_partkey % 3 = 1 THEN 'PUT' WHEN p_partkey % 2 = 0 THEN 'CALL' ELSE 'PUT' END AS option_type, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE (p_partkey % 500)::DOUBLE END AS strike_price,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE DATE '2024-01-19' END AS expiry_date, ({lot})::DOUBLE AS lot_size, CASE WHEN p_partkey % 5 = 0 THEN true WHEN p_partkey % 5 = 1 THEN false END AS suspension,
  TIMESTAMP '{at}' AS captured_at, '{run}' AS run FROM part QUALIFY row_number() OVER (PARTITION BY option_code ORDER BY p_partkey DESC) = 1)""")
    return ", ".join(out) + ", oc AS (SELECT * FROM o0 UNION ALL SELECT * FROM o1)"


VOL = """vol AS (SELECT 'OPT-' || (l_partkey % 40) AS option_code, CAST(l_shipdate AS DATE) AS trade_date, l_discount AS implied_volatility, round(l_tax - 0.01, 9) + 0.0 AS historical_volatility, l_linenumber::BIGINT AS volatility_status
  FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' AND CAST(l_shipdate AS DATE) <= DATE '1996-12-31'
  QUALIFY row_number() OVER (PARTITION BY l_partkey % 40, CAST(l_shipdate AS DATE) ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) = 1)"""


def _checks(names: list[str], source: str) -> str:
    """Rows of a quality suite from one row of counts."""
    kinds = {"option_underlying_relationship": "WARN", "requested_range_complete": "WARN", "requested_range_complete_by_code": "WARN"}
    return " UNION ALL ".join(f"SELECT '{n}' AS check_name, CASE WHEN {n} = 0 THEN 'PASS' ELSE '{kinds.get(n, 'FAIL')}' END AS result, CAST({n} AS VARCHAR) AS actual FROM {source}" for n in names)


F8 = ["simple_return", "log_return", "rolling_mean", "rolling_std", "rolling_volume_mean", "volume_ratio", "candle_range", "candle_body"]
L4 = ["forward_return", "forward_direction", "favorable", "adverse"]
WIDE = ", ".join(F8 + L4)
NAMED = lambda names, extra: " UNION ALL ".join(f"SELECT sample_key, '{n}' AS name, 'COMPLETE' AS status, {n} AS value, {extra(n)} FROM fv" for n in names)

#: Days, four hours before and the hour of each bar: what the reason queries ask for.
NEAR = """near AS (SELECT a.code, a.t, a.day, count(*) FILTER (b.t >= a.t - INTERVAL 4 HOUR AND b.t < a.t + INTERVAL 1 HOUR) AS n,
  list((b.t, b.day) ORDER BY b.t) FILTER (b.t >= a.t - INTERVAL 4 HOUR AND b.t <= a.t) AS past, count(*) FILTER (b.t = a.t + INTERVAL 1 HOUR) AS x0, count(*) FILTER (b.t = a.t + INTERVAL 2 HOUR) AS x1, count(*) FILTER (b.t = a.t + INTERVAL 3 HOUR) AS x2
  FROM bars a JOIN bars b ON b.code = a.code AND b.t >= a.t - INTERVAL 4 HOUR AND b.t <= a.t + INTERVAL 3 HOUR GROUP BY 1, 2, 3)"""

WD = "(dayofweek({d}) + 6) % 7"
NEXT_WD = "CASE (dayofweek({d}) + 6) % 7 WHEN 5 THEN {d} + 2 WHEN 6 THEN {d} + 1 ELSE {d} END"
PREV_WD = "CASE (dayofweek({d}) + 6) % 7 WHEN 5 THEN {d} - 1 WHEN 6 THEN {d} - 2 ELSE {d} END"

#: Which of the three overlapping builds hold a bar.
IN_BUILD = "(b.build_id = 'b1' AND hour(t) < 16) OR (b.build_id = 'b2' AND hour(t) >= 8) OR (b.build_id = 'b3' AND hour(t) = 23)"

ROW_HASH = digest("'time_utc:timestamp'", "t::VARCHAR", "'market_calendar_date:date'", "day::VARCHAR", "'session:string'", "session", *(x for c in ("open", "high", "low", "close", "volume") for x in (f"'{c}:double'", f"{c}::VARCHAR")))
DIGEST_ROW = digest("'code:string'", "code", "'session:string'", "session", "'key:string'", "key")

ORACLES: dict[str, str] = {
    "bars_normalized": f"""WITH {B} SELECT upper(code) AS code, 'EQUITY' AS asset_type, '60m' AS interval, 'NONE' AS adjustment, t AS time_utc, CAST(t - INTERVAL 5 HOUR AS DATE) AS market_calendar_date, {session("t")} AS session,
      open, high, low, close, volume, t + INTERVAL 1 HOUR AS market_available_at, {occurrence("t", session("t"))} AS occurrence_date FROM b""",
    "bars_latest": f"WITH {CAP} SELECT code, t AS time_utc, run AS ingestion_run_id, close, volume FROM cap QUALIFY row_number() OVER (PARTITION BY code, t ORDER BY ingested_at DESC, run DESC) = 1",
    "bars_query": f"WITH {RANKED} SELECT code, t AS time_utc, session, open, close FROM bars WHERE code = 'view' AND session = 'REGULAR' AND t BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20 12:00:00'",
    "bars_head": f"WITH {RANKED} SELECT t AS time_utc, code, close FROM bars ORDER BY t, code LIMIT 50",
    "bar_quality": f"""WITH {CAP}, q AS (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS non_empty, 0 AS required_columns, count(*) - count(DISTINCT (code, adj, t)) AS duplicate_bars,
      count(*) FILTER (high < greatest(open, close, low) OR low > least(open, close, high)) AS ohlc_consistency, count(*) FILTER (coalesce(volume < 0, true)) AS non_negative_volume,
      (SELECT count(DISTINCT code) FROM (SELECT code, t, lag(t) OVER (PARTITION BY code ORDER BY k, t) AS p FROM bent) WHERE p > t) AS time_monotonic_by_code, count(*) FILTER (open IS NULL) AS non_null_prices FROM bent)
      {_checks(["non_empty", "required_columns", "duplicate_bars", "ohlc_consistency", "non_negative_volume", "time_monotonic_by_code", "non_null_prices"], "q")}""",
    "calendar_latest": f"WITH {CAL} SELECT d AS trade_date, kind AS trade_date_type, a AS requested_start_date, b AS requested_end_date, stamp AS captured_at, run AS ingestion_run_id FROM lat",
    "calendar_query": f"WITH {CAL} SELECT d AS trade_date, kind AS trade_date_type FROM lat WHERE d BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'",
    "calendar_dates": f"WITH {CAL} SELECT DISTINCT d AS trade_date FROM lat WHERE d BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'",
    "calendar_requested_ranges": f'WITH {CAL} SELECT DISTINCT a AS start, b AS "end" FROM cal WHERE a <= DATE \'1995-02-01\' AND b >= DATE \'1995-01-01\'',
    "calendar_dates_after": f"WITH {CAL} SELECT DISTINCT d AS trade_date FROM lat WHERE d > DATE '2001-01-15'",
    "next_trading_dates": f"WITH {CAL}, o AS (SELECT 'c' || o_custkey AS code, CAST(max(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1) SELECT code, min(d) AS next_date FROM o LEFT JOIN lat ON d > day AND d <= DATE '2001-07-20' GROUP BY code",
    "calendar_normalized": "SELECT 'MARKET' AS scope_type, 'US' AS scope_value, CAST(o_orderdate AS DATE) AS trade_date, o_orderstatus AS trade_date_type, o_orderkey AS ingest_seq FROM orders QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1",
    "calendar_quality": f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 90 <> 0 THEN CAST(o_orderdate AS DATE) END AS d, CASE WHEN o_orderkey % 70 = 0 THEN '' WHEN o_orderkey % 110 <> 0 THEN o_orderstatus END AS s,
      CASE WHEN o_orderkey % 50 = 0 THEN 'OTHER' ELSE 'MARKET' END AS x, CASE WHEN o_orderkey % 60 = 0 THEN ' ' ELSE 'US' END AS y FROM orders), q AS (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS non_empty, 0 AS required_columns, count(*) FILTER (d IS NULL) AS trade_date_valid,
      count(*) FILTER (d NOT BETWEEN DATE '1995-01-01' AND DATE '2000-12-31') AS trade_date_in_requested_range, count(*) FILTER (x NOT IN ('MARKET', 'CODE')) AS scope_type_valid, count(*) FILTER (trim(y) = '') AS scope_value_non_empty,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT x, y, d FROM o)) AS duplicate_trading_calendar,
      (SELECT count(*) FROM (SELECT d, lag(d) OVER (PARTITION BY x, y ORDER BY o_orderkey) AS p FROM o) WHERE p > d) AS trade_date_ascending, count(*) FILTER (coalesce(s, '') = '') AS trade_date_type_non_empty FROM o)
      {_checks(["non_empty", "required_columns", "trade_date_valid", "trade_date_in_requested_range", "scope_type_valid", "scope_value_non_empty", "duplicate_trading_calendar", "trade_date_ascending", "trade_date_type_non_empty"], "q")}
      UNION ALL SELECT 'trade_date_type_known', 'WARN', (SELECT string_agg(DISTINCT s, ', ' ORDER BY s) FROM o)""",
    "weekday_chunks": f"""WITH o AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1), c AS (SELECT o_custkey, b, unnest(range(0, (b - a) + 1, 30)) AS i, a FROM o),
      d AS (SELECT o_custkey, CAST(a + CAST(i AS INT) AS DATE) AS s, least(CAST(a + CAST(i AS INT) + 29 AS DATE), b) AS e FROM c)
      SELECT o_custkey, s AS start, e AS "end", {NEXT_WD.format(d="s")} AS next_weekday, {PREV_WD.format(d="e")} AS previous_weekday FROM d""",
    "ranges_merged": f'WITH {RANGES} SELECT k, a AS start, b AS "end" FROM merged',
    "ranges_missing": f"""WITH {RANGES}, w AS (SELECT k, min(a) - 5 AS a, max(b) + 5 AS b FROM r0 GROUP BY k), m AS (SELECT k, a, b, lag(b) OVER (PARTITION BY k ORDER BY a) AS p FROM merged)
      SELECT k, p + 1 AS start, a - 1 AS "end" FROM m WHERE p IS NOT NULL UNION ALL SELECT k, a AS start, a + 4 AS "end" FROM w UNION ALL SELECT k, b - 4, b FROM w""",
    "option_contracts": f"WITH {_contracts()} SELECT option_code, option_name, underlying_code, option_type, strike_price, expiry_date, lot_size, suspension, captured_at FROM oc",
    "option_contracts_latest": f"WITH {_contracts()} SELECT option_code, captured_at, run AS ingestion_run_id, option_name FROM oc QUALIFY row_number() OVER (PARTITION BY option_code ORDER BY captured_at DESC, run DESC) = 1",
    "option_contract_quality": f"""WITH {_contracts()}, n AS (SELECT *, CAST(right(option_code, 6) AS INT) // 1000 AS n FROM oc), bent AS (SELECT n, captured_at, expiry_date, option_code, CASE WHEN n % 19 = 0 THEN ' ' ELSE underlying_code END AS u,
      CASE WHEN n % 23 = 0 THEN 'BOTH' WHEN n % 29 <> 0 THEN option_type END AS k, CASE WHEN n % 31 <> 1 THEN strike_price END AS p FROM n), every AS (SELECT * FROM bent UNION ALL SELECT * REPLACE (' ' AS option_code) FROM bent WHERE n % 37 = 0 UNION ALL SELECT * FROM bent WHERE n % 41 = 0),
      q AS (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS non_empty, 0 AS required_columns, count(*) FILTER (trim(option_code) = '') AS option_code_non_empty, count(*) FILTER (trim(u) = '') AS underlying_code_non_empty, count(*) FILTER (coalesce(k NOT IN ('CALL', 'PUT'), true)) AS option_type_call_or_put,
      count(*) FILTER (p <= 0) AS strike_price_positive, count(*) FILTER (expiry_date IS NULL) AS expiry_date_valid, count(*) - (SELECT count(*) FROM (SELECT DISTINCT option_code, captured_at FROM every)) AS duplicate_option_contracts,
      count(*) FILTER (option_code <> ' ' AND u <> 'US.BRAND') AS option_underlying_relationship FROM every)
      {_checks(["non_empty", "required_columns", "option_code_non_empty", "underlying_code_non_empty", "option_type_call_or_put", "strike_price_positive", "expiry_date_valid", "duplicate_option_contracts", "option_underlying_relationship"], "q")}""",
    "option_volatility": f"WITH {VOL} SELECT * FROM vol",
    "option_volatility_quality": f"""WITH {VOL}, every AS (SELECT * FROM vol UNION ALL SELECT * FROM vol WHERE volatility_status = 1 UNION ALL SELECT * REPLACE (NULL::DATE AS trade_date) FROM vol WHERE volatility_status = 3),
      q AS (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS non_empty, 0 AS required_columns, count(*) FILTER (trade_date IS NULL) AS trade_date_valid, count(*) - (SELECT count(*) FROM (SELECT DISTINCT option_code, trade_date FROM every)) AS duplicate_option_volatility,
      count(*) FILTER (implied_volatility < 0 OR historical_volatility < 0) AS non_negative_volatility, count(*) FILTER (trade_date NOT BETWEEN DATE '1995-12-01' AND DATE '1996-11-30') AS trade_date_in_requested_range,
      CASE WHEN min(trade_date) <= DATE '1995-12-01' AND max(trade_date) >= DATE '1996-11-29' THEN 0 ELSE 1 END AS requested_range_complete,
      (SELECT count(*) FROM (SELECT option_code, min(trade_date) AS a, max(trade_date) AS b FROM every GROUP BY 1) WHERE NOT (a <= DATE '1995-12-01' AND b >= DATE '1996-11-29')) AS requested_range_complete_by_code FROM every)
      {_checks(["non_empty", "required_columns", "trade_date_valid", "duplicate_option_volatility", "non_negative_volatility", "trade_date_in_requested_range", "requested_range_complete", "requested_range_complete_by_code"], "q")}""",
    "option_volatility_coverage": f"WITH {VOL} SELECT option_code, min(trade_date) AS returned_min_date, max(trade_date) AS returned_max_date, count(*) AS row_count, min(trade_date) <= DATE '1996-01-08' AND max(trade_date) >= DATE '1996-12-27' AS range_complete FROM vol GROUP BY 1",
    "option_volatility_latest": f"""WITH {VOL} SELECT option_code, trade_date, round(implied_volatility + CASE WHEN volatility_status < 3 THEN 1 ELSE 0 END, 9) + 0.0 AS implied_volatility, CASE WHEN volatility_status < 3 THEN 'w' ELSE 'v' END AS ingestion_run_id,
      CASE WHEN volatility_status < 3 THEN TIMESTAMP '2024-01-03' ELSE TIMESTAMP '2024-01-02' END AS captured_at FROM vol""",
    "option_code_parts": f"""WITH {_contracts()} SELECT DISTINCT option_code, 'OPTION' AS asset_type, 'US.BRAND' AS underlying, CASE WHEN length(option_code) * 10 <= 183 THEN 'HALF_YEAR' ELSE 'YEAR' END AS period FROM oc""",
    "failed_runs": f"WITH {RUNS} SELECT run AS run_id FROM bad",
    "completed_items": f"WITH {RUNS} SELECT code, day AS requested_trade_date FROM complete WHERE day IN (SELECT day FROM days)",
    "present_items": f"WITH {RUNS} SELECT code, day AS requested_trade_date FROM present WHERE day IN (SELECT day FROM days)",
    "incomplete_reasons": f"WITH {REASONS} SELECT code, day AS requested_trade_date, array_to_string(reasons, ',') AS reasons FROM whys",
    "latest_complete_snapshots": f"WITH {CHOSEN} SELECT code, day AS requested_trade_date, run AS ingestion_run_id, file AS snapshot_file, finished_at AS run_finished_at, ingested_at AS snapshot_ingested_at, n AS row_count FROM chosen",
    "latest_completed_dates": f"WITH {RUNS} SELECT code, max(day) AS latest FROM complete WHERE day <= DATE '2024-01-25' GROUP BY 1",
    "coverage_audit": f"""WITH {STATES} SELECT s.code, count(*) AS expected_count, count(*) FILTER (state = 'COMPLETE') AS complete_count, count(*) FILTER (state = 'INCOMPLETE') AS incomplete_count, count(*) FILTER (state = 'MISSING') AS missing_count,
      round(count(*) FILTER (state = 'COMPLETE') / count(*) * 100, 2) AS coverage_percentage, min(s.day) FILTER (state = 'COMPLETE') AS first_complete_date, max(s.day) FILTER (state = 'COMPLETE') AS last_complete_date,
      coalesce(string_agg(s.day || '=' || coalesce(array_to_string(reasons, '+'), ''), ',' ORDER BY s.day) FILTER (state = 'INCOMPLETE'), '') AS incomplete_reasons, coalesce(string_agg(s.day::VARCHAR, ',' ORDER BY s.day) FILTER (state = 'MISSING'), '') AS missing_dates,
      CASE WHEN count(*) FILTER (state = 'COMPLETE') = count(*) THEN 'PASS' ELSE 'WARN' END AS status FROM states s LEFT JOIN whys w ON w.code = s.code AND w.day = s.day GROUP BY 1""",
    "bar_inventory": f"""WITH {RUNS}, every AS (SELECT *, 'NONE' AS adj, '1' AS v FROM cap UNION ALL SELECT *, 'QFQ', '1' FROM cap WHERE code = 'view' UNION ALL SELECT *, 'NONE', NULL FROM cap WHERE code = 'click')
      SELECT code, '60m' AS interval, 'ALL' AS requested_session, adj AS adjustment, v AS source_schema_version, min(day) AS first_date, max(day) AS last_date, count(DISTINCT day) AS n_dates, count(DISTINCT run) AS n_runs, count(*) AS n_rows, max(ingested_at) AS newest,
      count(*) FILTER (v IS NULL) AS n_legacy, CASE WHEN adj = 'QFQ' THEN 0 ELSE (SELECT count(*) FROM complete c WHERE c.code = every.code) END AS n_complete FROM every GROUP BY code, adj, v""",
    "backfill_plan": f"WITH {RUNS} SELECT s.code, days.day AS trade_date, CASE WHEN c.code IS NULL THEN 'FETCH' ELSE 'SKIP' END AS action FROM (SELECT DISTINCT code FROM cap) s JOIN days ON days.day >= DATE '2024-01-01' + length(s.code)::INT LEFT JOIN complete c ON c.code = s.code AND c.day = days.day",
    "incremental_starts": f"""WITH {RUNS}, l AS (SELECT s.code, max(c.day) AS last FROM (SELECT DISTINCT code FROM cap) s LEFT JOIN complete c ON c.code = s.code AND c.day <= DATE '2024-01-30' AND c.day IN (SELECT day FROM days) GROUP BY 1)
      SELECT code, CASE WHEN last IS NULL THEN DATE '2024-01-01' ELSE (SELECT min(day) FROM days WHERE day > last AND day <= DATE '2024-01-30') END AS start FROM l""",
    "intraday_segments": f"WITH {CHOSEN} SELECT code, day AS requested_trade_date, segment, session, first_time, last_time, row_count, grid_violations, gap_count, missing_bars FROM seg",
    "intraday_gaps": f"WITH {CHOSEN} SELECT code, day AS requested_trade_date, segment, own AS session, before AS previous_time, t AS next_time, delta AS delta_seconds, delta // 3600 - 1 AS missing_bars FROM s5 WHERE delta > 3600 AND delta % 3600 = 0",
    "intraday_checks": f"""WITH {CHOSEN} SELECT code, day AS requested_trade_date, check_name, result, mismatch_count::BIGINT AS mismatch_count, details FROM chk
      UNION ALL SELECT 'unseen', DATE '2024-01-05', 'NON_EMPTY', 'FAIL', 1, ''""",
    "intraday_sessions": f"""WITH {CHOSEN} SELECT code, day AS requested_trade_date, count(*) FILTER (session = 'OVERNIGHT') AS overnight, count(*) FILTER (session = 'PRE_MARKET') AS pre_market, count(*) FILTER (session = 'REGULAR') AS regular,
      count(*) FILTER (session = 'AFTER_HOURS') AS after_hours, min(tm) AS first_time, max(tm) AS last_time FROM aud GROUP BY 1, 2""",
    "intraday_summary": f"""WITH {CHOSEN}, i AS (SELECT code, day, CASE WHEN sum((result = 'FAIL')::INT) > 0 THEN 'FAILED' WHEN sum((result = 'WARN')::INT) > 0 THEN 'WARN' ELSE 'PASS' END AS audit, sum(mismatch_count) FILTER (check_name = 'INTERNAL_GAPS') AS g, sum(mismatch_count) FILTER (check_name = 'DUPLICATE_TIMESTAMPS') AS du, sum(mismatch_count) FILTER (check_name = 'VALID_TIMESTAMPS') AS inv FROM chk GROUP BY 1, 2),
      n AS (SELECT code, day, sum(row_count) AS rows, sum(missing_bars) AS missing FROM seg GROUP BY 1, 2), x AS (SELECT s.state, i.audit, i.g, i.du, i.inv, n.rows, n.missing FROM states s LEFT JOIN i ON i.code = s.code AND i.day = s.day LEFT JOIN n ON n.code = s.code AND n.day = s.day)
      SELECT count(*) AS expected_items, count(*) FILTER (state = 'COMPLETE') AS complete_items, count(*) FILTER (state = 'INCOMPLETE') AS incomplete_items, count(*) FILTER (state = 'MISSING') AS missing_items, count(*) FILTER (audit = 'PASS') AS pass_items,
      count(*) FILTER (audit = 'WARN') AS warn_items, count(*) FILTER (audit = 'FAILED') AS fail_items, coalesce(sum(rows), 0)::BIGINT AS audited_rows, coalesce(sum(du), 0)::BIGINT AS duplicate_timestamps, coalesce(sum(inv), 0)::BIGINT AS invalid_timestamps, coalesce(sum(g), 0)::BIGINT AS internal_gaps,
      coalesce(sum(missing), 0)::BIGINT AS missing_bars, round(count(*) FILTER (state = 'COMPLETE') / count(*) * 100, 2) AS coverage_percentage,
      CASE WHEN count(*) FILTER (audit = 'FAILED') > 0 THEN 'FAILED' WHEN count(*) FILTER (audit = 'WARN' OR state <> 'COMPLETE') > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM x""",
    "canonical_violations": f"""WITH {CAP}, v AS (SELECT *, day(day) AS v FROM cap), w AS (SELECT CASE WHEN v = 1 THEN 'code' WHEN v = 2 THEN 'interval' WHEN v = 3 THEN 'adjustment' WHEN v = 4 THEN 'time_utc' WHEN v = 5 THEN 'time_market' WHEN v = 6 THEN 'market_calendar_date'
      WHEN (v = 7 OR volume = 1) AND session <> 'REGULAR' THEN 'session' WHEN volume = 2 THEN 'number' WHEN v = 9 THEN 'optional number' END AS violation FROM v) SELECT violation, count(*) AS n_rows FROM w WHERE violation IS NOT NULL GROUP BY 1""",
    "canonical_bars": f"WITH {RANKED} SELECT key AS canonical_bar_key, version AS canonical_row_version_id, code, t AS event_time, available AS market_available_at, ingested_at AS archive_available_at, open, high, low, close, volume, session FROM bars",
    "canonical_conflicts": f"WITH {RANKED} SELECT key AS canonical_bar_key, min(code) AS code, min(t) AS event_time, count(*) AS n_sources, 'volume' AS fields FROM ranked GROUP BY key HAVING count(DISTINCT volume) > 1",
    "canonical_resolution": f"WITH {RANKED} SELECT key AS canonical_bar_key, min(run) FILTER (rank = 1) AS selected, coalesce(string_agg(run, ',' ORDER BY rank) FILTER (rank > 1), '') AS discarded FROM ranked GROUP BY key",
    "canonical_provenance": f"WITH {RANKED} SELECT code, day AS requested_trade_date, run AS ingestion_run_id, file AS snapshot_file, count(*) FILTER (rank = 1) AS n_selected, count(*) FILTER (rank > 1) AS n_discarded FROM ranked GROUP BY 1, 2, 3, 4",
    "canonical_source_count": f"WITH {CAP} SELECT count(DISTINCT (code, day, run, file)) AS n_sources FROM cap",
    "canonical_gaps": f"""WITH {GAPS} SELECT gap_id, code, '60m' AS interval, 'NONE' AS adjustment, day AS market_calendar_date, session, before AS previous_event_time, t AS next_event_time, before + INTERVAL 1 HOUR AS missing_from_event_time,
      t - INTERVAL 1 HOUR AS missing_to_event_time, missing AS missing_bar_count FROM gaps""",
    "canonical_gap_boundaries": f"WITH {GAPS} SELECT gap_id, before_version AS previous_canonical_row_version_id, version AS next_canonical_row_version_id, before_available AS previous_market_available_at, ingested_at AS next_archive_available_at FROM gaps",
    "snapshot_hash_groups": f"""WITH {CAP}, d AS (SELECT code, day, run, file, {ROW_HASH} AS d FROM cap), n AS (SELECT code, day, run, file, substr(d, 1, 2) AS p, sha256(string_agg(d, '' ORDER BY d)) AS n FROM d GROUP BY ALL)
      SELECT code, day AS requested_trade_date, run AS ingestion_run_id, file AS snapshot_file, sha256(string_agg(p || n, '' ORDER BY p)) AS logical_source_rows_hash FROM n GROUP BY 1, 2, 3, 4""",
    "content_ids": f"""WITH {RANKED}, d AS (SELECT {DIGEST_ROW} AS d, count(*) AS n FROM bars GROUP BY 1), n AS (SELECT substr(d, 1, 4) AS p, sha256(string_agg(d || ':' || n, '' ORDER BY d)) AS h FROM d GROUP BY 1)
      SELECT sha256(string_agg(p || h, '' ORDER BY p)) AS content_id FROM n""",
    "scope_bars": f"WITH {RANKED} SELECT code, t AS event_time, close FROM bars WHERE code IN ('click', 'view') AND dayofweek(day) BETWEEN 1 AND 5",
    "merged_builds": f"WITH {RANKED} SELECT code, t AS event_time, close, version AS canonical_row_version_id, CASE WHEN hour(t) < 8 THEN 'b1' WHEN hour(t) < 16 THEN 'b1,b2' ELSE 'b2' END AS build_ids FROM bars",
    "builds_reconciled": f"""WITH {RANKED} SELECT key AS canonical_bar_key, CASE WHEN hour(t) < 8 THEN 'b1' WHEN hour(t) < 16 THEN 'b1,b2' WHEN hour(t) < 23 THEN 'b2' ELSE 'b2,b3' END AS build_ids, CASE WHEN hour(t) = 13 THEN 2 ELSE 1 END::BIGINT AS n_contents, low FROM bars""",
    "build_pins": f"""WITH {REQUESTS}, u AS (SELECT DISTINCT bars.version, bars.run, bars.hash, bars.day, bars.t FROM reqs JOIN bars ON bars.code = reqs.code AND bars.t >= f0 AND bars.t < l1),
      v AS (SELECT b.build_id, u.* FROM u JOIN (VALUES ('b1'), ('b2'), ('b3')) b(build_id) ON {IN_BUILD}), d AS (SELECT build_id, run, hash, day, {digest("'canonical_row_version_id:string'", "version")} AS d FROM v),
      n AS (SELECT build_id, run, hash, day, substr(d, 1, 4) AS p, count(*) AS n, sha256(string_agg(d || ':1', '' ORDER BY d)) AS h FROM d GROUP BY ALL),
      x AS (SELECT build_id, run, hash, day, sum(n)::BIGINT AS n, sha256(string_agg(p || h, '' ORDER BY p)) AS id FROM n GROUP BY 1, 2, 3, 4)
      SELECT b.build_id, run AS ingestion_run_id, hash AS physical_snapshot_hash, CASE WHEN n IS NOT NULL THEN '1' END AS source_schema_version, day::VARCHAR AS requested_trade_date, CASE WHEN n IS NOT NULL THEN 'ALL' END AS requested_session, coalesce(n, 0) AS n_row_versions, id AS versions_id
      FROM (VALUES ('b1'), ('b2'), ('b3')) b(build_id) LEFT JOIN x ON x.build_id = b.build_id""",
    "gap_references": f"""WITH {RANKED}, e AS (SELECT b.build_id, bars.* FROM bars JOIN (VALUES ('b1'), ('b2'), ('b3')) b(build_id) ON {IN_BUILD}), g0 AS (SELECT *, lag(t) OVER (PARTITION BY build_id, code, day, session ORDER BY t) AS before FROM e),
      g AS (SELECT build_id, {digest("'gap'", "'MARKET_BARS'", "code", "'60m'", "'NONE'", "day::VARCHAR", "session", instant("before"), instant("t"))} AS gap_id, (epoch(t) - epoch(before))::BIGINT // 3600 - 1 AS missing FROM g0 WHERE epoch(t) - epoch(before) > 3600),
      d AS (SELECT build_id, {digest("'gap_id:string'", "gap_id", "'missing_bar_count:bigint'", "missing::VARCHAR")} AS d FROM g), n AS (SELECT build_id, substr(d, 1, 4) AS p, count(*) AS n, sha256(string_agg(d || ':1', '' ORDER BY d)) AS h FROM d GROUP BY 1, 2),
      x AS (SELECT build_id, sum(n)::BIGINT AS n, sha256(string_agg(p || h, '' ORDER BY p)) AS id FROM n GROUP BY 1)
      SELECT b.build_id, coalesce(n, 0) AS gap_range_count, id AS gap_content_id FROM (VALUES ('b1'), ('b2'), ('b3')) b(build_id) LEFT JOIN x ON x.build_id = b.build_id""",
    "sample_ledger": f"""WITH {REQUESTS} SELECT sample_key, 1::BIGINT AS n_requests, code <> 'view' AND dayofweek(day) BETWEEN 1 AND 5 AS in_scope, 3::BIGINT AS n_feature_rows, 2::BIGINT AS n_label_rows, 3::BIGINT AS positions, 8::BIGINT AS n_features, 8::BIGINT AS n_complete_features, 4::BIGINT AS n_labels,
      CASE WHEN code = 'click' THEN 0 ELSE 1 END::BIGINT AS n_assigned FROM reqs""",
    "calendar_gaps": f"""WITH {CAL}, r AS (SELECT DISTINCT a, b FROM cal WHERE run = 'cal-2') SELECT DATE '1995-01-01' AS start, a - 1 AS "end" FROM r UNION ALL SELECT b + 1, DATE '2001-12-31' FROM r""",
    "sample_segments": f"WITH {SEGMENTS} SELECT code, day AS market_calendar_date, session, t AS first_event_time, n AS segment_bars FROM c3 WHERE pos = 0",
    "sample_requests": f"""WITH {REQUESTS} SELECT sample_key, code, '60m' AS interval, 'NONE' AS adjustment, 'ALL' AS requested_session, day AS anchor_market_calendar_date, f0 AS feature_window_start, f1 AS feature_window_close, l0 AS label_window_start, l1 AS label_window_close FROM reqs""",
    "sample_shortfalls": f"WITH {SEGMENTS} SELECT count(*) FILTER (pos = 0) AS n_segments, count(*) FILTER (pos = 0 AND n < 3) AS n_short_segments, count(*) FILTER (pos >= 2 AND pos + 2 >= n) AS n_unlabelled_anchors FROM c3",
    "minute_bars": f"""WITH {minute_bars("user_id")} SELECT code, t AS event_time, day AS market_calendar_date, session, open, high, low, close, volume, t + INTERVAL 1 MINUTE AS market_available_at FROM m""",
    "minute_segments": f"""WITH {minute_bars("event_type")}, s1 AS (SELECT *, CASE WHEN t - lag(t) OVER w = INTERVAL 1 MINUTE THEN 0 ELSE 1 END AS new FROM m WINDOW w AS (PARTITION BY code, day, session ORDER BY t)),
      s2 AS (SELECT *, sum(new) OVER (PARTITION BY code, day, session ORDER BY t) AS segment FROM s1)
      SELECT code, day AS market_calendar_date, session, min(t) AS first_event_time, count(*) AS segment_bars FROM s2 GROUP BY code, day, session, segment""",
    "minute_windows": f"""WITH {minute_bars("event_type")}, x AS (SELECT code || '|' || epoch(t)::BIGINT AS sample_key, count(*) OVER f - 1 AS nf, max(high) OVER (PARTITION BY code ORDER BY t RANGE BETWEEN INTERVAL 29 MINUTE PRECEDING AND INTERVAL 1 MINUTE PRECEDING) AS hf, count(*) OVER l AS nl, max(high) OVER l AS hl FROM m
      WINDOW f AS (PARTITION BY code ORDER BY t RANGE BETWEEN INTERVAL 29 MINUTE PRECEDING AND CURRENT ROW), l AS (PARTITION BY code ORDER BY t RANGE BETWEEN INTERVAL 1 MINUTE FOLLOWING AND INTERVAL 10 MINUTE FOLLOWING))
      SELECT sample_key, 'FEATURE' AS role, nf AS n_selected, 1::BIGINT AS n_late, hf AS highest FROM x UNION ALL SELECT sample_key, 'LABEL', nl, 0, hl FROM x WHERE nl > 0""",
    "pit_association": f"""WITH {REQUESTS}, w AS (SELECT sample_key, code, 'FEATURE' AS role, f0 AS a, f1 AS b FROM reqs UNION ALL SELECT sample_key, code, 'LABEL', l0, l1 FROM reqs)
      SELECT sample_key, role, row_number() OVER (PARTITION BY sample_key, role ORDER BY bars.t) - 1 AS position, version AS canonical_row_version_id, bars.t AS event_time FROM w JOIN bars ON bars.code = w.code AND bars.t >= a AND bars.t < b""",
    "pit_diagnostics": f"""WITH {REQUESTS}, w AS (SELECT sample_key, code, 'FEATURE' AS role, f0 AS a, f1 - INTERVAL 30 MINUTE AS b FROM reqs UNION ALL SELECT sample_key, code, 'LABEL', l0, l1 - INTERVAL 30 MINUTE FROM reqs),
      p AS (SELECT role, sample_key, CASE WHEN available > b THEN 'LATE' WHEN bars.ingested_at > TIMESTAMP '2024-02-01 01:30:00' THEN 'NOT' ELSE 'SELECTED' END AS s FROM w JOIN bars ON bars.code = w.code AND bars.t >= a AND bars.t < b)
      SELECT role, (SELECT count(*) FROM w WHERE w.role = p.role) AS n_windows, count(DISTINCT sample_key) AS n_samples, count(*) AS n_candidates, count(*) FILTER (s = 'SELECTED') AS n_selected, count(*) FILTER (s = 'LATE') AS n_not_market_available, count(*) FILTER (s = 'NOT') AS n_not_archived FROM p GROUP BY role""",
    "pit_known_gaps": f"""WITH {GAPS}, r AS (SELECT DISTINCT code, CAST(t AS DATE) AS d FROM bars), w AS (SELECT code || '-' || d AS sample_key, code, 'FEATURE' AS role, d::TIMESTAMP AS a, d::TIMESTAMP + INTERVAL 20 HOUR AS b FROM r
      UNION ALL SELECT code || '-' || d, code, 'LABEL', d::TIMESTAMP + INTERVAL 20 HOUR, d::TIMESTAMP + INTERVAL 24 HOUR FROM r)
      SELECT sample_key, role, string_agg(gap_id, ',' ORDER BY gap_id) AS gap_ids FROM w JOIN gaps ON gaps.code = w.code AND before + INTERVAL 1 HOUR < b AND t - INTERVAL 1 HOUR >= a
      WHERE available <= b AND greatest(before_archived, ingested_at) <= TIMESTAMP '2024-02-01 02:30:00' GROUP BY 1, 2""",
    "sample_versions": f"""WITH {REQUESTS}, w AS (SELECT sample_key, code, 'FEATURE' AS role, f0 AS a, f1 AS b FROM reqs UNION ALL SELECT sample_key, code, 'LABEL', l0, l1 FROM reqs),
      x AS (SELECT sample_key, role, row_number() OVER (PARTITION BY sample_key, role ORDER BY bars.t) - 1 AS position, version FROM w JOIN bars ON bars.code = w.code AND bars.t >= a AND bars.t < b),
      j AS (SELECT sample_key, '[' || string_agg('{{"role":"' || role || '","position":' || position || ',"canonical_row_version_id":"' || version || '"}}', ',' ORDER BY role, position) || ']' AS used FROM x GROUP BY 1)
      SELECT sample_key, {digest("sample_key", "used")} AS sample_version_id FROM j""",
    "feature_values": f"WITH {FEATURES} {NAMED(F8, lambda n: ('2' if n == 'rolling_volume_mean' else '1' if n.startswith('candle') else '3') + ' AS n_consumed')}",
    "feature_reasons": f"""WITH {RANKED}, {NEAR}, r AS (SELECT CASE WHEN n < 4 THEN 'INSUFFICIENT_ROWS' WHEN len(list_filter(past[-4:], lambda x: x[2] <> day)) > 0 THEN 'CROSS_MARKET_DATE'
      WHEN epoch(past[-1][1]) - epoch(past[-4][1]) <> 3 * 3600 THEN 'NON_CONTIGUOUS_ROWS' END AS reason_code FROM near) SELECT CASE WHEN reason_code IS NULL THEN 'COMPLETE' ELSE 'EXCLUDED' END AS status, reason_code, count(*) AS n_samples FROM r GROUP BY 1, 2""",
    "label_values": f"WITH {FEATURES} {NAMED(L4, lambda n: 'y_end AS end_time')}",
    "label_reasons": f"""WITH {RANKED}, {NEAR}, r AS (SELECT 'f' AS name, CASE WHEN x2 = 0 THEN 'MISSING_TARGET_ROW' END AS reason_code FROM near UNION ALL
      SELECT 'x', CASE WHEN x2 = 0 THEN 'MISSING_TARGET_ROW' WHEN x0 = 0 THEN 'INSUFFICIENT_ROWS' WHEN x1 = 0 THEN 'NON_CONTIGUOUS_ROWS' END FROM near)
      SELECT name, CASE WHEN reason_code IS NULL THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status, reason_code, count(*) AS n_samples FROM r GROUP BY 1, 2, 3""",
    "split_assignments": f"""WITH {SPLITS} SELECT sample_key, feature_window_close, y_end AS actual_label_end_time, d AS feature_window_close_date, nominal AS nominal_split, final AS final_split, status AS assignment_status, reason AS reason_code,
      CASE WHEN status = 'PURGED' THEN edge END AS purge_boundary FROM sp""",
    "split_counts": f"WITH {SPLITS} SELECT status AS assignment_status, nominal AS nominal_split, reason AS reason_code, count(*) AS n_samples FROM sp GROUP BY 1, 2, 3",
    "split_mismatches": f"WITH {SPLITS} SELECT sample_key, code, 'TEST' AS final_split FROM sp WHERE code = 'view' AND final IS DISTINCT FROM 'TEST'",
    "dataset_rows": f"WITH {SPLITS} SELECT code, sample_key, feature_window_close, 'COMPLETE' AS label_status, {WIDE.replace('forward_direction', 'forward_direction::BIGINT AS forward_direction')}, final AS final_split, status AS assignment_status FROM sp",
    "dataset_completion": f"""WITH {REQUESTS}, days AS (SELECT DISTINCT day FROM cap WHERE dayofweek(day) BETWEEN 1 AND 5), n AS (SELECT code, day, count(*) AS n FROM reqs GROUP BY 1, 2)
      SELECT s.code, days.day AS trade_date, coalesce(n.n, 0) AS n_samples, CASE WHEN n.n IS NULL THEN 'MISSING' ELSE 'COMPLETE' END AS status, NULL::VARCHAR AS reason FROM (SELECT DISTINCT code FROM cap) s CROSS JOIN days LEFT JOIN n ON n.code = s.code AND n.day = days.day""",
    "dataset_diagnostics": f"""WITH {SPLITS} SELECT count(*) AS n_rows, count(*) FILTER (status = 'ASSIGNED') AS n_assigned, count(*) FILTER (status = 'PURGED') AS n_purged, count(*) FILTER (status = 'EXCLUDED') AS n_excluded, count(*) FILTER (final = 'TRAIN') AS n_train,
      count(*) FILTER (final = 'VALIDATION') AS n_validation, count(*) FILTER (final = 'TEST') AS n_test, (SELECT count(*) FROM reqs) AS n_requests, (SELECT count(*) FROM reqs) - count(*) AS n_without_features FROM sp""",
    "catalog_entries": f"""WITH {SPLITS} SELECT 'ds-' || CAST(feature_window_close AS DATE) AS dataset_id, count(*) AS row_count, string_agg(DISTINCT code, ',' ORDER BY code) AS symbols, min(CAST(feature_window_close AS DATE))::VARCHAR AS dates,
      min(feature_window_close) AS first_close, max(feature_window_close) AS last_close, count(*) FILTER (status = 'ASSIGNED') AS assigned_count FROM sp GROUP BY 1""",
    "catalog_search": f"""WITH {SPLITS}, e AS (SELECT 'ds-' || CAST(feature_window_close AS DATE) AS dataset_id, count(*) AS row_count FROM sp GROUP BY 1 HAVING count(*) FILTER (code = 'click') > 0)
      SELECT dataset_id, row_count, (SELECT count(*) FROM e) AS matched_count FROM e ORDER BY dataset_id LIMIT 10 OFFSET 2""",
    "catalog_lookup": f"WITH {SPLITS} SELECT 'ds-2024-01-10' AS dataset_id, count(*) AS row_count, count(*) FILTER (status = 'ASSIGNED') AS assigned_count FROM sp WHERE CAST(feature_window_close AS DATE) = DATE '2024-01-10' HAVING count(*) > 0",
    "dataset_page": f"""WITH {SPLITS} SELECT '{{"code":"' || code || '","feature_window_close":"' || strftime(feature_window_close, '%Y-%m-%d %H:%M:%S') || '","sample_key":"' || sample_key || '","label_status":"COMPLETE"}}' AS row
      FROM sp ORDER BY code, feature_window_close, sample_key LIMIT 20 OFFSET 5""",
    "coverage_totals": f"""WITH {STATES}, n AS (SELECT count(*) AS a, count(*) FILTER (state = 'COMPLETE') AS b, count(*) FILTER (state = 'INCOMPLETE') AS c, count(*) FILTER (state = 'MISSING') AS d FROM states)
      SELECT a AS expected_count, b AS complete_count, c AS incomplete_count, d AS missing_count, round(b / a * 100, 2) AS coverage_percentage, 0::BIGINT AS calendar_gap_count, CASE WHEN a = b THEN 'PASS' ELSE 'WARN' END AS status, 'whole' AS calendar FROM n
      UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 2, 'FAILED', 'part'""",
    "bar_inventory_totals": f"WITH {CAP} SELECT count(*) AS n_rows, count(DISTINCT code) AS n_symbols, count(DISTINCT day) AS n_dates, count(DISTINCT run) AS n_runs, 1::BIGINT AS n_keys, 0::BIGINT AS n_legacy FROM cap",
    "intraday_gap_details": f"""WITH {CHOSEN} SELECT code, day AS requested_trade_date, segment, own AS session, before AS previous_time, t AS next_time, delta AS delta_seconds, delta // 3600 - 1 AS missing_bars,
      count(*) OVER (PARTITION BY code, day) > 2 AS truncated FROM s5 WHERE delta > 3600 AND delta % 3600 = 0 QUALIFY row_number() OVER (PARTITION BY code, day ORDER BY before, segment) <= 2""",
    "canonical_from_snapshots": f"""WITH {CHOSEN}, x AS (SELECT cap.*, c.finished_at, {digest("'MARKET_BARS'", "cap.code", "'60m'", "'NONE'", instant("t"))} AS key FROM cap JOIN chosen c ON c.code = cap.code AND c.day = cap.day AND c.run = cap.run)
      SELECT key AS canonical_bar_key, {digest("key", "run", "sha256('content of ' || file)", "'1'", "'1'")} AS canonical_row_version_id, code, t AS event_time, finished_at AS archive_available_at, close, run AS ingestion_run_id FROM x""",
    "sample_requests_apart": f"""WITH {SEGMENTS}, x AS (SELECT *, t - INTERVAL 1 HOUR AS f0, t + INTERVAL 1 HOUR AS f1, t + INTERVAL 2 HOUR AS l1 FROM c3 WHERE pos >= 1 AND (pos - 1) % 2 = 0 AND pos + 1 < n)
      SELECT {digest("code", "'60m'", "'NONE'", "'ALL'", "day::VARCHAR", instant("f0"), instant("f1"), instant("f1"), instant("l1"))} AS sample_key, code, f1 AS feature_window_close, l1 AS label_window_close FROM x""",
    "split_edges": f"""WITH {RANKED}, x AS (SELECT code || '@' || strftime(t, '%Y%m%d%H') AS sample_key, t + INTERVAL 1 HOUR AS feature_window_close, CASE WHEN hour(t) % 5 = 0 THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS label_status, CASE WHEN hour(t) % 7 <> 0 THEN t + INTERVAL 6 HOUR END AS y FROM bars),
      e1 AS (SELECT *, CAST(feature_window_close - INTERVAL 5 HOUR AS DATE) AS d FROM x), e2 AS (SELECT *, CASE WHEN d <= DATE '2024-01-12' THEN 'TRAIN' WHEN d <= DATE '2024-01-19' THEN 'VALIDATION' WHEN d <= DATE '2024-01-26' THEN 'TEST' END AS nominal FROM e1),
      e3 AS (SELECT *, CASE nominal WHEN 'TRAIN' THEN TIMESTAMP '2024-01-13 05:00:00' WHEN 'VALIDATION' THEN TIMESTAMP '2024-01-20 05:00:00' END AS edge FROM e2),
      e4 AS (SELECT *, CASE WHEN nominal IS NULL THEN 'FEATURE_CLOSE_AFTER_TEST_END' WHEN label_status = 'INCOMPLETE' THEN 'INCOMPLETE_LABEL' WHEN y >= edge THEN 'ACTUAL_LABEL_END_CROSSES_' || nominal || '_BOUNDARY' END AS reason FROM e3)
      SELECT sample_key, feature_window_close, label_status, y AS actual_label_end_time, d AS feature_window_close_date, nominal AS nominal_split, reason AS reason_code, CASE WHEN reason IS NULL THEN 'ASSIGNED' WHEN reason LIKE 'ACTUAL%' THEN 'PURGED' ELSE 'EXCLUDED' END AS assignment_status,
      CASE WHEN reason IS NULL THEN nominal END AS final_split, CASE WHEN reason LIKE 'ACTUAL%' THEN edge END AS purge_boundary FROM e4""",
    "stored_bars": f"WITH {CAP} SELECT code, t AS time_utc, '60m' AS interval, day AS requested_trade_date, run AS ingestion_run_id, close, volume, NULL::DOUBLE AS turnover, 64 AS n_digits FROM cap",
    "stored_calendar": f"WITH {CAL} SELECT d AS trade_date, kind AS trade_date_type, a AS requested_start_date, b AS requested_end_date, stamp AS captured_at, run AS ingestion_run_id FROM cal",
    "bar_batches": f"""WITH {B}, x AS (SELECT *, CAST(t - INTERVAL 5 HOUR AS DATE) AS day FROM b)
      SELECT CASE WHEN day = DATE '2024-01-10' THEN 'r1' ELSE 'r2' END AS run_id, day::VARCHAR AS requested_trade_date, count(*) AS row_count, string_agg(DISTINCT upper(code), ',' ORDER BY upper(code)) AS symbols, CASE WHEN day = DATE '2024-01-10' THEN '' ELSE 'UNSEEN' END AS failed,
      CASE WHEN day = DATE '2024-01-10' THEN 'SUCCESS' ELSE 'PARTIAL' END AS status FROM x WHERE day IN (DATE '2024-01-10', DATE '2024-01-11') GROUP BY day""",
    "stored_build_parts": f"WITH {RANKED} SELECT key AS canonical_bar_key, code, t AS event_time, close FROM bars WHERE code = 'view' AND day BETWEEN DATE '2024-01-08' AND DATE '2024-01-19'",
    "stored_build_altered": f"WITH {RANKED} SELECT code, day AS market_calendar_date, count(*) AS n_stored, count(*) AS n_found FROM bars WHERE code = 'view' AND day(day) % 5 = 0 GROUP BY 1, 2",
    "catalog_indexed_search": f"""WITH {SPLITS}, e AS (SELECT code || '-' || weekofyear(CAST(feature_window_close AS DATE)) AS dataset_id, code, count(*) AS row_count, bool_or(CAST(feature_window_close AS DATE) = DATE '2024-01-10') AS dated FROM sp GROUP BY 1, 2),
      one AS (SELECT dataset_id, row_count, (SELECT count(*) FROM e WHERE code = 'click') AS matched_count FROM e WHERE code = 'click' ORDER BY dataset_id LIMIT 2 OFFSET 1)
      SELECT 'symbol' AS search, * FROM one UNION ALL SELECT 'date', dataset_id, row_count, count(*) OVER () FROM e WHERE dated
      UNION ALL SELECT 'both', dataset_id, row_count, count(*) OVER () FROM e WHERE dated AND code = 'view' UNION ALL SELECT 'id', dataset_id, row_count, NULL FROM e WHERE dataset_id = 'view-3'""",
    "catalog_of_datasets": f"""WITH {SPLITS} SELECT count(*) AS row_count, string_agg(DISTINCT code, ',' ORDER BY code) AS symbols, min(feature_window_close) AS first_close, max(feature_window_close) AS last_close, count(*) FILTER (status = 'ASSIGNED') AS assigned_count
      FROM sp WHERE final IN ('TRAIN', 'VALIDATION') GROUP BY final""",
}

# What was written comes back as it was.
ORACLES |= {"stored_option_contracts": ORACLES["option_contracts"], "stored_option_volatility": ORACLES["option_volatility"], "stored_build": ORACLES["canonical_bars"]}

#: Columns that hold dates, by query; both sides return them as text.
DATES: dict[str, tuple[str, ...]] = {
    "bars_normalized": ("market_calendar_date", "occurrence_date",),
    "calendar_latest": ("trade_date", "requested_start_date", "requested_end_date",),
    "calendar_query": ("trade_date",),
    "calendar_dates": ("trade_date",),
    "calendar_requested_ranges": ("start", "end",),
    "calendar_dates_after": ("trade_date",),
    "next_trading_dates": ("next_date",),
    "calendar_normalized": ("trade_date",),
    "weekday_chunks": ("start", "end", "next_weekday", "previous_weekday",),
    "ranges_merged": ("start", "end",),
    "ranges_missing": ("start", "end",),
    "option_contracts": ("expiry_date",),
    "option_volatility": ("trade_date",),
    "option_volatility_coverage": ("returned_min_date", "returned_max_date",),
    "completed_items": ("requested_trade_date",),
    "present_items": ("requested_trade_date",),
    "incomplete_reasons": ("requested_trade_date",),
    "latest_complete_snapshots": ("requested_trade_date",),
    "latest_completed_dates": ("latest",),
    "coverage_audit": ("first_complete_date", "last_complete_date",),
    "bar_inventory": ("first_date", "last_date",),
    "backfill_plan": ("trade_date",),
    "incremental_starts": ("start",),
    "intraday_segments": ("requested_trade_date",),
    "intraday_gaps": ("requested_trade_date",),
    "intraday_checks": ("requested_trade_date",),
    "intraday_sessions": ("requested_trade_date",),
    "canonical_provenance": ("requested_trade_date",),
    "canonical_gaps": ("market_calendar_date",),
    "sample_segments": ("market_calendar_date",),
    "minute_bars": ("market_calendar_date",),
    "minute_segments": ("market_calendar_date",),
    "calendar_gaps": ("start", "end"),
    "sample_requests": ("anchor_market_calendar_date",),
    "split_assignments": ("feature_window_close_date",),
    "dataset_completion": ("trade_date",),
    "option_volatility_latest": ("trade_date",),
    "snapshot_hash_groups": ("requested_trade_date",),
    "intraday_gap_details": ("requested_trade_date",),
    "split_edges": ("feature_window_close_date",),
    "stored_bars": ("requested_trade_date",),
    "stored_calendar": ("trade_date", "requested_start_date", "requested_end_date",),
    "stored_option_contracts": ("expiry_date",),
    "stored_option_volatility": ("trade_date",),
    "stored_build_altered": ("market_calendar_date",),
}
for _name, _columns in DATES.items():
    _casts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLES[_name]})"

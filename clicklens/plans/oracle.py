"""ANSI SQL twins of the registered queries, for an independent engine (DuckDB) over the same tables.

They state each query's meaning the plain way (full windows, joins, scalar subqueries) so that the
Spark plans -- which use per-group limits, pre-aggregation and sliced windows -- are checked against
a straightforward definition rather than against a copy of themselves. Timestamps are compared as
formatted strings.
"""

from __future__ import annotations

FLOW = "1,2,3,4,5,6,7"
THRESHOLD = 3
RANGE = ("2024-01-08", "2024-01-21")
# Replays: late clicks (every LATE_EACH-th, sent last), the declared arrival clock, and broken lines beside the clicks.
LATE_BATCHES, LATE_EACH = 5, 7
ARRIVAL_BATCHES, ARRIVAL_START, ARRIVAL_STEP_S = 5, "2030-01-01 00:00:00", 20
BROKEN = (97, 101)

VISIT_LOG = """
SELECT event_id,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
  user_id,
  CONCAT(CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id,
  TRY_CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS BIGINT) % 10 + 1 AS page_id,
  ts AS action_time,
  CASE WHEN event_type IN ('click', 'view') THEN event_id % 20 + 1 ELSE -1 END AS click_category_id,
  CASE WHEN event_type = 'signup' THEN CONCAT(CAST(event_id % 20 + 1 AS VARCHAR), ',',
       CAST((event_id * 7) % 20 + 1 AS VARCHAR)) END AS order_category_ids,
  CASE WHEN event_type = 'purchase' THEN CONCAT(CAST(event_id % 20 + 1 AS VARCHAR), ',',
       CAST((event_id * 3) % 20 + 1 AS VARCHAR)) END AS pay_category_ids
FROM events
"""

ADS_LOG = """
SELECT e.event_id, e.ts, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS dt,
  REPLACE(r.r_name, ' ', '-') AS area, n.n_name AS city, CAST(e.user_id AS VARCHAR) AS userid,
  CAST(TRY_CAST(REGEXP_EXTRACT(e.props, '([0-9]+)', 1) AS BIGINT) % 6 + 1 AS VARCHAR) AS adid
FROM events e
LEFT JOIN (customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
                     JOIN region r ON r.r_regionkey = n.n_regionkey) ON c.c_custkey = e.user_id
"""

TS_US = "'%Y-%m-%d %H:%M:%S.%f'"
TS_MS = "'%Y-%m-%d %H:%M:%S.%g'"
TS_S = "'%Y-%m-%d %H:%M:%S'"


def _non_blank(c: str) -> str:
    return f"({c} IS NOT NULL AND regexp_matches({c}, '[^\\x00-\\x20]'))"


def _ids(c: str) -> str:
    s = f"regexp_replace({c}, ',+\\z', '')"
    return f"CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE string_split({s}, ',') END"


ROUTING = f"""
SELECT event_id, CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS metric
FROM v WHERE COALESCE(click_category_id, -1) <> -1
UNION ALL
SELECT event_id, UNNEST({_ids('order_category_ids')}) AS category_id, 'order' AS metric
FROM v WHERE COALESCE(click_category_id, -1) = -1 AND {_non_blank('order_category_ids')}
UNION ALL
SELECT event_id, UNNEST({_ids('pay_category_ids')}) AS category_id, 'pay' AS metric
FROM v WHERE COALESCE(click_category_id, -1) = -1 AND NOT {_non_blank('order_category_ids')}
  AND {_non_blank('pay_category_ids')}
"""

PIVOT = """
SELECT category_id,
  COUNT(*) FILTER (WHERE metric = 'click') AS click_count,
  COUNT(*) FILTER (WHERE metric = 'order') AS order_count,
  COUNT(*) FILTER (WHERE metric = 'pay') AS pay_count
FROM r GROUP BY category_id
"""

TOP10 = f"""
SELECT * FROM ({PIVOT}) p ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
"""

CLICKS = """
SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id
FROM v WHERE COALESCE(click_category_id, -1) <> -1
"""


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in ctes) + "\n"


def _pairs_values(flow: str) -> str:
    ids = [int(p) for p in flow.split(",")]
    pairs = list(dict.fromkeys(zip(ids, ids[1:])))
    # page ids are BIGINT in the visit log; the literals take that type
    return ("SELECT CAST(from_page AS BIGINT) AS from_page, CAST(to_page AS BIGINT) AS to_page FROM (VALUES "
            + ", ".join(f"({a}, {b})" for a, b in pairs) + ") t(from_page, to_page)")


STEPS = """
SELECT session_id, page_id AS from_page,
  LEAD(page_id) OVER w AS to_page, LEAD(action_time) OVER w AS next_time, LEAD(1) OVER w AS has_next,
  action_time
FROM v WINDOW w AS (PARTITION BY session_id ORDER BY action_time, event_id)
"""

BUCKETS = """
SELECT time_bucket(INTERVAL 10 SECOND, ts) AS b, COUNT(*) AS clicks FROM a GROUP BY 1
"""


def oracle_sql() -> dict[str, str]:
    v = ("v", VISIT_LOG)
    a = ("a", ADS_LOG)
    r = ("r", ROUTING)
    lo, hi = RANGE
    flow_ids = ", ".join(FLOW.split(","))
    n = THRESHOLD
    visit_cols = (f"event_id, date, user_id, session_id, page_id, strftime(action_time, {TS_US}) AS action_time, "
                  "click_category_id, order_category_ids, pay_category_ids")
    first = ("f", "SELECT dt, adid, userid, ts, event_id, ROW_NUMBER() OVER (PARTITION BY dt, adid, userid "
                  "ORDER BY ts, event_id) AS rn FROM a")
    since = ("s", f"SELECT userid, MIN(ts) AS since FROM f WHERE rn = {n} GROUP BY userid")
    by_batch = ("c", "SELECT dt, adid, userid, event_id % 5 AS batch, COUNT(*) AS n FROM a GROUP BY dt, adid, userid, event_id % 5")
    run = ("rr", "SELECT *, SUM(n) OVER (PARTITION BY dt, adid, userid ORDER BY batch "
                 "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM c")
    listed = ("l", f"SELECT userid, MIN(batch) AS since_batch FROM rr WHERE running >= {n} GROUP BY userid")
    top = ("t", TOP10)
    rollup = ("ro", "SELECT dt, area, adid, COUNT(*) AS clicks FROM a GROUP BY dt, area, adid")
    top3 = ("t3", "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY dt, area ORDER BY clicks DESC, adid) "
                  "AS rank FROM ro) WHERE rank <= 3")
    trend = f"SELECT strftime(b, {TS_S}) AS bucket, clicks FROM bk"
    q = {
        "visit_log": _with(v) + f"SELECT {visit_cols} FROM v",
        "visit_date_range": _with(v) + f"SELECT {visit_cols} FROM v WHERE date >= '{lo}' AND date <= '{hi}'",
        "visit_row_count": _with(v) + "SELECT COUNT(*) AS n FROM v",
        "visit_log_typed": _with(v) + f"SELECT event_id, date, user_id, session_id, page_id, "
                                      f"strftime(action_time, {TS_US}) AS action_time, "
                                      "CAST(NULL AS VARCHAR) AS search_keyword, click_category_id, "
                                      "CAST(NULL AS BIGINT) AS click_product_id, order_category_ids, "
                                      "CAST(NULL AS VARCHAR) AS order_product_ids, pay_category_ids, "
                                      "CAST(NULL AS VARCHAR) AS pay_product_ids, CAST(NULL AS BIGINT) AS city_id "
                                      "FROM v",
        "action_routing": _with(v, r) + "SELECT event_id, category_id, metric FROM r",
        "category_metric_counts": _with(v, r) + "SELECT category_id, metric, COUNT(*) AS n FROM r GROUP BY ALL",
        "category_metric_pivot": _with(v, r) + PIVOT,
        "hot_category_top10": _with(v, r) + TOP10,
        "hot_category_top10_ranged": _with(("v", f"SELECT * FROM ({VISIT_LOG}) WHERE date >= '{lo}' AND date <= '{hi}'"),
                                           r) + TOP10,
        "top_category_clicks": _with(v, r, top) + f"SELECT category_id, session_id FROM ({CLICKS}) "
                                                  "WHERE category_id IN (SELECT category_id FROM t)",
        "category_session_counts": _with(v, r, top) + f"SELECT category_id, session_id, COUNT(*) AS click_count "
                                                      f"FROM ({CLICKS}) WHERE category_id IN "
                                                      "(SELECT category_id FROM t) GROUP BY ALL",
        "hot_category_session_top10": _with(
            v, r, top,
            ("cs", f"SELECT category_id, session_id, COUNT(*) AS click_count FROM ({CLICKS}) "
                   "WHERE category_id IN (SELECT category_id FROM t) GROUP BY ALL"))
        + "SELECT category_id, session_id, click_count FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
          "category_id ORDER BY click_count DESC, session_id) AS rn FROM cs) WHERE rn <= 10",
        "page_visits": _with(v) + f"SELECT page_id, COUNT(*) AS visits FROM v WHERE page_id IN ({flow_ids}) "
                                  "GROUP BY page_id",
        "page_transitions": _with(v, ("st", STEPS)) + "SELECT from_page, to_page, COUNT(*) AS num FROM st "
                                                      "WHERE has_next IS NOT NULL GROUP BY ALL",
        "page_conversion": _with(
            v, ("st", STEPS), ("p", _pairs_values(FLOW)),
            ("nm", "SELECT st.from_page, st.to_page, COUNT(*) AS num FROM st JOIN p ON st.from_page = p.from_page "
                   "AND st.to_page = p.to_page WHERE has_next IS NOT NULL GROUP BY ALL"),
            ("dn", f"SELECT page_id, COUNT(*) AS den FROM v WHERE page_id IN ({flow_ids}) GROUP BY page_id"))
        + "SELECT nm.from_page, nm.to_page, nm.num, COALESCE(dn.den, 1) AS den, "
          "CAST(nm.num AS DOUBLE) / COALESCE(dn.den, 1) AS rate FROM nm LEFT JOIN dn ON dn.page_id = nm.from_page",
        "page_conversion_all_hops": _with(
            v, ("st", STEPS), ("p", _pairs_values(FLOW)),
            ("nm", "SELECT p.from_page, p.to_page, COUNT(st.from_page) AS num FROM p LEFT JOIN st "
                   "ON st.from_page = p.from_page AND st.to_page = p.to_page AND st.has_next IS NOT NULL "
                   "GROUP BY ALL"),
            ("dn", f"SELECT page_id, COUNT(*) AS den FROM v WHERE page_id IN ({flow_ids}) GROUP BY page_id"))
        + "SELECT nm.from_page, nm.to_page, nm.num, COALESCE(dn.den, 1) AS den, "
          "CAST(nm.num AS DOUBLE) / COALESCE(dn.den, 1) AS rate FROM nm LEFT JOIN dn ON dn.page_id = nm.from_page",
        "page_dwell": _with(v, ("st", STEPS)) + "SELECT session_id, from_page AS page_id, "
                                                "epoch_ms(date_trunc('second', next_time)) - "
                                                "epoch_ms(date_trunc('second', action_time)) AS dwell_ms "
                                                "FROM st WHERE has_next IS NOT NULL",
        "page_avg_dwell": _with(v, ("st", STEPS),
                                ("d", "SELECT from_page AS page_id, epoch_ms(date_trunc('second', next_time)) - "
                                      "epoch_ms(date_trunc('second', action_time)) AS dwell_ms FROM st "
                                      "WHERE has_next IS NOT NULL"))
        + "SELECT page_id, CAST(SUM(dwell_ms) AS BIGINT) // COUNT(dwell_ms) AS avg_ms FROM d GROUP BY page_id",
        "ads_log": _with(a) + f"SELECT event_id, strftime(ts, {TS_US}) AS ts, dt, area, city, userid, adid FROM a",
        "ads_log_parse": _with(a) + f"SELECT event_id, strftime(ts, {TS_MS}) AS ts, "
                                    f"CAST(CAST(date_trunc('millisecond', ts) AS DATE) AS VARCHAR) AS dt, "
                                    "area, city, userid, adid FROM a",
        "ad_user_daily_counts": _with(a) + "SELECT dt, adid, userid, COUNT(*) AS clicks FROM a GROUP BY ALL",
        "ads_click_daily": _with(a) + "SELECT dt, area, city, adid, COUNT(*) AS clicks FROM a GROUP BY ALL",
        "ads_area_rollup": _with(a, rollup) + "SELECT * FROM ro",
        "ads_area_top3": _with(a, rollup, top3) + "SELECT dt, area, adid, clicks, rank FROM t3",
        "ads_area_top3_json": _with(a, rollup, top3)
        + "SELECT dt, area, '{' || string_agg('\"' || CAST(adid AS VARCHAR) || '\":' || CAST(clicks AS VARCHAR), "
          "',' ORDER BY rank) || '}' AS top3 FROM t3 GROUP BY dt, area",
        "ads_trend_10s": _with(a, ("bk", BUCKETS)) + trend,
        "ads_sliding_60s": _with(a, ("bk", BUCKETS))
        + f"SELECT strftime(ws, {TS_S}) AS win_start, strftime(ws + INTERVAL 60 SECOND, {TS_S}) AS win_end, "
          "CAST(SUM(clicks) AS BIGINT) AS clicks FROM (SELECT b - k * INTERVAL 10 SECOND AS ws, clicks "
          "FROM bk, (SELECT UNNEST(range(6)) AS k)) GROUP BY ws",
        "ads_last_minute": _with(a, ("bk", "SELECT time_bucket(INTERVAL 10 SECOND, ts) AS b, COUNT(*) AS clicks "
                                           "FROM a WHERE ts >= (SELECT time_bucket(INTERVAL 10 SECOND, MAX(ts)) "
                                           "FROM a) - INTERVAL 50 SECOND GROUP BY 1"))
        + trend,
        "blacklist_users": _with(a, first, since) + f"SELECT userid, strftime(since, {TS_MS}) AS since FROM s",
        "blacklist_filtered_counts": _with(a, first, since)
        + "SELECT a.dt, a.adid, a.userid, COUNT(*) AS clicks FROM a LEFT JOIN s ON s.userid = a.userid "
          "WHERE s.since IS NULL OR a.ts <= s.since GROUP BY ALL",
        "blacklist_users_by_batch": _with(a, by_batch, run, listed) + "SELECT userid, since_batch FROM l",
        "blacklist_filtered_counts_by_batch": _with(a, by_batch, run, listed)
        + "SELECT c.dt, c.adid, c.userid, CAST(SUM(c.n) AS BIGINT) AS clicks FROM c LEFT JOIN l "
          "ON l.userid = c.userid WHERE l.since_batch IS NULL OR c.batch <= l.since_batch GROUP BY ALL",
    }
    ranged_v = f"SELECT * FROM ({VISIT_LOG}) WHERE date >= '{lo}' AND date <= '{hi}'"
    for name in ("hot_category_session_top10", "page_conversion", "page_avg_dwell"):
        q[f"{name}_ranged"] = q[name].replace(f"v AS ({VISIT_LOG})", f"v AS ({ranged_v})", 1)
        assert q[f"{name}_ranged"] != q[name]
    # Streaming twins must equal their batch twins.
    q["stream_ads_click_daily"] = q["ads_click_daily"]
    q["stream_ads_area_top3"] = q["ads_area_top3_json"]
    q["stream_ads_trend"] = q["ads_trend_10s"]
    q["stream_ads_sliding_60s"] = q["ads_sliding_60s"]
    q["stream_blacklist"] = q["blacklist_users"]
    q["stream_blacklist_counts"] = q["blacklist_filtered_counts"]
    q["stream_blacklist_micro_batch"] = q["blacklist_users_by_batch"]
    q["stream_blacklist_micro_batch_counts"] = q["blacklist_filtered_counts_by_batch"]
    q["stream_ads_trend_watermark"] = q["ads_trend_10s"]
    q["page_dwell_text"] = q["page_dwell"].replace("ORDER BY action_time, event_id", "ORDER BY date_trunc('second', action_time), event_id")
    q["stream_counter_state"] = q["ads_click_daily"]
    # a batch's late clicks are judged by the clicks that came two batches before it and earlier
    days = "date_diff('day', (SELECT MIN(CAST(ts AS DATE)) FROM a), CAST(ts AS DATE))"
    span = "date_diff('day', (SELECT MIN(CAST(ts AS DATE)) FROM a), (SELECT MAX(CAST(ts AS DATE)) FROM a)) + 1"
    q["stream_ads_late"] = _with(
        a, ("ar", f"SELECT date_trunc('millisecond', ts) AS ts, CASE WHEN event_id % {LATE_EACH} = 0 THEN {LATE_BATCHES - 1} "
                  f"ELSE {days} * {LATE_BATCHES} // ({span}) END AS k FROM a"),
        ("wm", "SELECT x.k, MAX(y.newest) - INTERVAL 1 MINUTE AS mark FROM (SELECT DISTINCT k FROM ar) x JOIN "
               "(SELECT k, MAX(ts) AS newest FROM ar GROUP BY k) y ON y.k <= x.k - 2 GROUP BY x.k"),
        ("bk", "SELECT time_bucket(INTERVAL 10 SECOND, ts) AS b, COUNT(*) AS clicks FROM ar LEFT JOIN wm USING (k) "
               "WHERE mark IS NULL OR time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND > mark GROUP BY 1")) + trend
    q["stream_ads_arrival_trend"] = _with(a) + (
        f"SELECT strftime(ws, {TS_S}) AS win_start, strftime(ws + INTERVAL 60 SECOND, {TS_S}) AS win_end, "
        f"strftime(time_bucket(INTERVAL 10 SECOND, ts), {TS_S}) AS bucket, COUNT(*) AS clicks FROM (SELECT ts, TIMESTAMP '{ARRIVAL_START}' + "
        f"(event_id % {ARRIVAL_BATCHES}) * INTERVAL {ARRIVAL_STEP_S} SECOND - k * INTERVAL 10 SECOND AS ws "
        "FROM a, (SELECT UNNEST(range(6)) AS k)) GROUP BY ALL")
    no_click = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in (("event_id", "BIGINT"), ("ts", "VARCHAR"), ("dt", "VARCHAR"), ("area", "VARCHAR"),
                                                                   ("city", "VARCHAR"), ("userid", "VARCHAR"), ("adid", "VARCHAR")))
    q["stream_ads_log_split"] = _with(a, ("g", q["ads_log_parse"])) + (
        "SELECT 'good' AS kind, g.*, CAST(NULL AS VARCHAR) AS value FROM g "
        f"UNION ALL SELECT 'bad', {no_click}, 'broken ' || event_id FROM a WHERE event_id % {BROKEN[0]} = 0 "
        f"UNION ALL SELECT 'bad', {no_click}, 'noon a c ' || userid || ' ' || adid || ' ' || event_id FROM a WHERE event_id % {BROKEN[1]} = 0")
    scanned = "SELECT event_id, date, session_id, page_id FROM v "
    q["catalog_scan_ranged"] = _with(v) + scanned + f"WHERE date >= '{lo}' AND date <= '{hi}'"
    q["catalog_scan_days"] = _with(v) + scanned + "WHERE isodow(CAST(date AS DATE)) = 7"
    q["category_top10_stamped"] = _with(v, r) + f"SELECT 'run-1' AS task_id, * FROM ({TOP10})"
    q["sink_replace_table"] = q["hot_category_top10"]
    return q

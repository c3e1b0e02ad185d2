"""The same questions as plain SQL over the raw tables, in DuckDB's dialect.

Written from the meaning of each question, without buckets, panes or carried state, so that an
error in those shows.
"""

from __future__ import annotations

_EV = "WITH ev AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"


def _sliding(source: str, keys: str, size_minutes: int, slide_minutes: int) -> str:
    """Counts per sliding window by writing every row once per window."""
    spread = size_minutes // slide_minutes
    return f"""
      SELECT {keys}, window_end, count(*) AS cnt FROM (
        SELECT {keys}, time_bucket(INTERVAL {slide_minutes} MINUTE, ts)
               + INTERVAL 1 MINUTE * ({slide_minutes} * (i + 1)) AS window_end
        FROM {source}, (SELECT unnest(range({spread})) AS i)
      ) GROUP BY {keys}, window_end"""


def _sliding_seconds(source: str, keys: str, size: int, slide: int) -> str:
    return f"""
      SELECT {keys}, window_end, count(*) AS cnt FROM (
        SELECT {keys}, time_bucket(INTERVAL {slide} SECOND, ts)
               + INTERVAL 1 SECOND * ({slide} * (i + 1)) AS window_end
        FROM {source}, (SELECT unnest(range({size // slide})) AS i)
      ) GROUP BY {keys}, window_end"""


def _top(counts: str, key: str) -> str:
    return f"""
      SELECT {key}, cnt, window_end, rk FROM (
        SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS rk
        FROM ({counts})
      ) WHERE rk <= 5"""


_HOT_ITEMS = f"""{_EV}, views AS (SELECT k AS item_id, ts FROM ev WHERE event_type = 'view')
{_top(_sliding('views', 'item_id', 60, 5), 'item_id')}"""

_HOUR_END = "time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR"

_OFFSET = """list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''),
               lambda c: CAST(ascii(c) AS BIGINT)), lambda a, c: (a * 31 + c) & 536870911)"""

_PV = f"""SELECT {_HOUR_END} AS window_end, count(*) AS pv
FROM events WHERE event_type = 'view' GROUP BY 1"""

_REQUESTS = f"""{_EV}, gets AS (SELECT event_id, ts, '/item/' || k AS url FROM ev WHERE event_type = 'click')"""

_ARRIVED = f"""{_REQUESTS},
arriving AS (SELECT *, ts + INTERVAL 1 SECOND * (event_id * 7919 % 7200) AS arrival FROM gets),
seen AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
         FROM arriving),
placed AS (SELECT *, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE * (i + 1) AS window_end
           FROM seen, (SELECT unnest(range(10)) AS i)),
taken AS (SELECT * FROM placed
          WHERE mx IS NULL OR window_end + INTERVAL 30 MINUTE > mx - INTERVAL 5 MINUTE)"""

_CLICKS = f"""{_EV}, numbered AS (
  SELECT event_id, ts, user_id, k % 2 AS ad_id, 'p' || (k % 10) AS province,
         row_number() OVER (PARTITION BY user_id, k % 2, CAST(ts + INTERVAL 8 HOUR AS DATE)
                            ORDER BY ts, event_id) AS n
  FROM ev)"""

_PAIRS = """SELECT user_id, prev_ts AS first_ts, ts AS last_ts FROM (
  SELECT user_id, ts, event_type,
         lag(event_type) OVER w AS prev_type, lag(ts) OVER w AS prev_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
) WHERE event_type = 'error' AND prev_type = 'error' AND prev_ts + INTERVAL 6 HOUR > ts"""


def _failure_sequence(partition: str, condition: str) -> str:
    return f"""SELECT user_id, event_id AS first_id, next_id AS last_id FROM (
  SELECT user_id, event_id, ts, event_type, lead(event_type) OVER w AS next_type,
         lead(event_id) OVER w AS next_id, lead(ts) OVER w AS next_ts
  FROM events WINDOW w AS ({partition} ORDER BY ts, event_id)
) WHERE event_type = 'error' AND next_type = 'error' {condition}"""


# The window a failure opens depends on the windows before it, so each user's failures are
# walked in order by recursion: from one opening failure to the next.
_FAIL_WINDOW = """WITH RECURSIVE
fails AS (SELECT user_id, ts FROM events WHERE event_type = 'error'),
passes AS (SELECT user_id, ts FROM events WHERE event_type <> 'error'),
opened AS (
  SELECT f.user_id, f.ts AS open_ts,
         (SELECT min(p.ts) FROM passes p WHERE p.user_id = f.user_id
            AND p.ts >= f.ts AND p.ts <= f.ts + INTERVAL 6 HOUR) AS pass_ts
  FROM fails f),
step AS (
  SELECT o.user_id, o.open_ts, o.pass_ts,
         (SELECT min(f.ts) FROM fails f WHERE f.user_id = o.user_id
            AND CASE WHEN o.pass_ts IS NULL THEN f.ts > o.open_ts + INTERVAL 6 HOUR
                     ELSE f.ts > o.pass_ts END) AS next_open
  FROM opened o),
walk AS (
  SELECT user_id, min(ts) AS open_ts FROM fails GROUP BY user_id
  UNION ALL
  SELECT w.user_id, s.next_open FROM walk w JOIN step s
    ON s.user_id = w.user_id AND s.open_ts = w.open_ts
  WHERE s.next_open IS NOT NULL)
SELECT w.user_id, w.open_ts AS first_ts, max(f.ts) AS last_ts, count(*) AS n_fail
FROM walk w
JOIN step s ON s.user_id = w.user_id AND s.open_ts = w.open_ts AND s.pass_ts IS NULL
JOIN fails f ON f.user_id = w.user_id AND f.ts BETWEEN w.open_ts AND w.open_ts + INTERVAL 6 HOUR
GROUP BY w.user_id, w.open_ts HAVING count(*) >= 2"""

_ORDER_PATTERN = """WITH creates AS (SELECT * FROM events WHERE event_type = 'click'),
pays AS (SELECT * FROM events WHERE event_type = 'purchase'),
firsts AS (
  SELECT c.user_id, c.event_id AS create_id, min(p.event_id) AS pay_id
  FROM creates c LEFT JOIN pays p ON p.user_id = c.user_id
   AND (p.ts, p.event_id) > (c.ts, c.event_id) AND p.ts < c.ts + INTERVAL 12 HOUR
  GROUP BY ALL)
SELECT user_id, create_id, pay_id,
       CASE WHEN pay_id IS NULL THEN 'timeout' ELSE 'matched' END AS tag FROM firsts"""

_ORDER_STATE = """WITH near AS (
  SELECT user_id, ts, event_id, event_type,
         lag(event_type) OVER w AS prev_type, lag(ts) OVER w AS prev_ts, lead(ts) OVER w AS next_ts
  FROM events WHERE event_type IN ('click', 'purchase')
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type, event_id))
SELECT user_id, ts, event_id,
       CASE WHEN prev_type = 'click' AND ts <= prev_ts + INTERVAL 12 HOUR
            THEN 'paid' ELSE 'pay_without_create' END AS tag
FROM near WHERE event_type = 'purchase'
UNION ALL
SELECT user_id, ts + INTERVAL 12 HOUR AS ts, event_id, 'create_without_pay' AS tag
FROM near WHERE event_type = 'click' AND (next_ts IS NULL OR next_ts > ts + INTERVAL 12 HOUR)"""

_RECONCILE_ALL = """WITH both_sides AS (
  SELECT user_id, ts, event_id, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS side
  FROM events WHERE event_type IN ('click', 'purchase')),
near AS (
  SELECT *, coalesce(lag(side) OVER w <> side AND ts <= lag(ts) OVER w + INTERVAL 5 HOUR, false) AS joins_prev,
         coalesce(lead(side) OVER w <> side AND lead(ts) OVER w <= ts + INTERVAL 5 HOUR, false) AS joins_next,
         lag(ts) OVER w AS prev_ts, lag(event_id) OVER w AS prev_id
  FROM both_sides WINDOW w AS (PARTITION BY user_id ORDER BY ts, side, event_id)),
chained AS (
  SELECT *, sum(CASE WHEN joins_prev THEN 0 ELSE 1 END)
            OVER (PARTITION BY user_id ORDER BY ts, side, event_id) AS chain FROM near),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, chain ORDER BY ts, side, event_id) % 2 = 0 AS second
  FROM chained)
SELECT user_id,
       CASE WHEN side = 0 THEN ts WHEN second THEN prev_ts END AS pay_ts,
       CASE WHEN side = 0 THEN event_id WHEN second THEN prev_id END AS pay_id,
       CASE WHEN side = 1 THEN ts WHEN second THEN prev_ts END AS receipt_ts,
       CASE WHEN side = 1 THEN event_id WHEN second THEN prev_id END AS receipt_id,
       CASE WHEN second THEN 'matched' WHEN side = 0 THEN 'pay_no_receipt' ELSE 'receipt_no_pay' END AS tag
FROM placed WHERE second OR NOT joins_next"""

_RECONCILE = """WITH
pays AS (SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, min(ts) AS pay_ts, arg_min(event_id, ts) AS pay_id
         FROM events WHERE event_type = 'click' GROUP BY 1, 2),
receipts AS (SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, min(ts) AS receipt_ts, arg_min(event_id, ts) AS receipt_id
             FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT coalesce(p.user_id, r.user_id) AS user_id, coalesce(p.day, r.day) AS day,
       pay_ts, pay_id, receipt_ts, receipt_id,
       CASE WHEN pay_id IS NULL THEN 'receipt_no_pay' WHEN receipt_id IS NULL THEN 'pay_no_receipt'
            ELSE 'matched' END AS tag
FROM pays p FULL OUTER JOIN receipts r
  ON p.user_id = r.user_id AND p.day = r.day
 AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 5 HOUR AND p.pay_ts + INTERVAL 5 HOUR"""


def _pick(values: str, seed: int) -> str:
    return f"({values})[1 + ((((event_id * 2654435761 + {seed * 40503}) % 4294967296) >> 16) % 4)]"


_MARKET = f"""WITH made AS (
  SELECT ts, {_pick("['app store', 'wechat', 'weibo', 'tieba']", 1)} AS channel,
         {_pick("['CLICK', 'DOWNLOAD', 'INSTALL', 'UNINSTALL']", 0)} AS behavior FROM events)
{_sliding('made', 'channel, behavior', 60, 5)}"""

_OUTER = """SELECT coalesce(p.user_id, r.user_id) AS user_id, p.ts AS pay_ts, p.event_id AS pay_id,
       r.ts AS receipt_ts, r.event_id AS receipt_id,
       CASE WHEN r.ts IS NULL THEN 'pay_no_receipt' WHEN p.ts IS NULL THEN 'receipt_no_pay' ELSE 'matched' END AS tag
FROM (SELECT * FROM events WHERE event_type = 'click') p
FULL OUTER JOIN (SELECT * FROM events WHERE event_type = 'purchase') r ON p.user_id = r.user_id
 AND r.ts BETWEEN p.ts - INTERVAL 3 HOUR AND p.ts + INTERVAL 5 HOUR"""

ORACLE: dict[str, str] = {
    "hot_items_topn": _HOT_ITEMS,
    "hot_items_sql": _HOT_ITEMS,
    "hot_items_report": f"""SELECT window_end,
       '==============================' || chr(10) || '窗口结束时间：'
       || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10)
       || string_agg('TOP ' || rk || ' ItemId=' || item_id || ' 商品热度=' || cnt, chr(10) ORDER BY rk)
       || chr(10) || '==============================' AS report
FROM ({_HOT_ITEMS}) GROUP BY window_end""",
    "pv_hourly": _PV,
    "pv_hourly_salted": _PV,
    "uv_hourly_exact": f"SELECT {_HOUR_END} AS window_end, count(DISTINCT user_id) AS uv FROM events GROUP BY 1",
    "uv_hourly_records": f"""{_EV} SELECT {_HOUR_END} AS window_end,
       count(DISTINCT (user_id, k, event_type, ts)) AS uv FROM ev GROUP BY 1""",
    "uv_hourly_bitmap": f"SELECT {_HOUR_END} AS window_end, count(DISTINCT {_OFFSET}) AS uv FROM events GROUP BY 1",
    "uv_hourly_hll": f"SELECT DISTINCT {_HOUR_END} AS window_end, true AS close FROM events",
    "uv_sliding_hll": """SELECT window_end, count(DISTINCT user_id) AS exact, true AS close FROM (
        SELECT user_id, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 1 MINUTE * (5 * (i + 1)) AS window_end
        FROM events, (SELECT unnest(range(12)) AS i)) GROUP BY window_end""",
    "uv_daily_hll": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS exact, true AS close
FROM events GROUP BY 1""",
    "uv_running": f"""WITH placed AS (SELECT event_id, ts, {_HOUR_END} AS window_end, {_OFFSET} AS h FROM events),
flagged AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY window_end, h ORDER BY ts, event_id) = 1
                           THEN 1 ELSE 0 END AS first_seen FROM placed)
SELECT event_id, window_end,
       CAST(sum(first_seen) OVER (PARTITION BY window_end ORDER BY ts, event_id) AS BIGINT) AS uv FROM flagged""",
    "hot_urls_topn": f"{_REQUESTS} {_top(_sliding('gets', 'url', 10, 1), 'url')}",
    "hot_urls_topn_5s": f"""{_REQUESTS} {_top(_sliding_seconds('gets', 'url', 600, 5), 'url')}""",
    "hot_urls_report": f"""{_REQUESTS} SELECT window_end,
       '==============================' || chr(10) || '窗口结束时间：'
       || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10)
       || string_agg('TOP ' || rk || ' Url ' || url || ' Url热度=' || cnt, chr(10) ORDER BY rk)
       || chr(10) || '==============================' AS report
FROM ({_top(_sliding('gets', 'url', 10, 1), 'url')}) GROUP BY window_end""",
    "behavior_csv_counts": f"""SELECT event_type AS behavior, {_HOUR_END} AS window_end, count(*) AS cnt
FROM events GROUP BY 1, 2""",
    "pay_receipt_csv": """WITH paid AS (
  SELECT event_id, user_id AS orderId, CAST(floor(epoch(ts)) AS BIGINT) AS s,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events WHERE event_type = 'purchase')
SELECT 'tx' || event_id AS txId, orderId, 'c' || (k % 4) AS payChannel, s AS pay_s,
       s + event_id % 11 - 5 AS receipt_s
FROM paid WHERE event_id % 7 <> 0 AND event_id % 3 <> 0 AND event_id % 11 - 5 BETWEEN -3 AND 5""",
    "channel_stats": f"""{_EV}, m AS (SELECT ts, 'c' || (k % 4) AS channel, k FROM ev)
SELECT channel, window_end, count(k) AS n, CAST(sum(k) AS BIGINT) AS sum_k, min(k) AS min_k,
       max(k) AS max_k, avg(k) AS mean_k
FROM (SELECT channel, k, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 1 MINUTE * (5 * (i + 1)) AS window_end
      FROM m, (SELECT unnest(range(12)) AS i)) GROUP BY channel, window_end""",
    "province_peak_5s": f"""{_EV}, m AS (SELECT ts, 'p' || (k % 10) AS province FROM ev)
SELECT province, strftime(window_end, '%Y-%m-%d') AS day, max(cnt) AS peak
FROM ({_sliding_seconds('m', 'province', 3600, 5)}) GROUP BY 1, 2""",
    "hot_urls_late": f"""{_ARRIVED}
{_top("SELECT url, window_end, count(*) AS cnt FROM taken GROUP BY url, window_end", "url")}""",
    "late_rows": f"""{_ARRIVED} SELECT event_id, ts, url FROM seen
WHERE time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 40 MINUTE <= mx - INTERVAL 5 MINUTE""",
    "late_corrections": f"""{_ARRIVED} SELECT url, window_end,
       count(*) FILTER (WHERE mx IS NULL OR window_end > mx - INTERVAL 5 MINUTE) AS first_cnt,
       count(*) AS final_cnt
FROM taken GROUP BY url, window_end HAVING first_cnt <> final_cnt""",
    "access_log_counts": f"""{_REQUESTS}
SELECT url, {_HOUR_END} AS window_end, count(*) AS cnt FROM gets GROUP BY 1, 2""",
    "channel_behavior_counts": f"""{_EV}, m AS (SELECT ts, 'c' || (k % 4) AS channel, event_type AS behavior FROM ev)
{_sliding('m', 'channel, behavior', 60, 5)}""",
    "market_source_counts": _MARKET,
    "ad_clicks_by_province": f"""{_CLICKS}, pass AS (SELECT * FROM numbered WHERE n <= 2)
{_sliding('pass', 'province', 60, 5)}""",
    "click_blacklist": f"""{_CLICKS} SELECT user_id, ad_id, ts, event_id, 'warning' AS warning_msg
FROM numbered WHERE n = 3""",
    "login_fail_window": _FAIL_WINDOW,
    "login_fail_pairs": _PAIRS,
    "login_fail_alerts": f"""SELECT user_id, last_ts,
       user_id || '在' || CAST(floor(epoch(first_ts)) AS BIGINT) || '到' || CAST(floor(epoch(last_ts)) AS BIGINT)
       || '之间登录失败2次！' AS message FROM ({_PAIRS})""",
    "login_fail_strict_seq": _failure_sequence(
        "PARTITION BY user_id", "AND next_ts - ts < INTERVAL 6 HOUR"
    ),
    "login_fail_strict_seq_slots": _failure_sequence(
        "PARTITION BY user_id", "AND next_ts - ts < INTERVAL 6 HOUR"
    ),
    "login_fail_strict_seq_global": _failure_sequence("", "AND next_ts - ts < INTERVAL 10 MINUTE"),
    "fail_runs": _failure_sequence("PARTITION BY user_id", ""),
    "order_timeout_pattern": _ORDER_PATTERN,
    "order_timeout_pattern_slots": _ORDER_PATTERN,
    "order_timeout_state": _ORDER_STATE,
    "order_timeout_state_slots": _ORDER_STATE,
    "pay_receipt_interval": """SELECT p.user_id, p.ts AS pay_ts, p.event_id AS pay_id,
       r.ts AS receipt_ts, r.event_id AS receipt_id
FROM events p JOIN events r ON p.user_id = r.user_id
 AND r.ts BETWEEN p.ts - INTERVAL 3 HOUR AND p.ts + INTERVAL 5 HOUR
WHERE p.event_type = 'click' AND r.event_type = 'purchase'""",
    "pay_receipt_outer": _OUTER,
    "pay_receipt_reconcile": _RECONCILE,
    "pay_receipt_reconcile_all": _RECONCILE_ALL,
}


#: Where the watermark stands at the end of the input: a tick behind the last row of all.
_WATERMARK = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 MILLISECOND FROM events)"


def _seen(name: str, columns: str) -> str:
    return f"""SELECT {columns} FROM ({ORACLE[name]}) f JOIN events e ON e.event_id = f.last_id
WHERE e.ts <= {_WATERMARK}"""


_TAKEN = """(event_id % 50 <> 0 OR ts >= (SELECT max(ts) FROM gets) - INTERVAL 1 DAY)"""

ORACLE |= {
    "login_fail_strict_seq_stream": _seen("login_fail_strict_seq", "f.user_id, first_id, last_id"),
    "login_fail_strict_seq_global_stream": _seen("login_fail_strict_seq_global", "first_id, last_id"),
    "fail_runs_stream": _seen("fail_runs", "f.user_id, first_id, last_id"),
    "hot_items_stream": _HOT_ITEMS,
    "hot_items_closed_stream": f"SELECT * FROM ({_HOT_ITEMS}) WHERE window_end <= {_WATERMARK}",
    "hot_items_leaders_stream": f"SELECT * FROM ({_HOT_ITEMS}) WHERE window_end <= {_WATERMARK}",
    "hot_items_sql_stream": f"SELECT * FROM ({_HOT_ITEMS}) WHERE window_end <= {_WATERMARK}",
    "hot_items_changes_stream": f"SELECT *, CAST(1 AS BIGINT) AS net FROM ({_HOT_ITEMS})",
    "access_log_stream": f"""SELECT * FROM ({ORACLE['access_log_counts']}) WHERE window_end <=
  (SELECT date_trunc('second', max(ts)) - INTERVAL 1 MINUTE FROM events)""",
    "behavior_csv_stream": f"""SELECT * FROM ({ORACLE['behavior_csv_counts']}) WHERE window_end <=
  (SELECT date_trunc('second', max(ts)) - INTERVAL 2 SECOND FROM events)""",
    "hot_urls_late_stream": f"""{_REQUESTS}, near AS (SELECT * FROM gets WHERE {_TAKEN})
{_top(_sliding('near', 'url', 10, 1), 'url')}""",
    # Part after part arrives; behind each the watermark moves on and windows that it has passed fire.
    "hot_urls_firings_stream": f"""{_REQUESTS}, arriving AS (
  SELECT *, floor(epoch(ts)) + CASE WHEN event_id % 50 = 0 AND ts < (SELECT max(ts) FROM gets) - INTERVAL 1 DAY
                                    THEN 12 * 86400 ELSE event_id * 7919 % 1500 END AS arrival FROM gets
), parted AS (
  SELECT *, CAST(floor((arrival - (SELECT min(arrival) FROM arriving))
                 / greatest(1, ceil((SELECT max(arrival) - min(arrival) + 1 FROM arriving) / 6))) AS BIGINT) AS part
  FROM arriving
), marks AS (
  SELECT j AS part, (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 5 MINUTE FROM parted p WHERE p.part < j) AS before,
         (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 5 MINUTE FROM parted p WHERE p.part <= j) AS after
  FROM (SELECT unnest(range(6)) AS j)
), spread AS (
  SELECT url, part, before, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE * (i + 1) AS window_end
  FROM parted JOIN marks USING (part), (SELECT unnest(range(10)) AS i)
), counted AS (
  SELECT url, window_end, part, count(*) AS n FROM spread
  WHERE before IS NULL OR window_end + INTERVAL 30 MINUTE > before GROUP BY ALL
), stated AS (
  SELECT w.url, w.window_end, m.part, m.before, m.after, c.n,
         sum(c.n) OVER (PARTITION BY w.url, w.window_end ORDER BY m.part) AS total
  FROM (SELECT DISTINCT url, window_end FROM counted) w CROSS JOIN marks m
  LEFT JOIN counted c ON c.url = w.url AND c.window_end = w.window_end AND c.part = m.part
), firing AS (
  SELECT url, window_end, part, 0 AS phase, total FROM stated WHERE n > 0 AND window_end <= before
  UNION ALL
  SELECT url, window_end, part, 1 AS phase, total FROM stated
  WHERE total > 0 AND window_end <= after AND (before IS NULL OR window_end > before)
)
SELECT url, window_end, CAST(row_number() OVER (PARTITION BY url, window_end ORDER BY part, phase) AS INTEGER) AS firing,
       CAST(total AS BIGINT) AS cnt, 'window' AS tag, CAST(NULL AS TIMESTAMP) AS late_ts, CAST(NULL AS BIGINT) AS event_id
FROM firing
UNION ALL
SELECT url, NULL, NULL, NULL, 'late', ts, event_id FROM parted JOIN marks USING (part)
WHERE time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 40 MINUTE <= before""",
    "late_rows_stream": f"{_REQUESTS} SELECT event_id, ts, url FROM gets WHERE NOT ({_TAKEN})",
    "uv_bitmap_stream": ORACLE["uv_hourly_bitmap"],
    "pv_hourly_stream": f"SELECT * FROM ({_PV}) WHERE window_end <= {_WATERMARK}",
    "uv_hourly_stream": f"SELECT * FROM ({ORACLE['uv_hourly_exact']}) WHERE window_end <= {_WATERMARK}",
    "pay_receipt_interval_stream": ORACLE["pay_receipt_interval"],
    "pay_receipt_outer_stream": f"""SELECT * FROM ({_OUTER}) WHERE CASE tag WHEN 'matched' THEN true
  WHEN 'pay_no_receipt' THEN pay_ts + INTERVAL 5 HOUR <= {_WATERMARK}
  ELSE receipt_ts + INTERVAL 3 HOUR <= {_WATERMARK} END""",
    "login_fail_window_stream": f"""SELECT * FROM ({_FAIL_WINDOW})
WHERE first_ts + INTERVAL 6 HOUR < {_WATERMARK}""",
    "order_timeout_state_stream": f"SELECT * FROM ({_ORDER_STATE}) WHERE ts <= {_WATERMARK}",
    "order_timeout_pattern_stream": f"""SELECT o.* FROM ({_ORDER_PATTERN}) o
JOIN events c ON c.event_id = o.create_id LEFT JOIN events p ON p.event_id = o.pay_id
WHERE CASE WHEN pay_id IS NULL THEN c.ts + INTERVAL 12 HOUR ELSE p.ts END <= {_WATERMARK}""",
    "pay_receipt_reconcile_stream": f"""WITH pairs AS ({_RECONCILE_ALL}),
nexts AS (SELECT user_id, event_id, event_type, ts,
                 lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
          FROM events WHERE event_type IN ('click', 'purchase')
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type, event_id))
SELECT p.user_id, CASE WHEN tag = 'matched' AND receipt_ts < pay_ts THEN receipt_id
                       ELSE coalesce(CASE WHEN tag <> 'receipt_no_pay' THEN pay_id END, receipt_id) END AS first_id,
       CASE WHEN tag = 'matched' AND receipt_ts >= pay_ts THEN receipt_id
            ELSE coalesce(CASE WHEN tag <> 'receipt_no_pay' THEN pay_id END, receipt_id) END AS last_id, tag
FROM pairs p LEFT JOIN nexts n ON n.event_id = coalesce(p.pay_id, p.receipt_id)
WHERE CASE WHEN tag = 'matched' THEN greatest(pay_ts, receipt_ts) <= {_WATERMARK}
           -- a lone row is reported when its wait is over or when one of its own side takes over
           ELSE n.ts + INTERVAL 5 HOUR < {_WATERMARK}
             OR (n.next_type = n.event_type AND n.next_ts <= {_WATERMARK}) END""",
    "click_filter_stream": f"""{_CLICKS} SELECT user_id, ad_id, ts, event_id,
       CASE WHEN n <= 2 THEN 'pass' ELSE 'warning' END AS tag
FROM numbered WHERE n <= 3 AND ts <= {_WATERMARK}""",
}

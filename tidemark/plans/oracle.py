"""DuckDB SQL equal to each registered query (the correctness oracle).

Written from the operator definitions (row-level window membership,
window functions, a recursive fold), not from the Spark plans.
"""

from __future__ import annotations

from .catalog import (BURST_MIN_FAILS, CAP_MAX, DAY, DETECT_WITHIN_S, FINE_SLIDE, HOUR, LATE_BOUND_S,
                      LATE_LATENESS_S, METHODS, SLIDE, STREAM_SIZE, STREAM_SLIDE, TOP_ITEMS, TOP_URLS,
                      URL_SUFFIXES)

US = 1_000_000
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
W_US = DETECT_WITHIN_S * US
HOUR_US = HOUR * US
SLIDE_US = SLIDE * US
NWIN = HOUR // SLIDE


def _list(values):
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


URL = f"'/item/' || CAST({K} AS VARCHAR) || list_extract({_list(URL_SUFFIXES)}, CAST(event_id % {len(URL_SUFFIXES)} + 1 AS INTEGER))"

HASH = ("list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), "
        "lambda c: CAST(ascii(c) AS BIGINT)), lambda a, b: (a * 61 + b) % 1073741824)")


def _tumbling(where: str, agg: str, name: str) -> str:
    return f"""
SELECT (epoch_us(ts) // {HOUR_US}) * {HOUR} AS window_start,
       (epoch_us(ts) // {HOUR_US} + 1) * {HOUR} AS window_end,
       {agg} AS {name}
FROM events WHERE {where}
GROUP BY 1, 2"""


def _sliding(source: str, keys: str, name: str, slide: int = SLIDE) -> str:
    """``source`` yields (keys..., us); one output row per (window, keys)."""
    ksel = f"{keys}, " if keys else ""
    slide_us, nwin = slide * US, HOUR // slide
    return f"""
SELECT e * {slide} - {HOUR} AS window_start, e * {slide} AS window_end, {ksel}count(*) AS {name}
FROM (SELECT {ksel}unnest(range(us // {slide_us} + 1, us // {slide_us} + {nwin + 1})) AS e
      FROM ({source}) s) x
GROUP BY ALL"""


ITEM_TOP = f"""
WITH c AS ({_sliding(f"SELECT {K} AS item_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view'",
                     "item_id", "pv_count")})
SELECT window_start, window_end,
       row_number() OVER (PARTITION BY window_end ORDER BY pv_count DESC, item_id) AS rank,
       item_id, pv_count
FROM c QUALIFY rank <= {TOP_ITEMS}"""

CAPPED = f"""
SELECT event_id, user_id, event_type, {K} % 5 AS province, epoch_us(ts) AS us,
       row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                          ORDER BY ts, event_id) AS click_no
FROM events"""

LOGINS = "SELECT user_id, event_id, ts, epoch_us(ts) AS us, event_type = 'error' AS is_fail FROM events"

ARRIVALS = f"""
SELECT event_id, ts, epoch_us(ts) AS us,
       max(epoch_us(ts)) OVER (ORDER BY event_id + (event_id * 37) % 101, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - {LATE_BOUND_S * US} AS wm
FROM events"""

LATE_COND = (f"(us // {SLIDE_US}) * {SLIDE_US} + {HOUR_US} - 1000 + {LATE_LATENESS_S * US} <= wm")


def _accepted(keys_sel: str, source: str) -> str:
    """Rows not late, counted in the windows still open at arrival."""
    ksel = f"{keys_sel}, " if keys_sel else ""
    first = (f"CASE WHEN wm IS NULL THEN us // {SLIDE_US} + 1 ELSE greatest(us // {SLIDE_US} + 1, "
             f"(wm - {LATE_LATENESS_S * US} + 1000) // {SLIDE_US} + 1) END")
    return f"""
SELECT e * {SLIDE} - {HOUR} AS window_start, e * {SLIDE} AS window_end, {ksel}count(*) AS pv_count
FROM (SELECT {ksel}unnest(range({first}, us // {SLIDE_US} + {NWIN + 1})) AS e
      FROM ({source}) a WHERE NOT coalesce({LATE_COND}, false)) x
GROUP BY ALL"""


BURST = f"""
WITH RECURSIVE ev AS (
  SELECT user_id, epoch_us(ts) AS us, event_type = 'error' AS is_fail,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
st AS (
  SELECT user_id, rn,
         CASE WHEN is_fail THEN us END AS t0,
         CASE WHEN is_fail THEN 1 ELSE 0 END AS cnt,
         CASE WHEN is_fail THEN us END AS last_us,
         CAST(NULL AS BIGINT) AS e_first, CAST(NULL AS BIGINT) AS e_last, CAST(NULL AS BIGINT) AS e_cnt
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn,
         CASE WHEN e.is_fail THEN
              CASE WHEN s.t0 IS NULL OR e.us > s.t0 + {W_US} THEN e.us ELSE s.t0 END END,
         CASE WHEN e.is_fail THEN
              CASE WHEN s.t0 IS NULL OR e.us > s.t0 + {W_US} THEN 1 ELSE s.cnt + 1 END ELSE 0 END,
         CASE WHEN e.is_fail THEN e.us END,
         CASE WHEN s.t0 IS NOT NULL AND e.us > s.t0 + {W_US} AND s.cnt >= {BURST_MIN_FAILS} THEN s.t0 END,
         CASE WHEN s.t0 IS NOT NULL AND e.us > s.t0 + {W_US} AND s.cnt >= {BURST_MIN_FAILS} THEN s.last_us END,
         CASE WHEN s.t0 IS NOT NULL AND e.us > s.t0 + {W_US} AND s.cnt >= {BURST_MIN_FAILS} THEN s.cnt END
  FROM st s JOIN ev e ON e.user_id = s.user_id AND e.rn = s.rn + 1),
emits AS (
  SELECT user_id, e_first AS f, e_last AS l, e_cnt AS n FROM st WHERE e_first IS NOT NULL
  UNION ALL
  SELECT s.user_id, s.t0, s.last_us, s.cnt FROM st s
  JOIN (SELECT user_id, max(rn) AS rn FROM ev GROUP BY user_id) m USING (user_id, rn)
  WHERE s.t0 IS NOT NULL AND s.cnt >= {BURST_MIN_FAILS})
SELECT user_id, f AS first_fail_us, l AS last_fail_us, CAST(n AS BIGINT) AS fail_count,
       'warning:fail ' || CAST(n AS VARCHAR) || ' times in {DETECT_WITHIN_S} seconds' AS warning_msg
FROM emits"""


def _lag_pairs(partition: str, inclusive: bool, msg: str, user: str,
               order: str = "ts, event_id") -> str:
    op = "<=" if inclusive else "<"
    part = f"PARTITION BY {partition} " if partition else ""
    return f"""
WITH l AS (
  SELECT user_id, us, is_fail,
         lag(is_fail) OVER ({part}ORDER BY {order}) AS p_fail,
         lag(us) OVER ({part}ORDER BY {order}) AS p_us,
         lag(user_id) OVER ({part}ORDER BY {order}) AS p_user
  FROM ({LOGINS}) s)
SELECT {user} AS user_id, p_us AS first_fail_us, us AS last_fail_us, '{msg}' AS warning_msg
FROM l WHERE is_fail AND p_fail AND us - p_us {op} {W_US}"""


def _log_fields() -> str:
    return (f"SELECT event_id, format('10.{{}}.{{}}.{{}}', user_id % 256, {K}, event_id % 256) AS ip, "
            f"'u' || CAST(user_id AS VARCHAR) AS user_name, (epoch_us(ts) // {US}) * 1000 AS ts_ms, "
            f"list_extract({_list(METHODS)}, CAST(event_id % {len(METHODS)} + 1 AS INTEGER)) AS method, "
            f"{URL} AS url FROM events")


URL_TOP = f"""
WITH a AS (SELECT {URL} AS url, epoch_us(ts) AS us,
                  max(epoch_us(ts)) OVER (ORDER BY event_id + (event_id * 37) % 101, event_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    - {LATE_BOUND_S * US} AS wm
           FROM events),
p AS (SELECT * FROM a WHERE NOT regexp_matches(url, '\\.(css|js)$')),
c AS ({_accepted("url", "SELECT * FROM p")})
SELECT window_start, window_end,
       row_number() OVER (PARTITION BY window_end ORDER BY pv_count DESC, url) AS rank, url, pv_count
FROM c QUALIFY rank <= {TOP_URLS}"""


def _url_top(size: int, slide: int) -> str:
    """Top URLs of sliding windows, each row in the windows still open at its arrival."""
    us, wide = slide * US, size * US
    late = f"us // {us} * {us} + {wide} - 1000 + {LATE_LATENESS_S * US} <= wm"
    first = f"greatest(us // {us} - {size // slide - 1}, coalesce((wm - {LATE_LATENESS_S * US} + 1000 - {wide}) // {us} + 1, us // {us} - {size // slide - 1}))"
    return f"""
WITH a AS (SELECT {URL} AS url, us, wm FROM events JOIN (SELECT event_id, us, wm FROM ({ARRIVALS}) q) USING (event_id)),
c AS (SELECT j * {slide} AS window_start, j * {slide} + {size} AS window_end, url, count(*) AS pv_count
      FROM (SELECT url, unnest(range({first}, us // {us} + 1)) AS j FROM a
            WHERE NOT regexp_matches(url, '\\.(css|js)$') AND NOT coalesce({late}, false)) x
      GROUP BY ALL)
SELECT window_start, window_end, row_number() OVER (PARTITION BY window_end ORDER BY pv_count DESC, url) AS rank, url, pv_count
FROM c QUALIFY rank <= {TOP_URLS}"""


def _url_report(top: str) -> str:
    return f"""
SELECT window_end,
       'window end: ' || strftime(make_timestamp(window_end * {US}), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg(format('Top{{}}: {{}} {{}}', rank, pv_count, url), chr(10) ORDER BY rank)
       || chr(10) || '{"-" * 32}' AS report
FROM ({top}) t GROUP BY window_end"""


RECONCILE = f"""
WITH x AS (SELECT event_type, 'tx-' || CAST(user_id AS VARCHAR) || '-' || CAST({K} % 10 AS VARCHAR) AS tx_id, epoch_us(ts) AS us FROM events),
p AS (SELECT tx_id, us FROM x WHERE event_type = 'purchase'),
r AS (SELECT tx_id, us FROM x WHERE event_type = 'signup')
SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, p.us AS pay_us, r.us AS receipt_us,
       CASE WHEN p.us IS NULL THEN 'receipt_only' WHEN r.us IS NULL THEN 'payment_only' ELSE 'matched' END AS status
FROM p FULL JOIN r ON p.tx_id = r.tx_id AND abs(p.us - r.us) <= {DAY * US}"""

STREAM_US, STREAM_WIDE = STREAM_SLIDE * US, STREAM_SIZE * US

SQL: dict[str, str] = {
    "pv_hourly": _tumbling("event_type = 'view'", "count(*)", "pv_count"),
    "uv_hourly_exact": _tumbling("event_type = 'view'", "count(DISTINCT user_id)", "uv_count"),
    "uv_hourly_bitmap": _tumbling("event_type = 'view'", f"count(DISTINCT {HASH})", "uv_count"),
    "time_formats": f"""
SELECT window_end,
       strftime(make_timestamp(window_end * {US}) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS end_local,
       strftime(make_timestamp(window_end * {US}), '%Y-%m-%d %H:%M:%S') || '.0' AS end_java,
       epoch(date_trunc('day', make_timestamp(window_start * {US}) + INTERVAL 8 HOUR)
             + INTERVAL 1 DAY - INTERVAL 8 HOUR)::BIGINT AS next_midnight
FROM ({_tumbling("event_type = 'view'", "count(*)", "pv_count")}) t""",
    "item_top5_sliding": ITEM_TOP,
    "item_top5_report": f"""
SELECT window_end,
       'window end: ' || strftime(make_timestamp(window_end * {US}), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg(format('Top{{}}: item_id={{}}, pv={{}}', rank, item_id, pv_count), chr(10) ORDER BY rank)
       || chr(10) || '{"-" * 32}' AS report
FROM ({ITEM_TOP}) t GROUP BY window_end""",
    "type_count_sliding": _sliding(
        f"SELECT {K} % 5 AS channel, event_type AS behavior, epoch_us(ts) AS us "
        "FROM events WHERE event_type <> 'signup'", "channel, behavior", "event_count"),
    "type_count_fine": _sliding("SELECT event_type, epoch_us(ts) AS us FROM events", "event_type",
                                "event_count", slide=FINE_SLIDE),
    "click_cap_pass": f"SELECT event_id, user_id, event_type FROM ({CAPPED}) c WHERE click_no <= {CAP_MAX + 1}",
    "click_cap_warn": f"""
SELECT user_id, event_type, us AS ts_us, ' warning: flush click and more than {CAP_MAX}' AS msg
FROM ({CAPPED}) c WHERE click_no = {CAP_MAX + 2}""",
    "cap_then_sliding": _sliding(f"SELECT province, us FROM ({CAPPED}) c WHERE click_no <= {CAP_MAX + 1}",
                                 "province", "event_count"),
    "fail_pair": _lag_pairs("user_id", True,
                            f"warning: fail times more than 2 in {DETECT_WITHIN_S} seconds", "user_id"),
    "fail_pair_arrival": _lag_pairs("user_id", True,
                                    f"warning: fail times more than 2 in {DETECT_WITHIN_S} seconds",
                                    "user_id", order="event_id + (event_id * 37) % 101, event_id"),
    "fail_seq_keyed": _lag_pairs("user_id", False, f"fail 2 times in {DETECT_WITHIN_S} seconds", "user_id"),
    "fail_seq_global": _lag_pairs("", False, f"fail 2 times in {DETECT_WITHIN_S} seconds", "p_user"),
    "fail_burst": BURST,
    "late_rows": f"SELECT event_id, us AS ts_us, wm AS watermark_us FROM ({ARRIVALS}) a WHERE {LATE_COND}",
    "late_accepted_counts": _accepted("", ARRIVALS),
    "url_top3_late": URL_TOP,
    "url_top3_report": f"""
SELECT window_end,
       'window end: ' || strftime(make_timestamp(window_end * {US}), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg(format('Top{{}}: {{}} {{}}', rank, pv_count, url), chr(10) ORDER BY rank)
       || chr(10) || '{"-" * 32}' AS report
FROM ({URL_TOP}) t GROUP BY window_end""",
    "log_parse": _log_fields(),
    "asset_filter": f"SELECT event_id, url FROM (SELECT event_id, {URL} AS url FROM events) u "
                    "WHERE NOT regexp_matches(url, '\\.(css|js)$')",
    "stream_url_top3": _url_top(STREAM_SIZE, STREAM_SLIDE),
    "stream_url_report": _url_report(_url_top(STREAM_SIZE, STREAM_SLIDE)),
    "stream_late_rows": f"""
SELECT event_id, us AS ts_us, wm AS watermark_us FROM ({ARRIVALS}) a JOIN (SELECT event_id, {URL} AS url FROM events) u USING (event_id)
WHERE us // {STREAM_US} * {STREAM_US} + {STREAM_WIDE} - 1000 + {LATE_LATENESS_S * US} <= wm AND NOT regexp_matches(url, '\\.(css|js)$')""",
    "stream_type_count_fine": _sliding("SELECT event_type, epoch_us(ts) AS us FROM events", "event_type",
                                       "event_count", slide=FINE_SLIDE),
    "stream_fail_seq_global": _lag_pairs("", False, f"fail 2 times in {DETECT_WITHIN_S} seconds", "p_user"),
    "pay_timeout": f"""
SELECT order_id, created_us, paid_us,
       CASE WHEN created_us IS NULL THEN 'no_create' WHEN abs(paid_us - created_us) <= {DAY * US} THEN 'paid' ELSE 'timeout' END AS status
FROM (SELECT user_id * 100 + {K} AS order_id, min(CASE WHEN event_type = 'click' THEN epoch_us(ts) END) AS created_us,
             min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS paid_us
      FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1) o""",
    "reconcile_payments": RECONCILE,
    "stream_reconcile": RECONCILE,
    "stream_uv_hourly": _tumbling("event_type = 'view'", "count(DISTINCT user_id)", "uv_count"),
    "stream_uv_bitmap": f"SELECT window_end, uv_count FROM ({_tumbling("event_type = 'view'", f'count(DISTINCT {HASH})', 'uv_count')}) t",
}
SQL["stream_cap_then_sliding"] = SQL["cap_then_sliding"]
SQL["stream_click_cap_warn"] = SQL["click_cap_warn"]
for _name in ("fail_pair", "fail_seq_keyed", "fail_burst"):
    SQL[f"stream_{_name}"] = SQL[_name]

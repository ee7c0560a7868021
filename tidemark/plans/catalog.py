"""Registered queries over the driver tables.

Every query reads the whole ``events`` table of an ``sf_dir`` and returns
a DataFrame whose columns match the DuckDB oracle in ``oracle.py``.
Window bounds and times leave as BIGINT epoch seconds / microseconds.

Parameters are scaled to the table (mean gap between a user's events is
hours, not seconds): detection bounds are 6 h instead of 2 s.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_page_url
from ..functions.time import epoch_micros, format_java_timestamp, format_local, next_midnight
from ..operators import detect, late, reconcile, topn, windows
from ..sources import tables
from ..sources.text import parse_access_log
from ..streaming import jobs as sjobs
from ..streaming import reconcile as streams
from ..streaming import sinks
from ..streaming.replay import NOW, replay
from ..streaming.stateful import WARNING_SCHEMA
from . import jobs

# Shared with oracle.py.
HOUR = 3600
SLIDE = 300                  # 1 h / 5 min sliding windows
TOP_ITEMS = 5
TOP_URLS = 3
DETECT_WITHIN_S = 6 * HOUR   # login detectors
BURST_MIN_FAILS = 2
CAP_MAX = 1                  # click cap: 2 pass, the 3rd warns
LATE_BOUND_S = 600
LATE_LATENESS_S = 1800
DAY = 24 * HOUR
DISPLAY_TZ = "+08:00"
URL_SUFFIXES = ["", ".css", ".js", ".ico", ".css?v=1", ".js/x", ".html"]
METHODS = ["GET", "POST", "PUT", "HEAD"]


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.events(spark, sf_dir)


def _us(c: str):
    return epoch_micros(c)


# --- counts and distincts --------------------------------------------------------------------

def pv_hourly(spark, sf_dir):
    return jobs.page_view_count(tables.behaviors(_ev(spark, sf_dir)), HOUR, pv_behavior="view")


def uv_hourly_exact(spark, sf_dir):
    return jobs.unique_visitors(tables.behaviors(_ev(spark, sf_dir)), HOUR, pv_behavior="view",
                                method="exact")


def uv_hourly_bitmap(spark, sf_dir):
    return jobs.unique_visitors(tables.behaviors(_ev(spark, sf_dir)), HOUR, pv_behavior="view",
                                method="bitmap")


def time_formats(spark, sf_dir):
    pv = pv_hourly(spark, sf_dir)
    end = F.timestamp_seconds("window_end")
    return pv.select("window_end",
                     format_local(end, DISPLAY_TZ).alias("end_local"),
                     format_java_timestamp(end, "UTC").alias("end_java"),
                     F.unix_seconds(next_midnight(F.timestamp_seconds("window_start"), DISPLAY_TZ))
                     .alias("next_midnight"))


# --- sliding windows and top-n -----------------------------------------------------------------

def item_top5_sliding(spark, sf_dir):
    top = jobs.item_top_n(tables.behaviors(_ev(spark, sf_dir)), TOP_ITEMS, HOUR, SLIDE,
                          pv_behavior="view")
    return top.withColumn("rank", F.col("rank").cast("long"))


def item_top5_report(spark, sf_dir):
    top = jobs.item_top_n(tables.behaviors(_ev(spark, sf_dir)), TOP_ITEMS, HOUR, SLIDE,
                          pv_behavior="view")
    return jobs.item_top_n_report(top)


def type_count_sliding(spark, sf_dir):
    return jobs.channel_counts(tables.marketing(_ev(spark, sf_dir)), HOUR, SLIDE,
                               exclude="signup").withColumnRenamed("count", "event_count")


FINE_SLIDE = 5               # 1 h / 5 s: 720 windows per row


def type_count_fine(spark, sf_dir):
    """Very fine sliding windows (1 h / 5 s) by event type over all rows."""
    ev = _ev(spark, sf_dir)
    return windows.sliding_count(ev, "ts", ["event_type"], HOUR, FINE_SLIDE, count_name="event_count")


def _capped(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    clicks = ev.select("user_id", F.col("event_type").alias("ad_id"),
                       (tables.prop_k() % 5).alias("province"), "ts",
                       F.col("event_id").alias("seq"))
    return detect.click_cap(clicks, CAP_MAX)


def click_cap_pass(spark, sf_dir):
    passed, _ = _capped(spark, sf_dir)
    return passed.select(F.col("seq").alias("event_id"), "user_id",
                         F.col("ad_id").alias("event_type"))


def click_cap_warn(spark, sf_dir):
    _, warn = _capped(spark, sf_dir)
    return warn.select("user_id", F.col("ad_id").alias("event_type"), _us("ts").alias("ts_us"),
                       "msg")


def cap_then_sliding(spark, sf_dir):
    passed, _ = _capped(spark, sf_dir)
    return windows.sliding_count(passed, "ts", ["province"], HOUR, SLIDE, count_name="event_count")


# --- login detectors -------------------------------------------------------------------------

def _warn_cols(df):
    return df.select("user_id", _us("first_fail_ts").alias("first_fail_us"),
                     _us("last_fail_ts").alias("last_fail_us"), "warning_msg")


def fail_pair(spark, sf_dir):
    return _warn_cols(jobs.login_fail_pairs(tables.logins(_ev(spark, sf_dir)), DETECT_WITHIN_S))


def fail_pair_arrival(spark, sf_dir):
    """Pairs in arrival order (jittered arrival, then event_id), as a
    consumer that does not sort by event time sees them."""
    lg = tables.logins(_ev(spark, sf_dir))
    lg = lg.withColumn("arrival", F.col("seq") + (F.col("seq") * 37) % 101)
    return _warn_cols(detect.fail_pairs(lg, DETECT_WITHIN_S, order="arrival",
                                        arrival=["arrival", "seq"]))


def fail_seq_keyed(spark, sf_dir):
    return _warn_cols(jobs.login_fail_pattern(tables.logins(_ev(spark, sf_dir)), DETECT_WITHIN_S,
                                              keyed=True))


def fail_seq_global(spark, sf_dir):
    return _warn_cols(jobs.login_fail_pattern(tables.logins(_ev(spark, sf_dir)), DETECT_WITHIN_S,
                                              keyed=False))


def fail_burst(spark, sf_dir):
    b = jobs.login_fail_bursts(tables.logins(_ev(spark, sf_dir)), DETECT_WITHIN_S, BURST_MIN_FAILS)
    return b.select("user_id", _us("first_fail_ts").alias("first_fail_us"),
                    _us("last_fail_ts").alias("last_fail_us"), "fail_count", "warning_msg")


# --- lateness ----------------------------------------------------------------------------------

def _arrivals(spark, sf_dir):
    """Events with a jittered arrival number (then event_id as tie-break)."""
    ev = _ev(spark, sf_dir)
    return ev.withColumn("arrival", F.col("event_id") + (F.col("event_id") * 37) % 101)


def _routed(spark, sf_dir):
    return late.route_late(_arrivals(spark, sf_dir), HOUR, SLIDE, LATE_BOUND_S, LATE_LATENESS_S,
                           arrival=["arrival", "event_id"])


def late_rows(spark, sf_dir):
    return (_routed(spark, sf_dir).filter("is_late")
            .select("event_id", _us("ts").alias("ts_us"), "watermark_us"))


def late_accepted_counts(spark, sf_dir):
    return late.accepted_window_counts(_routed(spark, sf_dir), [], HOUR, SLIDE, LATE_LATENESS_S)


def _url():
    suffix = F.element_at(F.array(*[F.lit(s) for s in URL_SUFFIXES]),
                          (F.col("event_id") % len(URL_SUFFIXES) + 1).cast("int"))
    return F.concat(F.lit("/item/"), tables.prop_k().cast("string"), suffix)


def url_top3_late(spark, sf_dir):
    # The watermark advances on every request; static assets are dropped
    # after it, before the windows.
    routed = _routed(spark, sf_dir).select("ts", "watermark_us", "is_late", _url().alias("url"))
    pages = routed.filter(is_page_url("url"))
    counts = late.accepted_window_counts(pages, ["url"], HOUR, SLIDE, LATE_LATENESS_S)
    return (topn.top_n_per_window(counts, TOP_URLS, key="url", count="pv_count")
            .select("window_start", "window_end", F.col("rank").cast("long").alias("rank"), "url",
                    "pv_count"))


# --- access-log text ---------------------------------------------------------------------------

def url_top3_report(spark, sf_dir):
    return jobs.page_view_top_n_report(url_top3_late(spark, sf_dir))


def _log_lines(spark, sf_dir):
    """Access-log lines rendered from events (time written at +08:00)."""
    ev = _ev(spark, sf_dir)
    ip = F.format_string("10.%d.%d.%d", F.col("user_id") % 256, tables.prop_k(),
                         F.col("event_id") % 256)
    method = F.element_at(F.array(*[F.lit(m) for m in METHODS]),
                          (F.col("event_id") % len(METHODS) + 1).cast("int"))
    when = format_local("ts", DISPLAY_TZ, "dd/MM/yyyy:HH:mm:ss")
    line = F.concat_ws(" ", ip, F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit("-"),
                       when, F.lit("+0000"), method, _url())
    return ev.select("event_id", line.alias("value"))


def log_parse(spark, sf_dir):
    parsed = parse_access_log(_log_lines(spark, sf_dir), tz=DISPLAY_TZ)
    return parsed.select("event_id", "ip", F.col("user_id").alias("user_name"),
                         F.unix_millis("ts").alias("ts_ms"), "method", "url")


def asset_filter(spark, sf_dir):
    ev = _ev(spark, sf_dir).select("event_id", _url().alias("url"))
    return ev.filter(is_page_url("url"))


# --- orders, payments, receipts ------------------------------------------------------------------

def _orders(spark, sf_dir):
    """Clicks create an order, purchases pay it; a user's item is the order."""
    kind = F.when(F.col("event_type") == "click", "create").when(F.col("event_type") == "purchase", "pay")
    return _ev(spark, sf_dir).select((F.col("user_id") * 100 + tables.prop_k()).alias("order_id"), kind.alias("event"), "ts")


def _payments(spark, sf_dir, event_type):
    """Purchases are payments, signups receipts; user and item name the transaction."""
    tx = F.concat_ws("-", F.lit("tx"), F.col("user_id").cast("string"), (tables.prop_k() % 10).cast("string"))
    return _ev(spark, sf_dir).filter(F.col("event_type") == event_type).select("event_id", tx.alias("tx_id"), "ts")


def pay_timeout(spark, sf_dir):
    """Orders paid within a day, not paid in time, or paid without having been created."""
    return reconcile.payment_timeouts(_orders(spark, sf_dir), DAY)


def reconcile_payments(spark, sf_dir):
    """Payments and receipts of one transaction at most a day apart, and those without partner."""
    return reconcile.reconcile(_payments(spark, sf_dir, "purchase"), _payments(spark, sf_dir, "signup"), DAY)


# --- streams, replayed from the table -----------------------------------------------------------

FAR_S = 4_000_000_000        # closing rows: past every window of the table
STREAM_SIZE, STREAM_SLIDE = 600, 10
CUTS = 3


def _closing(df, *far_s):
    """One row per time: the schema of ``df``, nulls but for ts and what the streams filter out."""
    spark = df.sparkSession
    out = []
    for i, s in enumerate(far_s):
        row = spark.range(1).select(*[
            (F.timestamp_seconds(F.lit(s)) if f.name == "ts" else
             F.lit("/closing.css") if f.name == "url" else
             F.lit("closing") if f.name in ("behavior", "event_type", "state") else
             F.lit((1 << 60) + i) if f.name in ("arrival", "event_id", "seq") else
             F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        out.append(row)
    return out


def _page_log(spark, sf_dir):
    return _arrivals(spark, sf_dir).select("event_id", "arrival", "ts", _url().alias("url"))


def _page_view_stream(spark, sf_dir):
    log = _page_log(spark, sf_dir)

    def start(stream, root, name):
        return sjobs.page_view_query(stream, root, TOP_URLS, STREAM_SIZE, STREAM_SLIDE, LATE_BOUND_S,
                                     LATE_LATENESS_S, name, arrival=["arrival", "event_id"], trigger=NOW, folder_s=DAY)

    return replay(log, F.col("arrival"), start, CUTS, _closing(log, FAR_S), near=("event_id", 101))


def stream_url_top3(spark, sf_dir):
    """The page-view job as one stream over the table: 10 min / 10 s windows, lateness, refinements."""
    root = _page_view_stream(spark, sf_dir)
    return (spark.read.parquet(f"{root}/out")
            .select("window_start", "window_end", F.col("rank").cast("long").alias("rank"), "url", "pv_count"))


def stream_url_report(spark, sf_dir):
    """Text report of the windows that the page-view stream has published."""
    return sjobs.page_view_report(spark.read.parquet(f"{_page_view_stream(spark, sf_dir)}/out"))


def stream_late_rows(spark, sf_dir):
    """The late side output of the page-view stream: pages late for all their windows."""
    root = _page_view_stream(spark, sf_dir)
    return spark.read.parquet(f"{root}/late").select("event_id", _us("ts").alias("ts_us"), "watermark_us")


def stream_type_count_fine(spark, sf_dir):
    """Counts by event type over 1 h / 5 s windows, published by the stream itself."""
    ev = _ev(spark, sf_dir).select("event_id", "ts", "event_type")

    def start(stream, root, name):
        return sjobs.window_count_query(stream, root, ["event_type"], HOUR, FINE_SLIDE,
                                        keep=F.col("event_type") != "closing", count_name="event_count",
                                        arrival=["event_id"], name=name, trigger=NOW, folder_s=DAY)

    root = replay(ev, F.col("event_id"), start, CUTS, _closing(ev, FAR_S), near=("event_id", 0))
    return spark.read.parquet(f"{root}/out").select("window_start", "window_end", "event_type", "event_count")


def stream_uv_hourly(spark, sf_dir):
    """Exact visitors per hour by the chained aggregation of the stream, ascending watermark."""
    beh = tables.behaviors(_ev(spark, sf_dir)).select("seq", "ts", "user_id", "behavior")

    def start(stream, root, name):
        return sjobs.unique_visitor_query(stream, root, HOUR, "view", name=name, trigger=NOW)

    root = replay(beh, F.col("seq"), start, CUTS, _closing(beh, FAR_S, FAR_S + 2 * HOUR))
    return spark.read.parquet(root).select("window_start", "window_end", "uv_count")


def stream_uv_bitmap(spark, sf_dir):
    """Visitors per hour so far, refreshed by every micro-batch, from the upserted bitmap chunks."""
    beh = tables.behaviors(_ev(spark, sf_dir)).select("seq", "ts", "user_id", "behavior")

    def start(stream, root, name):
        return sjobs.unique_visitor_bitmap_query(stream, root, HOUR, "view", name=name, trigger=NOW)

    root = replay(beh, F.col("seq"), start, CUTS)
    return spark.read.parquet(root).groupBy(F.col("window_end").cast("long").alias("window_end")).agg(F.sum("bits").cast("long").alias("uv_count"))


def stream_fail_seq_global(spark, sf_dir):
    """The pattern across users as a stream, rows in jittered arrival order, none late by more than the delay."""
    lg = tables.logins(_ev(spark, sf_dir)).select("user_id", "state", "ts", "seq")

    def start(stream, root, name):
        return sjobs.login_pattern_query(stream, root, DETECT_WITHIN_S, 10 * DAY, name, trigger=NOW)

    root = replay(lg, F.col("seq") + (F.col("seq") * 37) % 101, start, CUTS, _closing(lg, FAR_S), near=("seq", 101))
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def _login_stream(spark, sf_dir, kind, threshold=2):
    """Warnings of the per-user detector ``kind`` as a stream, rows in jittered arrival order."""
    lg = tables.logins(_ev(spark, sf_dir)).select("user_id", "state", "ts", "seq")

    def start(stream, root, name):
        return sjobs.login_warning_query(stream, root, kind, DETECT_WITHIN_S, threshold, "10 days", name, NOW)

    root = replay(lg, F.col("seq") + (F.col("seq") * 37) % 101, start, CUTS, _closing(lg, FAR_S), near=("seq", 101))
    return spark.read.schema(WARNING_SCHEMA).parquet(root).drop("batch_id")


def stream_fail_pair(spark, sf_dir):
    """``fail_pair`` as a stream."""
    return _login_stream(spark, sf_dir, "pair").drop("fail_count")


def stream_fail_seq_keyed(spark, sf_dir):
    """``fail_seq_keyed`` as a stream."""
    return _login_stream(spark, sf_dir, "sequence").drop("fail_count")


def stream_fail_burst(spark, sf_dir):
    """``fail_burst`` as a stream."""
    return _login_stream(spark, sf_dir, "burst", BURST_MIN_FAILS)


def _ad_stream(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    clicks = ev.select("user_id", F.col("event_type").alias("ad_id"), (tables.prop_k() % 5).alias("province"),
                       "ts", F.col("event_id").alias("seq"))

    def start(stream, root, name):
        return sjobs.ad_click_windows_query(stream, root, CAP_MAX, HOUR, SLIDE, name, NOW, folder_s=DAY)

    return replay(clicks, F.col("seq"), start, CUTS, _closing(clicks, FAR_S), near=("seq", 0))


def stream_cap_then_sliding(spark, sf_dir):
    """The ad job as one stream: clicks under the cap per province and window."""
    return (spark.read.parquet(f"{_ad_stream(spark, sf_dir)}/out").filter("window_start < 3000000000")
            .select("window_start", "window_end", "province", F.col("count").alias("event_count")))


def stream_click_cap_warn(spark, sf_dir):
    """The warnings of the same stream."""
    warn = spark.read.parquet(f"{_ad_stream(spark, sf_dir)}/warn")
    return warn.select("user_id", F.col("ad_id").alias("event_type"), _us("ts").alias("ts_us"), "msg")


def stream_reconcile(spark, sf_dir):
    """``reconcile_payments`` as a stream-stream full outer join; both sides come from one source."""
    both = _payments(spark, sf_dir, "purchase").withColumn("kind", F.lit("pay")).unionByName(
        _payments(spark, sf_dir, "signup").withColumn("kind", F.lit("receipt")))

    def start(stream, root, name):
        closing = F.col("kind").isNull()
        sides = [stream.filter((F.col("kind") == kind) | closing) for kind in ("pay", "receipt")]
        return sjobs.start(streams.reconcile_stream(*sides, DAY, "0 seconds"), sinks.write_batch(root), name, "append", NOW)

    root = replay(both, F.col("event_id"), start, CUTS, _closing(both, FAR_S, FAR_S + 10 * DAY), near=("event_id", 0))
    return spark.read.parquet(root).drop("batch_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pv_hourly": pv_hourly,
    "uv_hourly_exact": uv_hourly_exact,
    "uv_hourly_bitmap": uv_hourly_bitmap,
    "time_formats": time_formats,
    "item_top5_sliding": item_top5_sliding,
    "item_top5_report": item_top5_report,
    "type_count_sliding": type_count_sliding,
    "type_count_fine": type_count_fine,
    "click_cap_pass": click_cap_pass,
    "click_cap_warn": click_cap_warn,
    "cap_then_sliding": cap_then_sliding,
    "fail_pair": fail_pair,
    "fail_pair_arrival": fail_pair_arrival,
    "fail_seq_keyed": fail_seq_keyed,
    "fail_seq_global": fail_seq_global,
    "fail_burst": fail_burst,
    "late_rows": late_rows,
    "late_accepted_counts": late_accepted_counts,
    "url_top3_late": url_top3_late,
    "url_top3_report": url_top3_report,
    "log_parse": log_parse,
    "asset_filter": asset_filter,
    "stream_url_top3": stream_url_top3,
    "stream_url_report": stream_url_report,
    "stream_late_rows": stream_late_rows,
    "stream_type_count_fine": stream_type_count_fine,
    "stream_uv_hourly": stream_uv_hourly,
    "stream_uv_bitmap": stream_uv_bitmap,
    "stream_fail_seq_global": stream_fail_seq_global,
    "stream_fail_pair": stream_fail_pair,
    "stream_fail_seq_keyed": stream_fail_seq_keyed,
    "stream_fail_burst": stream_fail_burst,
    "stream_cap_then_sliding": stream_cap_then_sliding,
    "stream_click_cap_warn": stream_click_cap_warn,
    "pay_timeout": pay_timeout,
    "reconcile_payments": reconcile_payments,
    "stream_reconcile": stream_reconcile,
}

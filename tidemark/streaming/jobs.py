"""The analytics jobs as streaming queries.

Each ``*_query`` function wires sources, operators and sinks and returns
a started ``StreamingQuery``. Checkpoints go under the shared
``spark.checkpoint.dir`` (``name`` picks the sub-folder); sinks are
idempotent per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import SEQUENCE_MESSAGE, is_page_url, window_seconds_text
from ..functions.time import epoch_micros
from ..operators.topn import top_n_per_window
from ..plans.jobs import page_view_top_n_report
from ..session import checkpoint_path
from . import sinks, stateful
from . import windows as swin
from .click_cap import click_cap_writer
from .global_pattern import pattern_writer
from .window_store import window_writer


def _views(behaviors: DataFrame, pv_behavior: str, delay: str) -> DataFrame:
    """Page views of a stream whose watermark is set on all rows first (every
    behaviour advances event time, as in the reference)."""
    return (behaviors.withWatermark("ts", delay)
            .filter(swin.after_watermark(F.col("behavior") == pv_behavior)))


def start(df: DataFrame, write: Callable[[DataFrame, int], None], name: str,
          mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    spark = df.sparkSession
    w = (df.writeStream.outputMode(mode).foreachBatch(write).queryName(name)
         .option("checkpointLocation", checkpoint_path(spark, f"streams/{name}")))
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return w.start()


def item_top_n_query(behaviors: DataFrame, out_root: str, n: int = 5, size_s: int = 3600,
                     slide_s: int = 300, pv_behavior: str = "pv", delay: str = "0 seconds",
                     name: str = "item_top_n", trigger: dict | None = None) -> StreamingQuery:
    """Top-n items per sliding window: append-mode counts, ranked per batch."""
    views = _views(behaviors, pv_behavior, delay)
    counts = swin.window_counts(views, "ts", ["item_id"], size_s, slide_s, None, "pv_count")
    return start(counts, swin.top_n_batches(n, "item_id", "pv_count", sinks.write_batch(out_root)),
                 name, "append", trigger)


def page_view_query(log: DataFrame, root: str, n: int = 3, size_s: int = 600, slide_s: int = 10,
                    bound_s: int = 1, lateness_s: int = 60, name: str = "page_views",
                    arrival: Sequence[str] | None = None, early: bool = False,
                    extensions: list[str] | None = None, trigger: dict | None = None,
                    **outputs) -> StreamingQuery:
    """The page-view job as one stream: every log line is routed once; requests for pages are counted
    in the windows still open for them, and the top ``n`` URLs of a window are published (``root/out``)
    when the watermark passes its end, and again when a late but accepted row refines it. Rows late for
    all their windows go to ``root/late``. Static assets advance the watermark and nothing else.
    ``arrival`` orders the lines of a micro-batch; ``early`` also publishes windows not yet ended."""
    def top(counts: DataFrame) -> DataFrame:
        return (top_n_per_window(counts, n, key="url", count="pv_count")
                .select("window_start", "window_end", "rank", "url", "pv_count"))

    writer = window_writer(root, ["url"], size_s, slide_s, bound_s, lateness_s, "pv_count",
                           keep=is_page_url("url", extensions), arrival=arrival, early=early,
                           publish=top, **outputs)
    return start(log, writer, name, "append", trigger)


def page_view_report(top: DataFrame, tz: str = "UTC") -> DataFrame:
    """Text block per published window of ``page_view_query`` (a read of its ``root/out``)."""
    return page_view_top_n_report(top.drop("part"), tz)


def page_view_top_n_query(log: DataFrame, store_root: str, top_root: str, n: int = 3,
                          size_s: int = 600, slide_s: int = 10, bound_s: int = 1,
                          lateness_s: int = 60, name: str = "page_view_top_n",
                          trigger: dict | None = None) -> StreamingQuery:
    """``page_view_query`` with early results: the store under ``store_root``, the top-n in ``top_root``."""
    return page_view_query(log, store_root, n, size_s, slide_s, bound_s, lateness_s, name,
                           early=True, trigger=trigger, out=top_root)


def ad_click_query(clicks: DataFrame, pass_root: str, warn_root: str, max_clicks: int = 100,
                   name: str = "ad_click_cap", trigger: dict | None = None) -> StreamingQuery:
    """Click cap on a stream: passing clicks and warnings to two outputs.
    By keyed state, row by row as they come; ``ad_click_windows_query`` caps by micro-batch and
    counts the province windows in the same query."""
    tagged = stateful.click_cap_stream(clicks, max_clicks)
    return start(tagged, sinks.split_by_kind({"pass": sinks.write_batch(pass_root),
                                               "warn": sinks.write_batch(warn_root)}),
                 name, "append", trigger)


def ad_click_windows_query(clicks: DataFrame, root: str, max_clicks: int = 100, size_s: int = 3600,
                           slide_s: int = 5, name: str = "ad_clicks", trigger: dict | None = None,
                           **options) -> StreamingQuery:
    """The whole ad job as one stream (``click_cap``): ``root/pass``, ``root/warn``, ``root/late`` and the province
    windows of the clicks that pass in ``root/out``."""
    return start(clicks, click_cap_writer(root, max_clicks, size_s=size_s, slide_s=slide_s, **options), name,
                 "append", trigger)


def channel_pane_query(events: DataFrame, pane_root: str, slide_s: int = 5,
                       exclude: str = "UNINSTALL", delay: str = "0 seconds",
                       name: str = "channel_panes", trigger: dict | None = None) -> StreamingQuery:
    """Very fine sliding windows (1 h / 5 s) on a stream: stream pane counts
    to a table; roll them up with ``operators.windows.sliding_from_panes``."""
    kept = events.withWatermark("ts", delay).filter(swin.after_watermark(F.col("behavior") != exclude))
    panes = swin.pane_counts(kept, "ts", ["channel", "behavior"], slide_s, None)
    return start(panes, sinks.write_batch(pane_root), name, "append", trigger)


def page_view_count_query(behaviors: DataFrame, out_root: str, size_s: int = 3600,
                          pv_behavior: str = "pv", delay: str = "0 seconds",
                          name: str = "page_view_count", trigger: dict | None = None) -> StreamingQuery:
    """Page views per tumbling window (append: one row per closed window)."""
    views = _views(behaviors, pv_behavior, delay)
    counts = swin.window_counts(views, "ts", [], size_s, None, None, "pv_count")
    return start(counts, sinks.write_batch(out_root), name, "append", trigger)


def unique_visitor_query(behaviors: DataFrame, out_root: str, size_s: int = 3600,
                         pv_behavior: str = "pv", delay: str = "0 seconds",
                         name: str = "unique_visitors", trigger: dict | None = None) -> StreamingQuery:
    """Exact visitors per tumbling window (chained aggregation, append)."""
    views = _views(behaviors, pv_behavior, delay)
    uv = swin.distinct_counts(views, "ts", "user_id", size_s, delay=None)
    return start(uv, sinks.write_batch(out_root), name, "append", trigger)


def unique_visitor_bitmap_query(behaviors: DataFrame, store_root: str, size_s: int = 3600,
                                pv_behavior: str = "pv", delay: str = "0 seconds",
                                name: str = "unique_visitors_bitmap",
                                trigger: dict | None = None) -> StreamingQuery:
    """Hashed-bitmap visitors, refreshed on every micro-batch (update mode):
    the bitmap words touched by a batch are upserted into ``store_root``, keyed by
    (window_end, bucket); visitors so far = ``sum(bits)`` per window_end."""
    views = _views(behaviors, pv_behavior, delay)
    chunks = swin.bitmap_buckets(views, "ts", "user_id", size_s, None)
    return start(chunks, sinks.upsert_partitions(store_root, ["bucket"], "window_end"), name,
                 "update", trigger)


def login_warning_query(logins: DataFrame, out_root: str, kind: str = "pair", within_s: float = 2,
                        threshold: int = 2, delay: str = "3 seconds", name: str | None = None,
                        trigger: dict | None = None) -> StreamingQuery:
    """Login-failure warnings on a stream: ``kind`` = 'pair', 'sequence'
    (keyed) or 'burst'."""
    if kind == "pair":
        out = stateful.fail_pairs_stream(logins, within_s, threshold, delay)
    elif kind == "sequence":
        out = stateful.fail_sequences_stream(logins, within_s, delay)
    elif kind == "burst":
        out = stateful.fail_bursts_stream(logins, within_s, threshold, delay)
    else:
        raise ValueError(kind)
    return start(out, sinks.write_batch(out_root), name or f"login_{kind}", "append", trigger)


def login_pattern_query(logins: DataFrame, root: str, within_s: float = 2, delay_s: float = 3,
                        name: str = "login_pattern", trigger: dict | None = None) -> StreamingQuery:
    """Failure then failure over the whole stream, across users; the warning carries the first one's id."""
    msg = SEQUENCE_MESSAGE.format(s=window_seconds_text(within_s))

    def warnings(found: DataFrame) -> DataFrame:
        return found.select(F.col("first_user").alias("user_id"), epoch_micros("first_ts").alias("first_fail_us"),
                            epoch_micros("ts").alias("last_fail_us"), F.lit(msg).alias("warning_msg"))

    is_fail = F.col("state") == "fail"
    writer = pattern_writer(root, [is_fail, is_fail], within_s, delay_s, publish=warnings)
    return start(logins, writer, name, "append", trigger)


def page_view_top_n_queries(log: DataFrame, store_root: str, top_root: str, accepted_root: str,
                            late_root: str, n: int = 3, size_s: int = 600, slide_s: int = 10,
                            bound_s: int = 1, lateness_s: int = 60, name: str = "page_views",
                            trigger: dict | None = None) -> list[StreamingQuery]:
    """``page_view_top_n_query`` that also writes accepted rows and late rows; one query, in a list."""
    return [page_view_query(log, store_root, n, size_s, slide_s, bound_s, lateness_s, name, early=True,
                            trigger=trigger, out=top_root, accepted=sinks.write_batch(accepted_root),
                            late=sinks.write_batch(late_root))]


def window_count_query(events: DataFrame, root: str, keys: Sequence[str], size_s: int = 3600,
                       slide_s: int = 5, keep: Column | None = None, bound_s: float = 0,
                       lateness_s: float = 0, count_name: str = "count",
                       arrival: Sequence[str] | None = None, name: str = "window_counts",
                       trigger: dict | None = None, **outputs) -> StreamingQuery:
    """Sliding counts by ``keys`` (e.g. channel and behaviour, 1 h / 5 s), published to ``root/out``
    as the watermark passes the windows; no roll-up is left to do."""
    writer = window_writer(root, keys, size_s, slide_s, bound_s, lateness_s, count_name, keep=keep,
                           arrival=arrival, **outputs)
    return start(events, writer, name, "append", trigger)

"""The analytics jobs as DataFrame compositions (batch).

Each job takes typed records (see ``tidemark.schemas`` / ``sources``) with
an instant column ``ts`` and, where order matters, a total-order
tie-breaker ``seq`` (arrival number), and returns DataFrames. Streaming
forms of the same jobs live in ``tidemark.streaming``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_page_url
from ..operators import aggregates, detect, late, topn, windows


def item_top_n(behaviors: DataFrame, n: int = 5, size_s: int = 3600, slide_s: int = 300,
               pv_behavior: str = "pv") -> DataFrame:
    """Top-n items by page views per sliding window.
    -> window_start, window_end, rank, item_id, pv_count"""
    views = behaviors.filter(F.col("behavior") == pv_behavior)
    counts = windows.sliding_count(views, "ts", ["item_id"], size_s, slide_s, count_name="pv_count")
    return topn.top_n_per_window(counts, n, key="item_id", count="pv_count") \
        .select("window_start", "window_end", "rank", "item_id", "pv_count")


def item_top_n_report(top: DataFrame, tz: str = "UTC") -> DataFrame:
    return topn.top_n_report(top, key="item_id", count="pv_count", header="window end: ",
                             key_label="item_id", count_label="pv", tz=tz)


def page_view_count(behaviors: DataFrame, size_s: int = 3600, pv_behavior: str = "pv") -> DataFrame:
    """Page views per tumbling window. -> window_start, window_end, pv_count"""
    views = behaviors.filter(F.col("behavior") == pv_behavior)
    return windows.tumbling_count(views, "ts", [], size_s, count_name="pv_count")


def unique_visitors(behaviors: DataFrame, size_s: int = 3600, pv_behavior: str = "pv",
                    method: str = "exact") -> DataFrame:
    """Distinct visitors per tumbling window: ``exact`` or ``bitmap``.
    -> window_start, window_end, uv_count"""
    views = behaviors.filter(F.col("behavior") == pv_behavior)
    if method == "exact":
        return aggregates.distinct_count(views, "ts", "user_id", size_s)
    if method == "bitmap":
        return aggregates.bitmap_distinct_count(views, "ts", "user_id", size_s)
    if method == "approx":
        return aggregates.approx_distinct_count(views, "ts", "user_id", size_s)
    raise ValueError(method)


def channel_counts(events: DataFrame, size_s: int = 3600, slide_s: int = 5,
                   exclude: str = "UNINSTALL") -> DataFrame:
    """Rows per (channel, behavior) per sliding window, one behavior excluded.
    -> window_start, window_end, channel, behavior, count"""
    kept = events.filter(F.col("behavior") != exclude)
    return windows.sliding_count(kept, "ts", ["channel", "behavior"], size_s, slide_s,
                                 count_name="count")


def ad_counts_by_province(clicks: DataFrame, max_clicks: int = 100, size_s: int = 3600,
                          slide_s: int = 5, day_tz: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """Click cap per (user, ad, day), then clicks per province per sliding
    window. -> (window_start, window_end, province, count), warnings"""
    passed, warnings = detect.click_cap(clicks, max_clicks, day_tz=day_tz)
    counts = windows.sliding_count(passed, "ts", ["province"], size_s, slide_s, count_name="count")
    return counts, warnings


def page_view_top_n(log: DataFrame, n: int = 3, size_s: int = 600, slide_s: int = 10,
                    bound_s: float = 1, lateness_s: float = 60,
                    extensions: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Top-n URLs per sliding window, with a watermark bound, allowed
    lateness and a side output of late rows. ``log`` needs ``url``, ``ts``
    and an arrival number ``arrival``. The watermark advances on every log
    line; static-asset requests are dropped after it, before the windows.
    -> (window_start, window_end, rank, url, pv_count), late rows"""
    routed = late.route_late(log, size_s, slide_s, bound_s, lateness_s)
    routed = routed.filter(is_page_url("url", extensions))
    counts = late.accepted_window_counts(routed, ["url"], size_s, slide_s, lateness_s)
    top = topn.top_n_per_window(counts, n, key="url", count="pv_count") \
        .select("window_start", "window_end", "rank", "url", "pv_count")
    return top, routed.filter(F.col("is_late")).drop("is_late")


def page_view_top_n_report(top: DataFrame, tz: str = "UTC") -> DataFrame:
    """Text block per window: 'TopN: <count> <url>' lines."""
    return topn.top_n_report(top, key="url", count="pv_count", header="window end: ",
                             line="Top{rank}: {count} {key}", tz=tz)


def login_fail_bursts(logins: DataFrame, within_s: float = 2, min_fails: int = 2) -> DataFrame:
    return detect.fail_bursts(logins, within_s, min_fails)


def login_fail_pairs(logins: DataFrame, within_s: float = 2, max_fails: int = 2,
                     order: str = "event") -> DataFrame:
    return detect.fail_pairs(logins, within_s, max_fails, order=order)


def login_fail_pattern(logins: DataFrame, within_s: float = 2, keyed: bool = True) -> DataFrame:
    return detect.fail_sequences(logins, within_s, keyed=keyed)

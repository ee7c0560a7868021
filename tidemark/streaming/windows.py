"""Windowed aggregations on streams.

* Counts per window use chained aggregations in append mode: rows are
  counted per pane (gcd(size, slide) wide) first, then panes are rolled up into their
  ``size/slide`` windows (``window(window_time(pane), size, slide)``), so
  the per-row fan-out happens on pane counts, not on rows.
* Exact distinct counts are the chain (window, key, value) -> (window,
  key): streaming rejects ``count(distinct)``.
* Top-n per window ranks each micro-batch of closed windows inside
  ``foreachBatch``: in append mode all keys of a window are emitted in the
  same micro-batch (they close on the same watermark), so the rank is
  exact and ``row_number`` keeps its partial ``WindowGroupLimit``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BITMAP_BITS, BITMAP_HASH_SEED, bitmap_mask, bitmap_word, poly_hash
from ..operators.topn import top_n_per_window


def _bounds(w: str = "window"):
    return [F.unix_seconds(F.col(f"{w}.start")).alias("window_start"),
            F.unix_seconds(F.col(f"{w}.end")).alias("window_end")]


def _watermarked(stream: DataFrame, ts: str, delay: str | None) -> DataFrame:
    """``delay=None``: the stream already carries its watermark (set before
    a filter, so filtered-out rows still advance event time)."""
    return stream if delay is None else stream.withWatermark(ts, delay)


def after_watermark(condition: Column, ts: str = "ts") -> Column:
    """A filter that stays behind the watermark. The optimizer moves a filter that does not read the
    event time below the watermark, and rows filtered out then no longer advance event time; this
    form reads it (no timestamp has that value)."""
    return condition | (F.unix_micros(ts) == F.lit(-(1 << 63)))


def window_counts(stream: DataFrame, ts: str, keys: Sequence[str], size_s: int,
                  slide_s: int | None = None, delay: str | None = "0 seconds",
                  count_name: str = "count") -> DataFrame:
    """Append-mode counts per (window, keys); ``slide_s=None`` = tumbling.
    Windows are emitted once, when the watermark (max ts - delay) passes
    their end."""
    src = _watermarked(stream, ts, delay)
    if not slide_s or slide_s == size_s:
        agg = src.groupBy(F.window(ts, f"{size_s} seconds"), *keys).agg(
            F.count(F.lit(1)).alias(count_name))
    else:
        width = gcd(size_s, slide_s)  # every window bound is a pane bound
        panes = src.groupBy(F.window(ts, f"{width} seconds").alias("pane"), *keys).agg(
            F.count(F.lit(1)).alias("_n"))
        agg = panes.groupBy(
            F.window(F.window_time("pane"), f"{size_s} seconds", f"{slide_s} seconds"), *keys
        ).agg(F.sum("_n").cast("long").alias(count_name))
    return agg.select(*_bounds(), *keys, count_name)


def pane_counts(stream: DataFrame, ts: str, keys: Sequence[str], slide_s: int,
                delay: str | None = "0 seconds") -> DataFrame:
    """Append-mode counts per slide-wide pane; for very fine slides write
    these to a table and roll them up with ``operators.windows`` in batch."""
    src = _watermarked(stream, ts, delay)
    return (src.groupBy(F.window(ts, f"{slide_s} seconds").alias("pane"), *keys)
            .agg(F.count(F.lit(1)).alias("pane_count"))
            .select(F.unix_seconds(F.col("pane.start")).alias("pane_start"), *keys, "pane_count"))


def distinct_counts(stream: DataFrame, ts: str, value: str, size_s: int,
                    keys: Sequence[str] = (), delay: str | None = "0 seconds",
                    name: str = "uv_count") -> DataFrame:
    """Exact distinct ``value`` per tumbling window (append mode)."""
    src = _watermarked(stream, ts, delay)
    first = src.groupBy(F.window(ts, f"{size_s} seconds"), *keys, value).agg(
        F.count(F.lit(1)).alias("_n"))
    return (first.groupBy("window", *keys).agg(F.count(F.lit(1)).alias(name))
            .select(*_bounds(), *keys, name))


def bitmap_buckets(stream: DataFrame, ts: str, value: str, size_s: int,
                   delay: str | None = "0 seconds", seed: int = BITMAP_HASH_SEED,
                   bits: int = BITMAP_BITS) -> DataFrame:
    """Per (window, bucket): the set-bit count of one 64-bit word of the hashed
    bitmap (state: that word, never a larger chunk, so sparse ids stay cheap).
    Run in ``update`` mode, each micro-batch re-emits only the words it touched (early results on every batch); upsert them with
    ``sinks.upsert_partitions`` and sum ``bits`` per window to read the
    visitors so far."""
    off = poly_hash(value, seed, bits)
    src = _watermarked(stream, ts, delay).select(ts, off.alias("_o"))
    return (src.groupBy(F.window(ts, f"{size_s} seconds"), bitmap_word("_o").alias("bucket"))
            .agg(F.bit_count(F.bit_or(bitmap_mask("_o"))).cast("long").alias("bits"))
            .select(*_bounds(), "bucket", "bits"))


def top_n_batches(n: int, key: str, count: str,
                  write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function ranking each batch of closed windows."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(top_n_per_window(batch, n, key=key, count=count), batch_id)
    return run

"""Event-time windows.

* Tumbling windows are a projection (``window(ts, size)``): no fan-out.
* Sliding windows are computed with panes: rows are first counted per
  pane, gcd(size, slide) wide (map-side partial aggregation); window counts are then
  running sums over the panes (a difference array per block of
  consecutive windows), so the work is proportional to panes plus output windows, not to
  rows times ``size/slide``. Pane rows are co-located by (keys, block of
  windows): one hot key is still spread over its time range and
  nothing after that repartition needs another exchange.

Window ends leave as BIGINT epoch seconds (``window_end``) and
``window_start``; a window is ``[start, end)`` aligned to the epoch, so a
row exactly on an end belongs to the next window.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import MICROS_PER_SECOND, col_, epoch_micros, epoch_seconds, floor_div


def _grid(size_s: int, slide_s: int) -> tuple[int, int]:
    """(pane width, block length): panes are gcd(size, slide) wide, so every
    window bound is a pane bound; a pane lies in at most ceil(size/slide)
    windows, which is also the number of windows per block."""
    if size_s <= 0 or slide_s <= 0:
        raise ValueError("window size and slide must be positive")
    return gcd(size_s, slide_s), -(-size_s // slide_s)


def pane_index(ts, width_s: int) -> Column:
    """Index of the pane holding ``ts`` (pane p = [p*width, (p+1)*width))."""
    return floor_div(epoch_micros(ts), width_s * MICROS_PER_SECOND)


def _window_range(start_s: Column, size_s: int, slide_s: int) -> tuple[Column, Column]:
    """Indices j (window = [j*slide, j*slide + size)) of the first and last
    window holding a pane that starts at ``start_s``."""
    return floor_div(start_s - size_s, slide_s) + 1, floor_div(start_s, slide_s)


def tumbling_count(df: DataFrame, ts: str, keys: Sequence[str], size_s: int,
                   count_name: str = "count") -> DataFrame:
    """Count rows per (tumbling window, keys)."""
    w = F.window(col_(ts), f"{size_s} seconds")
    return (df.groupBy(w.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias(count_name))
            .select(epoch_seconds(F.col("w.start")).alias("window_start"),
                    epoch_seconds(F.col("w.end")).alias("window_end"), *keys, count_name))


def sliding_count(df: DataFrame, ts: str, keys: Sequence[str], size_s: int, slide_s: int,
                  count_name: str = "count", first_window_index: Column | None = None) -> DataFrame:
    """Count rows per (sliding window, keys) with the pane rewrite.

    ``first_window_index`` optionally gives, per row, the index j (window
    start / slide) of the first window the row may still be counted in;
    windows before it are skipped (rows accepted after some windows closed).
    Returns ``window_start, window_end, *keys, count`` for every window
    holding at least one counted row.
    """
    _, k = _grid(size_s, slide_s)
    panes = pane_ranges(df, ts, keys, size_s, slide_s, first_window_index)
    return _fan_out(panes, keys, k, slide_s, size_s, count_name)


def pane_ranges(df: DataFrame, ts: str, keys: Sequence[str], size_s: int, slide_s: int,
                first_window_index: Column | None = None) -> DataFrame:
    """Rows counted by (keys, first window, last window), one row per pane by partial
    aggregation: (keys, _f, _l, _n)."""
    width, _ = _grid(size_s, slide_s)
    start = pane_index(ts, width) * width
    first, last = _window_range(start, size_s, slide_s)
    if first_window_index is not None:
        first = F.greatest(first, first_window_index)
    return (df.select(*keys, first.alias("_f"), last.alias("_l"))
            .filter(F.col("_f") <= F.col("_l"))
            .groupBy(*keys, "_f", "_l").agg(F.count(F.lit(1)).alias("_n")))


def sliding_from_panes(panes: DataFrame, keys: Sequence[str], pane_start: str, pane_count: str,
                       size_s: int, slide_s: int, count_name: str = "count") -> DataFrame:
    """Roll pre-counted panes (``pane_start`` epoch seconds; pane width must
    divide gcd(size, slide)) up into sliding windows, e.g. panes streamed
    to a table."""
    _, k = _grid(size_s, slide_s)
    first, last = _window_range(F.col(pane_start).cast("long"), size_s, slide_s)
    staged = (panes.select(*keys, first.alias("_f"), last.alias("_l"), F.col(pane_count).alias("_n"))
              .groupBy(*keys, "_f", "_l").agg(F.sum("_n").alias("_n")))
    return _fan_out(staged, keys, k, slide_s, size_s, count_name)


def _fan_out(panes: DataFrame, keys: Sequence[str], k: int, slide_s: int, size_s: int,
             count_name: str) -> DataFrame:
    """panes(keys, _f, _l, _n) -> per-window sums of _n over window indices
    _f.._l (at most k of them; window j = [j*slide, j*slide + size)).

    Windows are grouped in blocks of k consecutive indices; a pane feeds at
    most two blocks, so pane rows are co-located by (keys, block) with one
    repartition and everything after it runs without another exchange.
    Inside a block the count of window j is a running sum of a difference
    array (+n at a pane's first window, -n after its last), so work
    is one row per pane plus one row per non-empty window - never k rows
    per pane - and a hot key is spread over its blocks.
    """
    staged = into_blocks(panes, k).repartition(*keys, "_b")
    return counts_of_deltas(block_deltas(staged, keys, k), keys, slide_s, size_s, count_name)


def into_blocks(panes: DataFrame, k: int) -> DataFrame:
    """One row per block of k windows that a pane feeds (column ``_b``)."""
    blocks = F.array_distinct(F.array(floor_div(F.col("_f"), k), floor_div(F.col("_l"), k)))
    return panes.withColumn("_b", F.explode(blocks))


def block_deltas(staged: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Panes in blocks -> difference array (keys, _b, pos, d): the count of window j of a block is
    the sum of d over the block's positions up to j."""
    lo = F.greatest(F.col("_f"), F.col("_b") * k)
    hi = F.least(F.col("_l"), F.col("_b") * k + (k - 1))
    steps = F.array(F.struct(lo.alias("pos"), F.col("_n").alias("d")),
                    F.struct((hi + 1).alias("pos"), (-F.col("_n")).alias("d")))
    return (staged.filter(lo <= hi)
            .select(*keys, "_b", F.explode(steps).alias("x"))
            .groupBy(*keys, "_b", F.col("x.pos").alias("pos")).agg(F.sum("x.d").alias("d")))


def counts_of_deltas(deltas: DataFrame, keys: Sequence[str], slide_s: int, size_s: int,
                     count_name: str) -> DataFrame:
    """Difference arrays -> one row per non-empty window and key."""
    w = Window.partitionBy(*keys, "_b").orderBy("pos")
    runs = deltas.select(*keys, "_b", "pos", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))
                         .alias("_c"), F.lead("pos").over(w).alias("_next"))
    # every +n is matched by a later -n inside the block: a positive run has a next step
    ends = (runs.filter(F.col("_c") > 0)
            .select(*keys, "_c", F.explode(F.sequence(F.col("pos"), F.col("_next") - 1)).alias("_e")))
    return ends.select((F.col("_e") * slide_s).alias("window_start"),
                       (F.col("_e") * slide_s + size_s).alias("window_end"),
                       *keys, F.col("_c").cast("long").alias(count_name))


def sliding_count_direct(df: DataFrame, ts: str, keys: Sequence[str], size_s: int, slide_s: int,
                         count_name: str = "count") -> DataFrame:
    """Same result through the built-in ``window(ts, size, slide)`` (an
    ``Expand`` of size/slide copies of every row); kept as the reference
    form for tests and for small fan-outs."""
    w = F.window(col_(ts), f"{size_s} seconds", f"{slide_s} seconds")
    return (df.groupBy(w.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias(count_name))
            .select(epoch_seconds(F.col("w.start")).alias("window_start"),
                    epoch_seconds(F.col("w.end")).alias("window_end"), *keys, count_name))


def last_window_end_micros(ts, size_s: int, slide_s: int) -> Column:
    """End (epoch micros) of the last sliding window containing ``ts``."""
    slide_us = slide_s * MICROS_PER_SECOND
    return floor_div(epoch_micros(ts), slide_us) * slide_us + size_s * MICROS_PER_SECOND

"""Sliding windows on a stream as a store of difference arrays.

Each micro-batch is routed once (``late.judge``): late rows go to their own output, an accepted row
counts in the windows still open for it. The accepted rows become signed deltas - plus n at the first
window of a pane, minus n after its last - in blocks of ``size / slide`` windows, so a row costs
two to four deltas whatever the slide (1 h / 5 s would expand it 720 times), and a refinement by a late
but accepted row is an addition to the store and not a recount.

After the deltas, the folders whose windows the batch touched or fired are read back (a pruned range)
and their windows published: those whose end the watermark has passed, or with ``early`` all of them. A
published folder replaces its earlier form. A folder holds whole blocks, about ``folder_s`` seconds of
windows: what a micro-batch reads and rewrites at least, so it should be near the time that stays open.

Layout under ``root``, all idempotent by ``batch_id`` so that a replayed micro-batch rewrites its own:

    state/max_ts/batch_id=N     greatest event time so far
    deltas/part=P/batch_id=N    difference arrays
    out/part=P                  published windows
    late/batch_id=N             late rows

Folders whose last window is past its lateness get no more rows; their deltas are deleted one batch
later, so the store holds open windows only. The driver handles a few numbers a batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import MICROS_PER_SECOND, epoch_micros, floor_div
from ..operators.late import FIRE_DELAY_US, first_open_window
from ..operators.windows import _grid, block_deltas, counts_of_deltas, into_blocks, pane_ranges
from . import late as routing
from .sinks import path_exists, write_batch


def overwrite_partitions(df: DataFrame, root: str, *by: str) -> None:
    """Replace only the partitions that ``df`` holds; the setting is this write's own."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(root))


def drop_below(spark: SparkSession, root: str, column: str, limit: int) -> None:
    """Delete the folders ``column=v`` of ``root`` with v below ``limit``."""
    if not path_exists(spark, root):
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        name, _, value = status.getPath().getName().partition("=")
        if name == column and int(value) < limit:
            fs.delete(status.getPath(), True)


def window_writer(root: str, keys: Sequence[str], size_s: int, slide_s: int, bound_s: float = 0,
                  lateness_s: float = 0, count_name: str = "count", keep: Column | None = None,
                  arrival: Sequence[str] | None = None, early: bool = False,
                  publish: Callable[[DataFrame], DataFrame] | None = None,
                  late: Callable[[DataFrame, int], None] | None = None,
                  accepted: Callable[[DataFrame, int], None] | None = None,
                  out: str | None = None, folder_s: int = 3600) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps sliding window counts of a stream with a column ``ts``.

    ``keep``: rows that count (all rows advance the watermark); null keys are keys of their own.
    ``arrival``: columns that order the rows of a micro-batch, see ``late``. ``publish`` turns window
    counts (window_start, window_end, keys, count) of whole windows into what is stored, e.g. a top-n.
    ``late`` and ``accepted`` get those rows (by default late rows go to ``root/late``)."""
    keys = list(keys)
    _, k = _grid(size_s, slide_s)
    per = max(1, folder_s // (k * slide_s))  # blocks of a folder
    out = out or os.path.join(root, "out")
    state, deltas_root = os.path.join(root, "state"), os.path.join(root, "deltas")
    late = late or write_batch(os.path.join(root, "late"))
    bound_us, lateness_us = int(bound_s * MICROS_PER_SECOND), int(lateness_s * MICROS_PER_SECOND)
    size_us, slide_us = size_s * MICROS_PER_SECOND, slide_s * MICROS_PER_SECOND

    def past(max_us: int | None, delay_us: int = 0) -> int | None:
        """Last window that ends (delay_us later) at or before the watermark."""
        return None if max_us is None else (max_us - bound_us - delay_us + FIRE_DELAY_US - size_us) // slide_us

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = routing.carried(spark, state, batch_id)
        df = df.persist()
        routed = routing.judge(df, before, size_s, slide_s, bound_s, lateness_s, arrival)
        kept = (routed if keep is None else routed.filter(keep)).persist()
        try:
            on_time = kept.filter(~F.col("is_late"))
            late(kept.filter(F.col("is_late")).drop("is_late"), batch_id)
            if accepted:
                accepted(on_time.drop("is_late"), batch_id)
            panes = pane_ranges(on_time, "ts", keys, size_s, slide_s, first_open_window(size_s, slide_s, lateness_s)).persist()
            deltas = block_deltas(into_blocks(panes, k), keys, k)
            stored = deltas.select(*keys, "pos", "d", F.col("_b").alias("block"), floor_div(F.col("_b"), per).alias("part"), F.lit(batch_id).alias("batch_id"))
            overwrite_partitions(stored.hint("rebalance", F.col("part")), deltas_root, "part", "batch_id")
            now = routing.carry(spark, state, batch_id, before, df.agg(F.max(epoch_micros("ts"))).first()[0])
            ranges = panes.agg(F.min("_f"), F.max("_l")).first()
            low = [x // (k * per) for x in (ranges[0], None if past(before) is None else past(before) + 1) if x is not None]
            high = [x // (k * per) for x in (ranges[1] if early else None, past(now)) if x is not None]
            if high and path_exists(spark, deltas_root):
                held = spark.read.schema(stored.schema).parquet(deltas_root)
                _publish(held, min(low) if low else None, max(high), past(now))
            if past(before, lateness_us) is not None:
                drop_below(spark, deltas_root, "part", (past(before, lateness_us) + 1) // (k * per))
            panes.unpersist()
        finally:
            kept.unpersist()
            df.unpersist()

    def _publish(held: DataFrame, low: int | None, high: int, fired: int | None) -> None:
        held = held.filter(F.col("part") <= high)
        if low is not None:
            held = held.filter(F.col("part") >= low)
        summed = held.groupBy(*keys, F.col("block").alias("_b"), "pos").agg(F.sum("d").alias("d"))
        counts = counts_of_deltas(summed, keys, slide_s, size_s, count_name)
        if not early:
            counts = counts.filter(F.col("window_start") <= fired * slide_s)
        if publish:
            counts = publish(counts)
        part = floor_div(F.col("window_start"), slide_s * k * per)
        overwrite_partitions(counts.withColumn("part", part).hint("rebalance", F.col("part")), out, "part")

    return run

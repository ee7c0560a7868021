"""Late-row routing on a stream (``foreachBatch``).

Spark drops rows behind the watermark silently; the reference keeps them
as a side output. Here a row is judged against the greatest event time
before it. What earlier micro-batches hold of that is one number, stored per
``batch_id`` under the stream's folder, so a replayed batch sees the
same watermark again. Inside a micro-batch rows follow their ``arrival``
columns (a line number, an offset): the prefix maximum of
``operators.late.route_late``, so the stream judges each row as the batch
router does, however it is cut. Without an arrival column a whole
micro-batch is judged by the batches before it. Accepted rows (with the
index of the first window still open for them) and late rows go to two
writers (accepted rows carry ``first_open_start``, the start of the first
window still open for them); ``operators.late.accepted_window_counts``
rolls the accepted output up.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import MICROS_PER_SECOND, epoch_micros
from ..operators.late import FIRE_DELAY_US, first_open_window, route_late
from ..operators.windows import last_window_end_micros
from .sinks import path_exists


def _state_path(state_dir: str, batch_id: int) -> str:
    return os.path.join(state_dir, f"max_ts/batch_id={batch_id}")


def carried(spark, state_dir: str, batch_id: int) -> int | None:
    """Greatest event time of the batches before ``batch_id``; None if they held no row.

    A later batch without the state of the one before it is an error: the folder belongs to
    another run of the stream, and every row would pass as on time."""
    if batch_id == 0:
        return None
    path = _state_path(state_dir, batch_id - 1)
    if not path_exists(spark, path):
        raise RuntimeError(f"no state of batch {batch_id - 1} in {state_dir}")
    return spark.read.parquet(path).first()["max_us"]


def carry(spark, state_dir: str, batch_id: int, before: int | None, own: int | None) -> int | None:
    """Store the greatest event time up to and with ``batch_id``, and return it."""
    seen = [v for v in (before, own) if v is not None]
    total = max(seen) if seen else None
    (spark.createDataFrame([(total,)], "max_us long").coalesce(1).write.mode("overwrite")
     .parquet(_state_path(state_dir, batch_id)))
    return total


def judge(df: DataFrame, before: int | None, size_s: int, slide_s: int, bound_s: float,
          lateness_s: float, arrival: Sequence[str] | None = None) -> DataFrame:
    """A micro-batch with ``watermark_us`` and ``is_late``; ``before`` is what ``carried`` gives."""
    if arrival:
        return route_late(df, size_s, slide_s, bound_s, lateness_s, arrival, carry_us=before)
    wm = F.lit(None if before is None else before - int(bound_s * MICROS_PER_SECOND)).cast("long")
    past = (last_window_end_micros("ts", size_s, slide_s) - FIRE_DELAY_US
            + int(lateness_s * MICROS_PER_SECOND)) <= wm
    return df.withColumn("watermark_us", wm).withColumn("is_late", F.coalesce(past, F.lit(False)))


def route_late_batches(state_dir: str, size_s: int, slide_s: int, bound_s: float,
                       lateness_s: float, accepted: Callable[[DataFrame, int], None],
                       late: Callable[[DataFrame, int], None], keep: Column | None = None,
                       arrival: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """``keep`` filters the rows written to both outputs; every row of the
    batch still advances the watermark (as a filter placed after the
    watermark would)."""
    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = carried(spark, state_dir, batch_id)
        df = df.persist()
        x = judge(df, before, size_s, slide_s, bound_s, lateness_s, arrival).persist()
        try:
            first_open = first_open_window(size_s, slide_s, lateness_s) * slide_s
            kept = x if keep is None else x.filter(keep)
            accepted(kept.filter(~F.col("is_late")).drop("is_late")
                     .withColumn("first_open_start", first_open), batch_id)
            late(kept.filter(F.col("is_late")).drop("is_late"), batch_id)
            carry(spark, state_dir, batch_id, before, df.agg(F.max(epoch_micros("ts")).alias("m")).first()["m"])
        finally:
            x.unpersist()
            df.unpersist()
    return run

"""The un-keyed pattern on a stream, without one task for all rows.

Each micro-batch takes up the rows that earlier ones left pending and splits them at the watermark
(greatest event time so far less ``delay``): rows behind it are final, so their place in the global
order is known. They are matched by range partitions (``operators.global_order``) together with the last
final rows before them, and those to come stay pending. So matches of all batches are those of the batch
operator on all rows, but for rows that arrive behind the watermark: these go to a late output.

Layout under ``root``, by ``batch_id`` (a replayed batch rewrites its own): ``state``, ``pending``, ``last``
(the rows carried over), ``late`` and ``out``. What a batch needs of earlier ones is that of the batch before it;
older folders are deleted.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import MICROS_PER_SECOND, epoch_micros
from ..operators.global_order import match_in_order
from . import late as routing
from .sinks import write_batch
from .window_store import drop_below


def pattern_writer(root: str, predicates: Sequence[Column], within_s: float, delay_s: float = 0,
                   inclusive: bool = False,
                   publish: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over rows with ts and seq; matches (``match_in_order``'s rows, or what
    ``publish`` makes of them) go to ``root/out``."""
    k = len(predicates)
    folder = {name: os.path.join(root, name) for name in ("state", "pending", "last", "late", "out")}

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = routing.carried(spark, folder["state"], batch_id)
        delay_us = int(delay_s * MICROS_PER_SECOND)
        old = None if before is None else before - delay_us
        df = df.persist()
        try:
            us = epoch_micros("ts")
            behind = F.coalesce(us < F.lit(old).cast("long"), F.lit(False))
            write_batch(folder["late"])(df.filter(behind), batch_id)
            held = df.filter(~behind)
            last = held.limit(0)
            if batch_id:
                stored = spark.read.schema(df.schema)
                held = held.unionByName(stored.parquet(os.path.join(folder["pending"], f"batch_id={batch_id - 1}")))
                last = stored.parquet(os.path.join(folder["last"], f"batch_id={batch_id - 1}"))
            own = df.agg(F.max(us)).first()[0]
            now = max((x for x in (before, own) if x is not None), default=None)
            mark = F.lit(None if now is None else now - delay_us).cast("long")
            final = F.coalesce(us < mark, F.lit(False))
            write_batch(folder["pending"])(held.filter(~final), batch_id)
            ready = last.unionByName(held.filter(final))
            found = match_in_order(ready, predicates, int(round(within_s * MICROS_PER_SECOND)), inclusive)
            write_batch(folder["out"])(publish(found) if publish else found, batch_id)
            tail = ready.orderBy(F.desc("ts"), F.desc("seq")).limit(k - 1)
            write_batch(folder["last"])(tail, batch_id)
            routing.carry(spark, folder["state"], batch_id, before, own)
            for name in ("pending", "last"):
                drop_below(spark, folder[name], "batch_id", batch_id - 1)
        finally:
            df.unpersist()

    return run

"""The ad job as one stream: click cap per (user, ad, day), then clicks per province and sliding window.

Each micro-batch takes its clicks of a key and day in (ts, seq) order behind those of earlier batches:
the first max + 1 of a day pass, the next one warns, later ones are dropped. A key with a third of all
clicks stays small: ``row_number() <= max + 2`` has a partial limit before the shuffle, and earlier
batches are one count a key and day. Clicks that pass go on to the window store in the same batch, so
capped clicks, warnings and windows always agree; all clicks advance event time.

A day is open until the watermark (greatest event time less ``delay``) passes its end. Its counts are then
deleted and its clicks go to a late output, so input = passed + warned + dropped + late.

Layout under ``root``, by ``batch_id`` (a replayed batch rewrites its own): ``cap/state``, ``cap/counts/day=D``,
``pass``, ``warn``, ``late``, ``tally`` (clicks by kind), and the window store's ``state``, ``deltas``, ``out``.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CLICK_CAP_MESSAGE
from ..functions.time import MICROS_PER_SECOND, epoch_micros, floor_div
from . import late as routing
from .sinks import path_exists, write_batch
from .window_store import drop_below, overwrite_partitions, window_writer

DAY_S = 86_400
COUNT_FILES = 4  # of a day and batch


def click_cap_writer(root: str, max_clicks: int = 100, keys: Sequence[str] = ("user_id", "ad_id"),
                     region: str = "province", size_s: int = 3600, slide_s: int = 5, bound_s: float = 0,
                     delay_s: float = DAY_S, day_offset_s: int = 0, **windows) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over clicks (keys, region, ts, seq). Days are UTC days moved by
    ``day_offset_s`` (8 hours east: -28,800)."""
    keys = list(keys)
    folder = {n: os.path.join(root, *n.split("/")) for n in ("cap/state", "cap/counts", "pass", "warn", "late", "tally")}
    count_windows = window_writer(root, [region], size_s, slide_s, bound_s, keep=F.col("kind") == "pass",
                                  late=write_batch(os.path.join(root, "late_windows")), **windows)
    day_us, offset_us = DAY_S * MICROS_PER_SECOND, day_offset_s * MICROS_PER_SECOND

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = routing.carried(spark, folder["cap/state"], batch_id)
        mark = None if before is None else before - int(delay_s * MICROS_PER_SECOND)
        closed = None if mark is None else (mark - offset_us) // day_us  # first day still open
        df = df.withColumn("day", floor_div(epoch_micros("ts") - offset_us, day_us)).persist()
        try:
            over = F.coalesce(F.col("day") < F.lit(closed).cast("long"), F.lit(False))
            write_batch(folder["late"])(df.filter(over).drop("day"), batch_id)
            rows = df.filter(~over)
            order = Window.partitionBy(*keys, "day").orderBy("ts", "seq")
            few = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max_clicks + 2)
            new = rows.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("n"))
            counts = new.withColumn("batch_id", F.lit(batch_id))
            if path_exists(spark, folder["cap/counts"]):
                held = (spark.read.schema(counts.schema).parquet(folder["cap/counts"]).filter(F.col("batch_id") < batch_id)
                        .groupBy(*keys, "day").agg(F.sum("n").alias("n")))
                names = [*keys, "day"]
                held = held.select(*(F.col(c).alias(f"_{c}") for c in names), F.col("n").alias("_n"))
                same = F.lit(True)
                for c in names:
                    same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
                few = few.join(held, same, "left").withColumn("place", F.col("place") + F.coalesce("_n", F.lit(0))).select(*df.columns, "place")
            few = few.filter(F.col("place") <= max_clicks + 2).persist()
            passed = few.filter(F.col("place") <= max_clicks + 1).drop("place", "day")
            warned = few.filter(F.col("place") == max_clicks + 2).select(*keys, "ts", "seq", F.lit(CLICK_CAP_MESSAGE.format(max=max_clicks)).alias("msg"))
            write_batch(folder["pass"])(passed, batch_id)
            write_batch(folder["warn"])(warned, batch_id)
            by_place = few.agg(F.count_if(F.col("place") <= max_clicks + 1), F.count_if(F.col("place") == max_clicks + 2)).first()
            total, late, newest = df.agg(F.count(F.lit(1)), F.count_if(over), F.max(epoch_micros("ts"))).first()
            tally = [("pass", by_place[0]), ("warn", by_place[1]), ("late", late), ("dropped", total - late - by_place[0] - by_place[1])]
            write_batch(folder["tally"])(spark.createDataFrame(tally, "kind string, n long").coalesce(1), batch_id)
            now = spark.createDataFrame([(newest,)], "us long").filter("us is not null")
            clock = now.select(F.timestamp_micros("us").alias("ts"), F.lit("clock").alias("kind"))
            count_windows(passed.withColumn("kind", F.lit("pass")).unionByName(clock, allowMissingColumns=True), batch_id)
            overwrite_partitions(counts.repartition("day", F.pmod(F.xxhash64(*keys), F.lit(COUNT_FILES))), folder["cap/counts"], "day", "batch_id")
            routing.carry(spark, folder["cap/state"], batch_id, before, newest)
            if closed is not None:
                drop_below(spark, folder["cap/counts"], "day", closed)
            few.unpersist()
        finally:
            df.unpersist()

    return run

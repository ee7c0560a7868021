"""Orders against payments and payments against receipts on streams.

* ``payment_timeouts_stream`` - keyed state per order and an event-time timer that fires on absence: an order
  is reported as timed out when the watermark passes its bound and no payment has come.
* ``reconcile_stream`` - stream-stream full outer join with a time range: rows wait in the join's
  state until the watermark passes the range, then leave as unmatched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.reconcile import NO_CREATE, PAID, TIMEOUT, status

OUTCOME = "order_id long, created_us long, paid_us long, status string"


class PaymentTimeoutProcessor(StatefulProcessor):
    """First creation and first payment of an order; reported once, when they are ``within`` of each other
    or when the watermark passes the bound of the first of them. The state goes with the timer."""

    def __init__(self, within_s: float):
        self.within_us = int(within_s * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "created long, paid long, told boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        created, paid, told = self.seen.get() if self.seen.exists() else (None, None, False)
        fresh = created is None and paid is None
        times = new.groupby("is_pay")["us"].min()
        created = min((int(x) for x in (created, times.get(False)) if x is not None), default=None)
        paid = min((int(x) for x in (paid, times.get(True)) if x is not None), default=None)
        if fresh:
            self.handle.registerTimer((min(x for x in (created, paid) if x is not None) + self.within_us) // 1000 + 1)
        if not told and created is not None and paid is not None and abs(paid - created) <= self.within_us:
            told = True
            yield self._row(key, created, paid, PAID)
        self.seen.update((created, paid, told))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        created, paid, told = self.seen.get()
        self.seen.clear()
        if not told:
            yield self._row(key, created, paid, NO_CREATE if created is None else TIMEOUT)

    def _row(self, key, created, paid, what) -> pd.DataFrame:
        out = pd.DataFrame({"order_id": [key[0]], "created_us": [created], "paid_us": [paid], "status": [what]})
        return out.astype({"created_us": "Int64", "paid_us": "Int64"})

    def close(self) -> None:
        pass


def payment_timeouts_stream(orders: DataFrame, within_s: float = 900, delay: str = "3 seconds",
                            create: str = "create", pay: str = "pay") -> DataFrame:
    """Streaming ``payment_timeouts``; a payment that comes after its order was reported as timed out
    is an order of its own (``no_create``)."""
    src = (orders.withWatermark("ts", delay)
           .select("order_id", "ts", F.unix_micros("ts").alias("us"), "event")
           .filter(F.col("event").isin(create, pay) | (F.unix_micros("ts") == F.lit(-(1 << 63))))
           .select("order_id", "ts", "us", (F.col("event") == pay).alias("is_pay")))
    return src.groupBy("order_id").transformWithStateInPandas(
        PaymentTimeoutProcessor(within_s), OUTCOME, "append", "EventTime")


def reconcile_stream(payments: DataFrame, receipts: DataFrame, within_s: int, delay: str = "3 seconds") -> DataFrame:
    """Streaming ``reconcile``: both sides with (tx_id, ts), pairs at most ``within_s`` apart. Rows
    without a transaction id only advance the watermark."""
    p = payments.select(F.col("tx_id").alias("p_tx"), F.col("ts").alias("p_ts")).withWatermark("p_ts", delay)
    r = receipts.select(F.col("tx_id").alias("r_tx"), F.col("ts").alias("r_ts")).withWatermark("r_ts", delay)
    near = F.expr(f"r_ts >= p_ts - interval {int(within_s)} seconds AND r_ts <= p_ts + interval {int(within_s)} seconds")
    joined = p.join(r, (F.col("p_tx") == F.col("r_tx")) & near, "full_outer")
    return (joined.filter("p_tx is not null or r_tx is not null")
            .select(F.coalesce("p_tx", "r_tx").alias("tx_id"), F.unix_micros("p_ts").alias("pay_us"),
                    F.unix_micros("r_ts").alias("receipt_us"))
            .select("*", status()))

"""Orders against payments, payments against receipts (batch forms; streams: ``streaming.reconcile``).

* ``payment_timeouts`` - what became of each order: paid within the bound, not paid in time, or paid
  without having been created. A conditional aggregation, partial before the shuffle.
* ``reconcile`` - full outer join of payments and receipts by transaction, optionally within a time
  range. Rows without a transaction id match nothing; they skip the join, whose one
  partition for nulls they would all fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import MICROS_PER_SECOND, epoch_micros

PAID, TIMEOUT, NO_CREATE = "paid", "timeout", "no_create"
MATCHED, PAYMENT_ONLY, RECEIPT_ONLY = "matched", "payment_only", "receipt_only"


def payment_timeouts(orders: DataFrame, within_s: float = 900, create: str = "create", pay: str = "pay") -> DataFrame:
    """orders (order_id, event, ts) -> one row an order with a create or pay event:
    order_id, created_us, paid_us, status. The first event of each kind counts; a payment more than
    ``within_s`` away from the creation is as good as none."""
    us = epoch_micros("ts")
    firsts = (orders.filter(F.col("event").isin(create, pay)).groupBy("order_id")
              .agg(F.min(F.when(F.col("event") == create, us)).alias("created_us"),
                   F.min(F.when(F.col("event") == pay, us)).alias("paid_us")))
    in_time = F.abs(F.col("paid_us") - F.col("created_us")) <= int(within_s * MICROS_PER_SECOND)
    return firsts.withColumn("status", F.when(F.col("created_us").isNull(), NO_CREATE)
                             .when(F.coalesce(in_time, F.lit(False)), PAID).otherwise(TIMEOUT))


def reconcile(payments: DataFrame, receipts: DataFrame, within_s: float | None = None) -> DataFrame:
    """payments (tx_id, ts), receipts (tx_id, ts) -> tx_id, pay_us, receipt_us, status: a row for each
    pair of one transaction (at most ``within_s`` apart), and one for each row without partner."""
    p = payments.select(F.col("tx_id").alias("p_tx"), epoch_micros("ts").alias("pay_us"))
    r = receipts.select(F.col("tx_id").alias("r_tx"), epoch_micros("ts").alias("receipt_us"))
    same = F.col("p_tx") == F.col("r_tx")
    if within_s is not None:
        same = same & (F.abs(F.col("pay_us") - F.col("receipt_us")) <= int(within_s * MICROS_PER_SECOND))
    joined = p.filter("p_tx is not null").join(r.filter("r_tx is not null"), same, "full_outer")
    for side, lone in ((p, "p_tx is null"), (r, "r_tx is null")):
        joined = joined.unionByName(side.filter(lone), allowMissingColumns=True)
    return joined.select(F.coalesce("p_tx", "r_tx").alias("tx_id"), "pay_us", "receipt_us", status())


def status():
    return (F.when(F.col("pay_us").isNull(), RECEIPT_ONLY).when(F.col("receipt_us").isNull(), PAYMENT_ONLY)
            .otherwise(MATCHED).alias("status"))

"""Order timeouts and reconciliation: values of the sample files, batch = stream."""

import os

from pyspark.sql import functions as F

from helpers import fixture
from tidemark import schemas
from tidemark.operators import reconcile
from tidemark.sources.text import read_delimited, read_delimited_stream
from tidemark.streaming import reconcile as streams
from tidemark.streaming import sinks

FAR = 4_000_000_000


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def read(spark):
    return (read_delimited(spark, fixture("order_events.csv"), schemas.ORDER_EVENT),
            read_delimited(spark, fixture("receipts.csv"), schemas.RECEIPT))


def test_timeouts_of_the_sample(spark):
    orders, _ = read(spark)
    got = reconcile.payment_timeouts(orders, 900)
    by = {s: sorted(r["order_id"] for r in got.filter(F.col("status") == s).collect()) for s in (reconcile.PAID, reconcile.TIMEOUT, reconcile.NO_CREATE)}
    assert by["timeout"] == [34756, 34767] and by["no_create"] == [34768] and len(by["paid"]) == 37


def test_reconciliation_of_the_sample(spark):
    orders, receipts = read(spark)
    payments = orders.filter("event = 'pay'")
    got = reconcile.reconcile(payments, receipts)
    by = {s: sorted(r["tx_id"] for r in got.filter(F.col("status") == s).collect()) for s in (reconcile.MATCHED, reconcile.PAYMENT_ONLY, reconcile.RECEIPT_ONLY)}
    assert len(by["matched"]) == 38 and by["payment_only"] == ["35jue34we", "88snrn932"] and by["receipt_only"] == ["8fdsfae83", "ewr342as4"]


def test_reconciliation_of_awkward_rows(spark):
    schema = "tx_id string, s long"
    p = spark.createDataFrame([("a", 0), ("a", 100), ("b", 0), (None, 0), (None, 1), ("c", 0)], schema).withColumn("ts", F.timestamp_seconds("s"))
    r = spark.createDataFrame([("a", 5), ("a", 5), ("b", 50), (None, 0), ("d", 0)], schema).withColumn("ts", F.timestamp_seconds("s"))
    got = [(x, a and a // 10**6, b and b // 10**6, s) for x, a, b, s in rows_of(reconcile.reconcile(p, r, 10).fillna(-10**6, ["pay_us", "receipt_us"]))]
    assert sorted(got, key=repr) == sorted([("a", 0, 5, "matched"), ("a", 0, 5, "matched"), ("a", 100, -1, "payment_only"), ("b", 0, -1, "payment_only"), ("b", -1, 50, "receipt_only"),
                                            ("c", 0, -1, "payment_only"), ("d", -1, 0, "receipt_only"), (None, 0, -1, "payment_only"), (None, 1, -1, "payment_only"), (None, -1, 0, "receipt_only")], key=repr)
    assert reconcile.reconcile(p.limit(0), r.limit(0)).count() == 0 and reconcile.payment_timeouts(spark.createDataFrame([], "order_id long, event string, ts timestamp")).count() == 0


def files(scratch, name, source, closing, size=15):
    """The sample in pieces, then closing lines."""
    folder = os.path.join(scratch, name)
    os.makedirs(folder)
    with open(fixture(source)) as f:
        lines = sorted((x.strip() for x in f if x.strip()), key=lambda x: int(x.split(",")[-1]))
    parts = [lines[i:i + size] for i in range(0, len(lines), size)] + closing
    for i, part in enumerate(parts):
        path = os.path.join(folder, f"{i:03d}.csv")
        with open(path, "w") as f:
            f.write("\n".join(part) + "\n")
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    return folder


def run(df, scratch, name):
    out = os.path.join(scratch, f"out-{name}")
    q = (df.writeStream.outputMode("append").foreachBatch(sinks.write_batch(out))
         .option("checkpointLocation", os.path.join(scratch, f"ck-{name}")).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.parquet(out).drop("batch_id")


def test_timeout_stream_equals_batch(spark, scratch):
    orders, _ = read(spark)
    closing = [[f"1,other,,{FAR}"], [f"2,other,,{FAR + 10**6}"]]
    stream = read_delimited_stream(spark, files(scratch, "orders", "order_events.csv", closing), schemas.ORDER_EVENT, max_files_per_trigger=1)
    got = run(streams.payment_timeouts_stream(stream, 900), scratch, "timeouts")
    told = {r["order_id"]: r["status"] for r in got.filter("status <> 'no_create'").collect()}
    assert told == {r["order_id"]: r["status"] for r in reconcile.payment_timeouts(orders, 900).collect() if r["status"] != "no_create"}
    alone = {r["order_id"] for r in got.filter("status = 'no_create'").collect()}
    assert 34768 in alone and alone <= {34768, 34756, 34767}  # a payment after its order timed out stands alone


def test_reconcile_stream_equals_batch(spark, scratch):
    orders, receipts = read(spark)
    far = [[f"0,close,,{FAR}"], [f"0,close,,{FAR + 10**6}"]]
    pay = read_delimited_stream(spark, files(scratch, "orders", "order_events.csv", far), schemas.ORDER_EVENT, max_files_per_trigger=1)
    pay = pay.filter("event <> 'create'")
    got_in = read_delimited_stream(spark, files(scratch, "receipts", "receipts.csv", [[f",close,{FAR}"], [f",close,{FAR + 10**6}"]], 8), schemas.RECEIPT, max_files_per_trigger=1)
    got = run(streams.reconcile_stream(pay, got_in, 3600, "1 hour"), scratch, "reconcile")
    assert rows_of(got) == rows_of(reconcile.reconcile(orders.filter("event = 'pay'"), receipts, 3600))

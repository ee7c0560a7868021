"""Per-user login detectors on streams: rows cut anywhere give the batch result, and state ends with the watermark."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import detect
from tidemark.streaming import sinks, stateful

BASE, FAR = 1_600_000_000, 4_000_000_000


def history(seed, n=260):
    """Logins of a hot user, some others and nobody; dense ties, successes in between, a null state."""
    rng = random.Random(seed)
    at, rows = 0, []
    for i in range(n):
        at += rng.choice([0, 0, 1, 1, 2, 6])
        user = rng.choice([1, 1, 1, 2, 3, None])
        rows.append((user, rng.choice(["fail", "fail", "fail", "success", None]), BASE + at, i))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "user_id long, state string, s long, seq long")
    return df.select("user_id", "state", F.timestamp_seconds("s").alias("ts"), "seq")


def run_stream(spark, folder, make, cuts):
    """Result rows and the number of state rows after the last micro-batch."""
    src, out = os.path.join(folder, "in"), os.path.join(folder, "out")
    for rows in cuts:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("user_id long, state string, ts timestamp, seq long").parquet(src)
        q = (make(stream).writeStream.foreachBatch(sinks.write_batch(out)).outputMode("append")
             .option("checkpointLocation", os.path.join(folder, "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
    progress = [p for p in q.recentProgress if p["stateOperators"]]
    return spark.read.parquet(out), progress[-1]["stateOperators"][0]["numRowsTotal"]


DETECTORS = {
    "pair": (lambda d: stateful.fail_pairs_stream(d, 2, delay="8 seconds"), lambda d: detect.fail_pairs(d, 2)),
    "sequence": (lambda d: stateful.fail_sequences_stream(d, 2, delay="8 seconds"), lambda d: detect.fail_sequences(d, 2)),
    "burst": (lambda d: stateful.fail_bursts_stream(d, 3, 2, "8 seconds"), lambda d: detect.fail_bursts(d, 3, 2)),
}


@pytest.mark.parametrize("kind", sorted(DETECTORS))
def test_any_cut_gives_the_batch_result_and_no_state_stays(spark, scratch, kind):
    rows = history(5)
    as_stream, as_batch = DETECTORS[kind]
    order = sorted(rows, key=lambda r: r[2] + random.Random(r[3]).randrange(6))  # out of order, within the delay
    cuts = [order[:90], order[90:100], order[100:]]
    got, left = run_stream(spark, scratch, as_stream, [*cuts, [(0, "success", FAR, 1000)], [(0, "success", FAR + 100, 1001)]])
    cols = ["user_id", "first_fail_us", "last_fail_us", "fail_count"]
    exp = as_batch(frame(spark, rows)).select(
        "user_id", F.unix_micros("first_fail_ts").alias("first_fail_us"), F.unix_micros("last_fail_ts").alias("last_fail_us"),
        "fail_count" if kind == "burst" else F.lit(2).alias("fail_count"))
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)
    assert exp.count() > 10
    # the closing row alone: one slot, its timer and the timer's index entry
    assert left <= 3


@pytest.mark.parametrize("kind", sorted(DETECTORS))
def test_users_who_stay_away_leave_no_state(spark, scratch, kind):
    """State after the last watermark does not depend on how many users there were."""
    rows = [(u, "fail", BASE + u % 5, u) for u in range(1, 60)]
    _, left = run_stream(spark, scratch, DETECTORS[kind][0],
                         [rows, [(1, "fail", BASE, 900), (1, "fail", BASE + 1, 901), (0, "success", FAR, 1000)], [(0, "success", FAR + 100, 1001)]])
    assert left <= 3


@pytest.mark.parametrize("kind", sorted(DETECTORS))
def test_state_rows_follow_groups_of_users_not_users(spark, scratch, kind):
    """3,000 users of one micro-batch share the state of at most 256 groups: a slot, its timer and its index entry each."""
    rows = [(u, "fail", BASE + u % 2, u) for u in range(3000)]
    _, held = run_stream(spark, scratch, DETECTORS[kind][0], [rows])
    assert held <= 4 * 256

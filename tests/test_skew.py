"""A third of all rows on one key, or on no key at all: the detectors stay exact."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import SF_MID
from tidemark.operators import detect
from tidemark.sources import tables


def _skewed_logins(spark, hot=7):
    lg = tables.logins(tables.events(spark, SF_MID))
    return lg.withColumn("user_id", F.when(F.col("seq") % 3 == 0, F.lit(hot).cast("long")).otherwise(F.col("user_id")))


@pytest.mark.parametrize("hot", [7, None])
def test_pairs_exact_under_skew(spark, hot):
    lg = _skewed_logins(spark, hot)
    got = detect.fail_pairs(lg, 6 * 3600).select("user_id", "first_fail_ts", "last_fail_ts")
    w = Window.partitionBy("user_id").orderBy("ts", "seq")
    plain = (lg.select("user_id", "state", "ts", F.lag("state").over(w).alias("ps"),
                       F.lag("ts").over(w).alias("pt"))
             .filter((F.col("state") == "fail") & (F.col("ps") == "fail")
                     & (F.unix_micros("ts") - F.unix_micros("pt") <= 6 * 3600 * 10**6))
             .select("user_id", F.col("pt").alias("first_fail_ts"), F.col("ts").alias("last_fail_ts")))
    a = sorted((tuple(r) for r in got.collect()), key=repr)
    b = sorted((tuple(r) for r in plain.collect()), key=repr)
    assert a == b and any(r[0] == hot for r in a)


@pytest.mark.parametrize("hot", [7, None])
def test_bursts_exact_under_skew(spark, hot):
    lg = _skewed_logins(spark, hot)
    wide = sorted((tuple(r) for r in detect.fail_bursts(lg, 1200).collect()), key=repr)
    narrow = sorted((tuple(r) for r in detect.fail_bursts(lg, 1200, span=1).collect()), key=repr)
    assert wide == narrow and any(r[0] == hot for r in wide)


def test_a_run_without_end_is_spread(spark):
    """One user (or none) fails once a second without pause: no task holds more than its buckets."""
    n = 200_000
    df = spark.range(n).select(F.lit(None).cast("long").alias("user_id"), F.lit("fail").alias("state"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"))
    got = detect.fail_bursts(df, 2).agg(F.count("*"), F.sum("fail_count"), F.max("fail_count")).first()
    assert tuple(got) == (n // 3 + 1, n, 3) or tuple(got) == (n // 3, n - n % 3, 3)


def test_no_job_runs_while_a_detector_is_built(spark):
    lg = _skewed_logins(spark)
    spark.sparkContext.setJobGroup("built", "built")
    try:
        detect.fail_pairs(lg, 6 * 3600)
        detect.fail_sequences(lg, 6 * 3600)
        detect.fail_sequences(lg, 6 * 3600, keyed=False)
        detect.fail_bursts(lg, 6 * 3600)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("built")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

"""Properties: rewrites equal their direct forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import SF_SMALL, fixture
from tidemark import schemas
from tidemark.operators import aggregates, detect, windows
from tidemark.operators.ordered import number_bucket, time_bucket, with_neighbors
from tidemark.sources import tables
from tidemark.sources.text import read_delimited


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size,slide", [(3600, 300), (3600, 3600), (600, 10), (600, 180),
                                        (3600, 420), (100, 30)])
def test_pane_equals_direct_window(spark, size, slide):
    ev = tables.marketing(tables.events(spark, SF_SMALL))
    a = windows.sliding_count(ev, "ts", ["behavior"], size, slide, "n")
    b = windows.sliding_count_direct(ev, "ts", ["behavior"], size, slide, "n")
    assert _rows(a) == _rows(b)


def test_pane_equals_direct_fine_slide(spark):
    ck = read_delimited(spark, fixture("ad_clicks.csv"), schemas.AD_CLICK)
    a = windows.sliding_count(ck, "ts", ["province"], 3600, 5, "n")
    b = windows.sliding_count_direct(ck, "ts", ["province"], 3600, 5, "n")
    assert _rows(a) == _rows(b)


def test_bitmap_equals_exact_for_short_ids(spark):
    ev = tables.events(spark, SF_SMALL)
    a = aggregates.bitmap_distinct_count(ev, "ts", "user_id", 3600)
    b = aggregates.distinct_count(ev, "ts", "user_id", 3600)
    c = aggregates.distinct_count_chained(ev, "ts", "user_id", 3600)
    assert _rows(a) == _rows(b) == _rows(c)


def test_bitmap_of_colliding_ids_equals_a_set_of_offsets(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(3) * 3600, rnd.randrange(10 ** 11, 10 ** 12)) for _ in range(4000)] + [(9 * 3600, None), (0, None)]
    df = spark.createDataFrame(rows, "s long, user_id long").withColumn("ts", F.timestamp_seconds("s"))
    bits = 10  # 1,024 offsets: all windows dense, many ids on one offset
    expected = {}
    for s, user in rows:
        held = expected.setdefault(s, set())
        if user is not None:
            h = 0
            for ch in str(user):
                h = h * 61 + ord(ch)
            held.add(h % (1 << bits))
    got = {r.window_start: r.uv_count for r in aggregates.bitmap_distinct_count(df, "ts", "user_id", 3600, seed=61, bits=bits).collect()}
    assert got == {s: len(held) for s, held in expected.items()}
    assert got[9 * 3600] == 0 and got[0] > 500


def _random_history(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        user = 0 if rnd.random() < 0.4 else rnd.randrange(1, 30)   # one hot user
        ts = rnd.randrange(0, 20 * 3600)                             # seconds; many ties
        val = None if rnd.random() < 0.3 else rnd.randrange(100)
        data.append((user, ts, i, val))
    df = spark.createDataFrame(data, "user_id long, s long, seq long, v long")
    return df.withColumn("ts", F.timestamp_seconds("s"))


@pytest.mark.parametrize("bucket_seconds", [60, 600, 3600, 86400])
def test_with_neighbors_equals_plain_windows(spark, bucket_seconds):
    df = _random_history(spark)
    got = with_neighbors(df, ["user_id"], ["ts", "seq"], time_bucket("ts", bucket_seconds),
                         lag=["v", "seq"], lead=["v", "seq"], ffill=["v"], prior_max=["s"])
    w = Window.partitionBy("user_id").orderBy("ts", "seq")
    exp = df.select("user_id", "s", "seq", "v", "ts",
                    F.lag("v").over(w).alias("prev_v"), F.lag("seq").over(w).alias("prev_seq"),
                    F.lead("v").over(w).alias("next_v"), F.lead("seq").over(w).alias("next_seq"),
                    F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("ffill_v"),
                    F.max("s").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("pmax_s"))
    cols = ["user_id", "seq", "prev_v", "prev_seq", "next_v", "next_seq", "ffill_v", "pmax_s"]
    assert _rows(got.select(*cols)) == _rows(exp.select(*cols))


def test_with_neighbors_global_arrival(spark):
    df = _random_history(spark)
    got = with_neighbors(df, [], ["seq"], number_bucket("seq", 256), prior_max=["s"], lag=["user_id"])
    w = Window.orderBy("seq")
    exp = df.select("seq", F.lag("user_id").over(w).alias("prev_user_id"),
                    F.max("s").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("pmax_s"))
    assert _rows(got.select("seq", "prev_user_id", "pmax_s")) == _rows(exp)


def test_sequence_keyed_subset_of_pairs(spark):
    lg = tables.logins(tables.events(spark, SF_SMALL))
    pairs = {tuple(r) for r in detect.fail_pairs(lg, 86400).select("user_id", "last_fail_ts").collect()}
    seq = {tuple(r) for r in detect.fail_sequences(lg, 86400).select("user_id", "last_fail_ts").collect()}
    assert seq <= pairs and len(pairs) > 0


def test_click_cap_conserves_rows(spark):
    ev = tables.events(spark, SF_SMALL)
    clicks = ev.select("user_id", F.col("event_type").alias("ad_id"), "ts", F.col("event_id").alias("seq"))
    passed, warn = detect.click_cap(clicks, 0)
    n_pass, n_warn = passed.count(), warn.count()
    groups = clicks.groupBy("user_id", "ad_id", F.to_date("ts")).count()
    assert n_pass == groups.count()                       # max 0: one pass per group
    assert n_warn == groups.filter("count >= 2").count()  # and one warning where a second exists


def test_with_neighbors_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 2, 20), (5, 3, 30), (None, 90000, 40)],
                               "user_id long, s long, v long").withColumn("ts", F.timestamp_seconds("s")) \
        .withColumn("seq", F.col("s"))
    got = with_neighbors(df, ["user_id"], ["ts", "seq"], time_bucket("ts", 60), lag=["v"])
    rows = sorted((r.s, r.prev_v) for r in got.collect())
    assert rows == [(1, None), (2, 10), (3, None), (90000, 20)]


def test_with_neighbors_bfill_and_count(spark):
    df = _random_history(spark)
    got = with_neighbors(df, ["user_id"], ["ts", "seq"], time_bucket("ts", 600), bfill=["v"],
                         prior_count="rank")
    w = Window.partitionBy("user_id").orderBy("ts", "seq")
    exp = df.select("user_id", "seq",
                    F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("bfill_v"),
                    (F.row_number().over(w) - 1).cast("long").alias("rank"))
    assert _rows(got.select("user_id", "seq", "bfill_v", "rank")) == _rows(exp)


@pytest.mark.parametrize("hot", [0, None])
def test_hot_key_is_spread(spark, hot):
    """One user (or the rows without one) with 40% of the rows is spread over many partitions, with
    the neighbour column kept in the plan; a per-user window would hold all of them in one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _random_history(spark, n=6000)
        df = df.withColumn("user_id", F.when(F.col("user_id") != 0, F.col("user_id")).otherwise(F.lit(hot).cast("long")))
        got = with_neighbors(df, ["user_id"], ["ts", "seq"], time_bucket("ts", 60), lag=["v", "seq"])
        rows = got.where(F.col("user_id").eqNullSafe(F.lit(hot).cast("long")))
        parts = (rows.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count("*").alias("n"), F.count("prev_seq").alias("with_prev")).collect())
        total = sum(r["n"] for r in parts)
        assert len(parts) >= 6 and max(r["n"] for r in parts) < 0.3 * total
        assert sum(r["with_prev"] for r in parts) == total - 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sliding_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _random_history(spark, n=6000)
        out = windows.sliding_count(df, "ts", ["user_id"], 3600, 300, "n").filter("user_id = 0")
        parts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) >= 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_with_neighbors_two_keys_split(spark):
    df = _random_history(spark).withColumn("g", (F.col("seq") % 2).cast("int"))
    got = with_neighbors(df, ["user_id", "g"], ["ts", "seq"], time_bucket("ts", 600), lag=["v"])
    w = Window.partitionBy("user_id", "g").orderBy("ts", "seq")
    exp = df.select("seq", F.lag("v").over(w).alias("prev_v"))
    assert _rows(got.select("seq", "prev_v")) == _rows(exp)


def test_sliding_with_gaps_brute_force(spark):
    """slide > size (windows with gaps between them), against brute force."""
    secs = [0, 5, 299, 300, 301, 599, 600, 650, 1234, 1799, 1800]
    df = spark.createDataFrame([(s,) for s in secs], "s long").select(F.timestamp_seconds("s").alias("ts"))
    got = sorted((r.window_start, r.window_end, r.n)
                 for r in windows.sliding_count(df, "ts", [], 300, 600, "n").collect())
    exp = {}
    for s in secs:
        for j in range(-5, 10):
            if j * 600 <= s < j * 600 + 300:
                exp[(j * 600, j * 600 + 300)] = exp.get((j * 600, j * 600 + 300), 0) + 1
    assert got == sorted((a, b, n) for (a, b), n in exp.items())

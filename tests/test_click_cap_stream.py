"""The ad job as one stream: cap and province windows agree with the batch job however clicks are cut."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import fixture
from tidemark import schemas
from tidemark.operators import detect
from tidemark.plans import jobs as bjobs
from tidemark.sources.text import read_delimited
from tidemark.streaming import jobs as sjobs
from tidemark.streaming.click_cap import click_cap_writer

DAY = 86_400


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_ad_job_as_one_query(spark, scratch):
    clicks = read_delimited(spark, fixture("ad_clicks.csv"), schemas.AD_CLICK).cache()
    source, root = os.path.join(scratch, "clicks"), os.path.join(scratch, "ads")
    lines = clicks.orderBy("seq").collect()
    far = spark.createDataFrame(lines[:1], clicks.schema).withColumn("ts", F.timestamp_seconds(F.lit(4_000_000_000)))
    name = f"t_ads_{os.path.basename(scratch)}"
    for part in (lines[:70], lines[70:110], lines[110:], far):
        df = part if not isinstance(part, list) else spark.createDataFrame(part, clicks.schema)
        df.coalesce(1).write.mode("append").parquet(source)
        q = sjobs.ad_click_windows_query(spark.readStream.schema(clicks.schema).parquet(source), root, name=name, trigger={"availableNow": True}, bound_s=100)
        q.awaitTermination()
    passed = spark.read.parquet(f"{root}/pass").filter("ts < timestamp'2050-01-01'")
    warned = spark.read.parquet(f"{root}/warn").collect()
    assert passed.count() == 123 and [(r.user_id, r.ad_id, int(r.ts.timestamp())) for r in warned] == [(937166, 1715, 1511661702)]
    counts, _ = bjobs.ad_counts_by_province(clicks)
    out = spark.read.parquet(f"{root}/out").filter("window_start < 3000000000")
    assert out.count() == 5988 and rows_of(out, "window_end", "province", "count") == rows_of(counts, "window_end", "province", "count")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_gives_the_batch_result(spark, scratch, seed):
    rng = random.Random(seed)
    rows, at = [], 3 * DAY - 2000
    for i in range(200):
        at += rng.choice([0, 5, 40])
        user = 7 if rng.random() < 0.4 else rng.choice([None, 1, 2])
        rows.append((user, rng.choice([1, 2]), rng.choice(["a", "b", None]), at, i))

    def frame(part):
        return spark.createDataFrame(part, "user_id long, ad_id long, province string, s long, seq long").select("user_id", "ad_id", "province", F.timestamp_seconds("s").alias("ts"), "seq")

    write = click_cap_writer(scratch, 5, size_s=60, slide_s=20, folder_s=DAY)
    cuts = [0, *sorted(rng.sample(range(1, 200), 3)), 200]
    parts = [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    if seed == 2:  # clicks of one cut come in any order
        for part in parts:
            rng.shuffle(part)
    parts += [[(1, 1, "a", 40 * DAY, 1000)], [(7, 1, "a", 3 * DAY, 1001), (7, 1, "a", 40 * DAY + 1, 1002)]]
    for i, part in enumerate(parts):
        write(frame(part), i)
        if i == 1:
            write(frame(part), i)
    passed, warned = detect.click_cap(frame(rows), 5)
    got = spark.read.parquet(f"{scratch}/pass").filter("seq < 1000")
    assert rows_of(got, "seq") == rows_of(passed, "seq")
    assert rows_of(spark.read.parquet(f"{scratch}/warn"), "user_id", "ad_id", "ts") == rows_of(warned, "user_id", "ad_id", "ts") and warned.count() > 2
    assert [r["seq"] for r in spark.read.parquet(f"{scratch}/late").collect()] == [1001]  # its day is over
    tally = {r["kind"]: r["n"] for r in spark.read.parquet(f"{scratch}/tally").groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    assert sum(tally.values()) == 203 and tally["late"] == 1 and tally["dropped"] > 0 and tally["pass"] == passed.count() + 2
    held = sorted(d for d in os.listdir(f"{scratch}/cap/counts") if d.startswith("day="))
    assert held == ["day=40"]  # counts of closed days are gone
    windows = spark.read.parquet(f"{scratch}/out").filter(f"window_end < {40 * DAY}")
    late_windows = spark.read.parquet(f"{scratch}/late_windows").count()
    if seed == 1:
        from tidemark.operators.windows import sliding_count
        assert late_windows == 0 and rows_of(windows, "window_end", "province", "count") == rows_of(sliding_count(passed, "ts", ["province"], 60, 20), "window_end", "province", "count")


def test_counts_of_a_day_are_a_few_files(spark, scratch):
    """A batch dealt over many tasks writes its counts by day, not a file for each task and day."""
    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")
    plain.conf.set("spark.sql.shuffle.partitions", "16")
    clicks = plain.range(2000).select((F.col("id") % 500).alias("user_id"), F.lit(1).alias("ad_id"), F.lit("a").alias("province"),
                                      F.timestamp_seconds(F.col("id") % 3 * DAY).alias("ts"), F.col("id").alias("seq"))
    click_cap_writer(scratch, 5, size_s=60, slide_s=20, folder_s=DAY)(clicks, 0)
    days = os.path.join(scratch, "cap", "counts")
    files = [f for f in os.listdir(os.path.join(days, "day=1", "batch_id=0")) if f.endswith(".parquet")]
    assert len(files) <= 4
    assert spark.read.parquet(days).agg(F.sum("n")).first()[0] == 2000

"""The window store, per-row lateness and the global pattern: micro-batches cut anywhere equal the batch
operators, also when a micro-batch is run again. Writers are called as a streaming query calls them."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import fixture
from tidemark.operators import detect, late, windows
from tidemark.operators.global_order import match_in_order
from tidemark.plans import jobs as bjobs
from tidemark.sources.text import read_access_log
from tidemark.streaming import jobs as sjobs
from tidemark.streaming import late as slate
from tidemark.streaming import sinks
from tidemark.streaming.global_pattern import pattern_writer
from tidemark.streaming.window_store import window_writer

BASE = 1_600_000_000


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def log_rows(rng, n=160):
    """Requests that come out of order, some far too late, some for assets."""
    at, rows = 0, []
    for i in range(n):
        at += rng.choice([0, 1, 3, 10])
        back = rng.choice([0, 0, 0, 1, 2, 5, 40, 90, 400])
        rows.append((i, f"/p{rng.randrange(4)}" + rng.choice(["", "", "", ".css"]), BASE + at - back))
    return rows


def log_frame(spark, rows):
    df = spark.createDataFrame(rows, "arrival long, url string, s long")
    return df.select("arrival", "url", F.timestamp_seconds("s").alias("ts"))


def cuts_of(rng, n, k):
    return [0, *sorted(rng.sample(range(1, n), k - 1)), n]


@pytest.mark.parametrize("seed", [1, 2])
def test_page_views_equal_the_batch_job_however_they_are_cut(spark, scratch, seed):
    rng = random.Random(seed)
    rows = log_rows(rng)
    size, slide, bound, lateness = [(60, 10, 2, 30), (50, 20, 5, 0)][seed - 1]
    closing = [(10**6, "/end.css", BASE + 10**6)]
    log = log_frame(spark, rows + closing)
    top, late_rows = bjobs.page_view_top_n(log, 3, size, slide, bound, lateness)
    routed = late.route_late(log, size, slide, bound, lateness)
    counts = late.accepted_window_counts(routed.filter("url not like '%.css'"), ["url"], size, slide, lateness)
    writer_of = {}
    for name, publish in (("top", None), ("counts", None)):
        root = os.path.join(scratch, name)
        accepted = sinks.write_batch(os.path.join(root, "accepted"))
        writer_of[name] = root, window_writer(root, ["url"], size, slide, bound, lateness, "pv_count", keep=F.col("url").rlike("^(?!.*[.]css$)"),
                                              arrival=["arrival"], accepted=accepted, folder_s=[size, 7 * size][seed - 1])
    root, write = writer_of["counts"]
    cuts = cuts_of(rng, len(rows), 4)
    parts = [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])] + [closing]
    for i, part in enumerate(parts):
        batch = log_frame(spark, part)
        write(batch, i)
        if i % 2:
            write(batch, i)  # run again, as after a lost driver
    got = rows_of(spark.read.parquet(f"{root}/out"), "window_start", "window_end", "url", "pv_count")
    assert got == rows_of(counts, "window_start", "window_end", "url", "pv_count") and got
    # every page is accepted or late, once
    out = [r[0] for n in ("accepted", "late") for r in rows_of(spark.read.parquet(f"{root}/{n}"), "arrival")]
    assert sorted(out) == [i for i, url, _ in rows if not url.endswith(".css")]
    assert rows_of(spark.read.parquet(f"{root}/late"), "arrival") == rows_of(late_rows, "arrival")
    held = [int(d.split("=")[1]) for d in os.listdir(f"{root}/deltas") if d.startswith("part=")]
    assert len(held) <= len([d for d in os.listdir(f"{root}/out") if d.startswith("part=")])


def test_page_view_script_as_one_stream(spark, scratch):
    """The lateness script by lines: 68 windows, one late row, early and final results."""
    log = read_access_log(spark, fixture("access_lateness.log"))
    lines = log.orderBy("arrival").collect()
    source = os.path.join(scratch, "source")
    schema = log.schema
    root = os.path.join(scratch, "views")
    name = f"t_views_{os.path.basename(scratch)}"
    far = [r for r in lines[:1]]
    closing = spark.createDataFrame(far, schema).withColumns({"url": F.lit("/x.css"), "ts": F.timestamp_seconds(F.lit(BASE)), "arrival": F.lit(10**9).cast("long")}).select(*log.columns)
    for part in (lines[:3], lines[3:8], lines[8:], closing):
        df = part if not isinstance(part, list) else spark.createDataFrame(part, schema)
        df.coalesce(1).write.mode("append").parquet(source)
        q = sjobs.page_view_query(spark.readStream.schema(schema).parquet(source), root, arrival=["arrival"], name=name, trigger={"availableNow": True})
        q.awaitTermination()
    top, late_rows = bjobs.page_view_top_n(log)
    out = spark.read.parquet(f"{root}/out")
    assert rows_of(out, "window_end", "rank", "url", "pv_count") == rows_of(top, "window_end", "rank", "url", "pv_count") and out.count() == 68
    assert [int(r.ts.timestamp()) for r in spark.read.parquet(f"{root}/late").collect()] == [1431870949]
    assert rows_of(sjobs.page_view_report(out), "window_end", "report") == rows_of(bjobs.page_view_top_n_report(top), "window_end", "report")
    assert not [x for x in spark.streams.active if x.name == name]


def test_rows_are_judged_one_by_one_across_batches(spark, scratch):
    rng = random.Random(9)
    rows = log_rows(rng)
    cuts = cuts_of(rng, len(rows), 5)
    acc, lt = os.path.join(scratch, "acc"), os.path.join(scratch, "late")
    route = slate.route_late_batches(os.path.join(scratch, "state"), 60, 10, 2, 30, sinks.write_batch(acc), sinks.write_batch(lt), arrival=["arrival"])
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        route(log_frame(spark, rows[a:b]), i)
    expected = late.route_late(log_frame(spark, rows), 60, 10, 2, 30)
    for path, flag in ((acc, "not is_late"), (lt, "is_late")):
        assert rows_of(spark.read.parquet(path), "arrival", "watermark_us") == rows_of(expected.filter(flag), "arrival", "watermark_us")


def test_a_batch_without_the_state_before_it_fails(spark, scratch):
    route = slate.route_late_batches(os.path.join(scratch, "state"), 60, 10, 2, 30, lambda d, i: None, lambda d, i: None)
    with pytest.raises(RuntimeError, match="no state of batch 4"):
        route(log_frame(spark, log_rows(random.Random(1), 5)), 5)


def test_very_fine_windows_are_published_by_the_stream(spark, scratch):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None]), BASE + i * rng.choice([1, 2])) for i in range(120)]
    rows.sort(key=lambda r: r[2])

    def frame(part):
        return spark.createDataFrame(part, "n long, channel string, s long").select("channel", F.timestamp_seconds("s").alias("ts"))

    write = window_writer(scratch, ["channel"], 3600, 5, folder_s=86_400, keep=F.coalesce(F.col("channel") != "end", F.lit(True)))
    for i, part in enumerate([rows[:50], rows[50:], [(0, "end", BASE + 10**6)]]):
        write(frame(part), i)
    exp = windows.sliding_count(frame(rows), "ts", ["channel"], 3600, 5)
    got = spark.read.parquet(f"{scratch}/out").select(*exp.columns)
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0


# -- patterns in the global order


def brute_matches(rows, preds, within, inclusive=False):
    rows, k, out = sorted(rows, key=lambda r: (r[0], r[1])), len(preds), []
    for i in range(len(rows) - k + 1):
        w = rows[i:i + k]
        span = w[-1][0] - w[0][0]
        if all(p == r[2] for p, r in zip(preds, w)) and (span < within or inclusive and span == within):
            out.append((w[-1][1], w[0][1], w[0][3]))
    return sorted(out, key=repr)


def login_frame(spark, rows):
    return spark.createDataFrame(rows, "s long, seq long, state string, user_id long").select("seq", "state", "user_id", F.timestamp_seconds("s").alias("ts"))


@pytest.mark.parametrize("preds", ["ff", "ffs", "fsff"])
@pytest.mark.parametrize("minutes", [0, 30])
def test_matches_cross_the_tasks(spark, preds, minutes):
    rng = random.Random(len(preds) + minutes)
    rows = [(BASE + rng.randint(0, 60 * minutes), i, rng.choice("ffs"), rng.choice([None, 1, 2, 3])) for i in range(300)]
    df = login_frame(spark, rows).repartition(3)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {c: spark.conf.get(c) for c in conf}
    for parts in (1, 7, 150, 400):
        try:
            for c, v in {**conf, "spark.sql.shuffle.partitions": str(parts)}.items():
                spark.conf.set(c, v)
            found = match_in_order(df, [F.col("state") == p for p in preds], 5_000_000, inclusive=True)
            got = rows_of(found, "seq", "first_seq", "first_user")
        finally:
            for c, v in {**before, "spark.sql.shuffle.partitions": "8"}.items():
                spark.conf.set(c, v)
        assert got == brute_matches(rows, list(preds), 5, inclusive=True) and got
    assert rows_of(detect.match_sequence(df, [], [F.col("state") == p for p in preds], 5, inclusive=True), "seq", "first_seq", "first_user") == got


def test_a_crowded_minute_is_spread_over_tasks(spark):
    df = spark.range(40_000).select(F.timestamp_seconds(F.lit(BASE)).alias("ts"), F.col("id").alias("seq"), F.lit("fail").alias("state"), F.lit(1).cast("long").alias("user_id"))
    dealt = df.repartitionByRange(8, "ts", "seq").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 10_000
    assert detect.fail_sequences(df, 2, keyed=False).count() == 39_999


@pytest.mark.parametrize("seed", [3, 4])
def test_pattern_stream_equals_batch(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [(BASE + i + rng.randint(-4, 4), i, rng.choice("ffs"), rng.choice([1, 2])) for i in range(120)]
    preds = [F.col("state") == p for p in "ff"]
    write = pattern_writer(scratch, preds, 3, delay_s=[10, 0][seed - 3])
    cuts = cuts_of(rng, len(rows), 4)
    parts = [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])] + [[(BASE + 10**6, 10**6, "s", 0)]]
    for i, part in enumerate(parts):
        write(login_frame(spark, part), i)
        if i == 2:
            write(login_frame(spark, part), i)
    late_seqs = [r["seq"] for r in spark.read.parquet(f"{scratch}/late").collect()]
    assert (seed == 4) == bool(late_seqs)
    kept = [r for r in rows if r[1] not in late_seqs]
    assert rows_of(spark.read.parquet(f"{scratch}/out"), "seq", "first_seq", "first_user") == brute_matches(kept, "ff", 3)

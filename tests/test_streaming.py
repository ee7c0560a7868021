"""Batch = stream: the same operator over a file stream, one file per
micro-batch, ending with sentinel rows far in the future (a stream has no
end-of-input flush)."""

import os

from pyspark.sql import functions as F

from helpers import SF_SMALL, fixture
from tidemark.operators import aggregates, detect, windows
from tidemark.operators import late as late_ops
from tidemark.sources import tables
from tidemark.sources.text import parse_access_log
from tidemark.streaming import late as slate
from tidemark.streaming import sinks, stateful
from tidemark.streaming import windows as swin

FAR = 4_000_000_000  # sentinel epoch seconds


def _write_chunks(folder, chunks):
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(chunks):
        p = os.path.join(folder, f"part-{i:05d}.csv")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))


def _run(df, scratch, name, fn, mode="append"):
    q = (df.writeStream.outputMode(mode).foreachBatch(fn)
         .option("checkpointLocation", os.path.join(scratch, f"ck-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _login_stream(spark, scratch, chunks):
    src = os.path.join(scratch, "logins")
    _write_chunks(src, chunks)
    from pyspark.sql import types as T

    from tidemark import schemas
    from tidemark.sources.text import read_delimited_stream
    schema = T.StructType(schemas.LOGIN_EVENT.fields + [T.StructField("seq", T.LongType())])
    return read_delimited_stream(spark, src, schema, trim=False, max_files_per_trigger=1)


def _login_chunks(size=10):
    with open(fixture("login_events.csv")) as f:
        lines = [ln.strip() for ln in f if ln.strip()]
    rows = [f"{ln},{i}" for i, ln in enumerate(lines)]
    chunks = [rows[i:i + size] for i in range(0, len(rows), size)]
    return chunks + [[f"0,0,success,{FAR},100000"], [f"0,0,success,{FAR + 100},100001"]]


def test_fail_pairs_stream_equals_batch(spark, scratch):
    stream = _login_stream(spark, scratch, _login_chunks())
    out = os.path.join(scratch, "pairs")
    _run(stateful.fail_pairs_stream(stream, 2), scratch, "pairs", sinks.write_batch(out))
    got = sorted((r.user_id, r.first_fail_us // 10**6, r.last_fail_us // 10**6, r.warning_msg)
                 for r in spark.read.parquet(out).collect())
    assert got == [(1035, 1558430842, 1558430843, "warning: fail times more than 2 in 2 seconds")]


def test_fail_bursts_stream_equals_batch(spark, scratch):
    # user 1: burst (0,1,2) then a lone failure at 2.5 s -> with min 1: two groups
    base = 1_558_430_000
    rows = [f"1,x,fail,{base}", f"1,x,fail,{base + 1}", f"2,x,fail,{base + 1}", f"1,x,fail,{base + 2}",
            f"2,x,success,{base + 2}", f"1,x,fail,{base + 5}", f"3,x,fail,{base}", f"3,x,fail,{base + 2}"]
    rows = [f"{r},{i}" for i, r in enumerate(rows)]
    chunks = [rows[:3], rows[3:5], rows[5:]] + [[f"0,0,success,{FAR},100"], [f"0,0,success,{FAR + 100},101"]]
    stream = _login_stream(spark, scratch, chunks)
    out = os.path.join(scratch, "bursts")
    _run(stateful.fail_bursts_stream(stream, 2, 1), scratch, "bursts", sinks.write_batch(out))
    got = sorted((r.user_id, r.first_fail_us // 10**6 - base, r.last_fail_us // 10**6 - base, r.fail_count)
                 for r in spark.read.parquet(out).collect())
    batch_in = spark.createDataFrame([tuple(r.split(",")) for r in rows],
                                     "user_id string, ip string, state string, ts_s string, seq string")
    batch_in = batch_in.select(F.col("user_id").cast("long").alias("user_id"), "state",
                               F.timestamp_seconds(F.col("ts_s").cast("long")).alias("ts"),
                               F.col("seq").cast("long").alias("seq"))
    exp = sorted((r.user_id, int(r.first_fail_ts.timestamp()) - base, int(r.last_fail_ts.timestamp()) - base,
                  r.fail_count) for r in detect.fail_bursts(batch_in, 2, 1).collect())
    assert got == exp
    assert (1, 0, 2, 3) in got and (1, 5, 5, 1) in got and (3, 0, 2, 2) in got


def test_logins_without_a_user_are_one_user(spark, scratch):
    base = 1_558_430_000
    rows = [f",x,fail,{base}", f"1,x,fail,{base}", f",x,fail,{base + 1}", f"1,x,success,{base + 1}", f",x,fail,{base + 9}"]
    rows = [f"{r},{i}" for i, r in enumerate(rows)]
    chunks = [rows[:2], rows[2:]] + [[f"0,0,success,{FAR},100"], [f"0,0,success,{FAR + 100},101"]]
    for kind, stream_of in (("pair", stateful.fail_pairs_stream), ("burst", stateful.fail_bursts_stream)):
        where = os.path.join(scratch, kind)
        stream = _login_stream(spark, where, chunks)
        out = os.path.join(where, "out")
        _run(stream_of(stream, 2), where, kind, sinks.write_batch(out))
        got = [(r.user_id, r.first_fail_us // 10**6 - base, r.last_fail_us // 10**6 - base) for r in spark.read.parquet(out).collect()]
        assert got == [(None, 0, 1)]


def test_click_cap_stream_gold(spark, scratch):
    with open(fixture("ad_clicks.csv")) as f:
        lines = [ln.strip() for ln in f if ln.strip()]
    rows = [f"{ln},{i}" for i, ln in enumerate(lines)]
    chunks = [rows[i:i + 40] for i in range(0, len(rows), 40)]
    src = os.path.join(scratch, "clicks")
    _write_chunks(src, chunks)
    df = (spark.readStream.schema("user_id long, ad_id long, province string, city string, ts_s long, seq long")
          .option("maxFilesPerTrigger", 1).csv(src).withColumn("ts", F.timestamp_seconds("ts_s")))
    passed, warned = os.path.join(scratch, "pass"), os.path.join(scratch, "warn")
    _run(stateful.click_cap_stream(df, 100), scratch, "cap",
         sinks.split_by_kind({"pass": sinks.write_batch(passed), "warn": sinks.write_batch(warned)}))
    assert spark.read.parquet(passed).count() == 123
    w = spark.read.parquet(warned).collect()
    assert [(r.user_id, r.ad_id, r.us // 10**6) for r in w] == [(937166, 1715, 1511661702)]


def _events_stream(spark, scratch, n_files=4):
    ev = tables.events(spark, SF_SMALL).select("event_id", "ts", "user_id", "event_type", "props")
    src = os.path.join(scratch, "events")
    lo_hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    step = (lo_hi[1] - lo_hi[0]) // n_files + 1
    for i in range(n_files):
        part = ev.filter((F.col("event_id") >= lo_hi[0] + i * step) & (F.col("event_id") < lo_hi[0] + (i + 1) * step))
        part.coalesce(1).write.mode("overwrite").parquet(os.path.join(src, f"p{i}"))
    sentinel = spark.createDataFrame([(10**9, FAR, -1, "sentinel", "{}"), (10**9 + 1, FAR + 7200, -1, "sentinel", "{}")],
                                     "event_id long, s long, user_id long, event_type string, props string")
    sentinel = sentinel.select("event_id", F.timestamp_seconds("s").alias("ts"), "user_id", "event_type", "props")
    sentinel.limit(1).coalesce(1).write.parquet(os.path.join(src, "p8"))
    sentinel.filter("event_id > 1000000000").coalesce(1).write.parquet(os.path.join(src, "p9"))
    files = []
    for d in sorted(os.listdir(src)):
        files += [os.path.join(src, d, f) for f in os.listdir(os.path.join(src, d)) if f.endswith(".parquet")]
    flat = os.path.join(scratch, "events_flat")
    os.makedirs(flat)
    for i, f in enumerate(sorted(files)):
        dst = os.path.join(flat, f"f{i:03d}.parquet")
        with open(f, "rb") as a, open(dst, "wb") as b:
            b.write(a.read())
        os.utime(dst, (1_600_000_000 + i, 1_600_000_000 + i))
    return (spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, props string")
            .option("maxFilesPerTrigger", 1).parquet(flat)), ev


def test_window_counts_stream_equals_batch(spark, scratch):
    stream, ev = _events_stream(spark, scratch)
    out = os.path.join(scratch, "wc")
    _run(swin.window_counts(stream, "ts", ["event_type"], 3600, 300), scratch, "wc", sinks.write_batch(out))
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch_id")
                 .filter("event_type <> 'sentinel'").collect())
    exp = sorted(tuple(r) for r in windows.sliding_count(ev, "ts", ["event_type"], 3600, 300).collect())
    assert got == exp


def test_distinct_counts_stream_equals_batch(spark, scratch):
    stream, ev = _events_stream(spark, scratch)
    out = os.path.join(scratch, "uv")
    views = stream.filter("event_type in ('view', 'sentinel')")
    _run(swin.distinct_counts(views, "ts", "user_id", 3600), scratch, "uv", sinks.write_batch(out))
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch_id")
                 .filter("window_end < 3000000000").collect())
    exp = sorted(tuple(r) for r in aggregates.distinct_count(ev.filter("event_type = 'view'"), "ts", "user_id",
                                                             3600).collect())
    assert got == exp


def test_bitmap_upsert_stream(spark, scratch):
    stream, ev = _events_stream(spark, scratch)
    store = os.path.join(scratch, "uv_store")
    views = stream.filter("event_type = 'view'")
    _run(swin.bitmap_buckets(views, "ts", "user_id", 3600), scratch, "bm",
         sinks.upsert_partitions(store, ["bucket"], "window_end"), mode="update")
    got = sorted((r.window_end, r.uv) for r in
                 spark.read.parquet(store).groupBy("window_end").agg(F.sum("bits").alias("uv")).collect())
    exp = sorted((r.window_end, r.uv_count) for r in
                 aggregates.distinct_count(ev.filter("event_type = 'view'"), "ts", "user_id", 3600).collect())
    assert got == exp


def test_late_router_stream(spark, scratch):
    with open(fixture("access_lateness.log")) as f:
        text = f.read()
    chunks = [[ln for ln in block.split("\n") if ln.strip()] for block in text.split("\n\n")]
    src = os.path.join(scratch, "log")
    _write_chunks(src, chunks)
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    log = parse_access_log(lines)
    acc, lt = os.path.join(scratch, "acc"), os.path.join(scratch, "late")
    _run(log, scratch, "late", slate.route_late_batches(os.path.join(scratch, "state"), 600, 10, 1, 60,
                                                        sinks.write_batch(acc), sinks.write_batch(lt)))
    late_rows = spark.read.parquet(lt).collect()
    assert [int(r.ts.timestamp()) for r in late_rows] == [1431870949]   # 21:55:49 at +08:00
    accepted = spark.read.parquet(acc).drop("batch_id")
    assert accepted.count() == 8
    routed = accepted.withColumn("is_late", F.lit(False))
    counts = late_ops.accepted_window_counts(routed, [], 600, 10, 60)
    assert counts.count() == 68


def test_item_top_n_query_equals_batch(spark, scratch):
    from tidemark.plans import jobs as bjobs
    from tidemark.streaming import jobs as sjobs
    stream, ev = _events_stream(spark, scratch)
    beh = stream.select("user_id", tables.prop_k().alias("item_id"),
                        F.when(F.col("event_type") == "sentinel", "view").otherwise(F.col("event_type"))
                        .alias("behavior"), "ts")
    out = os.path.join(scratch, "top")
    q = sjobs.item_top_n_query(beh, out, 5, 3600, 300, pv_behavior="view", name=f"t_top_{os.path.basename(scratch)}",
                               trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch_id")
                 .filter("window_end < 3000000000")
                 .select("window_end", "rank", "item_id", "pv_count").collect())
    exp = sorted(tuple(r) for r in bjobs.item_top_n(tables.behaviors(ev), 5, 3600, 300, pv_behavior="view")
                 .select("window_end", "rank", "item_id", "pv_count").collect())
    assert got == exp


def test_page_view_top_n_refinement(spark, scratch):
    from tidemark.plans import jobs as bjobs
    from tidemark.sources.text import read_access_log
    from tidemark.streaming import jobs as sjobs
    with open(fixture("access_lateness.log")) as f:
        text = f.read()
    chunks = [[ln for ln in block.split("\n") if ln.strip()] for block in text.split("\n\n")]
    src = os.path.join(scratch, "log")
    _write_chunks(src, chunks)
    log = parse_access_log(spark.readStream.option("maxFilesPerTrigger", 1).text(src))
    store, top = os.path.join(scratch, "store"), os.path.join(scratch, "top")
    q = sjobs.page_view_top_n_query(log, store, top, 3, 600, 10, 1, 60, name=f"t_pv_{os.path.basename(scratch)}",
                                    trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted((r.window_end, r.rank, r.url, r.pv_count) for r in spark.read.parquet(top).collect())
    btop, blate = bjobs.page_view_top_n(read_access_log(spark, fixture("access_lateness.log")))
    exp = sorted((r.window_end, r.rank, r.url, r.pv_count) for r in btop.collect())
    assert got == exp and len(exp) == 68
    assert blate.count() == 1


def test_sliding_from_panes_equals_direct(spark):
    ev = tables.marketing(tables.events(spark, SF_SMALL))
    panes = (ev.groupBy("behavior", F.window("ts", "5 seconds").alias("p")).count()
             .select("behavior", F.unix_seconds("p.start").alias("pane_start"), F.col("count").alias("n")))
    a = windows.sliding_from_panes(panes, ["behavior"], "pane_start", "n", 3600, 300, "c")
    b = windows.sliding_count(ev, "ts", ["behavior"], 3600, 300, "c")
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_fail_sequences_stream_strict(spark, scratch):
    base = 1_558_430_000
    rows = [f"1,x,fail,{base}", f"1,x,fail,{base + 2}", f"2,x,fail,{base}", f"2,x,fail,{base + 1}"]
    rows = [f"{r},{i}" for i, r in enumerate(rows)]
    chunks = [rows[:2], rows[2:]] + [[f"0,0,success,{FAR},100"], [f"0,0,success,{FAR + 100},101"]]
    stream = _login_stream(spark, scratch, chunks)
    out = os.path.join(scratch, "seq")
    _run(stateful.fail_sequences_stream(stream, 2), scratch, "seq", sinks.write_batch(out))
    got = [(r.user_id, r.first_fail_us // 10**6 - base, r.last_fail_us // 10**6 - base, r.warning_msg)
           for r in spark.read.parquet(out).collect()]
    assert got == [(2, 0, 1, "fail 2 times in 2 seconds")]


def test_fan_out_and_job_queries(spark, scratch):
    from tidemark.streaming import jobs as sjobs
    stream, ev = _events_stream(spark, scratch)
    beh = stream.select("user_id", F.col("event_type").alias("behavior"), "ts")
    tag = os.path.basename(scratch)
    pv_out, uv_out = os.path.join(scratch, "pv"), os.path.join(scratch, "uv")
    q1 = sjobs.page_view_count_query(beh.filter("behavior in ('view', 'sentinel')")
                                     .withColumn("behavior", F.lit("pv")), pv_out,
                                     name=f"t_pv_{tag}", trigger={"availableNow": True})
    q1.awaitTermination()
    q2 = sjobs.unique_visitor_query(beh, uv_out, pv_behavior="view", name=f"t_uv_{tag}",
                                    trigger={"availableNow": True})
    q2.awaitTermination()
    pv = spark.read.parquet(pv_out).filter("window_end < 3000000000").agg(F.sum("pv_count")).first()[0]
    assert pv == ev.filter("event_type = 'view'").count()
    assert spark.read.parquet(uv_out).count() > 0

    seen = []
    fan = sinks.fan_out(lambda df, i: seen.append(("a", df.count())), lambda df, i: seen.append(("b", df.count())))
    fan(ev, 0)
    assert seen == [("a", ev.count()), ("b", ev.count())]


def test_page_view_queries_pair(spark, scratch):
    from tidemark.streaming import jobs as sjobs
    with open(fixture("access_lateness.log")) as f:
        text = f.read()
    chunks = [[ln for ln in block.split("\n") if ln.strip()] for block in text.split("\n\n")]
    src = os.path.join(scratch, "log")
    _write_chunks(src, chunks)
    log = parse_access_log(spark.readStream.option("maxFilesPerTrigger", 1).text(src))
    roots = [os.path.join(scratch, d) for d in ("store", "top", "acc", "late")]
    qs = sjobs.page_view_top_n_queries(log, *roots, name=f"t_pvq_{os.path.basename(scratch)}",
                                       trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(roots[1]).count() == 68
    assert [int(r.ts.timestamp()) for r in spark.read.parquet(roots[3]).collect()] == [1431870949]


def test_channel_pane_store_rollup(spark, scratch):
    from tidemark.streaming import jobs as sjobs
    stream, ev = _events_stream(spark, scratch)
    mk = stream.select(F.col("event_type").alias("behavior"),
                       (tables.prop_k() % 5).alias("channel"), "ts")
    store = os.path.join(scratch, "panes")
    q = sjobs.channel_pane_query(mk, store, slide_s=5, exclude="signup",
                                 name=f"t_cp_{os.path.basename(scratch)}", trigger={"availableNow": True})
    q.awaitTermination()
    panes = spark.read.parquet(store).drop("batch_id").filter("behavior <> 'sentinel'")
    got = windows.sliding_from_panes(panes, ["channel", "behavior"], "pane_start", "pane_count", 3600, 5, "n")
    exp = windows.sliding_count(tables.marketing(ev).filter("behavior <> 'signup'"), "ts",
                                ["channel", "behavior"], 3600, 5, "n")
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


def test_ad_click_job_gold(spark, scratch):
    from tidemark.streaming import jobs as sjobs
    with open(fixture("ad_clicks.csv")) as f:
        lines = [ln.strip() for ln in f if ln.strip()]
    rows = [f"{ln},{i}" for i, ln in enumerate(lines)]
    src = os.path.join(scratch, "clicks")
    _write_chunks(src, [rows[i:i + 50] for i in range(0, len(rows), 50)])
    df = (spark.readStream.schema("user_id long, ad_id long, province string, city string, ts_s long, seq long")
          .option("maxFilesPerTrigger", 1).csv(src).withColumn("ts", F.timestamp_seconds("ts_s")))
    passed, warned = os.path.join(scratch, "pass"), os.path.join(scratch, "warn")
    q = sjobs.ad_click_query(df, passed, warned, 100, name=f"t_ad_{os.path.basename(scratch)}",
                             trigger={"availableNow": True})
    q.awaitTermination()
    ok = spark.read.parquet(passed).withColumn("ts", F.timestamp_micros("us"))
    assert windows.sliding_count(ok, "ts", ["province"], 3600, 5).count() == 5988
    assert spark.read.parquet(warned).count() == 1


def test_bitmap_and_login_job_queries(spark, scratch):
    from tidemark.streaming import jobs as sjobs
    tag = os.path.basename(scratch)
    stream, ev = _events_stream(spark, scratch)
    beh = stream.select("user_id", F.col("event_type").alias("behavior"), "ts")
    store = os.path.join(scratch, "uvstore")
    q = sjobs.unique_visitor_bitmap_query(beh, store, pv_behavior="view", name=f"t_bm_{tag}",
                                          trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted((r.window_end, r.uv) for r in spark.read.parquet(store).groupBy("window_end")
                 .agg(F.sum("bits").alias("uv")).collect())
    exp = sorted((r.window_end, r.uv_count) for r in
                 aggregates.distinct_count(ev.filter("event_type = 'view'"), "ts", "user_id", 3600).collect())
    assert got == exp

    logins = _login_stream(spark, scratch, _login_chunks())
    out = os.path.join(scratch, "warn")
    q2 = sjobs.login_warning_query(logins, out, kind="pair", within_s=2, name=f"t_lw_{tag}",
                                   trigger={"availableNow": True})
    q2.awaitTermination()
    assert [(r.user_id, r.first_fail_us // 10**6) for r in spark.read.parquet(out).collect()] == \
        [(1035, 1558430842)]


def test_upsert_writes_a_file_a_partition(spark, scratch):
    """A batch of many tasks leaves each partition in one file, at the first write and at the merge."""
    write = sinks.upsert_partitions(os.path.join(scratch, "store"), ["bucket"], "window_end")
    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")  # as in the batches of a stateful query
    for batch_id, low in enumerate((0, 500)):
        rows = plain.range(low, low + 1000).select((F.col("id") % 3).alias("window_end"), F.col("id").alias("bucket"), F.lit(batch_id).alias("bits"))
        write(rows.repartition(8), batch_id)
        files = [f for _, _, names in os.walk(os.path.join(scratch, "store", "window_end=1")) for f in names if f.endswith(".parquet")]
        assert len(files) == 1
    got = spark.read.parquet(os.path.join(scratch, "store")).agg(F.count("*"), F.count_distinct("bucket"), F.sum("bits")).first()
    assert tuple(got) == (1500, 1500, 1000)

"""Hand-written micro-fixtures for edge cases."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import is_page_url, poly_hash
from tidemark.functions.time import format_java_timestamp
from tidemark.operators import detect, topn, windows
from tidemark.sources.text import parse_access_log, read_delimited

T0 = 1_700_000_000  # epoch seconds, arbitrary


def logins(spark, rows):
    """rows: (user, state, seconds offset) in arrival order."""
    data = [(u, s, float(T0 + t), i) for i, (u, s, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "user_id long, state string, tsd double, seq long")
    return df.select("user_id", "state", F.timestamp_micros((F.col("tsd") * 1e6).cast("long")).alias("ts"),
                     "seq")


def bursts(df, within=2, n=2):
    return sorted((r.user_id, r.first_fail_ts.timestamp() - T0, r.last_fail_ts.timestamp() - T0, r.fail_count)
                  for r in detect.fail_bursts(df, within, n).collect())


def test_burst_then_new_group(spark):
    df = logins(spark, [(1, "fail", 0), (1, "fail", 1), (1, "fail", 2), (1, "fail", 2.5)])
    assert bursts(df) == [(1, 0, 2, 3)]
    # the failure at 2.5 opens a new group (of one: below the minimum)
    assert bursts(df, n=1) == [(1, 0, 2, 3), (1, 2.5, 2.5, 1)]


def test_burst_cancelled_by_success(spark):
    df = logins(spark, [(1, "fail", 0), (1, "fail", 1), (1, "success", 2)])
    assert bursts(df) == []


def test_burst_success_after_window_does_not_cancel(spark):
    df = logins(spark, [(1, "fail", 0), (1, "fail", 1), (1, "success", 2.5)])
    assert bursts(df) == [(1, 0, 1, 2)]


def test_burst_message(spark):
    df = logins(spark, [(7, "fail", 0), (7, "fail", 1)])
    msg = detect.fail_bursts(df, 2, 2).first().warning_msg
    assert msg == "warning:fail 2 times in 2 seconds"


def test_pair_delta_two(spark):
    df = logins(spark, [(1, "fail", 0), (1, "fail", 2)])
    assert detect.fail_pairs(df, 2).count() == 1          # inclusive
    assert detect.fail_sequences(df, 2).count() == 0      # strict


def test_pair_arrival_order_negative_span(spark):
    df = logins(spark, [(1, "fail", 5), (1, "fail", 1)])
    assert detect.fail_pairs(df, 2, order="arrival").count() == 1
    assert detect.fail_pairs(df, 2, order="event").count() == 0


def test_mixed_users(spark):
    df = logins(spark, [(1, "fail", 0), (2, "fail", 1)])
    assert detect.fail_sequences(df, 2, keyed=True).count() == 0
    g = detect.fail_sequences(df, 2, keyed=False).collect()
    assert [(r.user_id, r.last_fail_ts.timestamp() - T0) for r in g] == [(1, 1)]


def test_success_breaks_pair(spark):
    df = logins(spark, [(1, "fail", 0), (1, "success", 0.5), (1, "fail", 1)])
    assert detect.fail_pairs(df, 2).count() == 0


def test_match_sequence_three_links(spark):
    df = logins(spark, [(1, "fail", 0), (1, "success", 1), (1, "fail", 2), (1, "fail", 9)])
    is_f, is_s = F.col("state") == "fail", F.col("state") == "success"
    m = detect.match_sequence(df, ["user_id"], [is_f, is_s, is_f], within_s=3)
    assert [(r.first_ts.timestamp() - T0, r.ts.timestamp() - T0) for r in m.collect()] == [(0, 2)]


def clicks(spark, rows):
    data = [(u, a, "p", T0 + t, i) for i, (u, a, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "user_id long, ad_id long, province string, ts_s long, seq long")
    return df.withColumn("ts", F.timestamp_seconds("ts_s"))


def test_click_cap_cycle(spark):
    day = 86400
    base = (T0 // day + 1) * day - T0  # offset of the next UTC midnight
    rows = [(1, 9, t) for t in range(0, 5)] + [(1, 9, base + 1), (1, 9, base + 2)]
    passed, warn = detect.click_cap(clicks(spark, rows), max_clicks=2)
    got = sorted(r.ts_s - T0 for r in passed.collect())
    assert got == [0, 1, 2, base + 1, base + 2]          # max+1 pass, new day passes again
    w = warn.collect()
    assert len(w) == 1 and int(w[0].ts.timestamp()) - T0 == 3   # warned once
    assert w[0].msg == " warning: flush click and more than 2"


def test_rank_tie_lower_key_first(spark):
    df = spark.createDataFrame([(100, 5, 3), (100, 2, 3), (100, 7, 1)],
                               "window_end long, item_id long, pv_count long")
    top = topn.top_n_per_window(df, 2, key="item_id", count="pv_count").orderBy("rank").collect()
    assert [r.item_id for r in top] == [2, 5]


def test_url_filter(spark):
    urls = ["/a.css", "/a.js", "/a.ico", "/x.css?y", "/a.css/b", "/index"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    kept = [r.url for r in df.filter(is_page_url("url")).collect()]
    assert kept == ["/a.ico", "/x.css?y", "/a.css/b", "/index"]
    wide = [r.url for r in df.filter(is_page_url("url", ["css", "js", "ico"])).collect()]
    assert wide == ["/x.css?y", "/a.css/b", "/index"]


def test_window_edge(spark):
    df = spark.createDataFrame([(3600,), (3599,)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    c = {r.window_end: r.n for r in windows.tumbling_count(df, "ts", [], 3600, "n").collect()}
    assert c == {3600: 1, 7200: 1}
    s = windows.sliding_count(df, "ts", [], 3600, 1800, "n").collect()
    assert sorted((r.window_end, r.n) for r in s) == [(3600, 1), (5400, 2), (7200, 1)]


def test_poly_hash_value(spark):
    # "1234": ((('1'*61 + '2')*61 + '3')*61 + '4') mod 2**30
    expect = 0
    for ch in "1234":
        expect = (expect * 61 + ord(ch)) % (1 << 30)
    got = spark.range(1).select(poly_hash(F.lit(1234)).alias("h")).first().h
    assert got == expect


def test_java_timestamp_format(spark):
    df = spark.createDataFrame([(1511658000000,), (1511658000500,)], "ms long")
    got = [r.s for r in df.select(format_java_timestamp(F.timestamp_millis("ms")).alias("s")).collect()]
    assert got == ["2017-11-26 01:00:00.0", "2017-11-26 01:00:00.5"]


def test_bad_delimited_line_fails(spark, scratch):
    p = f"{scratch}/bad.csv"
    with open(p, "w") as f:
        f.write("1,1.1.1.1,fail,1558430815\nxx,1.1.1.1,fail,1558430816\n")
    with pytest.raises(Exception):
        read_delimited(spark, p, schemas.LOGIN_EVENT).collect()


def test_bad_log_line_fails(spark):
    df = spark.createDataFrame([("1.1.1.1 - - 17/05/2015:22:05:52",)], "value string")
    with pytest.raises(Exception):
        parse_access_log(df).collect()


def test_report_field_order(spark):
    from tidemark.plans import jobs
    df = spark.createDataFrame([(3600, 1, "/a", 7), (3600, 2, "/b", 3)],
                               "window_end long, rank int, url string, pv_count long")
    rep = jobs.page_view_top_n_report(df).first().report
    assert rep == "window end: 1970-01-01 01:00:00.0\nTop1: 7 /a\nTop2: 3 /b\n" + "-" * 32


@pytest.mark.parametrize("rows", [
    [(1, "fail", 0), (1, "fail", 1), (1, "fail", 2), (1, "fail", 2.5)],
    [(1, "fail", 0), (1, "fail", 1), (1, "success", 2)],
    [(1, "fail", 0), (1, "fail", 1), (1, "success", 2.5)],
    [(1, "fail", t * 0.7) for t in range(40)] + [(1, "success", 28.5), (2, "fail", 3), (2, "fail", 4)],
    [(1, "fail", t * 0.6) for t in range(30)] + [(1, "fail", 40 + t) for t in range(9)],
])
def test_burst_bucket_widths_agree(spark, rows):
    df = logins(spark, rows)
    cols = ["user_id", "first_fail_ts", "last_fail_ts", "fail_count"]
    forms = [sorted(tuple(r) for r in detect.fail_bursts(df, 2, 2, span=span).select(*cols).collect()) for span in (1, 2, 64)]
    assert forms[0] == forms[1] == forms[2]


def fold_bursts(rows, within, least):
    """The fold, row by row: rows of one user as (time, order, fails)."""
    out, group = [], None
    for t, _, fails in sorted(rows):
        if group and t > group[0] + within:
            out.append(group)
            group = None
        group = ((group[0], t, group[2] + 1) if group else (t, t, 1)) if fails else None
    if group:
        out.append(group)
    return [g for g in out if g[2] >= least]


@pytest.mark.parametrize("span, dense", [(1, 1), (2, 1), (64, 1), (1, 30), (3, 10)])
def test_bursts_equal_the_fold(spark, span, dense):
    import random
    rng = random.Random(span * 100 + dense)
    rows = []
    for user in [None, *range(1, 9)]:
        chance, at = rng.choice([0.5, 0.9, 0.98, 1.0]), -50
        for _ in range(rng.choice([5, 60, 700])):
            at += rng.choice([0, 1, 1, 2, 5, 30]) if dense == 1 else rng.choice([0, 0, 0, 0, 0, 1, 1, 7])
            rows.append((user, "fail" if rng.random() < chance else "success", at, len(rows)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "user_id long, state string, s long, seq long").withColumn("ts", F.timestamp_seconds("s")).repartition(5)
    for within in (3, 10):
        got = sorted((tuple(r) for r in detect.fail_bursts(df, within, 2, span=span)
                      .select("user_id", F.unix_seconds("first_fail_ts"), F.unix_seconds("last_fail_ts"), "fail_count").collect()), key=repr)
        users = {r[0] for r in rows}
        expected = sorted(((u, *g) for u in users for g in fold_bursts([(t, q, s == "fail") for v, s, t, q in rows if v == u], within, 2)), key=repr)
        assert got == expected and got


def test_partial_trim(spark, scratch):
    p = f"{scratch}/ub.csv"
    with open(p, "w") as f:
        f.write(" 1, 2 ,3, pv ,1511658000\n")
    df = read_delimited(spark, p, schemas.USER_BEHAVIOR,
                        trim=["user_id", "item_id", "category_id", "ts_s"]).first()
    assert (df.user_id, df.item_id, df.category_id, df.behavior) == (1, 2, 3, " pv ")
    with open(p, "w") as f:
        f.write("x,2,3,pv,1511658000\n")
    with pytest.raises(Exception):
        read_delimited(spark, p, schemas.USER_BEHAVIOR, trim=["user_id", "ts_s"]).collect()


def test_parse_delimited_lines(spark):
    from tidemark.sources.text import parse_delimited
    lines = spark.createDataFrame([("543462,1715,beijing,beijing,1511658000",)], "value string")
    r = parse_delimited(lines, schemas.AD_CLICK).first()
    assert (r.user_id, r.ad_id, r.province, int(r.ts.timestamp())) == (543462, 1715, "beijing", 1511658000)
    bad = spark.createDataFrame([("543462,1715,beijing",)], "value string")
    with pytest.raises(Exception):
        parse_delimited(bad, schemas.AD_CLICK).collect()


def test_scale_settings():
    from tidemark.session import scale_settings
    s = scale_settings(100 * 10**12, executor_cores_total=8000)
    assert int(s["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert int(scale_settings(10**6)["spark.sql.shuffle.partitions"]) == 200


def test_line_order_over_files_and_splits(spark, scratch):
    """A small first file and a large second one, read in many splits: positions follow the lines."""
    from tidemark.schemas import LOGIN_EVENT
    with open(os.path.join(scratch, "part-0.csv"), "w") as f:
        f.writelines(f"{i},1.1.1.1,fail,{i}\n" for i in range(3))
    with open(os.path.join(scratch, "part-1.csv"), "w") as f:
        f.writelines(f"{i},1.1.1.1,fail,{i}\n" for i in range(3, 5000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_delimited(spark, scratch, LOGIN_EVENT)
        rows = df.select("user_id", "seq").orderBy("seq").collect()
        assert [r["user_id"] for r in rows] == list(range(5000)) and len({r["seq"] for r in rows}) == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_line_fails_whatever_columns_are_read(spark, scratch):
    from tidemark.schemas import LOGIN_EVENT
    with open(os.path.join(scratch, "a.csv"), "w") as f:
        f.write("1,1.1.1.1,fail,5\nx,1.1.1.1,fail,y\n")
    df = read_delimited(spark, scratch, LOGIN_EVENT, with_seq=False)
    for read in (lambda: df.count(), lambda: df.groupBy("state").count().collect()):
        with pytest.raises(Exception):
            read()

"""Golden values on the sample files (values computed from the files)."""

from pyspark.sql import functions as F

from helpers import fixture
from tidemark import schemas
from tidemark.functions.time import format_local
from tidemark.operators import detect, late, windows
from tidemark.plans import jobs
from tidemark.sources.text import read_access_log, read_delimited


def _logins(spark):
    return read_delimited(spark, fixture("login_events.csv"), schemas.LOGIN_EVENT)


def _clicks(spark):
    return read_delimited(spark, fixture("ad_clicks.csv"), schemas.AD_CLICK)


def test_click_cap_gold(spark):
    passed, warn = detect.click_cap(_clicks(spark), 100)
    assert passed.count() == 123
    w = warn.collect()
    assert len(w) == 1
    assert (w[0].user_id, w[0].ad_id) == (937166, 1715)
    assert int(w[0].ts.timestamp()) == 1511661702
    assert w[0].msg == " warning: flush click and more than 100"
    hot = passed.filter((F.col("user_id") == 937166) & (F.col("ad_id") == 1715)).count()
    assert hot == 101
    by_prov = {r.province: r["count"] for r in passed.groupBy("province").count().collect()}
    assert by_prov == {"beijing": 103, "guangdong": 5, "zhejiang": 5, "jiangsu": 4, "henan": 3,
                       "shanghai": 2, "hebei": 1}


def test_province_sliding_after_cap(spark):
    counts, _ = jobs.ad_counts_by_province(_clicks(spark), 100, 3600, 5)
    rows = counts.collect()
    assert len(rows) == 5988
    at = {(r.window_end, r.province): r["count"] for r in rows}
    assert at[(1511661600, "beijing")] == 2
    assert at[(1511661600, "guangdong")] == 5
    assert at[(1511661600, "shanghai")] == 2
    assert at[(1511662000, "beijing")] == 101
    assert max(r["count"] for r in rows) == 102
    assert len([k for k in at if k[0] == 1511661600]) == 3


def test_province_sliding_without_cap(spark):
    c = windows.sliding_count(_clicks(spark), "ts", ["province"], 3600, 5)
    assert c.count() == 5991


def test_login_pairs_gold(spark):
    lg = _logins(spark)
    assert detect.fail_pairs(lg, 2, order="arrival").count() == 0
    ev = detect.fail_pairs(lg, 2).collect()
    assert [(r.user_id, int(r.first_fail_ts.timestamp()), int(r.last_fail_ts.timestamp()))
            for r in ev] == [(1035, 1558430842, 1558430843)]
    assert ev[0].warning_msg == "warning: fail times more than 2 in 2 seconds"
    for keyed in (True, False):
        seq = detect.fail_sequences(lg, 2, keyed=keyed).collect()
        assert [(r.user_id, int(r.first_fail_ts.timestamp()), int(r.last_fail_ts.timestamp()))
                for r in seq] == [(1035, 1558430842, 1558430843)]
        assert seq[0].warning_msg == "fail 2 times in 2 seconds"


def test_login_burst_gold(spark):
    assert detect.fail_bursts(_logins(spark), 2, 2).count() == 0


def test_lateness_script_gold(spark):
    log = read_access_log(spark, fixture("access_lateness.log"))
    routed = late.route_late(log, 600, 10, 1, 60, arrival=["arrival"])
    late_rows = routed.filter("is_late").select(format_local("ts", "+08:00", "HH:mm:ss").alias("t"))
    assert [r.t for r in late_rows.collect()] == ["21:55:49"]
    counts = late.accepted_window_counts(routed, [], 600, 10, 60)
    end = format_local(F.timestamp_seconds("window_end"), "+08:00", "HH:mm:ss")
    got = {r.e: r.pv_count for r in counts.select(end.alias("e"), "pv_count").collect()}
    assert len(got) == 68
    assert got["22:05:40"] == 1
    assert got["22:05:50"] == 3
    assert all(got[f"22:06:{s:02d}"] == 5 for s in range(0, 60, 10))
    assert got["22:07:00"] == 8
    # the row at 22:05:43 is accepted in all its 60 windows
    acc = routed.filter(~F.col("is_late")).select(format_local("ts", "+08:00", "HH:mm:ss").alias("t"))
    assert "22:05:43" in [r.t for r in acc.collect()]


def test_access_log_parse(spark):
    log = read_access_log(spark, fixture("access_lateness.log"))
    rows = log.orderBy("arrival").collect()
    assert len(rows) == 9
    first = rows[0]
    assert (first.ip, first.user_id, first.method, first.url) == (
        "16.105.14.53", "-", "GET", "/blog/tags/puppet")
    # wall-clock 17/05/2015 22:05:52 read at +08:00
    assert int(first.ts.timestamp()) == 1431871552

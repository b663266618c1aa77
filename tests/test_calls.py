"""Call-record analysis: the published golden and edge cases."""

import datetime as dt

from driftwood.operators import calls as C
from driftwood.schemas import CDR_SCHEMA

# Fixture F1 (36 call-detail records), re-typed.
IPDR = """2021-04-0212:23:10,2021-04-0212:24:48,1,10819,9960,app1
2021-04-0212:28:56,2021-04-0212:33:12,1,16067,10663,app1
2021-04-0216:24:21,2021-04-0216:38:28,2,1173,4265,app1
2021-04-0215:08:57,2021-04-0215:20:56,2,1200,192,app2
2021-04-0215:08:57,2021-04-0215:20:41,2,175130,101657,app2
2021-04-0215:09:22,2021-04-0215:21:02,2,1440,0,app2
2021-04-0215:09:22,2021-04-0215:20:35,2,3672,1152,app2
2021-04-0215:09:22,2021-04-0215:21:08,2,1440,0,app2
2021-04-0215:54:46,2021-04-0216:11:49,3,10932,5504,app3
2021-04-0215:54:46,2021-04-0215:55:34,3,500,580,app3
2021-04-0215:54:46,2021-04-0215:54:47,3,592,656,app3
2021-04-0215:54:46,2021-04-0216:11:48,3,382607,350215,app3
2021-04-0215:54:46,2021-04-0216:11:44,3,7728,5392,app3
2021-04-0215:54:46,2021-04-0216:11:30,3,1702305,1439409,app3
2021-04-0212:13:11,2021-04-0212:23:27,3,271,6030,app4
2021-04-0216:15:17,2021-04-0216:25:24,3,3524,663,app4
2021-04-0217:38:02,2021-04-0217:50:15,3,3358597,3733223,app4
2021-04-0217:44:16,2021-04-0217:57:03,3,4672568,4547960,app4
2021-04-0212:14:42,2021-04-0212:24:56,4,1456,968,app3
2021-04-0212:14:43,2021-04-0212:14:43,4,524,488,app3
2021-04-0212:14:43,2021-04-0212:14:43,4,940,760,app3
2021-04-0220:53:24,2021-04-0221:04:25,4,145880,64046,app3
2021-04-0220:53:25,2021-04-0220:53:34,4,1136,680,app3
2021-04-0220:53:25,2021-04-0220:53:39,4,1660,1132,app3
2021-04-0212:14:42,2021-04-0212:24:45,4,2328,2441,app3
2021-04-0212:14:42,2021-04-0212:24:55,4,668,408,app3
2021-04-0212:14:42,2021-04-0212:24:56,4,668,408,app3
2021-04-0220:53:24,2021-04-0221:04:13,4,496200,340357,app3
2021-04-0220:53:24,2021-04-0221:04:16,4,4312,896,app3
2021-04-0220:53:24,2021-04-0221:04:16,4,11792,2481,app3
2021-04-0222:27:36,2021-04-0222:34:55,4,6569,577,app4
2021-04-0222:30:52,2021-04-0222:34:55,4,27334,2478,app4
2021-04-0222:32:33,2021-04-0222:34:55,4,4162,343,app4
2021-04-0222:33:29,2021-04-0222:34:55,4,168536,27621,app4
2021-04-0222:34:15,2021-04-0222:34:55,4,7164,1348,app4
2021-04-0222:34:43,2021-04-0222:34:55,4,4311,1289,app4"""

# Golden result (msisdn, domain, duration_sec, fdr_count, kbps, is_audio, is_video).
GOLDEN = {
    (1, "app1", 602, 2, 2219.59), (2, "app1", 247, 1, 619.21), (2, "app2", 131, 5, 61377.55),
    (3, "app3", 423, 6, 259735.37), (3, "app4", 16, 1, 11075.98), (3, "app4", 7, 1, 16822.77),
    (3, "app4", 541, 2, 848031.03), (4, "app3", 14, 6, 24221.65), (4, "app3", 61, 6, 493603.89),
    (4, "app4", 439, 6, 16127.48),
}


def _records(spark, text=IPDR):
    rows = [line.split(",") for line in text.splitlines()]
    typed = [(a, b, int(c), int(d), int(e), f) for a, b, c, d, e, f in rows]
    return C.parse_record_times(spark.createDataFrame(typed, CDR_SCHEMA))


def test_golden_calls(spark):
    out = C.result_columns(C.analyze_calls(_records(spark))).collect()
    got = {(r.msisdn, r.domain, r.duration_sec, r.fdr_count, r.kbps) for r in out}
    assert got == GOLDEN
    assert all(r.is_video and not r.is_audio for r in out)


def test_golden_summary(spark):
    s = C.summarize_calls(C.analyze_calls(_records(spark))).collect()[0]
    assert (s.total_calls, s.audio_calls, s.video_calls) == (10, 0, 10)
    assert abs(s.avg_duration_sec - 248.1) < 1e-9
    assert abs(s.avg_bitrate_kbps - 173383.452) < 1e-6
    assert (s.total_msisdns, s.total_domains) == (4, 4)


def test_true_kbps_option(spark):
    out = C.analyze_calls(_records(spark), bitrate_unit="kbps").collect()
    assert len(out) == 4
    assert sum(r.is_audio for r in out) == 3 and sum(r.is_video for r in out) == 1


def test_csv_source_keeps_corrupt_rows(spark, tmp_path):
    from driftwood.sources.files import read_cdr_csv
    p = tmp_path / "ipdr.csv"
    p.write_text("starttime,endtime,msisdn,ulvolume,dlvolume,domain\n" + IPDR
                 + "\nnot,a,valid,row,at,all\n")
    from driftwood.sources.files import split_corrupt
    df = read_cdr_csv(spark, str(p))
    good, bad = split_corrupt(df)
    assert bad.collect()[0]["_corrupt_record"] == "not,a,valid,row,at,all"
    assert good.count() == 36
    calls = C.analyze_calls(C.parse_record_times(good))
    assert calls.count() == 10


def _edge(spark, rows):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 1, 1, *s), dt.datetime(2021, 1, 1, *e), m, 1000, 1000, "d")
         for s, e, m in rows],
        "start_dt timestamp, end_dt timestamp, msisdn long, ulvolume long, dlvolume long, domain string")
    return C.sessionize(C.idle_trim(df))


def test_gap_of_exactly_five_minutes_stays_one_call(spark):
    s = _edge(spark, [((10, 0, 0), (10, 1, 0), 1), ((10, 6, 0), (10, 7, 0), 1)])
    assert {r.call_no for r in s.collect()} == {0}


def test_gap_over_five_minutes_starts_new_call(spark):
    s = _edge(spark, [((10, 0, 0), (10, 1, 0), 1), ((10, 6, 1), (10, 7, 0), 1)])
    assert sorted(r.call_no for r in s.collect()) == [0, 1]


def test_exactly_ten_minute_record_alone_is_dropped(spark):
    s = _edge(spark, [((10, 0, 0), (10, 10, 0), 1)])
    assert C.classify_calls(C.call_aggregates(s)).count() == 0


def test_null_key_is_left_out(spark):
    s = _edge(spark, [((10, 0, 0), (10, 1, 0), None), ((10, 0, 0), (10, 1, 0), 2)])
    assert [r.msisdn for r in s.collect()] == [2]


def test_nested_record_previous_vs_running_max(spark):
    # A long record, a short one inside it, then one 6 minutes after the
    # short one but inside the long one's reach.
    rows = [((10, 0, 0), (10, 30, 0), 1), ((10, 1, 0), (10, 2, 0), 1),
            ((10, 8, 0), (10, 9, 0), 1)]
    prev = _edge(spark, rows)
    df = prev.select("start_dt", "end_dt", "msisdn", "ulvolume", "dlvolume", "domain")
    runmax = C.sessionize(C.idle_trim(df.drop("call_no")), gap_from="running_max")
    assert max(r.call_no for r in prev.collect()) == 1
    assert max(r.call_no for r in runmax.collect()) == 0


def test_bucket_split_matches_single_bucket(spark):
    """The skew split (key, time bucket) gives the same calls for any bucket."""
    from driftwood.plans.views import cdr
    base = C.idle_trim(cdr(spark, "/root/testdata/sf0.001"))
    order = ("end_dt", "ulvolume", "dlvolume", "event_id")
    cols = ["msisdn", "domain", "event_id", "call_no"]
    for rule in ("previous", "running_max"):
        fine = C.sessionize(base, order=order, bucket="1 minute", gap_from=rule).select(*cols)
        coarse = C.sessionize(base, order=order, bucket="3650 days", gap_from=rule).select(*cols)
        assert fine.exceptAll(coarse).count() == 0 and coarse.exceptAll(fine).count() == 0


def test_call_sessions_match_numbered_records(spark):
    """The call-level form equals aggregating the numbered records, for
    buckets finer and coarser than the calls."""
    from driftwood.plans.views import cdr
    base = C.idle_trim(cdr(spark, "/root/testdata/sf0.001"))
    order = ("end_dt", "ulvolume", "dlvolume", "event_id")
    for rule in ("previous", "running_max"):
        want = C.call_aggregates(C.sessionize(base, order=order, gap_from=rule))
        for bucket in ("1 minute", "10 minutes", "3650 days"):
            got = C.call_sessions(base, order=order, bucket=bucket, gap_from=rule)
            assert got.columns == want.columns
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_call_sessions_read_records_once(spark):
    """The records are scanned and shuffled by one job (the checkpointed
    partial calls); the calls themselves read only the checkpoint."""
    from driftwood.plans.views import cdr
    base = C.idle_trim(cdr(spark, "/root/testdata/sf0.001"))
    cls = type(base)
    plans = []
    orig = cls.checkpoint

    def spy(self, *a, **k):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return orig(self, *a, **k)

    cls.checkpoint = spy
    try:
        calls = C.call_sessions(base, order=("end_dt", "ulvolume", "dlvolume", "event_id"))
    finally:
        cls.checkpoint = orig
    assert len(plans) == 1
    assert plans[0].count("FileScan") == 1
    assert plans[0].count("Exchange hashpartitioning") == 1
    final = calls._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in final and "ExistingRDD" in final

"""Session invariants: random records against a brute-force
implementation of both gap rules, with buckets small enough that calls
cross bucket boundaries."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from driftwood.operators import calls as C

T0 = dt.datetime(2024, 1, 1)
GAP = 300  # seconds

records = st.lists(
    st.tuples(st.integers(0, 2),            # key
              st.integers(0, 4 * 3600),     # start offset (s)
              st.integers(0, 1800)),        # length (s)
    min_size=1, max_size=40)


def brute(rows, rule):
    out = {}
    by_key = {}
    for i, (k, s, n) in enumerate(rows):
        by_key.setdefault(k, []).append((s, s + n, i))
    for k, recs in by_key.items():
        recs.sort(key=lambda r: (r[0], r[1], r[2]))
        call, prev_end, max_end = 0, None, None
        for j, (s, e, i) in enumerate(recs):
            ref = prev_end if rule == "previous" else max_end
            if j and s - ref > GAP:
                call += 1
            out[i] = call
            prev_end = e
            max_end = e if max_end is None else max(max_end, e)
    return out


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=records)
def test_sessions_match_brute_force(spark, rows):
    df = spark.createDataFrame(
        [(k, T0 + dt.timedelta(seconds=s), T0 + dt.timedelta(seconds=s + n), i, i, "d")
         for i, (k, s, n) in enumerate(rows)],
        "msisdn long, start_dt timestamp, end_dt timestamp, ulvolume long, dlvolume long, "
        "domain string")
    for rule in ("previous", "running_max"):
        got = {r.ulvolume: r.call_no for r in
               C.sessionize(df, gap_from=rule, bucket="7 minutes",
                            order=("end_dt", "ulvolume")).collect()}
        assert got == brute(rows, rule), rule
        # the call-level form (records ordered once, partial calls stitched
        # across buckets) gives the same calls
        want = {}
        for i, (k, _, _) in enumerate(rows):
            c = want.setdefault((k, brute(rows, rule)[i]), [0, 0])
            c[0], c[1] = c[0] + 1, c[1] + i
        calls = {(r.msisdn, r.call_no): [r.fdr_count, r.ul_bytes] for r in
                 C.call_sessions(df, gap_from=rule, bucket="7 minutes", adjusted_end="end_dt",
                                 order=("end_dt", "ulvolume")).collect()}
        assert calls == want, rule

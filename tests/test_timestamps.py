"""Timestamp differences with numeric offsets: golden and edge cases."""

from pyspark.sql import functions as F

from driftwood.functions.timestamps import parse_offset_timestamp, timestamp_diff
from driftwood.operators.timediff import case_differences, case_results_json
from driftwood.sources.files import read_pairs

# Fixture F2, re-typed.
PAIRS = """2
Sun 10 May 2015 13:54:36 -0700
Sun 10 May 2015 13:54:36 -0000
Sat 02 May 2015 19:54:36 +0530
Fri 01 May 2015 13:54:36 -0000
"""


def test_golden_pairs(spark, tmp_path):
    (tmp_path / "input.txt").write_text(PAIRS)
    cases = case_differences(read_pairs(spark, str(tmp_path)))
    got = [r.diff_seconds for r in cases.orderBy("case_id").collect()]
    assert got == [25200, 88200]
    js = case_results_json(cases).collect()[0]
    assert js.results == '["25200","88200"]'


def test_edge_formats(spark):
    df = spark.createDataFrame([
        ("Mon 1 Jan 2024 00:00:00 +0545", "Mon 1 Jan 2024 00:00:00 -0000"),
        ("Xyz 31 Mar 2024 01:30:00 +0100", "Sun 31 Mar 2024 01:30:00 +0200"),
        ("Sun 10 Foo 2015 13:54:36 -0700", "Sun 10 May 2015 13:54:36 -0000"),
    ], "t1 string, t2 string")
    out = df.select(timestamp_diff(parse_offset_timestamp("t1"),
                                   parse_offset_timestamp("t2")).alias("d")).collect()
    assert out[0].d == 5 * 3600 + 45 * 60
    assert out[1].d == 3600          # wrong day name is ignored
    assert out[2].d is None          # bad month: null, not a failure


def test_missing_second_line_and_bad_count(spark, tmp_path):
    (tmp_path / "a.txt").write_text("2\nSun 10 May 2015 13:54:36 -0700\n"
                                    "Sun 10 May 2015 13:54:36 -0000\nSat 02 May 2015 19:54:36 +0530\n")
    (tmp_path / "b.txt").write_text("x\n")
    rows = case_differences(read_pairs(spark, str(tmp_path))).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file.rsplit("/", 1)[-1], []).append(r)
    a = sorted(by_file["a.txt"], key=lambda r: r.case_id)
    assert a[0].diff_seconds == 25200 and a[1].diff_seconds is None and a[1].error
    assert by_file["b.txt"][0].error == "invalid case count"
    assert F is not None

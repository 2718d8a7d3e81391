from pyspark.sql import functions as F

from flowstat.operators import windows
from flowstat.plans import tables

from .conftest import SF0001, at, rows


def _ev(spark):
    return tables.table(spark, SF0001, "events").select("event_type", "user_id", "ts")


def test_sliding_methods_agree(spark):
    ev = _ev(spark)
    for keys in (None, "event_type", ["event_type", "user_id"]):
        for size, slide in (("60 minutes", "5 minutes"), ("10 minutes", "1 minute"), ("1 hour", "10 minutes")):
            res = [rows(windows.sliding_count(ev, "ts", keys, size, slide, method=m, bucket="6 hours"),
                        "window_end", "cnt", *([] if keys is None else ([keys] if isinstance(keys, str) else keys)))
                   for m in ("window", "panes", "difference")]
            assert res[0] == res[1] == res[2], (keys, size, slide)


def test_sliding_sum_invariant(spark):
    ev = _ev(spark)
    n = ev.count()
    out = windows.sliding_count(ev, "ts", "event_type", "1 hour", "5 seconds", method="difference")
    assert out.agg(F.sum("cnt")).first()[0] == n * 720


def test_size_not_multiple_of_slide(spark):
    ev = _ev(spark)
    a = rows(windows.sliding_count(ev, "ts", "event_type", "25 minutes", "10 minutes", method="window"),
             "event_type", "window_end", "cnt")
    b = rows(windows.sliding_count(ev, "ts", "event_type", "25 minutes", "10 minutes", method="difference"),
             "event_type", "window_end", "cnt")
    c = rows(windows.sliding_count(ev, "ts", "event_type", "25 minutes", "10 minutes", method="panes"),
             "event_type", "window_end", "cnt")
    assert a == b == c


def test_window_boundary_row(spark):
    # a row exactly on a window start belongs to [start, start+size), not the window ending there
    df = spark.createDataFrame([(at(300),), (at(299.999999),)], "ts timestamp_ntz")
    out = rows(windows.sliding_count(df, "ts", None, "10 minutes", "5 minutes", method="difference"),
               "window_end", "cnt")
    assert out == [(at(300), 1), (at(600), 2), (at(900), 1)]
    assert out == rows(windows.sliding_count(df, "ts", None, "10 minutes", "5 minutes", method="window"),
                       "window_end", "cnt")


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, ts timestamp_ntz")
    for m in ("window", "panes", "difference"):
        assert windows.sliding_count(df, "ts", "k", "1 hour", "5 minutes", method=m).count() == 0


def test_salted_equals_plain(spark):
    ev = _ev(spark)
    a = rows(windows.tumbling_count(ev, "ts", None, "1 hour"), "window_end", "cnt")
    b = rows(windows.salted_count(ev, "ts", "1 hour", salt_col="user_id", n=10), "window_end", "cnt")
    assert a == b


def test_ltz_timestamps(spark):
    df = spark.createDataFrame([(at(1),), (at(7),)], "ts timestamp_ntz").select(F.col("ts").cast("timestamp").alias("ts"))
    a = rows(windows.sliding_count(df, "ts", None, "10 seconds", "5 seconds", method="difference"), "window_end", "cnt")
    b = rows(windows.sliding_count(df, "ts", None, "10 seconds", "5 seconds", method="window"), "window_end", "cnt")
    assert a == b and [c for _, c in a] == [1, 2, 1]


def test_sliding_count_open_methods_and_edges(spark):
    # 10 s windows sliding by 5 s, lateness 2 s; the second row sees watermark 20 s
    df = spark.createDataFrame([(at(20), None), (at(12), at(20)), (at(17.5), at(20))],
                               "ts timestamp_ntz, watermark timestamp_ntz")
    a = rows(windows.sliding_count_open(df, "ts", None, "10 seconds", "5 seconds", "watermark", "2 seconds",
                                        method="window"), "window_end", "cnt")
    b = rows(windows.sliding_count_open(df, "ts", None, "10 seconds", "5 seconds", "watermark", "2 seconds",
                                        method="difference"), "window_end", "cnt")
    # row 12 s: windows end 15 (15 - 0.001 + 2 <= 20: closed) and 20 (21.999 > 20: open)
    # row 17.5 s: windows end 20, 25 (both open); row 20 s: windows end 25, 30
    assert a == b == [(at(20), 2), (at(25), 2), (at(30), 1)]
    # with a null watermark everywhere it equals the plain count
    ev = _ev(spark).withColumn("watermark", F.lit(None).cast("timestamp_ntz"))
    c = rows(windows.sliding_count_open(ev, "ts", "event_type", "1 hour", "5 minutes", "watermark", "0 seconds"),
             "event_type", "window_end", "cnt")
    d = rows(windows.sliding_count(ev, "ts", "event_type", "1 hour", "5 minutes"), "event_type", "window_end", "cnt")
    assert c == d

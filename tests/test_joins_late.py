from flowstat.operators import joins, late

from .conftest import at, rows


def test_interval_bounds_inclusive(spark):
    pays = spark.createDataFrame([(1, 10, at(100)), (2, 11, at(100))], "k long, pay_id long, pay_ts timestamp_ntz")
    recs = spark.createDataFrame(
        [(1, 20, at(97)), (1, 21, at(96.999)), (1, 22, at(105)), (1, 23, at(105.001)), (3, 24, at(100))],
        "k long, rec_id long, rec_ts timestamp_ntz")
    inner = joins.interval_join(pays, recs, "k", "pay_ts", "rec_ts", "-3 seconds", "5 seconds")
    assert rows(inner, "pay_id", "rec_id") == [(10, 20), (10, 22)]
    m, lu, ru = joins.interval_match(pays, recs, "k", "pay_ts", "rec_ts", "pay_id", "rec_id",
                                     "-3 seconds", "5 seconds", bucket="1 second")
    assert rows(m, "pay_id", "rec_id") == [(10, 20), (10, 22)]
    assert rows(lu, "pay_id") == [(11,)]
    assert rows(ru, "rec_id") == [(21,), (23,), (24,)]
    full = joins.full_outer_interval(pays, recs, "k", "pay_ts", "rec_ts", "pay_id", "rec_id", "-3 seconds", "5 seconds")
    assert full.count() == 2 + 1 + 3


def test_late_split_partial_windows(spark):
    # size 10 s, slide 5 s, no disorder bound, no lateness.  Arrival order by `arr`.
    data = [(1, at(20), at(0)),      # watermark -> 20
            (2, at(12), at(1)),      # windows end 15, 20: last end 20 s - 1 ms <= watermark 20 s: late
            (3, at(16), at(2)),      # windows end 20 (closed), 25 (open): counted, not late
            (4, at(30), at(3))]
    df = spark.createDataFrame(data, "seq long, ts timestamp_ntz, arr timestamp_ntz")
    on_time, late_df = late.split_late(df, "ts", "arr", "seq", "0 seconds", "10 seconds", "5 seconds", "0 seconds",
                                       chunk="1 second")
    assert rows(late_df, "seq") == [(2,)]
    assert rows(on_time, "seq") == [(1,), (3,), (4,)]
    _, late2 = late.split_late(df, "ts", "arr", "seq", "0 seconds", "10 seconds", "5 seconds", "1 second")
    assert late2.count() == 0


def test_interval_duplicate_keys_and_empty(spark):
    pays = spark.createDataFrame([(1, 10, at(100)), (1, 11, at(101))], "k long, pay_id long, pay_ts timestamp_ntz")
    recs = spark.createDataFrame([(1, 20, at(102)), (1, 21, at(103))], "k long, rec_id long, rec_ts timestamp_ntz")
    inner = joins.interval_join(pays, recs, "k", "pay_ts", "rec_ts", "-3 seconds", "5 seconds")
    assert rows(inner, "pay_id", "rec_id") == [(10, 20), (10, 21), (11, 20), (11, 21)]
    empty = recs.limit(0)
    m, lu, ru = joins.interval_match(pays, empty, "k", "pay_ts", "rec_ts", "pay_id", "rec_id")
    assert (m.count(), lu.count(), ru.count()) == (0, 2, 0)
    on_time, late_df = late.split_late(pays.limit(0).withColumnRenamed("pay_id", "seq"), "pay_ts", "pay_ts", "seq")
    assert on_time.count() == 0 and late_df.count() == 0

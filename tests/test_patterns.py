from pyspark.sql import functions as F

from flowstat.operators import capping, patterns

from .conftest import at, rows

LOGIN = "user_id long, seq long, event_type string, ts timestamp_ntz"


def _logins(spark):
    # arrival order = seq; user 1: fail 0, fail 2 (gap exactly 2 s), fail 5 (gap 3 s), success 5.5,
    # fail 6 (after a success), fail 5.9 (arrives late: negative gap -0.1 s)
    data = [(1, 1, "fail", at(0)), (1, 2, "fail", at(2)), (1, 3, "fail", at(5)), (1, 4, "success", at(5.5)),
            (1, 5, "fail", at(6)), (1, 6, "fail", at(5.9)),
            (2, 7, "fail", at(0)), (2, 8, "fail", at(0))]            # equal timestamps
    return spark.createDataFrame(data, LOGIN)


def test_consecutive_inclusive_and_negative_gap(spark):
    fail = F.col("event_type") == "fail"
    out = rows(patterns.consecutive(_logins(spark), "user_id", fail, "ts", "seq", "2 seconds", chunk=2),
               "user_id", "seq")
    assert out == [(1, 2), (1, 6), (2, 8)]
    strict = rows(patterns.consecutive(_logins(spark), "user_id", fail, "ts", "seq", "2 seconds", inclusive=False),
                  "user_id", "seq")
    assert strict == [(1, 6), (2, 8)]
    no_neg = rows(patterns.consecutive(_logins(spark), "user_id", fail, "ts", "seq", "2 seconds", min_gap=0),
                  "user_id", "seq")
    assert no_neg == [(1, 2), (2, 8)]


def test_match_next_event_time_order(spark):
    fail = F.col("event_type") == "fail"
    out = rows(patterns.match_next(_logins(spark), "user_id", fail, fail, "ts", "seq", "2 seconds", chunk="3 seconds"),
               "user_id", "first_fail", "last_fail")
    # event-time order of user 1: 0 f, 2 f, 5 f, 5.5 s, 5.9 f, 6 f -> (5.9, 6) only (0->2 is not < 2 s)
    assert out == [(1, at(5.9), at(6)), (2, at(0), at(0))]


def test_burst(spark):
    fail = F.col("event_type") == "fail"
    df = spark.createDataFrame(
        [(1, 1, "fail", at(0)), (1, 2, "fail", at(1)), (1, 3, "fail", at(2)), (1, 4, "fail", at(2.5)),
         (1, 5, "fail", at(4.4)),                                 # anchor 0 -> [0, 2]: 3 fails; anchor 2.5 -> 2 fails
         (2, 6, "fail", at(0)), (2, 7, "success", at(1)), (2, 8, "fail", at(1.5)),   # success cancels
         (3, 9, "fail", at(0)),
         (4, 10, "fail", at(0)), (4, 11, "fail", at(1)), (4, 12, "success", at(1.5)),   # cancelled in span
         (5, 13, "fail", at(0)), (5, 14, "fail", at(1)), (5, 15, "success", at(2.5)),   # success after expiry
         (6, 16, "fail", at(0)), (6, 17, "fail", at(2)), (6, 18, "success", at(2))],    # success at the bound
        LOGIN)
    out = rows(patterns.burst(df, "user_id", fail, ~fail, "ts", "seq", "2 seconds"),
               "user_id", "first_fail", "last_fail", "n_fails")
    assert out == [(1, at(0), at(2), 3), (1, at(2.5), at(4.4), 2), (5, at(0), at(1), 2)]


ORDER = "order_id long, seq long, event_type string, ts timestamp_ntz"


def test_followed_by(spark):
    df = spark.createDataFrame(
        [(1, 1, "create", at(0)), (1, 2, "pay", at(0)),           # equal time, create first -> match
         (2, 4, "pay", at(0)), (2, 5, "create", at(0)),           # equal time, pay first -> no
         (3, 6, "create", at(0)), (3, 7, "pay", at(900)),         # exactly 15 min -> timeout
         (4, 8, "create", at(0)), (4, 9, "pay", at(899.5)),
         (5, 10, "create", at(0)), (5, 11, "create", at(10)), (5, 12, "pay", at(20))],   # both take the pay
        ORDER)
    m, t = patterns.followed_by(df, "order_id", F.col("event_type") == "create", F.col("event_type") == "pay",
                                "ts", "seq", "15 minutes", chunk="7 seconds")
    assert rows(m, "order_id", "seq", "then_seq") == [(1, 1, 2), (4, 8, 9), (5, 10, 12), (5, 11, 12)]
    assert rows(t, "order_id", "seq") == [(2, 5), (3, 6)]


def test_pair_status(spark):
    df = spark.createDataFrame(
        [(1, 1, "create", at(0)), (1, 2, "pay", at(899)),
         (2, 3, "create", at(0)), (2, 4, "pay", at(900)),
         (3, 5, "pay", at(5)), (3, 6, "create", at(10)),
         (4, 7, "pay", at(5)),
         (5, 8, "create", at(0))],
        ORDER)
    out = rows(patterns.pair_status(df, "order_id", F.col("event_type") == "create", F.col("event_type") == "pay",
                                    "ts", "15 minutes"), "order_id", "status")
    assert out == [(1, "payed"), (2, "timeout"), (3, "pay_without_create"), (3, "timeout"),
                   (4, "pay_without_create"), (5, "timeout")]


def test_cap_and_flag(spark):
    data = [(7, 42, i, at(i)) for i in range(1, 103)]                 # 102 clicks on day 1
    data += [(7, 42, 200, at(86400 + 1))]                             # next day resets
    data += [(8, 42, 300, at(86400 - 1)), (8, 42, 301, at(86400))]    # midnight
    df = spark.createDataFrame(data, "user_id long, ad_id long, seq long, ts timestamp_ntz")
    passed, warned = capping.cap_and_flag(df, ["user_id", "ad_id"], "ts", "seq", limit=100, chunk=16)
    p = rows(passed, "user_id", "seq")
    assert len([x for x in p if x[0] == 7]) == 101 and (7, 100) in p and (7, 101) not in p and (7, 200) in p
    assert rows(warned, "user_id", "ad_id", "seq") == [(7, 42, 101)]
    # in UTC+8 the midnight falls elsewhere: 16:00 UTC
    passed8, _ = capping.cap_and_flag(df, ["user_id", "ad_id"], "ts", "seq", limit=100, zone="Asia/Shanghai")
    assert passed8.where("user_id = 8").select("day").distinct().count() == 1


def test_empty_patterns(spark):
    df = spark.createDataFrame([], LOGIN)
    fail = F.col("event_type") == "fail"
    assert patterns.consecutive(df, "user_id", fail, "ts", "seq").count() == 0
    assert patterns.burst(df, "user_id", fail, ~fail, "ts", "seq").count() == 0


def test_burst_long_run_across_batches(spark):
    # one key failing every second for a long stretch: the scan crosses Arrow batch borders
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        fail = F.col("event_type") == "fail"
        df = spark.createDataFrame([(1, i, "fail", at(i)) for i in range(50)] + [(1, 99, "success", at(49.5))], LOGIN)
        out = rows(patterns.burst(df, "user_id", fail, ~fail, "ts", "seq", "2 seconds"), "first_fail", "n_fails")
        # anchors 0, 3, 6, ..., 48: each window [a, a+2] holds 3 failures; the last one (48, 49) is cancelled
        assert out == [(at(a), 3) for a in range(0, 48, 3)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

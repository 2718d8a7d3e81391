"""Small invented logs under tests/data; expected numbers by hand.

Seconds below are after 1,700,000,000 (22:13:20 UTC)."""

import os

from pyspark.sql import functions as F

from flowstat.operators import capping, joins, patterns, windows
from flowstat.sources import read_records

from .conftest import rows

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")
LOGIN, ADS, ORDERS, RECEIPTS = (f"{DATA}/{n}" for n in ("LoginLog.csv", "AdClickLog.csv", "OrderLog.csv", "ReceiptLog.csv"))
T0 = 1_700_000_000


def _secs(found):
    return [(u, int(a.timestamp()) - T0, int(b.timestamp()) - T0) for u, a, b in found]


def test_login_consecutive_and_sequence(spark):
    df = read_records(spark, LOGIN, "login")
    fail = F.col("event_type") == "fail"
    # arrival order: 5-7 (at the bound), 7-8; 14 arrives as 41 then 40 (a negative gap)
    c1 = _secs(rows(patterns.consecutive(df, "user_id", fail, "ts", "seq", "2 seconds"), "user_id", "first_fail", "last_fail"))
    assert c1 == [(11, 5, 7), (11, 7, 8), (14, 41, 40)]
    # event time, strictly inside the bound
    c3 = _secs(rows(patterns.match_next(df, "user_id", fail, fail, "ts", "seq", "2 seconds"), "user_id", "first_fail", "last_fail"))
    assert c3 == [(11, 7, 8), (14, 40, 41)]
    burst = rows(patterns.burst(df, "user_id", fail, ~fail, "ts", "seq", "2 seconds"), "user_id", "n_fails")
    assert burst == [(11, 2), (14, 2)]


def test_order_timeout_and_status(spark):
    df = read_records(spark, ORDERS, "order")
    create, pay = F.col("event_type") == "create", F.col("event_type") == "pay"
    m, t = patterns.followed_by(df, "order_id", create, pay, "ts", "seq", "15 minutes")
    assert rows(m, "order_id") == [(1,), (5,), (6,)]
    assert rows(t, "order_id") == [(2,), (3,)]              # 3 pays exactly at the bound
    status = rows(patterns.pair_status(df, "order_id", create, pay, "ts", "15 minutes"), "order_id", "status")
    assert status == [(1, "payed"), (2, "timeout"), (3, "timeout"), (4, "pay_without_create"), (5, "payed"),
                      (6, "pay_without_create"), (6, "payed")]


def test_tx_match(spark):
    pays = read_records(spark, ORDERS, "order").where("event_type = 'pay'").select("tx_id", F.col("ts").alias("pay_ts"), "order_id", F.col("seq").alias("pay_key"))
    recs = read_records(spark, RECEIPTS, "receipt").select("tx_id", F.col("ts").alias("receipt_ts"), "pay_channel", F.col("seq").alias("receipt_key"))
    inner = joins.interval_join(pays, recs, "tx_id", "pay_ts", "receipt_ts", "-3 seconds", "5 seconds")
    assert rows(inner, "tx_id") == [("tx1",), ("tx4",)]      # +5 and -3 are inside; -4 and +6 are not
    m, lu, ru = joins.interval_match(pays, recs, "tx_id", "pay_ts", "receipt_ts", "pay_key", "receipt_key", "-3 seconds", "5 seconds")
    assert rows(m, "tx_id") == [("tx1",), ("tx4",)]
    assert rows(lu, "tx_id") == [("tx3",), ("tx5",), ("tx6",), ("tx7",)]
    assert rows(ru, "tx_id") == [("tx3",), ("tx5",), ("tx6",), ("tx9",)]


def test_blacklist(spark):
    df = read_records(spark, ADS, "ad_click")
    passed, warned = capping.cap_and_flag(df, ["user_id", "ad_id"], "ts", "seq", limit=100, zone="Asia/Shanghai")
    assert passed.count() == 102
    assert rows(warned, "user_id", "ad_id") == [(7, 42)]


def test_province_sliding(spark):
    df = read_records(spark, ADS, "ad_click")
    out = windows.sliding_count(df, "ts", "province", "1 hour", "5 seconds")
    agg = out.agg(F.sum("cnt"), F.max("cnt")).first()
    assert tuple(agg) == (107 * 720, 106)
    same = windows.sliding_count(df, "ts", "province", "1 hour", "5 seconds", method="window")
    assert rows(out, "province", "window_end", "cnt") == rows(same, "province", "window_end", "cnt")


def test_arrival_order_of_several_files(spark, tmp_path):
    """Files by name, lines by place, though Spark reads the larger file first."""
    (tmp_path / "a.csv").write_text("1,10.0.0.1,fail,5\n2,10.0.0.1,fail,4\n")
    (tmp_path / "b.csv").write_text("".join(f"{u},10.0.0.1,fail,3\n" for u in range(3, 3003)))
    got = read_records(spark, str(tmp_path), "login").orderBy("seq").select("user_id").collect()
    assert [r.user_id for r in got] == list(range(1, 3003))


def test_malformed_messages_fail_fast(spark):
    import pytest
    from flowstat.sources import parse_csv_lines
    lines = spark.createDataFrame([("1,pay,tx1,notanumber",), ("2,pay,tx2,7",)], "value string")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        parse_csv_lines(lines, "order").collect()
    kept = parse_csv_lines(lines, "order", mode="PERMISSIVE", corrupt_col="bad").collect()
    assert [r.bad for r in kept] == ["1,pay,tx1,notanumber", None]

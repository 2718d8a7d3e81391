"""One user holds a third of all rows: the chunked operators must give the
same answer whether the hot key is split into many chunks or kept whole."""

import pytest
from pyspark.sql import functions as F

from flowstat.operators import capping, distinct, patterns
from flowstat.plans import tables

from .conftest import SF001, rows


@pytest.fixture(autouse=True, params=[50, 1 << 20], ids=["heavy keys", "light keys"])
def heavy_rows(request, monkeypatch):
    """Both ways: keys of more than 50 rows are split, or none is."""
    monkeypatch.setattr("flowstat.operators.ordered.HEAVY_ROWS", request.param)


@pytest.fixture(scope="module")
def skewed(spark):
    ev = tables.table(spark, SF001, "events")
    hot = F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id"))
    return ev.select(F.col("event_id").alias("seq"), "ts", hot.alias("user_id"), "event_type")


def test_hot_key_consecutive_and_next(skewed):
    fail = F.col("event_type") == "error"
    whole = rows(patterns.consecutive(skewed, "user_id", fail, "ts", "seq", "2 hours", chunk=1 << 40), "seq")
    split = rows(patterns.consecutive(skewed, "user_id", fail, "ts", "seq", "2 hours", chunk=97), "seq")
    assert whole == split and len(whole) > 0
    a = rows(patterns.match_next(skewed, "user_id", fail, fail, "ts", "seq", "2 hours", chunk="3650 days"), "seq")
    b = rows(patterns.match_next(skewed, "user_id", fail, fail, "ts", "seq", "2 hours", chunk="1 hour"), "seq")
    assert a == b and len(a) > 0


def test_hot_key_followed_by_and_burst(skewed):
    c, p = F.col("event_type") == "click", F.col("event_type") == "purchase"
    m1, t1 = patterns.followed_by(skewed, "user_id", c, p, "ts", "seq", "1 day", chunk="3650 days")
    m2, t2 = patterns.followed_by(skewed, "user_id", c, p, "ts", "seq", "1 day", chunk="2 hours")
    assert rows(m1, "seq", "then_seq") == rows(m2, "seq", "then_seq")
    assert rows(t1, "seq") == rows(t2, "seq")
    fail = F.col("event_type") == "error"
    b1 = patterns.burst(skewed, "user_id", fail, ~fail, "ts", "seq", "2 hours", chunk="3650 days")
    b2 = patterns.burst(skewed, "user_id", fail, ~fail, "ts", "seq", "2 hours", chunk="2 hours")
    assert rows(b1, "user_id", "first_fail", "n_fails") == rows(b2, "user_id", "first_fail", "n_fails")


def test_hot_key_cap_and_running_distinct(skewed):
    p1, w1 = capping.cap_and_flag(skewed, ["user_id", "event_type"], "ts", "seq", limit=5, chunk=1 << 40)
    p2, w2 = capping.cap_and_flag(skewed, ["user_id", "event_type"], "ts", "seq", limit=5, chunk=13)
    assert rows(p1, "seq") == rows(p2, "seq") and rows(w1, "seq") == rows(w2, "seq")
    d1 = distinct.running_distinct(skewed, "ts", "seq", "user_id", "1 hour", chunk=1 << 40)
    d2 = distinct.running_distinct(skewed, "ts", "seq", "user_id", "1 hour", chunk=7)
    assert rows(d1, "seq", "uv") == rows(d2, "seq", "uv")

"""Stream = batch on closed windows / finalised keys.

The input is sf0.001 events written as parquet files; a second wave holds a
sentinel row far in the future that moves the watermark past everything."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from flowstat.operators import capping, distinct, joins, patterns, windows
from flowstat.plans import tables
from flowstat.streaming import jobs, stateful
from flowstat.streaming.sinks import write_stream

from .conftest import SF0001, rows

SENTINEL_USER = 10 ** 9


@pytest.fixture(scope="module")
def stream_dir(spark):
    d = tempfile.mkdtemp(prefix="flowstat-stream-")
    ev = tables.table(spark, SF0001, "events")
    ev.repartitionByRange(4, "event_id").write.parquet(f"{d}/in")
    return d, ev


def _run(spark, stream_dir, build, mode="append"):
    d, ev = stream_dir
    src = spark.readStream.schema(ev.schema).parquet(f"{d}/in")
    name = "q_" + uuid.uuid4().hex[:8]
    q = write_stream(build(src), name, fmt="memory", mode=mode)
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


@pytest.fixture(scope="module", autouse=True)
def sentinel(spark, stream_dir):
    d, ev = stream_dir
    # written once, before any stream starts: the stream sees it with the data, and since it is
    # far in the future the watermark after the first batch closes every data window
    # one sentinel per event kind used as a stream side (a stream-stream join waits for the slower side)
    sent = spark.createDataFrame([(10 ** 9, "2030-01-01 00:00:00", SENTINEL_USER, "click", 0.0, '{"k": 0}'),
                                  (10 ** 9 + 1, "2030-01-01 00:00:00", SENTINEL_USER, "purchase", 0.0, '{"k": 0}')],
                                 "event_id long, ts string, user_id long, event_type string, value double, props string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    sent.write.mode("append").parquet(f"{d}/in")
    return sent


def test_sliding_stream_equals_batch(spark, stream_dir):
    _, ev = stream_dir
    got = _run(spark, stream_dir, lambda s: jobs.sliding_count_stream(s, "ts", "event_type", "1 hour", "5 minutes"))
    want = windows.sliding_count(ev, "ts", "event_type", "1 hour", "5 minutes").withColumn(
        "window_end", F.col("window_end").cast("timestamp"))
    assert rows(got, "event_type", "window_end", "cnt") == rows(want, "event_type", "window_end", "cnt")


def test_uv_stream_equals_batch(spark, stream_dir):
    _, ev = stream_dir
    got = _run(spark, stream_dir, lambda s: jobs.uv_stream(s, "ts", "user_id", "1 hour"))
    want = distinct.distinct_per_window(ev, "ts", "user_id", "1 hour").withColumn(
        "window_end", F.col("window_end").cast("timestamp"))
    assert rows(got, "window_end", "uv") == rows(want, "window_end", "uv")


def test_uv_stream_bitmap_and_approx(spark, stream_dir):
    _, ev = stream_dir
    for how in ("bitmap", "approx"):
        got = _run(spark, stream_dir, lambda s: jobs.uv_stream(s, "ts", "user_id", "1 hour", how=how))
        want = distinct.distinct_per_window(ev, "ts", "user_id", "1 hour", how).withColumn(
            "window_end", F.col("window_end").cast("timestamp"))
        assert rows(got, "window_end", "uv") == rows(want, "window_end", "uv")


def test_topn_stream_equals_batch(spark, stream_dir):
    _, ev = stream_dir
    beh = lambda df: df.select(F.get_json_object("props", "$.k").cast("long").alias("item_id"), "ts")
    got = _run(spark, stream_dir, lambda s: jobs.top_n_stream(beh(s), "ts", "item_id", "1 hour", "5 minutes", 3))
    from flowstat.operators import topn
    want = topn.top_n(windows.sliding_count(beh(ev), "ts", "item_id", "1 hour", "5 minutes"),
                      "window_end", "item_id", "cnt", 3).withColumn("window_end", F.col("window_end").cast("timestamp"))
    assert rows(got, "window_end", "rn", "item_id", "cnt") == rows(want, "window_end", "rn", "item_id", "cnt")


def test_interval_join_stream(spark, stream_dir):
    _, ev = stream_dir

    def sides(df):
        p = df.where("event_type = 'click'").select("user_id", F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts"))
        r = df.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("receipt_id"),
                                                       F.col("ts").alias("receipt_ts"))
        return p, r

    got = _run(spark, stream_dir, lambda s: jobs.interval_join_stream(*sides(s), "user_id", "pay_ts", "receipt_ts",
                                                                      "-1 hour", "2 hours")) \
        .where(F.col("user_id") != SENTINEL_USER)
    want = joins.interval_join(*sides(ev), "user_id", "pay_ts", "receipt_ts", "-1 hour", "2 hours")
    assert rows(got, "pay_id", "receipt_id") == rows(want, "pay_id", "receipt_id")


def test_consecutive_stream(spark, stream_dir):
    _, ev = stream_dir
    ev2 = ev.withColumnRenamed("event_id", "seq")
    fail = F.col("event_type") == "error"
    got = _run(spark, stream_dir, lambda s: stateful.consecutive_stream(
        s.withColumnRenamed("event_id", "seq"), "user_id", fail, "ts", "seq", "2 hours"))
    want = patterns.consecutive(ev2, "user_id", fail, "ts", "seq", "2 hours")
    assert rows(got, "user_id", "seq") == rows(want, "user_id", "seq")


def test_cap_stream(spark, stream_dir):
    _, ev = stream_dir
    ev2 = ev.withColumnRenamed("event_id", "seq")
    got = _run(spark, stream_dir, lambda s: stateful.cap_and_flag_stream(
        s.withColumnRenamed("event_id", "seq"), ["user_id", "event_type"], "ts", "seq", limit=2)) \
        .where(F.col("user_id") != SENTINEL_USER)
    passed, warned = capping.cap_and_flag(ev2, ["user_id", "event_type"], "ts", "seq", limit=2)
    assert rows(got.where("channel = 'passed'"), "seq") == rows(passed, "seq")
    assert rows(got.where("channel = 'blacklist'"), "seq") == rows(warned, "seq")


def test_order_status_stream(spark, stream_dir):
    _, ev = stream_dir
    c, p = F.col("event_type") == "click", F.col("event_type") == "purchase"
    got = _run(spark, stream_dir, lambda s: stateful.pair_status_stream(s, "user_id", c, p, "ts", "1 day"))
    want = patterns.pair_status(ev, "user_id", c, p, "ts", "1 day")
    assert rows(got, "user_id", "status") == rows(want, "user_id", "status")


def test_match_next_stream(spark, stream_dir):
    _, ev = stream_dir
    fail = F.col("event_type") == "error"
    got = _run(spark, stream_dir, lambda s: stateful.match_next_stream(
        s.withColumnRenamed("event_id", "seq"), "user_id", fail, fail, "ts", "seq", "2 hours"))
    want = patterns.match_next(ev.withColumnRenamed("event_id", "seq"), "user_id", fail, fail, "ts", "seq", "2 hours")
    assert rows(got, "user_id", "seq") == rows(want, "user_id", "seq")


def test_followed_by_stream(spark, stream_dir):
    _, ev = stream_dir
    c, p = F.col("event_type") == "click", F.col("event_type") == "purchase"
    got = _run(spark, stream_dir, lambda s: stateful.followed_by_stream(
        s.withColumnRenamed("event_id", "seq"), "user_id", c, p, "ts", "seq", "1 day"))
    m, t = patterns.followed_by(ev.withColumnRenamed("event_id", "seq"), "user_id", c, p, "ts", "seq", "1 day")
    assert rows(got.where("kind = 'matched'"), "seq", "then_seq") == rows(m, "seq", "then_seq")
    assert rows(got.where("kind = 'timeout'"), "seq") == rows(t, "seq")


def test_burst_stream(spark, stream_dir):
    _, ev = stream_dir
    fail = F.col("event_type") == "error"
    got = _run(spark, stream_dir, lambda s: stateful.burst_stream(
        s.withColumnRenamed("event_id", "seq"), "user_id", fail, ~fail, "ts", "seq", "2 hours"))
    want = patterns.burst(ev.withColumnRenamed("event_id", "seq"), "user_id", fail, ~fail, "ts", "seq", "2 hours")
    assert rows(got, "user_id", "n_fails") == rows(want, "user_id", "n_fails")
    assert want.count() > 0


def test_running_distinct_stream(spark, stream_dir):
    _, ev = stream_dir
    views = lambda df: df.where("event_type = 'view'").withColumnRenamed("event_id", "seq")
    d, _ = stream_dir
    src, got = spark.readStream.schema(ev.schema).parquet(f"{d}/in"), []
    cb = jobs.running_distinct_per_batch("seq", tempfile.mkdtemp(prefix="flowstat-totals-"), lambda df, e: got.extend((r.seq, r.uv) for r in df.collect()))
    q = write_stream(stateful.first_sightings_stream(views(src), "ts", "seq", "user_id", "1 hour"), "q_" + uuid.uuid4().hex[:8], foreach_batch=cb)
    q.processAllAvailable()
    q.stop()
    want = distinct.running_distinct(views(ev), "ts", "seq", "user_id", "1 hour")
    assert sorted(got) == rows(want, "seq", "uv")


def test_full_outer_interval_join_stream(spark, stream_dir):
    _, ev = stream_dir

    def sides(df):
        p = df.where("event_type = 'click'").select("user_id", F.col("event_id").alias("pay_id"), F.col("ts").alias("pay_ts"))
        r = df.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("receipt_id"),
                                                       F.col("ts").alias("receipt_ts"))
        return p, r

    got = _run(spark, stream_dir, lambda s: jobs.interval_join_stream(
        *sides(s), "user_id", "pay_ts", "receipt_ts", "-1 hour", "2 hours", how="full_outer")) \
        .where(F.col("user_id") != SENTINEL_USER)
    want = joins.full_outer_interval(*sides(ev), "user_id", "pay_ts", "receipt_ts", "pay_id", "receipt_id",
                                     "-1 hour", "2 hours")
    fill = lambda df: df.fillna(-1, subset=["pay_id", "receipt_id"])
    assert rows(fill(got), "user_id", "pay_id", "receipt_id") == rows(fill(want), "user_id", "pay_id", "receipt_id")


def test_salted_count_stream(spark, stream_dir):
    _, ev = stream_dir
    got = _run(spark, stream_dir, lambda s: windows.salted_count(jobs.with_event_time(s, "ts"), "ts", "1 hour",
                                                                 "user_id", 10))
    want = windows.tumbling_count(ev, "ts", None, "1 hour").withColumn("window_end", F.col("window_end").cast("timestamp"))
    assert rows(got, "window_end", "cnt") == rows(want, "window_end", "cnt")


def test_sliding_stream_panes_wide_ratio(spark, stream_dir):
    _, ev = stream_dir
    got = _run(spark, stream_dir, lambda s: jobs.sliding_count_stream(s, "ts", "event_type", "1 hour", "1 minute",
                                                                      method="panes"))
    want = windows.sliding_count(ev, "ts", "event_type", "1 hour", "1 minute").withColumn(
        "window_end", F.col("window_end").cast("timestamp"))
    assert rows(got, "event_type", "window_end", "cnt") == rows(want, "event_type", "window_end", "cnt")

"""Allowed lateness (update mode) and the late-row side output on streams,
driven file by file so the watermark moves between micro-batches."""

import tempfile
import time
import uuid

from pyspark.sql import functions as F

from flowstat.streaming import jobs, stateful
from flowstat.streaming.sinks import write_stream


def _waves(spark, waves):
    d = tempfile.mkdtemp(prefix="flowstat-late-")
    for i, secs in enumerate(waves):
        df = spark.createDataFrame([(s, float(s)) for s in secs], "sec long, v double") \
            .select(F.col("sec").alias("seq"), F.timestamp_seconds(F.lit(1704067200) + F.col("sec")).alias("ts"))
        df.coalesce(1).write.parquet(f"{d}/in/{i}")
        time.sleep(1.1)                        # distinct modification times keep the file order
    return spark.readStream.schema("seq long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*")


def _drain(df, mode):
    name = "late_" + uuid.uuid4().hex[:6]
    q = write_stream(df, name, fmt="memory", mode=mode)
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_allowed_lateness_update_mode(spark):
    # 10 s windows sliding by 5 s, watermark delay 61 s (1 s disorder + 60 s lateness)
    src = _waves(spark, [[120], [65], [66, 30]])
    out = _drain(jobs.sliding_count_stream(src, "ts", None, "10 seconds", "5 seconds", delay="61 seconds"), "update")
    seen = sorted((r["window_end"].second + 60 * r["window_end"].minute, r["cnt"]) for r in out.collect())
    # the window ending at 70 s is emitted early (1) and corrected (2); row 30 s is beyond the lateness: dropped
    assert (70, 1) in seen and (70, 2) in seen
    assert not any(end <= 40 for end, _ in seen)


def test_late_rows_stream(spark):
    src = _waves(spark, [[100, 200], [50, 195]])
    out = _drain(stateful.split_late_stream(src, "ts", "10 seconds", "5 seconds", "0 seconds", delay="0 seconds"),
                 "append")
    flags = sorted((r["seq"], r["late"]) for r in out.collect())
    assert flags == [(50, True), (100, False), (195, False), (200, False)]


def test_top_n_retract_stream(spark):
    import tempfile as _t
    # item views per 1 h window, top-2, arriving in three micro-batches
    d = _t.mkdtemp(prefix="flowstat-retract-")
    waves = [[(1, 10), (2, 20), (2, 30)],            # item 2: 2, item 1: 1
             [(3, 40), (3, 50), (3, 60)],            # item 3 takes rank 1, item 1 drops out
             [(1, 70), (1, 80)]]                     # item 1: 3 -> ties item 3, key order puts it first
    for i, wave in enumerate(waves):
        spark.createDataFrame([(item, sec) for item, sec in wave], "item_id long, sec long") \
            .select("item_id", F.timestamp_seconds(F.lit(1704067200) + F.col("sec")).alias("ts")) \
            .coalesce(1).write.parquet(f"{d}/in/{i}")
        time.sleep(1.1)
    src = spark.readStream.schema("item_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*")
    counts = jobs.tumbling_count_stream(src, "ts", "item_id", "1 hour", delay="1 hour")
    log = []
    cb = jobs.top_n_retract_per_batch("window_end", "item_id", 2, f"{d}/state",
                                      lambda df, e: log.append(sorted((r["op"], r["item_id"], r["cnt"], r["rn"])
                                                                      for r in df.collect())))
    q = write_stream(counts, "retract_" + uuid.uuid4().hex[:6], mode="update", foreach_batch=cb)
    q.processAllAvailable()
    q.stop()
    assert log[0] == [("+", 1, 1, 2), ("+", 2, 2, 1)]
    assert log[1] == [("+", 2, 2, 2), ("+", 3, 3, 1), ("-", 1, 1, 2), ("-", 2, 2, 1)]
    assert log[2] == [("+", 1, 3, 1), ("+", 3, 3, 2), ("-", 2, 2, 2), ("-", 3, 3, 1)]


def test_ordered_rules_across_batches(spark):
    """Out-of-order rows spread over micro-batches (none later than the 5 s
    watermark delay) give the same strict-next / followed-by / burst results
    as the batch operators."""
    import tempfile as _t

    from flowstat.operators import patterns
    d = _t.mkdtemp(prefix="flowstat-waves-")
    waves = [[(1, "fail", 10), (1, "fail", 12), (2, "fail", 11), (1, "pay", 13)],
             [(1, "fail", 9), (2, "pay", 14), (2, "fail", 15), (1, "ok", 16)],       # 9 arrives late but within delay
             [(1, "fail", 17), (2, "fail", 16), (1, "pay", 19), (3, "fail", 100)]]    # key 3 moves the watermark
    seq = 0
    for i, wave in enumerate(waves):
        data = []
        for k, e, sec in wave:
            data.append((k, seq, e, sec))
            seq += 1
        spark.createDataFrame(data, "k long, seq long, e string, sec long") \
            .select("k", "seq", "e", F.timestamp_seconds(F.lit(1704067200) + F.col("sec")).alias("ts")) \
            .coalesce(1).write.parquet(f"{d}/in/{i}")
        time.sleep(1.1)
    schema = "k long, seq long, e string, ts timestamp"
    batch = spark.read.schema(schema).parquet(f"{d}/in/*")
    fail, pay, ok = F.col("e") == "fail", F.col("e") == "pay", F.col("e") == "ok"

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*")

    got = _drain(stateful.match_next_stream(stream(), "k", fail, fail, "ts", "seq", "3 seconds", delay="5 seconds"),
                 "append")
    want = patterns.match_next(batch, "k", fail, fail, "ts", "seq", "3 seconds")
    assert sorted(r["seq"] for r in got.collect()) == sorted(r["seq"] for r in want.where("k != 3").collect())

    got = _drain(stateful.followed_by_stream(stream(), "k", fail, pay, "ts", "seq", "4 seconds", delay="5 seconds"),
                 "append")
    m, t = patterns.followed_by(batch, "k", fail, pay, "ts", "seq", "4 seconds")
    assert sorted((r["seq"], r["then_seq"]) for r in got.where("kind = 'matched'").collect()) == \
        sorted((r["seq"], r["then_seq"]) for r in m.collect())
    assert sorted(r["seq"] for r in got.where("kind = 'timeout'").collect()) == \
        sorted(r["seq"] for r in t.where("k != 3").collect())

    got = _drain(stateful.burst_stream(stream(), "k", fail, ok, "ts", "seq", "3 seconds", delay="5 seconds"),
                 "append")
    want = patterns.burst(batch, "k", fail, ok, "ts", "seq", "3 seconds")
    assert sorted((r["k"], r["n_fails"]) for r in got.collect()) == \
        sorted((r["k"], r["n_fails"]) for r in want.where("k != 3").collect())


def test_cap_stream_late_click_of_previous_day(spark):
    """A click of day 1 arriving after day 2 has started still counts against
    day 1, in the stream as in the batch operator."""
    import tempfile as _t

    from flowstat.operators import capping
    d = _t.mkdtemp(prefix="flowstat-cap-")
    waves = [[(1, 86400 - 30), (2, 86400 - 20)],          # day 1: clicks 1, 2
             [(3, 86400 + 10), (4, 86400 - 10)],          # day 2 starts, then a late day-1 click (3rd of day 1)
             [(5, 86400 - 5), (6, 86400 + 20)]]           # 4th click of day 1 -> warning; day 2: 2nd click
    for i, wave in enumerate(waves):
        spark.createDataFrame([(7, 42, seq, sec) for seq, sec in wave], "user_id long, ad_id long, seq long, sec long") \
            .select("user_id", "ad_id", "seq", F.timestamp_seconds(F.lit(1704067200) + F.col("sec")).alias("ts")) \
            .coalesce(1).write.parquet(f"{d}/in/{i}")
        time.sleep(1.1)
    schema = "user_id long, ad_id long, seq long, ts timestamp"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*")
    got = _drain(stateful.cap_and_flag_stream(src, ["user_id", "ad_id"], "ts", "seq", limit=3, delay="1 hour"), "append")
    passed, warned = capping.cap_and_flag(spark.read.schema(schema).parquet(f"{d}/in/*"), ["user_id", "ad_id"],
                                          "ts", "seq", limit=3)
    assert sorted(r["seq"] for r in got.where("channel = 'passed'").collect()) == sorted(r["seq"] for r in passed.collect())
    assert [r["seq"] for r in got.where("channel = 'blacklist'").collect()] == [r["seq"] for r in warned.collect()] == [5]

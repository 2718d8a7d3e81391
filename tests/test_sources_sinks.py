import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from flowstat.operators import topn
from flowstat.sources import parse_access_log, parse_csv_lines, read_records, replay_lines
from flowstat.streaming import jobs
from flowstat.streaming.sinks import checkpoint_location, write_stream

from .conftest import rows


def _write(lines):
    d = tempfile.mkdtemp(prefix="flowstat-src-")
    p = os.path.join(d, "log.csv")
    with open(p, "w") as f:
        f.write("\n".join(lines))
    return d, p


def test_read_records_types_and_empty_field(spark):
    _, p = _write(["1,create,,1558430842", "1,pay,tx01,1558430844"])
    df = read_records(spark, p, "order")
    r = df.orderBy("seq").collect()
    assert r[0]["tx_id"] is None and r[1]["tx_id"] == "tx01"
    assert r[0]["ts"].year == 2019 and [x["seq"] for x in r] == sorted(x["seq"] for x in r)


def test_read_records_failfast_and_permissive(spark):
    _, p = _write(["1,create,,1558430842", "x,pay,tx01,notanumber"])
    with pytest.raises(Exception):
        read_records(spark, p, "order").collect()
    perm = read_records(spark, p, "order", mode="PERMISSIVE")
    assert perm.where(F.col("order_id").isNull()).count() == 1
    bad = read_records(spark, p, "order", mode="PERMISSIVE", corrupt_col="bad_line").cache()
    assert [r["bad_line"] for r in bad.where(F.col("bad_line").isNotNull()).collect()] == ["x,pay,tx01,notanumber"]


def test_market_record_milliseconds(spark):
    _, p = _write(["7,CLICK,wechat,1600000000123"])
    r = read_records(spark, p, "market").first()
    assert r["ts"].microsecond == 123000


def test_parse_access_log(spark):
    df = spark.createDataFrame([("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/a.png",),
                                ("10.0.0.1 7 - 01/02/2020:03:04:05 +0000 POST /a/b.html",)], "value string")
    out = parse_access_log(df).orderBy("ip").collect()
    assert out[0]["user_id"] == "7" and out[0]["method"] == "POST" and out[0]["url"] == "/a/b.html"
    assert (out[0]["ts"].day, out[0]["ts"].month, out[0]["ts"].hour, out[0]["ts"].second) == (1, 2, 3, 5)
    assert out[1]["url"].endswith(".png")


def test_parse_csv_lines(spark):
    df = spark.createDataFrame([("7,42,hebei,tangshan,1600000001",)], "value string")
    r = parse_csv_lines(df, "ad_click").first()
    assert (r["user_id"], r["ad_id"], r["province"], r["timestamp"]) == (7, 42, "hebei", 1600000001)


def test_replay_lines_to_files(spark):
    _, p = _write(["a,1", "b,2", "c,3"])
    out = tempfile.mkdtemp(prefix="flowstat-replay-") + "/out"
    replay_lines(spark, p, fmt="text", target=out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == ["a,1", "b,2", "c,3"]


def test_changelog_snapshots(spark):
    prev = spark.createDataFrame([(1, "a"), (2, "b")], "rn int, k string")
    cur = spark.createDataFrame([(1, "b"), (2, "a")], "rn int, k string")
    ch = rows(topn.changelog(prev, cur, ["rn", "k"]), "op", "rn", "k")
    assert ch == [("+", 1, "b"), ("+", 2, "a"), ("-", 1, "a"), ("-", 2, "b")]


def test_foreach_batch_changelog_stream(spark):
    d = tempfile.mkdtemp(prefix="flowstat-fb-")
    # two complete snapshots, one file each, consumed one per micro-batch
    spark.createDataFrame([(1, "a"), (2, "b")], "rn int, k string").coalesce(1).write.parquet(f"{d}/in/1")
    spark.createDataFrame([(1, "b"), (2, "b")], "rn int, k string").coalesce(1).write.parquet(f"{d}/in/2")
    got = []
    name = "fb_" + uuid.uuid4().hex[:6]
    src = spark.readStream.schema("rn int, k string").option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*")
    cb = jobs.changelog_per_batch(["rn", "k"], f"{d}/snap", lambda df, e: got.extend(rows(df, "op", "rn", "k")))
    q = write_stream(src, name, foreach_batch=cb)
    q.processAllAvailable()
    q.stop()
    assert got == [("+", 1, "a"), ("+", 2, "b"), ("+", 1, "b"), ("-", 1, "a")]
    assert checkpoint_location(spark, name).endswith(f"streams/{name}")
    assert checkpoint_location(spark, name, "a") != checkpoint_location(spark, name, "b")


def test_console_sink_and_top_n_per_batch(spark, capsys):
    d = tempfile.mkdtemp(prefix="flowstat-topn-")
    spark.createDataFrame([(1, i % 4, f"2024-01-01 00:0{i % 3}:00") for i in range(12)],
                          "seq long, item_id long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{d}/in/1")
    src = spark.readStream.schema("seq long, item_id long, ts timestamp").parquet(f"{d}/in/*")
    counts = jobs.tumbling_count_stream(src, "ts", "item_id", "1 minute", delay="0 seconds")
    got = []
    q = write_stream(counts, "topn_" + uuid.uuid4().hex[:6], mode="update",
                     foreach_batch=jobs.top_n_per_batch("window_end", "item_id", 2,
                                                        lambda df, e: got.extend(rows(df, "window_end", "rn", "item_id"))))
    q.processAllAvailable()
    q.stop()
    assert len(got) == 6 and {r[1] for r in got} == {1, 2}
    c = write_stream(src, "console_" + uuid.uuid4().hex[:6], fmt="console")
    c.processAllAvailable()
    c.stop()


def test_parse_uri():
    from flowstat.sources import parse_uri
    assert parse_uri("socket://localhost:7777") == ("socket", {"host": "localhost", "port": 7777})
    assert parse_uri("kafka://b1:9092,b2:9092/hotitems") == ("kafka", {"servers": "b1:9092,b2:9092", "topic": "hotitems"})
    assert parse_uri("/data/UserBehavior.csv") == ("file", {"path": "/data/UserBehavior.csv"})


def test_changelog_replay_is_idempotent(spark):
    d = tempfile.mkdtemp(prefix="flowstat-replay-")
    out = []
    cb = jobs.changelog_per_batch(["rn", "k"], f"{d}/snap", lambda df, e: out.append(rows(df, "op", "rn", "k")))
    s1 = spark.createDataFrame([(1, "a")], "rn int, k string")
    s2 = spark.createDataFrame([(1, "b")], "rn int, k string")
    cb(s1, 0)
    cb(s2, 1)
    cb(s2, 1)                      # the same epoch again, as after a failure
    assert out[1] == out[2] == [("+", 1, "b"), ("-", 1, "a")]


def test_fan_out_side_outputs(spark):
    from flowstat.streaming import stateful
    from flowstat.streaming.sinks import fan_out_per_batch
    d = tempfile.mkdtemp(prefix="flowstat-fan-")
    spark.createDataFrame([(7, 42, i, f"2024-01-01 00:00:{i:02d}") for i in range(6)],
                          "user_id long, ad_id long, seq long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{d}/in/1")
    src = spark.readStream.schema("user_id long, ad_id long, seq long, ts timestamp").parquet(f"{d}/in/*")
    tagged = stateful.cap_and_flag_stream(src, ["user_id", "ad_id"], "ts", "seq", limit=3)
    cb = fan_out_per_batch("channel", {"passed": f"{d}/passed", "blacklist": f"{d}/blacklist"})
    q = write_stream(tagged, "fan_" + uuid.uuid4().hex[:6], foreach_batch=cb)
    q.processAllAvailable()
    q.stop()
    assert sorted(r["seq"] for r in spark.read.parquet(f"{d}/passed").collect()) == [0, 1, 2]
    assert [r["seq"] for r in spark.read.parquet(f"{d}/blacklist").collect()] == [3]

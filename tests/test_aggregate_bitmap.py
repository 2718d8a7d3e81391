"""User aggregates per window, and two-level bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from flowstat.functions import bitmap_hash
from flowstat.operators import aggregate, distinct, windows

from .conftest import at, rows


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(4)
    data = [(rnd.choice([1, 2, 3, None]), at(rnd.uniform(0, 40_000)), rnd.choice([None, 1.5, 2.0, 7.25]), rnd.randint(0, 400)) for _ in range(3000)]
    data += [(1, at(5), 1.0, 7)] * 2000 + [(1, None, 1.0, 7), (2, at(-7000), 3.0, None)]
    return spark.createDataFrame(data, "k long, ts timestamp_ntz, v double, user long").repartition(6).cache()


@pytest.mark.parametrize("size,slide", [("1 hour", None), ("1 hour", "20 minutes"), ("50 minutes", "20 minutes")])
def test_count_equals_the_built_in(events, size, slide):
    got = aggregate.aggregate_windows(events, "ts", "k", aggregate.count_rows(), size=size, slide=slide, out="cnt", most_groups=7)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    want = events.groupBy(w.alias("w"), "k").agg(F.count(F.lit(1)).alias("cnt")).select("k", F.col("w.end").alias("window_end"), "cnt")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_mean_without_keys_and_nulls(events):
    got = aggregate.aggregate_windows(events, "ts", None, aggregate.mean_of("v"), ["v"], "1 hour", out="mean")
    want = events.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.avg("v").alias("mean")).select(F.col("w.end").alias("window_end"), "mean")
    a, b = ({r.window_end: r["mean"] for r in df.where("window_end is not null").collect()} for df in (got, want))
    assert a.keys() == b.keys() and all((a[k] is None) == (b[k] is None) and (a[k] is None or abs(a[k] - b[k]) < 1e-9) for k in a)
    none = events.where("v is null").limit(5)
    assert [r["mean"] for r in aggregate.aggregate_windows(none, "ts", None, aggregate.mean_of("v"), ["v"], "1 day", out="mean").collect()][0] is None


def test_one_exchange_after_a_partial_step(events):
    plan = aggregate.aggregate_windows(events, "ts", "k", aggregate.count_rows(), size="1 hour", slide="5 minutes")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "MapInPandas" in plan


@pytest.mark.parametrize("size,slide", [("1 hour", None), ("6 hours", "1 hour"), ("50 minutes", "20 minutes")])
def test_bitmaps_count_distinct_positions(events, size, slide):
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    known = events.where("user is not null")
    for hashed in (True, False):
        got = distinct.bitmap_distinct(events, "ts", "user", size, slide, hashed=hashed)
        v = bitmap_hash("user") if hashed else F.col("user")
        want = known.where("ts is not null").groupBy(w.alias("w")).agg(F.count_distinct(v).alias("uv")).select(F.col("w.end").alias("window_end"), "uv")
        assert rows(got.where("window_end is not null"), "window_end", "uv") == rows(want, "window_end", "uv")


def test_wide_positions_fill_several_buckets(spark):
    df = spark.range(200_000).select(F.lit("2024-01-01 00:10:00").cast("timestamp_ntz").alias("ts"), (F.col("id") * 3).alias("v"))
    assert rows(distinct.bitmap_distinct(df, "ts", "v", "1 hour", hashed=False), "uv") == [(200_000,)]
    plan = distinct.bitmap_distinct(df, "ts", "v", "1 hour", hashed=False)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan


def test_sketch_error_is_told(spark):
    """With many visitors in an hour a coarse sketch misses the bound of a fine one."""
    df = spark.range(60_000).select(F.lit("2024-01-01 00:10:00").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user"))
    fine, coarse = (distinct.distinct_per_window(df, "ts", "user", "1 hour", "approx", rsd=r).first().uv for r in (0.01, 0.3))
    assert abs(fine - 60_000) <= 0.03 * 60_000 < abs(coarse - 60_000)


def test_sliding_count_of_keys_still_holds(events):
    got = aggregate.aggregate_windows(events, "ts", "k", aggregate.count_rows(), size="1 hour", slide="5 minutes", out="cnt")
    want = windows.sliding_count(events.where("ts is not null"), "ts", "k", "1 hour", "5 minutes")
    assert sorted(map(str, got.select("k", "window_end", "cnt").collect())) == sorted(map(str, want.select("k", "window_end", "cnt").collect()))

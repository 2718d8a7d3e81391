"""Failure bursts of runs that are split between tasks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowstat.operators import patterns

from .conftest import at, rows

COLS = ("k", "first_fail", "last_fail", "n_fails")


def frame(spark, data):
    return spark.createDataFrame([(k, i, e, at(t)) for i, (k, t, e) in enumerate(data)], "k long, seq long, e string, ts timestamp_ntz")


def bursts(df, within="2 seconds", n=2):
    fail = F.col("e") == "f"
    return patterns.burst(df, "k", fail, F.col("e") == "r", "ts", "seq", within, n)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_runs_equal_the_scan(spark, monkeypatch, seed):
    """Runs of every density, with ties, resets inside and outside the last window, and several keys."""
    rnd, data = random.Random(seed), []
    for k in (1, 2, 3):
        t = 0.0
        for _ in range(500):
            t += rnd.choice([0, 0, 0.001, 0.3, 0.9, 1.7, 1.999, 2.0]) if rnd.random() > 0.01 else 30
            data.append((k, round(t, 3), "r" if rnd.random() < 0.01 else "f"))
    df = frame(spark, data).cache()
    want = rows(bursts(df), *COLS)
    monkeypatch.setattr("flowstat.operators.ordered.HEAVY_ROWS", 20)
    real = patterns.long_run_bursts
    for chunk in (3, 16):
        monkeypatch.setattr(patterns, "long_run_bursts", lambda *a, c=chunk: real(*a, chunk_windows=c))
        assert rows(bursts(df), *COLS) == want
    assert len(want) > 20


def test_one_run_of_a_million_rows(spark, monkeypatch):
    n = 1_000_000
    df = spark.range(n).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("seq"), F.lit("f").alias("e"),
                               F.timestamp_add("MILLISECOND", F.col("id") * 300 + F.pmod(F.xxhash64("id"), F.lit(299)), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"))
    t = np.array([r.t for r in df.select(F.date_diff("ts", F.lit("2024-01-01")).alias("d"),
                                         (F.date_diff("ts", F.lit("2024-01-01")) * 86_400_000 + F.hour("ts") * 3_600_000 + F.minute("ts") * 60_000
                                          + (F.date_part(F.lit("SECOND"), "ts") * 1000).cast("long")).alias("t")).collect()])
    t.sort()
    want, i = [], 0
    while i < n:  # the plain scan
        j = int(np.searchsorted(t, t[i] + 2000, side="right"))
        if j - i >= 2:
            want.append(j - i)
        i = j
    monkeypatch.setattr("flowstat.operators.ordered.HEAVY_ROWS", 100_000)
    sizes = []
    real = patterns.long_run_bursts

    def seen(rows_, *a):
        out = real(rows_, *a)
        sizes.append(out.rdd.getNumPartitions())
        return out
    monkeypatch.setattr(patterns, "long_run_bursts", seen)
    got = bursts(df).select("n_fails").orderBy("first_fail").collect()
    assert [r.n_fails for r in got] == want and sizes and sizes[0] > 1

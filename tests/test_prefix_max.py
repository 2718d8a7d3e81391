"""The running maximum over an arrival order without a key, against a plain scan."""

import random

import pytest
from pyspark.sql import functions as F

from flowstat.operators import late, ordered

from .conftest import at, rows

SCHEMA = "arr long, seq long, v long, name string"


def scan(data):
    """seq -> largest value before the row in the order (arr, seq), nulls first."""
    def key(r):
        return [(x is not None, x or 0) for x in r[:2]]

    seen, best = {}, None
    for r in sorted(data, key=key):
        seen[r[1]] = best
        if r[2] is not None:
            best = r[2] if best is None else max(best, r[2])
    return seen


def table(kind: str, n: int = 3000):
    rng = random.Random(kind)
    places = {"even": lambda i: rng.randrange(20_000),
              "hot chunk": lambda i: rng.randrange(1000) if i % 3 else rng.randrange(20_000),
              "hot place": lambda i: 777 if i % 3 else rng.randrange(-2000, 2000),
              "one place": lambda i: 5,
              "null places": lambda i: None if i % 3 == 0 else rng.randrange(3000)}[kind]
    data = [(places(i), i, None if rng.random() < 0.1 else i + rng.randrange(10_000), "x") for i in range(n)]
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("heavy", [100, 1 << 20])
@pytest.mark.parametrize("kind", ["even", "hot chunk", "hot place", "one place", "null places"])
def test_equals_the_scan(spark, monkeypatch, kind, heavy):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
    data = table(kind)
    got = ordered.prefix_max(spark.createDataFrame(data, SCHEMA), "arr", "seq", "v", "mx", 1000)
    assert sorted(got.columns) == ["arr", "mx", "name", "seq", "v"]
    assert dict(rows(got, "seq", "mx")) == scan(data)


@pytest.mark.parametrize("kind", ["hot chunk", "hot place", "one place", "null places"])
def test_hot_chunk_is_dealt_over_leaves(spark, monkeypatch, kind):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", 100)
    df = spark.createDataFrame(table(kind), SCHEMA).withColumn("_ck", F.coalesce(ordered.floor_to(F.col("arr"), 1000), F.lit(ordered._FIRST)))
    heavy = df.groupBy("_ck").agg(F.count(F.lit(1)).alias("_n")).where("_n > 100")
    cut = ordered._leaves(df, ordered._cuts(df, heavy, "arr"), "arr", "seq")
    leaves = cut.groupBy("_ck", "_sub", "_tie").count().agg(F.max("count"), F.count(F.lit(1)), F.sum("count")).first()
    assert heavy.agg(F.max("_n")).first()[0] >= 900
    assert leaves[0] <= 400 and leaves[1] >= 10 and leaves[2] == 3000


def test_empty_table_and_text_ids(spark, monkeypatch):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", 100)
    assert ordered.prefix_max(spark.createDataFrame([], SCHEMA), "arr", "seq", "v", "mx", 10).count() == 0
    # ids that are not numbers break ties, a place they fill is not cut
    data = [(3 if i < 400 else i, f"{i:05d}", (i * 37) % 1009) for i in range(800)]
    got = ordered.prefix_max(spark.createDataFrame(data, "arr long, seq string, v long"), "arr", "seq", "v", "mx", 10_000)
    best, want = None, {}
    for _, seq, v in sorted(data):
        want[seq] = best
        best = v if best is None else max(best, v)
    assert dict(rows(got, "seq", "mx")) == want


def test_late_rows_of_a_hot_minute(spark, monkeypatch):
    rng = random.Random(4)
    data = [(i, at(rng.uniform(0, 120)), at(30 if i % 2 else rng.uniform(0, 59))) for i in range(1500)]
    df = spark.createDataFrame(data, "seq long, ts timestamp_ntz, arr timestamp_ntz")
    found = []
    for heavy in (100, 1 << 20):
        monkeypatch.setattr(ordered, "HEAVY_ROWS", heavy)
        on_time, late_df = late.split_late(df, "ts", "arr", "seq", "0 seconds", "10 seconds", "5 seconds", "0 seconds")
        found.append((rows(on_time, "seq"), rows(late_df, "seq", "watermark")))
    assert found[0] == found[1] and len(found[0][1]) > 100
    best, want = None, []
    for seq, ts, _ in sorted(data, key=lambda r: (r[2], r[0])):
        t = (ts - at(0)).total_seconds()
        if best is not None and t // 5 * 5 + 10 - 0.001 <= best:
            want.append(seq)
        best = t if best is None else max(best, t)
    assert [s for s, _ in found[0][1]] == sorted(want)

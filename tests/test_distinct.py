from pyspark.sql import functions as F

from flowstat.functions import bitmap_hash
from flowstat.operators import distinct
from flowstat.plans import tables

from .conftest import SF0001, rows


def _py_hash(s: str) -> int:
    h = 0
    for ch in s:
        h = h * 67 + ord(ch)
    return h & ((1 << 29) - 1)


def test_bitmap_hash_matches_python(spark):
    vals = [0, 7, 123456789, 937166, 2 ** 62]
    df = spark.createDataFrame([(v,) for v in vals], "u long")
    got = [r[0] for r in df.select(bitmap_hash("u")).collect()]
    assert got == [_py_hash(str(v)) for v in vals]


def test_bitmap_le_exact_le_pv(spark):
    ev = tables.behavior(spark, SF0001).where(F.col("behavior") == "view")
    ex = dict(rows(distinct.distinct_per_window(ev, "ts", "user_id", "1 hour", "exact"), "window_end", "uv"))
    bm = dict(rows(distinct.distinct_per_window(ev, "ts", "user_id", "1 hour", "bitmap"), "window_end", "uv"))
    from flowstat.operators import windows
    pv = dict(rows(windows.tumbling_count(ev, "ts", None, "1 hour"), "window_end", "cnt"))
    assert set(ex) == set(bm) == set(pv)
    assert all(bm[k] <= ex[k] <= pv[k] for k in ex)


def test_running_distinct_chunks(spark):
    ev = tables.behavior(spark, SF0001).where(F.col("behavior") == "view")
    a = rows(distinct.running_distinct(ev, "ts", "seq", "user_id", "1 hour", chunk=1 << 30), "seq", "uv")
    b = rows(distinct.running_distinct(ev, "ts", "seq", "user_id", "1 hour", chunk=3), "seq", "uv")
    assert a == b
    # the last row of each window carries the window's distinct count
    last = distinct.running_distinct(ev, "ts", "seq", "user_id", "1 hour", hashed=False) \
        .groupBy("window_end").agg(F.max("uv").alias("uv"))
    exact = distinct.distinct_per_window(ev, "ts", "user_id", "1 hour", "exact")
    assert rows(last, "window_end", "uv") == rows(exact, "window_end", "uv")


def test_approx_close_to_exact(spark):
    from .conftest import SF001
    ev = tables.behavior(spark, SF001).where(F.col("behavior") == "view")
    ex = dict(rows(distinct.distinct_per_window(ev, "ts", "user_id", "1 hour", "exact"), "window_end", "uv"))
    ap = dict(rows(distinct.distinct_per_window(ev, "ts", "user_id", "1 hour", "approx"), "window_end", "uv"))
    assert set(ex) == set(ap)
    assert sum(abs(ap[k] - ex[k]) for k in ex) <= 0.02 * sum(ex.values())

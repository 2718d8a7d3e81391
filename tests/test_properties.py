"""Property tests: the three sliding-count strategies agree, and chunked
prefix aggregates equal a plain Python prefix scan, on random inputs."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowstat.operators import windows
from flowstat.operators.ordered import running_total

from .conftest import at, rows

# reproducible examples by default; FLOWSTAT_EXPLORE=1 draws fresh random ones (and more of them)
SETTINGS = settings(max_examples=40 if os.environ.get("FLOWSTAT_EXPLORE") else 8, deadline=None,
                    derandomize=not os.environ.get("FLOWSTAT_EXPLORE"),
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(secs=st.lists(st.integers(min_value=0, max_value=3600), min_size=1, max_size=40),
       slide=st.sampled_from([5, 10, 30, 60]), mult=st.integers(min_value=1, max_value=30),
       extra=st.sampled_from([0, 0, 5]), bucket=st.sampled_from(["1 minute", "10 minutes", "1 day"]))
def test_sliding_strategies_agree(spark, secs, slide, mult, extra, bucket):
    size = slide * mult + (extra if extra < slide else 0)
    df = spark.createDataFrame([(s % 3, at(s)) for s in secs], "k long, ts timestamp_ntz")
    results = [rows(windows.sliding_count(df, "ts", "k", f"{size} seconds", f"{slide} seconds", method=m,
                                          bucket=bucket), "k", "window_end", "cnt")
               for m in ("window", "panes", "difference")]
    assert results[0] == results[1] == results[2]


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=40),
       chunk=st.integers(min_value=1, max_value=16), agg=st.sampled_from(["sum", "max", "min"]),
       exclusive=st.booleans(), descending=st.booleans())
def test_running_total_matches_scan(spark, vals, chunk, agg, exclusive, descending):
    data = [(k, i, v) for i, (k, v) in enumerate(vals)]
    df = spark.createDataFrame(data, "k long, seq long, v long")
    got = dict(rows(running_total(df, "k", "seq", "v", "r", chunk_col="seq", chunk=chunk, agg=agg,
                                  exclusive=exclusive, descending=descending), "seq", "r"))
    fn = {"sum": sum, "max": max, "min": min}[agg]
    for k in {d[0] for d in data}:
        seq = [d for d in data if d[0] == k]
        seq = list(reversed(seq)) if descending else seq
        for j, (_, s, _) in enumerate(seq):
            window = [d[2] for d in seq[: j if exclusive else j + 1]]
            want = fn(window) if window else (0 if agg == "sum" else None)
            assert got[s] == want, (k, s)


@SETTINGS
@given(left=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 120)), max_size=25),
       right=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 120)), max_size=25),
       lo=st.integers(-20, 0), width=st.integers(0, 30), bucket=st.sampled_from([None, "1 second", "7 seconds"]))
def test_interval_join_matches_brute_force(spark, left, right, lo, width, bucket):
    from flowstat.operators import joins
    hi = lo + width
    ldf = spark.createDataFrame([(k, i, at(t)) for i, (k, t) in enumerate(left)],
                                "k long, lid long, lts timestamp_ntz")
    rdf = spark.createDataFrame([(k, i, at(t)) for i, (k, t) in enumerate(right)],
                                "k long, rid long, rts timestamp_ntz")
    want = sorted((i, j) for i, (k1, t1) in enumerate(left) for j, (k2, t2) in enumerate(right)
                  if k1 == k2 and t1 + lo <= t2 <= t1 + hi)
    m, lu, ru = joins.interval_match(ldf, rdf, "k", "lts", "rts", "lid", "rid", f"{lo} seconds", f"{hi} seconds",
                                     bucket)
    assert rows(m, "lid", "rid") == want
    assert rows(joins.interval_join(ldf, rdf, "k", "lts", "rts", f"{lo} seconds", f"{hi} seconds", bucket),
                "lid", "rid") == want
    assert [r[0] for r in rows(lu, "lid")] == sorted(set(range(len(left))) - {i for i, _ in want})
    assert [r[0] for r in rows(ru, "rid")] == sorted(set(range(len(right))) - {j for _, j in want})

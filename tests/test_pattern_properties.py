"""Pattern operators against straightforward per-key Python scans on random
logs (small integer times, so equal timestamps and bound hits are common)."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowstat.operators import capping, patterns

from .conftest import at, rows

# reproducible examples by default; FLOWSTAT_EXPLORE=1 draws fresh random ones (and more of them)
SETTINGS = settings(max_examples=40 if os.environ.get("FLOWSTAT_EXPLORE") else 8, deadline=None,
                    derandomize=not os.environ.get("FLOWSTAT_EXPLORE"),
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
EVENTS = st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["fail", "ok", "pay"]), st.integers(0, 30)),
                  min_size=1, max_size=40)


def _df(spark, evs):
    data = [(k, i, e, at(t)) for i, (k, e, t) in enumerate(evs)]
    return spark.createDataFrame(data, "k long, seq long, e string, ts timestamp_ntz"), data


def _by_key(data, order):
    keys = sorted({d[0] for d in data})
    return {k: sorted((d for d in data if d[0] == k), key=order) for k in keys}


@SETTINGS
@given(evs=EVENTS, gap=st.integers(0, 5), inclusive=st.booleans())
def test_consecutive_and_next(spark, evs, gap, inclusive):
    df, data = _df(spark, evs)
    fail = F.col("e") == "fail"
    got = rows(patterns.consecutive(df, "k", fail, "ts", "seq", f"{gap} seconds", inclusive, chunk=4), "seq")
    want = []
    for rs in _by_key(data, lambda d: d[1]).values():
        for p, c in zip(rs, rs[1:]):
            d = (c[3] - p[3]).total_seconds()
            if p[2] == c[2] == "fail" and (d <= gap if inclusive else d < gap):
                want.append((c[1],))
    assert got == sorted(want)
    got = rows(patterns.match_next(df, "k", fail, fail, "ts", "seq", f"{gap} seconds", chunk="5 seconds"), "seq")
    want = []
    for rs in _by_key(data, lambda d: (d[3], d[1])).values():
        for p, c in zip(rs, rs[1:]):
            if p[2] == c[2] == "fail" and (c[3] - p[3]).total_seconds() < gap:
                want.append((c[1],))
    assert got == sorted(want)


@SETTINGS
@given(evs=EVENTS, within=st.integers(1, 10))
def test_followed_by(spark, evs, within):
    df, data = _df(spark, evs)
    m, t = patterns.followed_by(df, "k", F.col("e") == "fail", F.col("e") == "pay", "ts", "seq",
                                f"{within} seconds", chunk="4 seconds")
    want_m, want_t = [], []
    for rs in _by_key(data, lambda d: (d[3], d[1])).values():
        for i, r in enumerate(rs):
            if r[2] != "fail":
                continue
            nxt = next((x for x in rs[i + 1:] if x[2] == "pay"), None)
            if nxt is not None and (nxt[3] - r[3]).total_seconds() < within:
                want_m.append((r[1], nxt[1]))
            else:
                want_t.append((r[1],))
    assert rows(m, "seq", "then_seq") == sorted(want_m)
    assert rows(t, "seq") == sorted(want_t)


@SETTINGS
@given(evs=EVENTS, limit=st.integers(1, 4))
def test_cap(spark, evs, limit):
    df, data = _df(spark, evs)
    passed, warned = capping.cap_and_flag(df, ["k", "e"], "ts", "seq", limit=limit, chunk=3)
    want_p, want_w, n = [], [], {}
    for d in sorted(data, key=lambda d: d[1]):
        key = (d[0], d[2], d[3].date())
        n[key] = n.get(key, 0) + 1
        if n[key] <= limit:
            want_p.append((d[1],))
        elif n[key] == limit + 1:
            want_w.append((d[1],))
    assert rows(passed, "seq") == want_p and rows(warned, "seq") == want_w


@SETTINGS
@given(evs=EVENTS, within=st.integers(0, 6), min_count=st.integers(1, 3))
def test_burst_state_machine(spark, evs, within, min_count):
    df, data = _df(spark, evs)
    fail = F.col("e") == "fail"
    got = rows(patterns.burst(df, "k", fail, F.col("e") == "ok", "ts", "seq", f"{within} seconds", min_count,
                              chunk="4 seconds"), "k", "first_fail", "last_fail", "n_fails")
    want = []
    for k, rs in _by_key(data, lambda d: (d[3], d[1])).items():
        cur = None                                     # (anchor time, count, last failure time)
        for _, _, e, t in rs:
            if cur and (t - cur[0]).total_seconds() > within:
                if cur[1] >= min_count:
                    want.append((k, cur[0], cur[2], cur[1]))
                cur = None
            if e == "fail":
                cur = (t, 1, t) if cur is None else (cur[0], cur[1] + 1, t)
            elif e == "ok":
                cur = None                             # a success inside the window cancels it
        if cur and cur[1] >= min_count:
            want.append((k, cur[0], cur[2], cur[1]))
    assert got == sorted(want)


@SETTINGS
@given(evs=EVENTS, within=st.integers(1, 10))
def test_pair_status(spark, evs, within):
    df, data = _df(spark, evs)
    got = rows(patterns.pair_status(df, "k", F.col("e") == "fail", F.col("e") == "pay", "ts", f"{within} seconds"),
               "k", "status")
    want = []
    for k, rs in _by_key(data, lambda d: (d[3], d[1])).items():
        creates = [r[3] for r in rs if r[2] == "fail"]
        pays = [r[3] for r in rs if r[2] == "pay"]
        if creates:
            c = min(creates)
            later = [p for p in pays if p >= c]
            want.append((k, "payed" if later and (min(later) - c).total_seconds() < within else "timeout"))
        if pays and (not creates or min(pays) < min(creates)):
            want.append((k, "pay_without_create"))
    assert got == sorted(want)


@SETTINGS
@given(evs=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 7200)), min_size=1, max_size=40),
       chunk=st.integers(1, 8))
def test_running_distinct(spark, evs, chunk):
    from flowstat.operators import distinct
    data = [(i, u, at(t)) for i, (u, t) in enumerate(evs)]
    df = spark.createDataFrame(data, "seq long, user long, ts timestamp_ntz")
    got = rows(distinct.running_distinct(df, "ts", "seq", "user", "1 hour", hashed=False, chunk=chunk), "seq", "uv")
    want, seen = [], {}
    for i, u, t in sorted(data):
        hour = (t.hour, t.day)
        seen.setdefault(hour, set()).add(u)
        want.append((i, len(seen[hour])))
    assert got == want


@SETTINGS
@given(evs=st.lists(st.tuples(st.integers(0, 120), st.integers(0, 40)), min_size=1, max_size=30),
       lateness=st.integers(0, 10), method=st.sampled_from(["window", "difference"]))
def test_open_window_counts(spark, evs, lateness, method):
    from flowstat.operators import late, windows
    # arrival order = list order; event time t; watermark = max earlier t (no disorder bound)
    data = [(i, at(t), at(t + d)) for i, (t, d) in enumerate(evs)]
    df = spark.createDataFrame(data, "seq long, ts timestamp_ntz, arr timestamp_ntz")
    seen = late.watermark_before(df.withColumn("arr_n", F.col("seq")), "ts", "arr_n", "seq", "0 seconds", chunk=3)
    got = rows(windows.sliding_count_open(seen, "ts", None, "10 seconds", "5 seconds", "watermark",
                                          f"{lateness} seconds", method=method), "window_end", "cnt")
    counts, mx = {}, None
    for i, (t, _) in enumerate(evs):
        for end in range((t // 5) * 5 + 5, (t // 5) * 5 + 15, 5):
            if mx is None or end * 1000 - 1 + lateness * 1000 > mx * 1000:
                counts[end] = counts.get(end, 0) + 1
        mx = t if mx is None else max(mx, t)
    assert got == sorted((at(e), c) for e, c in counts.items())

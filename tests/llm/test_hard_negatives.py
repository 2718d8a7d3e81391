import math
import random

import numpy as np
import pytest

from flowstat.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, anchor string"
WIDE = SCHEMA.replace("float", "double")


def brute(rows, every=50, positives=5, negatives=3):
    kept = [(i, k, [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v], n) for n, (i, v, k) in enumerate(rows)
            if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    big = (1 << 63) - 1
    out = []
    for i, k, v, n in kept:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), big if j is None else j, lab == k) for j, lab, w, m in kept if m != n]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in scored if r[2]][:positives]:
            fit = [r for r in scored if not r[2] and 50 * ps <= 100 * r[0] <= 95 * ps][:negatives]
            out += [(i, None if p == big else p, t + 1, None if j == big else j, min(ps, big), min(s, big)) for t, (s, j, _) in enumerate(fit)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema)


def vectors(n, dims, labels, seed, step=None):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dims)) * 0.3 + rnd.normal(size=(labels, dims))[rnd.integers(0, labels, n)] * 0.2
    x = np.round(x / step) * step if step else x
    return [(i, [float(np.float32(v)) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, rnd.integers(0, labels, n)))]


def test_mined_rows_equal_brute_force(spark):
    rows = vectors(1500, 16, 4, 1)
    assert got(H.mine(frame(spark, rows).repartition(5))) == brute(rows)


def test_ties_and_copies(spark):
    """Few distinct scores, copies of rows and ids, one label that holds most rows."""
    rows = vectors(600, 3, 3, 2, step=0.25)
    rows = [(i, v, 0 if i % 3 else k) for i, v, k in rows] + rows[:40] + [(50, [0.5, 0.5, 0.5], 1)] * 30
    assert got(H.mine(frame(spark, rows).repartition(3))) == brute(rows)


def test_anchors_in_groups(spark):
    rows = vectors(800, 8, 5, 3)
    assert got(H.mine(frame(spark, rows), every=10, anchors_at_once=7)) == brute(rows, every=10)


def test_nulls_lengths_and_extremes(spark):
    rnd = random.Random(4)
    rows = vectors(300, 6, 3, 5)
    rows += [(None, [0.2] * 6, 1), (None, None, 1), (1000, [float("nan")] * 6, 1), (1050, [float("inf"), 1.0], 1), (1100, [1.0, None], 2),
             (1150, [0.5, 0.5], 1), (1200, [], 1), (1250, [0.1] * 9, None), (1300, [0.3] * 9, 2), (-50, [0.4] * 6, 0)]
    rnd.shuffle(rows)
    assert got(H.mine(frame(spark, rows))) == brute(rows)
    huge = [(i, [x * 10 ** rnd.choice([0, 8, 20, 37]) for x in v], k) for i, v, k in vectors(120, 4, 2, 6)]
    huge = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in huge]
    large = [(i, [x * 1e7 for x in v], k) for i, v, k in vectors(200, 4, 2, 7)]
    # products beyond a double's 53 bits, within a long
    assert got(H.mine(frame(spark, [(i, [x / 10 for x in v], k) for i, v, k in large], WIDE))) == brute([(i, [x / 10 for x in v], k) for i, v, k in large])
    assert H.mine(frame(spark, huge)).count() >= 0


def test_empty(spark):
    assert H.mine(frame(spark, [])).count() == 0
    assert H.mine(frame(spark, [(1, [1.0], 0)])).count() == 0
    assert H.mine(frame(spark, [(50, [1.0], 0)])).count() == 0


def test_relabel(spark):
    rows = {r.vec_id: r.label for r in H.relabel(frame(spark, [(7, [1.0], 9), (14, [1.0], 3), (8, [1.0], 9), (None, [1.0], 4), (21, [1.0], None)])).collect()}
    assert rows == {7: 0, 14: 4, 8: 9, None: 4, 21: None}


def _anchor(x, k):
    return H.Anchors(np.array([-1]), np.array([0]), np.array([x], float), [[(-math.inf, math.inf)]], True), [[H.Best(-math.inf, math.inf, k)]]


@pytest.mark.parametrize("sign", [1, -1])
def test_threshold_stops_early(sign, monkeypatch):
    """With one strong dimension the lists are read to a part only, and the best rows are found all the same."""
    rnd = np.random.default_rng(9)
    n = 4096
    x = np.stack([np.floor(rnd.normal(size=n) * 4), np.arange(n) * 8.0], axis=1)
    scored = []
    real = H.take
    monkeypatch.setattr(H, "take", lambda block, places, *rest: (scored.append(len(places)), real(block, places, *rest)))
    anchors, best = _anchor([1.0, sign * 5.0], 5)
    ids = np.arange(n)
    H.search(H.Block(ids, ids, np.zeros(n, np.int64), x), anchors, best)
    scores = x @ np.array([1.0, sign * 5.0])
    want = sorted(((int(s), int(i), int(i)) for i, s in enumerate(scores)), key=lambda r: (-r[0], r[1]))[:5]
    assert best[0][0].rows == want
    assert sum(scored) < n / 4

import random

import numpy as np
import pytest

from flowstat.llm import ngram_join as J

from .helpers import LONG, empty, nasty, near_copies


def word_set(text):
    w = [x for x in (text or "").encode().lower().split()]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def expected(rows):
    """doc_id -> (n_shingles, component_id), over all pairs."""
    sets = [word_set(t) for _, t in rows]
    low = list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                low[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)] = min(d, ids.get(root(i), d))
    return sorted(((d, len(sets[i]), ids.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, **parameters):
    got = J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), **parameters).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


@pytest.mark.parametrize("parameters", [{}, {"sketch_bits": 8, "star_rounds": 1}, {"most_shared": 1, "star_rounds": 0}],
                         ids=["defaults", "small sketch", "no stars"])
def test_brute_force(spark, parameters):
    rows = near_copies()
    passage = " ".join(f"p{i}" for i in range(55))       # a passage that many documents share
    rnd = random.Random(1)
    rows += [(1000 + i, passage + " " + " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 60)))) for i in range(40)]
    rows += [(5000 + i, passage) for i in range(20)]      # exact copies of it
    assert run(spark, rows, **parameters) == expected(rows)


def test_chain_is_one_component(spark):
    """Each text is near the next one only; the ends share nothing."""
    words = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 3:i * 3 + 60])) for i in range(40)]
    got = run(spark, rows)
    assert got == expected(rows) and len({c for _, _, c in got}) == 1


def test_prefixes_share_enough():
    """Linked sets share at least the smaller l of their prefixes, for any counters."""
    rnd = np.random.default_rng(4)
    for _ in range(300):
        n = int(rnd.integers(1, 60))
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(rnd.integers(0, len(a) // 5 + 1))
        b = np.unique(np.concatenate([a[drop:], rnd.integers(0, 2**63, int(rnd.integers(0, 3)), dtype=np.uint64)]))
        counts = rnd.integers(0, 5000, 64) ** rnd.integers(0, 2, 64)
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        (p, l), (q, m) = (J.prefix(s, J.quarters(counts), 58, 10.0, 4) for s in (a, b))
        assert len(np.intersect1d(p, q)) >= min(l, m)


def test_costly_prefixes_get_longer():
    s = np.sort(np.random.default_rng(0).integers(0, 2**63, 400, dtype=np.uint64))
    assert J.prefix(s, J.quarters(np.ones(64, int)), 58, 1.0, 4)[1] == 1
    assert J.prefix(s, J.quarters(np.full(64, 10_000)), 58, 1.0, 4)[1] > 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (7, 3), (10, 11), (11, 10), (5, 5)]
    got = {r["class"]: r.comp for r in J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 7: 1, 11: 10} or got == {1: 1, 2: 1, 3: 1, 7: 1, 10: 10, 11: 10}


def test_nasty(spark):
    rows = [(r.doc_id, r.text) for r in nasty(spark).collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_join(nasty(spark)).collect()), key=str)
    assert got == expected(rows)
    assert J.jaccard_join(empty(spark)).count() == 0


def test_keep_one(spark):
    kept = J.keep_one(nasty(spark))
    assert kept.columns == nasty(spark).columns
    ids = sorted((str(r.doc_id), r.text) if r.text != LONG else (str(r.doc_id), "long") for r in kept.where("text is not null").collect())
    assert ("5", "one two three four five six") in ids and ("6", "one two three four five six") not in ids
    assert ("7", "long") in ids and ("8", "long") not in ids
    assert sum(x == ("None", "no id here at all, only text") for x in ids) == 1


def nip(n, place, share):
    return (n << 32) + (place << 4) + share


def test_shared_shingles_count_in_either_order(spark):
    """A and B share two shingles; under the second one a larger component turns their order."""
    a, b, c1, c2 = 1, 2, 9, 10
    rows = [(100, a, nip(50, 0, 2), 1), (100, b, nip(50, 0, 2), 2)]
    rows += [(200, k, nip(50, 1, 2), comp) for k, comp in ((a, 1), (b, 2), (c1, 9), (c2, 9))]
    left = spark.createDataFrame(rows, "shingle long, class long, nip long, comp long")
    assert [tuple(r) for r in J._all_pairs(left).collect()] == [(a, b)]

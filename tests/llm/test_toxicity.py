import itertools
import math
import random

import numpy as np

from flowstat.llm import toxicity as X

from .helpers import empty, nasty

BAD = ["scoundrel", "blockhead", "nitwit", "wretch"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    plain = ["".join(rnd.choice("aeioubcdlmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(plain) for _ in range(rnd.randint(1, 150))]
        toxic = int(rnd.random() < 0.25)
        if toxic:
            for _ in range(rnd.randint(1, 5)):
                w.insert(rnd.randrange(len(w) + 1), rnd.choice(BAD).title() if rnd.random() < 0.3 else rnd.choice(BAD))
        docs.append((i, " ".join(w) + "."))
        labels.append((i, toxic, 1))
    return docs, labels


def test_held_out_documents_and_spans(spark):
    docs, labels = corpus(1500)
    d, k = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in X.classify(d, k, steps=25).collect()}
    truth = {i: t for i, t, _ in labels}
    held = [r for r in got.values() if r.held_out]
    assert 300 < len(held) < 450 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    text = dict(docs)
    words = [text[r.doc_id][s.s:s.e].lower() for r in held for s in r.found]
    there = sum(w.strip(".").lower() in BAD for r in held for w in text[r.doc_id].split())
    assert sum(w in BAD for w in words) > 0.95 * there and sum(w not in BAD for w in words) <= 0.03 * len(words)


def test_marginals_and_gradient_against_all_tag_sequences():
    rnd = np.random.default_rng(2)
    k, sizes = 5, np.array([1, 4, 6])
    theta = rnd.normal(size=k + 4)
    row, step, feature = np.array([0, 1, 1, 1, 2, 2, 2]), np.array([0, 0, 2, 2, 1, 5, 3]), np.array([0, 1, 2, 2, 3, 4, 0])
    tags = np.zeros((3, X.STEPS))
    tags[1, 2] = tags[2, 0] = tags[2, 1] = 1
    times = np.array([1.0, 3.0, 2.0])

    def score(i, y, th):
        total = sum(th[k] for t in y if t) + sum(th[f] for r, s, f in zip(row, step, feature) if r == i and y[s])
        return total + sum({(0, 1): th[k + 1], (1, 0): th[k + 2], (1, 1): th[k + 3]}.get(p, 0.0) for p in itertools.pairwise(y))

    def loglik(th):
        total = 0.0
        for i, n in enumerate(sizes):
            z = math.log(sum(math.exp(score(i, y, th)) for y in itertools.product((0, 1), repeat=int(n))))
            total += times[i] * (score(i, tuple(int(x) for x in tags[i, :n]), th) - z)
        return total

    value, grad = X.log_likelihood(theta, sizes, times, (row, step, feature), tags)
    assert abs(value - loglik(theta)) < 1e-9
    for j in range(len(theta)):
        up, down = theta.copy(), theta.copy()
        up[j] += 1e-5
        down[j] -= 1e-5
        assert abs(grad[j] - (loglik(up) - loglik(down)) / 2e-5) < 1e-5
    emission = np.full((3, X.STEPS), theta[k])
    np.add.at(emission, (row, step), theta[feature])
    p = X.marginals(emission, sizes, theta[k + 1:])
    for i, n in enumerate(sizes):
        all_y = list(itertools.product((0, 1), repeat=int(n)))
        w = np.array([math.exp(score(i, y, theta)) for y in all_y])
        for t in range(n):
            assert abs(p[i, t] - sum(x for x, y in zip(w, all_y) if y[t]) / w.sum()) < 1e-9
        assert not p[i, n:].any()


def test_scoring_equals_word_by_word(spark):
    """top, mass and spans of every text against sequences read one by one."""
    docs, labels = corpus(200, seed=4)
    docs = [*docs, (1000, ""), (1001, None), (1002, "É " * 200 + "nitwit " * 3), (1003, "1 2 3 _"), (1004, "word " * 5000 + "wretch")]
    rows = spark.createDataFrame([(t, k) for (_, t), (_, k, _) in zip(docs, labels)], "text string, toxic int")
    field = X.fit(rows, 500, 10)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    k, out = len(field.theta) - 4, {r.doc_id: r for r in X.read_off(d, field).collect()}

    def weight(p):
        return field.theta[field.place[p]] if field.place[p] >= 0 else 0.0

    for i, text in docs:
        found = list(X.WORD.finditer(text or ""))
        w = [m.group().lower() for m in found]
        e = [field.theta[k] + sum(map(weight, X.own_places(x))) + (weight(X.near_places(w[t - 1])[0]) if t else 0)
             + (weight(X.near_places(w[t + 1])[1]) if t + 1 < len(w) else 0) for t, x in enumerate(w)]
        p = []
        for a in range(0, len(w), X.STEPS):
            part = np.zeros((1, X.STEPS))
            part[0, :len(e[a:a + X.STEPS])] = e[a:a + X.STEPS]
            size = min(X.STEPS, len(w) - a)
            p += X.marginals(part, np.array([size]), field.theta[k + 1:])[0, :size].tolist()
        r = out[i]
        assert r.words == len(w) and abs(r.mass - sum(p)) < 1e-9 and abs(r.top - max(p, default=0.0)) < 1e-9
        assert [(s.s, s.e) for s in r.found] == [found[t].span() for t, q in enumerate(p) if q >= 0.5]


def test_nasty_and_empty(spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, 1, 1), (None, 1, 1), (9, None, 1), (7, 0, 1), (77, 1, 1)], "doc_id long, toxic int, quality int")
    assert X.classify(nasty(spark), labels, steps=3).count() == nasty(spark).count()
    assert X.classify(empty(spark), labels, steps=3).count() == 0
    none = X.classify(nasty(spark), labels.limit(0), steps=3).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    one = X.classify(nasty(spark), labels.where("toxic = 1"), steps=3)
    assert all(0 <= r.score <= 1 for r in one.collect())

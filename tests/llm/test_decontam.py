import hashlib
import random

from flowstat.llm.decontam import decontaminate, keep_clean, search, searchers, words

from .helpers import empty, nasty


def expected(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        p = words(t)
        m = min(width, len(p))
        for k in range(len(p) - m + 1 if p else 0):
            for i in range(len(w) - m + 1):
                if w[i:i + m] == p[k:k + m]:
                    hit |= set(range(i, i + m))
                    found.add(item)
    return len(w), hit, found


def make(seed):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "C", "ä", "1"]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 15)))) for k in range(6)]
    texts = []
    for _ in range(25):
        t = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))]
        if rnd.random() < 0.6:
            t[rnd.randint(0, len(t)):0] = rnd.choice(items)[1].split()
        texts.append(" ".join(t).replace(" a", rnd.choice([" a", "-A", "\n a"])))
    return items, texts


def test_search_brute_force():
    for seed in range(30):
        items, texts = make(seed)
        found_by = searchers(items)
        for t in texts:
            n, spans, found = search(t, found_by)
            e_n, hit, e_found = expected(t, items)
            assert (n, found) == (e_n, e_found)
            assert {i for a, b in spans for i in range(a, b)} == hit


def test_word_borders():
    items = [(1, "the quick brown fox jumps over the lazy dog today again")]
    found_by = searchers(items)
    assert search("x the quick brown fox jumps over the lazy dog today y", found_by)[1] == [(1, 11)]
    assert search("xthe quick brown fox jumps over the lazy dog today", found_by)[1] == []
    assert search("THE quick, brown-fox jumps over the lazy dog today AGAIN!", found_by)[1] == [(0, 11)]


def run(spark, texts, items, **parameters):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), **parameters).collect()


def test_operator_in_one_and_in_many_blocks(spark):
    items, texts = make(99)
    items += [(None, "only null id words here one two three four five"), (50, None), (51, "..."), (3, items[3][1])]
    texts += [None, "", "only null id words here one two three four five"]
    for parameters in ({}, {"block_windows": 8}):
        got = {r.doc_id: r for r in run(spark, texts, items, **parameters)}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            n, hit, found = expected(t, items)
            names = ",".join(sorted(str(x) for x in found if x is not None))
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
                n, len(hit), len([x for x in found if x is not None]), hashlib.sha256(names.encode()).hexdigest(), bool(hit))


def test_keep_clean(spark):
    items, texts = make(7)
    docs = spark.createDataFrame([(i, t, "s", t) for i, t in enumerate(texts)], "doc_id long, text string, source string, items string")
    kept = keep_clean(docs, spark.createDataFrame(items, "item_id long, text string"), block_windows=10)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts) if not expected(t, items)[1]}


def test_nasty_and_empty(spark):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "item_id long, text string")
    got = decontaminate(nasty(spark), items).collect()
    assert len(got) == nasty(spark).count()
    assert sum(r.contaminated for r in got) == 3
    assert decontaminate(empty(spark), items).count() == 0
    assert not any(r.contaminated for r in decontaminate(nasty(spark), items.limit(0)).collect())


def test_blocks_never_share_a_task(spark):
    """However many blocks the benchmark has, a plan holds one pass."""
    words_ = [f"w{i}" for i in range(120)]
    items = [(i, " ".join(words_[i:i + 12])) for i in range(50)]
    docs = spark.createDataFrame([(i, " ".join(words_[i:i + 20]) if i % 2 else f"clean text {i}") for i in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    many, one = keep_clean(docs, bench, block_windows=3), keep_clean(docs, bench)
    assert many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r.doc_id for r in many.collect()) == sorted(r.doc_id for r in one.collect()) == list(range(0, 40, 2))

import random
import zlib

from pyspark.sql import functions as F

from flowstat.llm import quality
from flowstat.llm.common import table

from ..conftest import SF001
from .helpers import empty, nasty


def test_held_out_accuracy(spark):
    got = quality.classify(table(spark, SF001, "documents"), table(spark, SF001, "labels"))
    rows = got.join(table(spark, SF001, "labels"), "doc_id").collect()
    assert got.count() == table(spark, SF001, "documents").count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == r.quality for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_fit_does_not_see_the_held_out_fold(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    rows = quality.training_rows(docs, labels, 1000)
    assert not [r for r in rows.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]


def test_pairs_prefer_the_better_class(spark):
    rows = spark.createDataFrame([(1, 0, [2.0, 0.0]), (1, 1, [3.0, 0.0]), (0, 0, [1.0, 1.0])], "quality int, i int, x array<double>")
    assert sorted(tuple(r.d) for r in quality.preference_pairs(rows, 1).collect()) == [(1.0, -1.0), (2.0, -1.0)]


def test_vectors():
    good, junk = "This is a plain sentence of words.\nAnd another one here.", "WOW!! BUY!! NOW!! $$$ ### NOW!! NOW!!"
    assert len(quality.measures(good.encode())) == quality.N_MEASURES == len(quality.measures(b""))
    assert quality.measures(good.encode()) != quality.measures(junk.encode())
    assert quality.measures(" \n".encode()) == [0.0] * quality.N_MEASURES


def test_nasty_empty_and_unlabelled(spark):
    labels = spark.createDataFrame([(5, 1, 0), (4, 0, 0), (None, 1, 0), (77, 0, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = quality.classify(nasty(spark), known).collect()
        assert len(got) == nasty(spark).count() and all(0 <= r.score <= 1 for r in got)
    assert all(abs(r.score - 0.3) < 1e-9 and r.predicted == 1 for r in quality.classify(nasty(spark), labels.limit(0)).collect())
    assert quality.classify(empty(spark), labels).count() == 0
    kept = quality.keep_good(nasty(spark), labels.limit(0))
    assert kept.columns == nasty(spark).columns and kept.count() == nasty(spark).count()


def overlapping(spark, n=2000):
    """Rows with a tenth of the worse class, whose texts are noisier on average only."""
    rnd, rows = random.Random(5), []
    for i in range(n):
        bad = i % 10 == 0
        words = [rnd.choice("some plain words of every day that people use".split()) for _ in range(rnd.randint(20, 60))]
        noise = sum(rnd.random() < (0.5 if bad else 0.35) for _ in range(12))
        rows.append((i, " ".join(words + [f"{rnd.choice('$#%')}{k}!" for k in range(noise)]), int(not bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return table.select("doc_id", "text"), table.select("doc_id", "quality")


def test_threshold_does_not_depend_on_the_sample(spark):
    """As many training rows are rejected as the worse class has, also where the fit sees equal classes."""
    docs, labels = overlapping(spark)
    worse = labels.where(~quality.held_out(F.col("doc_id")) & (F.col("quality") == 0)).count()
    for sample in (60, 20_000):
        got = quality.classify(docs, labels, sample=sample).where("not held_out")
        assert abs(got.where("predicted = 0").count() - worse) <= 2


def test_nth_smallest(spark):
    values = [x / 7 for x in range(300)] * 2 + [1e6] * 50 + [-3.0]
    rows = spark.createDataFrame([(v,) for v in values], "raw double")
    for k in (0, 1, 2, 299, 400, 600, 601, 650):
        assert quality.nth_smallest(rows, k, bins=16, few=8) == sorted(values)[k]

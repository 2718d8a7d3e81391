"""Quality classifier: Bradley-Terry scores from preference pairs, thresholded at a score quantile.

Each text becomes a fixed vector of measures (characters by kind, words, lines).
From the labelled rows of the training folds, rows of the better class are
paired with rows of the worse one; the probability that a is preferred to b is
sigmoid(w . (x_a - x_b)), and w is fitted by logistic loss on the feature
differences, both ways round and without an intercept.  A text's raw score is
w . x.  The threshold is the quantile of the training rows' raw scores at the
share of the worse class, and the score is the sigmoid of the distance to it,
moved so that the threshold stands at ``cut``.

Labels, language, source and ids are never inputs.  The fit uses about
``sample`` training rows of each class at most, chosen by a hash of the id;
the threshold is taken over all labelled rows of the training folds, whatever
the size of the sample.  Every text is scored whole.

Cases.  Null text counts as empty; an empty text has the zero vector and gets a
score as any other.  Null ids count as the empty string for the fold.  Labels
without a document, and null labels, are not used; with no pair to learn from
all weights are zero and every score is ``cut``.  Repeated documents are scored
row by row.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, hash_sample, materialize

SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~[]", np.uint8)


def _line_measures(line: bytes) -> tuple[float, float, float]:
    """Shares of a line's words that end in symbols, are in capitals, repeat the word before."""
    w = line.split()
    if not w:
        return 0.0, 0.0, 0.0
    n = len(w)
    marked = sum(x[-1] in MARKS for x in w)
    capitals = sum(map(bytes.isupper, w))
    return marked / n, capitals / n, sum(map(eq, w, w[1:])) / n


MARKS = frozenset(b"#$%&*|!~^<>{}[]=+_@\\/")


def measures(text: bytes) -> list[float]:
    """The feature vector of a UTF-8 text."""
    if not text.strip():
        return [0.0] * N_MEASURES
    a = np.frombuffer(text, np.uint8)
    h = np.bincount(a, minlength=256)
    n = len(a)
    chars = n - int(h[0x80:0xC0].sum())
    accented_capitals = int(np.count_nonzero((a[:-1] == 0xC3) & (a[1:] >= 0x80) & (a[1:] <= 0x9E)))
    capitals = int(h[65:91].sum()) + accented_capitals
    letters = int(h[65:91].sum() + h[97:123].sum() + h[0xC0:].sum())
    symbols, digits = int(h[SYMBOLS].sum()), int(h[48:58].sum())
    w = text.split()
    count, kinds = len(w), len(set(w))
    repeats = sum(map(eq, w, w[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    by_line = [_line_measures(x) for x in lines]
    sizes = [len(x) for x in lines]
    total = sum(sizes)
    marked, upper, same = (sum(s * (m[i] > 0.4) for s, m in zip(sizes, by_line)) / total for i in range(3))
    ends = int(h[[33, 46, 63]].sum())
    shares = [symbols / chars, capitals / max(letters, 1), digits / chars, repeats / count, int(h[33]) / chars,
              int(h[124]) / chars, letters / chars, ends / count]
    return [*shares, *(math.sqrt(x) for x in shares), marked, upper, same, math.sqrt(marked), math.sqrt(upper), math.sqrt(same),
            float(marked > 0), float(upper > 0), float(same > 0),
            math.log1p(count) / 10, math.log1p(kinds) / 10, kinds / count, math.log((kinds + 1) / (count + 1)),
            len(set(lines)) / len(lines), math.log1p(len(lines)) / 10, math.log1p(count / len(lines)) / 10,
            min(chars / count, 40) / 10, math.sqrt(max(x[0] for x in by_line)), max(x[1] for x in by_line), max(x[2] for x in by_line), 1.0]


N_MEASURES = 37


def with_features(docs: DataFrame, name: str = "x") -> DataFrame:
    """``docs`` with the vector of every row's text as column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [measures(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(x, pa.list_(pa.float64()))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def preference_pairs(rows: DataFrame, opponents: int) -> DataFrame:
    """Differences x_better - x_worse of rows (quality, i, x), numbered by class:
    each row of the better class meets ``opponents`` of the worse."""
    better, worse = rows.where("quality = 1"), rows.where("quality = 0")
    n = worse.count()
    if not n:
        return better.select(F.col("x").alias("d")).limit(0)
    meet = F.explode(F.array(*[F.pmod(F.col("i") * 31 + F.lit(k * 7919), F.lit(n)) for k in range(opponents)]))
    return (better.select("x", meet.alias("j")).join(worse.select(F.col("i").alias("j"), F.col("x").alias("y")), "j")
            .select(F.zip_with("x", "y", lambda a, b: a - b).alias("d")))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, quality, x, i of about ``sample`` labelled rows of each class at most, numbered by class."""
    known = labels.select("doc_id", "quality").where(~held_out(F.col("doc_id")))
    some = [hash_sample(known.where(F.col("quality") == q), sample, "doc_id") for q in (0, 1)]
    # about 2 * sample rows at most
    found = docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id")
    rows = with_features(found).select("doc_id", "quality", "x")
    order = W.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id", "x")
    return materialize(rows.withColumn("i", F.row_number().over(order) - 1), "quality-sample")


def fit(rows: DataFrame, opponents: int = 4) -> list[float] | None:
    """Weights from training rows; None with no pair to learn from."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    pairs = preference_pairs(rows, opponents)
    both = (pairs.select("d", F.lit(1.0).alias("label"))
            .unionByName(pairs.select(F.transform("d", lambda x: -x).alias("d"), F.lit(0.0).alias("label"))))
    both = materialize(both, "quality-pairs")
    if both.isEmpty():
        return None
    model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=100).fit(
        both.select(array_to_vector("d").alias("features"), "label"))
    return [float(x) for x in model.coefficients]


def nth_smallest(rows: DataFrame, k: int, bins: int = 4096, few: int = 4096) -> float:
    """The value with ``k`` values before it in the sorted column ``raw``, exactly:
    counts by equal bins narrow the range until few distinct values are left in it."""
    while True:
        low, high, kinds = rows.agg(F.min("raw"), F.max("raw"), F.approx_count_distinct("raw")).first()
        width = (high - low) / bins
        if kinds <= few or not width > 0:
            step = F.col("raw")
        else:
            step = F.least(F.floor((F.col("raw") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        # at most ``bins`` rows, or a few more than ``few`` distinct values
        for value, n in rows.groupBy(step.alias("at")).count().orderBy("at").collect():
            if k < n:
                break
            k -= n
        if kinds <= few or not width > 0:
            return value
        rows = rows.where(step == value)


def quantile(docs: DataFrame, labels: DataFrame, weights: list[float]) -> float:
    """The threshold: the quantile of the raw scores of all labelled rows of the
    training folds at the share of the worse class."""
    known = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    scored = with_features(texts).select("doc_id", raw_score(weights).alias("raw"))
    rows = materialize(scored.join(known, "doc_id").select("quality", "raw"), "quality-raw")
    worse = rows.where("quality = 0").count()
    # the quantile at the worse class's share lies between two rows; the threshold is halfway
    return (nth_smallest(rows, worse - 1) + nth_smallest(rows, worse)) / 2


def raw_score(weights: list[float], vector: str = "x") -> Column:
    return F.aggregate(F.zip_with(vector, F.array(*[F.lit(w) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def with_score(docs: DataFrame, labels: DataFrame, name: str = "score", cut: float = 0.3, sample: int = 20_000) -> DataFrame:
    """``docs`` with the score of every row as column ``name``."""
    weights = fit(training_rows(docs, labels, sample))
    threshold = quantile(docs, labels, weights) if weights else 0.0
    weights = weights or [0.0] * N_MEASURES
    vector = fresh(docs, "x")
    raw = raw_score(weights, vector)
    score = 1 / (1 + F.exp(F.lit(threshold - math.log(cut / (1 - cut))) - raw))
    # rounding must not move a text at the threshold below the cut
    score = F.when(raw >= threshold, F.greatest(score, F.lit(cut))).otherwise(score)
    return with_features(docs, vector).withColumn(name, score).drop(vector)


def classify(docs: DataFrame, labels: DataFrame, cut: float = 0.3, sample: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    return (with_score(docs.select("doc_id", "text"), labels, "score", cut, sample)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = 0.3, sample: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that score at least ``cut``."""
    name = fresh(docs, "score")
    return with_score(docs, labels, name, cut, sample).where(F.col(name) >= cut).drop(name)

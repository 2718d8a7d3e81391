"""Toxicity: a linear-chain conditional random field over the words of a text.

The field tags every word as toxic (T) or not (O).  It is trained on labelled
words, made from labelled documents: in a toxic document the words that bear a feature
seen far more often in toxic documents than in others (``SEED``) are T, all other
words, and all words of the others, are O.  Forward-backward gives each word's marginal
probability of T; a document's marginals are aggregated to a score (its largest one
and their sum, weighed against the number of words by a logistic curve), and words
with a marginal of ``tag`` or more are the offending spans.

Features of a word are itself, its beginnings and its ends, and the words before and
behind it, hashed to ``BUCKETS`` places.  The ``features`` places whose document
frequencies differ most between the classes have a weight each, and three
transitions and a bias; the model's size is fixed.  A chain is a sequence of at most
``STEPS`` words; sequences that are alike are counted once.  The gradient of the log-likelihood is
summed over tasks, a job for each step of the ascent.

Training uses about ``sample`` labelled rows of each class at most, chosen by a hash of the id, from
the folds that are not held out: crc32(id) % 4 in (0, 1) for the field, 3 for the
curve; every text is scored whole.  Labels, language, source and ids are never
inputs of a score.

Cases.  Null text counts as empty; texts without words have no marginals and get the curve's
value for none.  Null ids count as the empty string for the fold.  Labels without a document
and null labels are not used.  Without both classes in the sample every score is the share of
toxic rows in it (0 without any).  Very long texts are cut in sequences, none is dropped.  Repeated documents are scored
row by row.  Empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, materialize

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20
STEPS = 64
SEED = (2.5, 4.0)        # least log odds ratio, and least number of standard errors, of a seed feature
Z = 3.0                  # least number of standard errors of any feature
TEXT = 1 << 22           # characters that are taken together
PARTS = 16               # of the training sequences


# ------------------------------------------------------------------- features
def own_places(word: str) -> list[int]:
    """Places of a word's own features: the word, its beginnings of 4 to 7 bytes and its ends of 4 and 6."""
    w, crc = word.encode(), zlib.crc32
    found, n = [crc(w) % BUCKETS], len(w)
    if n > 4:
        start = crc(w[:4], 1)
        found.append(start % BUCKETS)
        for k in range(4, min(n - 1, 7)):  # each beginning goes on from the one before
            start = crc(w[k:k + 1], start)
            found.append(start % BUCKETS)
        found.append(crc(w[-4:], 2) % BUCKETS)
        if n > 6:
            found.append(crc(w[-6:], 3) % BUCKETS)
    return found


def near_places(word: str) -> tuple[int, int]:
    """Places of the features that a word gives to the next one and to the one before."""
    w = word.encode()
    return zlib.crc32(w, 4) % BUCKETS, zlib.crc32(w, 5) % BUCKETS


class Words:
    """What ``make`` gives for a word, kept for the words met last."""

    def __init__(self, make, most: int = 200_000):
        self.make, self.most, self.new, self.old = make, most, {}, {}

    def __getitem__(self, word: str):
        got = self.new.get(word)
        if got is None:
            got = self.old.get(word) or self.make(word.lower())
            if len(self.new) >= self.most:  # half of what is kept goes
                self.old, self.new = self.new, {}
            self.new[word] = got
        return got


def words_of(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Codes of all words of the texts, the distinct words, and the number of words of each text."""
    found = [WORD.findall(t) for t in texts]
    coded = pa.array([w for f in found for w in f], pa.string()).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist(), np.array([len(f) for f in found], np.int64)


def pieces(texts: list[str]) -> Iterator[slice]:
    """Slices of the list whose texts have about ``TEXT`` characters."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= TEXT:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


# ----------------------------------------------------------------- the field
class Field(NamedTuple):
    """Weights: ``place[bucket]`` is a feature's number or -1; ``theta`` its weight for T, then the
    bias of T and the transitions O-T, T-O, T-T (O-O counts as 0)."""
    place: np.ndarray
    theta: np.ndarray


def starts_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with so many words: the first word, the number of words and the text of each sequence."""
    parts = -(-sizes // STEPS)
    doc = np.repeat(np.arange(len(sizes)), parts)
    inside = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(np.cumsum(sizes) - sizes, parts) + inside * STEPS
    return first, np.minimum(STEPS, np.repeat(sizes, parts) - inside * STEPS), doc


def messages(emission: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log messages of (sequences, steps) scores of T, and the log partition sums.

    Steps beyond a sequence's size are not looked at.  ``moves`` are O-T, T-O, T-T."""
    n, steps = emission.shape
    ot, to, tt = moves
    ahead, back = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
    ahead[:, 0, 1] = emission[:, 0]
    for t in range(1, steps):
        o, x = ahead[:, t - 1, 0], ahead[:, t - 1, 1]
        ahead[:, t, 0] = np.logaddexp(o, x + to)
        ahead[:, t, 1] = np.logaddexp(o + ot, x + tt) + emission[:, t]
    for t in range(steps - 2, -1, -1):
        inside = t + 1 < sizes
        o, x = back[:, t + 1, 0], back[:, t + 1, 1] + emission[:, t + 1]
        back[:, t, 0] = np.where(inside, np.logaddexp(o, x + ot), 0.0)
        back[:, t, 1] = np.where(inside, np.logaddexp(o + to, x + tt), 0.0)
    end = ahead[np.arange(n), sizes - 1]
    return ahead, back, np.logaddexp(end[:, 0], end[:, 1])


def marginals(emission: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of T at each step, 0 beyond a sequence's size."""
    ahead, back, z = messages(emission, sizes, moves)
    p = np.exp(ahead[:, :, 1] + back[:, :, 1] - z[:, None])
    return np.where(np.arange(emission.shape[1]) < sizes[:, None], p, 0.0)


def log_likelihood(theta: np.ndarray, sizes: np.ndarray, times: np.ndarray, features: tuple[np.ndarray, np.ndarray, np.ndarray],
                   tags: np.ndarray) -> tuple[float, np.ndarray]:
    """Log-likelihood of sequences and its gradient.

    ``features`` are (sequence, step, feature) of all features, ``tags`` the (sequences, STEPS) tags."""
    n, k = len(sizes), len(theta) - 4
    row, step, feature = features
    emission = np.full((n, STEPS), theta[k])
    np.add.at(emission, (row, step), theta[feature])
    moves = theta[k + 1:]
    inside = np.arange(STEPS) < sizes[:, None]
    ahead, back, z = messages(emission, sizes, moves)
    p = np.where(inside, np.exp(ahead[:, :, 1] + back[:, :, 1] - z[:, None]), 0.0)
    rest = (np.where(inside, tags, 0) - p) * times[:, None]
    grad = np.zeros(len(theta))
    np.add.at(grad, feature, rest[row, step])
    grad[k] = rest.sum()
    pair = inside[:, 1:]
    before, after = tags[:, :-1] * pair, tags[:, 1:] * pair
    value = float((times * ((np.where(inside, tags * emission, 0)).sum(axis=1) - z)).sum())
    for i, (x, y) in enumerate(((0, 1), (1, 0), (1, 1))):
        seen = (before if x else pair - before) * (after if y else pair - after)
        expected = np.exp(ahead[:, :-1, x] + moves[i] + (emission[:, 1:] if y else 0) + back[:, 1:, y] - z[:, None])
        value += float((times[:, None] * seen).sum() * moves[i])
        grad[k + 1 + i] = ((seen - np.where(pair, expected, 0)) * times[:, None]).sum()
    return value, grad


# ------------------------------------------------------------------- training
def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, toxic, fold of at most ``sample`` labelled rows of each class, none of them held out."""
    known = labels.select("doc_id", "toxic").where((fold(F.col("doc_id")) != 2) & F.col("doc_id").isNotNull())
    some = [hash_sample(known.where(F.col("toxic") == q), sample, "doc_id") for q in (0, 1)]
    # 2 * sample rows at most
    found = docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id")
    return materialize(found.select("text", "toxic", fold(F.col("doc_id")).alias("fold")), "toxicity-sample")


def choose(rows: DataFrame, features: int) -> dict[int, tuple[float, float]]:
    """place -> (log odds ratio, standard errors) of the features whose document frequencies differ most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int32)
        places = Words(lambda w: [*own_places(w), *near_places(w)])
        for batch in batches:
            for text, toxic in zip(_texts(batch), batch.column("toxic").to_pylist()):
                seen = {p for w in set(WORD.findall(text)) for p in places[w]}
                counts[toxic, list(seen)] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[1, at].astype(np.int64)), pa.array(counts[0, at].astype(np.int64))],
                                         names=["place", "toxic", "clean"])

    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}  # two rows
    sums = rows.select("text", "toxic").mapInArrow(run, "place int, toxic long, clean long").groupBy("place").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b"))

    def odds(c: Column, k: int) -> Column:
        return F.log((c + 0.5) / (F.lit(n[k]) - c + 0.5))

    ratio = odds(F.col("a"), 1) - odds(F.col("b"), 0)
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = (sums.select("place", ratio.alias("ratio"), (ratio / error).alias("z")).where(F.abs("z") >= Z)
            .orderBy(F.desc(F.abs("z")), "place").limit(features))
    return {r.place: (r.ratio, r.z) for r in best.collect()}  # ``features`` rows at most


def sequences(rows: DataFrame, chosen: dict[int, tuple[float, float]]) -> tuple[DataFrame, np.ndarray]:
    """Labelled sequences (size, features coded step * count + number, steps that are T, times), and the table of places."""
    place = np.full(BUCKETS, -1, np.int32)
    place[list(chosen)] = np.arange(len(chosen))
    seeds = {p for p, (ratio, z) in chosen.items() if ratio >= SEED[0] and z >= SEED[1]}
    count = len(chosen)
    shared = rows.sparkSession.sparkContext.broadcast((place, seeds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seeds = shared.value

        def make(word: str) -> tuple:
            own, near = own_places(word), near_places(word)
            return ([int(place[p]) for p in own if place[p] >= 0], [int(place[p]) for p in near[:1] if place[p] >= 0],
                    [int(place[p]) for p in near[1:] if place[p] >= 0], any(p in seeds for p in own))

        known = Words(make)
        for batch in batches:
            sizes, features, tags = [], [], []
            for text, toxic in zip(_texts(batch), batch.column("toxic").to_pylist()):
                w = [known[x] for x in WORD.findall(text)]
                for a in range(0, len(w), STEPS):
                    part = w[a:a + STEPS]
                    sizes.append(len(part))
                    found = []
                    for t, x in enumerate(part):
                        near = (w[a + t - 1][1] if a + t else []) + (w[a + t + 1][2] if a + t + 1 < len(w) else [])
                        if x[0] or near:
                            found += [t * count + f for f in (*x[0], *near)]
                    features.append(found)
                    tags.append([t for t, x in enumerate(part) if x[3]] if toxic else [])
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(features, pa.list_(pa.int32())), pa.array(tags, pa.list_(pa.int32()))],
                                             names=["size", "features", "tags"])

    found = rows.select("text", "toxic").mapInArrow(run, "size int, features array<int>, tags array<int>")
    alike = found.groupBy("size", "features", "tags").agg(F.count(F.lit(1)).alias("times"))
    return materialize(alike.repartition(PARTS), "toxicity-sequences"), place


def _gradient(found: DataFrame, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Log-likelihood and gradient over all sequences: one vector from each task."""
    count = len(theta) - 4

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(x) for x in column], np.int64)
        return np.repeat(np.arange(len(lengths)), lengths), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, grad = 0.0, np.zeros(len(theta))
        for batch in batches:
            row, coded = flat(batch.column("features"))
            tags = np.zeros((batch.num_rows, STEPS))
            tags[flat(batch.column("tags"))] = 1
            v, g = log_likelihood(theta, batch.column("size").to_numpy().astype(np.int64), batch.column("times").to_numpy().astype(float),
                                  (row, coded // max(count, 1), coded % max(count, 1)), tags)
            value, grad = value + v, grad + g
        yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([grad.tobytes()], pa.binary())], names=["value", "grad"])

    parts = found.mapInArrow(run, "value double, grad binary").collect()  # a row for each task, as long as the model
    return sum(p.value for p in parts), sum((np.frombuffer(p.grad) for p in parts), np.zeros(len(theta)))


def fit(rows: DataFrame, features: int, steps: int, penalty: float = 1.0) -> Field | None:
    """The field trained on rows (text, toxic); None without both classes."""
    if rows.select("toxic").distinct().count() < 2:
        return None
    chosen = choose(rows, features)
    found, place = sequences(rows, chosen)
    theta = np.zeros(len(chosen) + 4)
    theta[len(chosen)] = -4.0  # T is rare
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n = max(1, found.agg(F.sum("times")).first()[0] or 1)
    for step in range(1, steps + 1):  # ascent with moments; the problem is concave
        _, grad = _gradient(found, theta)
        grad = (grad - penalty * theta) / n
        first, second = 0.8 * first + 0.2 * grad, 0.95 * second + 0.05 * grad * grad
        theta = theta + 0.5 * (1 - 0.8 * step / steps) * (first / (1 - 0.8 ** step)) / (np.sqrt(second / (1 - 0.95 ** step)) + 1e-9)
    return Field(place, theta)


# -------------------------------------------------------------------- scoring
def read_off(docs: DataFrame, field: Field, tag: float = 0.5) -> DataFrame:
    """``docs`` with words (their number), top (largest marginal), mass (their sum) and
    found (start, end, p of the tagged words, in code points) of every row's text."""
    from pyspark.sql import types as T

    shared = docs.sparkSession.sparkContext.broadcast(field)
    spans = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, theta = shared.value
        k = len(theta) - 4
        at = np.flatnonzero(place >= 0)
        weight = dict(zip(at.tolist(), theta[place[at]].tolist())).get

        def make(word: str) -> tuple[float, float, float]:
            ahead, behind = near_places(word)
            return sum(weight(p, 0.0) for p in own_places(word)), weight(ahead, 0.0), weight(behind, 0.0)

        known, moves = Words(make), theta[k + 1:]
        # sequences without any feature depend on their size only
        plain = marginals(np.full((STEPS, STEPS), theta[k]), np.arange(1, STEPS + 1), moves)
        for batch in batches:
            texts, out = _texts(batch), []
            for part in pieces(texts):
                out += score(texts[part], known, plain, theta[k], moves)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.float64()),
                 pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], spans)],
                names=[*batch.schema.names, "words", "top", "mass", "found"])

    def score(texts: list[str], known: Words, plain: np.ndarray, bias: float, moves: np.ndarray) -> list[tuple]:
        codes, distinct, sizes = words_of(texts)
        n = len(codes)
        own, ahead, behind = np.array([known[w] for w in distinct]).reshape(-1, 3).T
        e = np.full(n, bias)
        e += own[codes]
        ends = np.cumsum(sizes)
        if n:
            inner = np.ones(n, bool)
            inner[(ends - sizes)[sizes > 0]] = False       # no word before the first one of a text
            e[1:] += np.where(inner[1:], ahead[codes[:-1]], 0)
            e[:-1] += np.where(inner[1:], behind[codes[1:]], 0)
        first, length, doc = starts_of(sizes)
        odd = np.add.reduceat(np.abs(e - bias) > 1e-12, first) > 0 if len(first) else np.zeros(0, bool)
        top, mass = np.zeros(len(texts)), np.zeros(len(texts))
        if len(first):
            p = plain[length - 1]
            at = np.minimum(first[odd, None] + np.arange(STEPS), n - 1)
            if odd.any():
                p[odd] = marginals(e[at], length[odd], moves)
            np.maximum.at(top, doc, p.max(axis=1))
            np.add.at(mass, doc, p.sum(axis=1))
        spans: dict[int, list] = {}
        if len(first):
            for s, t in zip(*np.nonzero(p >= tag)):
                spans.setdefault(int(doc[s]), []).append((int(first[s] + t - (ends - sizes)[doc[s]]), float(p[s, t])))
        out = []
        for i, text in enumerate(texts):
            tagged = []
            if i in spans:
                where = [m.span() for m in WORD.finditer(text)]
                tagged = [{"s": where[w][0], "e": where[w][1], "p": q} for w, q in spans[i]]
            out.append((int(sizes[i]), float(top[i]), float(mass[i]), tagged))
        return out

    extra = [T.StructField("words", T.LongType()), T.StructField("top", T.DoubleType()), T.StructField("mass", T.DoubleType()),
             T.StructField("found", T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType()), T.StructField("p", T.DoubleType())])))]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))


def aggregates() -> Column:
    """What the curve weighs: the largest marginal, their sum and the number of words."""
    top = F.least(F.greatest(F.col("top"), F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.array(F.log(top / (1 - top)), F.log(F.col("mass") + 1e-3), F.log1p(F.col("words").cast("double")))


def curve(rows: DataFrame, field: Field) -> list[float] | None:
    """Weights and intercept of the logistic curve from rows (text, toxic); None without both classes."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    read = materialize(read_off(rows.select("text", "toxic"), field).select(aggregates().alias("a"), F.col("toxic").cast("double").alias("label")), "toxicity-curve")
    if read.select("label").distinct().count() < 2:
        return None
    model = LogisticRegression(regParam=1e-4, maxIter=50).fit(read.select(array_to_vector("a").alias("features"), "label"))
    return [*(float(x) for x in model.coefficients), float(model.intercept)]


def classify(docs: DataFrame, labels: DataFrame, cut: float = 0.3, sample: int = 5_000, features: int = 4096, steps: int = 40) -> DataFrame:
    """doc_id, held_out, score, predicted, found (start, end and marginal of the tagged words) of every row of ``docs``."""
    rows = training_rows(docs, labels, sample)
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}  # two rows
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    field = fit(rows.where("fold <> 3"), features, steps)
    weights = curve(rows.where("fold = 3"), field) if field else None
    if field and not weights:  # too few rows for a fold of their own
        weights = curve(rows, field)
    out = read_off(docs.select("doc_id", "text"), field or Field(np.full(BUCKETS, -1, np.int32), np.array([-30.0, 0, 0, 0])))
    if weights:
        a = aggregates()
        total = sum((a[i] * F.lit(w) for i, w in enumerate(weights[:-1])), F.lit(weights[-1]))
        score = 1 / (1 + F.exp(-total))
    else:
        score = F.lit(share)
    return (out.withColumn("score", score)
            .select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "found"))

"""Hard-negative mining by Fagin's threshold algorithm.

Rows are vectors with a label; a row's score for an anchor is their integer inner
product over components floor(scale * x).  An anchor's positives are its best other
rows of the same label; a positive's window holds the rows of other labels whose
score lies between two shares of the positive's own, and its hard negatives are
the best rows in the window.

Method.  A task reads its rows in blocks.  A block keeps, for each dimension, its
rows sorted by that component.  For a set of anchors it goes down these lists
step by step, from the top where the anchor's component is positive and from the
bottom where it is negative (sorted access); the rows met get their whole score
(random access, integers).  The threshold, the score of a row that would have the
last values read in every list, bounds all rows not met yet; an anchor is done
once the threshold falls strictly below the kth best score of each of its
windows (strictly, as a row of equal score and smaller id comes first), or
below the window's lower end while it holds fewer than k.  The best rows found go
on to the task's next block, so later blocks stop earlier.

Anchors are a stated query set.  They are taken ``anchors_at_once`` at a time (the
bound of what is broadcast); a pass over all rows finds the positives, another one
the negatives, and one small aggregate each joins what the tasks found (k rows for
each anchor and task).  No label, block or anchor is gathered in one task.

Cases.  Rows with a null label or vector, or a null or non-finite component, take
no part.  Null ids come after all others among equal scores and are no anchors.  Repeated
rows are rows of their own: a copy of an anchor can be its positive.  Shorter
vectors count as filled up with zeros.  Scores are exact whatever the
components' size; those beyond a long count as its ends.  Without
positives, or with empty windows, an anchor has no result.  Empty tables
give an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

CELLS = 1 << 20          # components of a block
STEPS = (1 / 64, 1 / 16, 1 / 4, 1)
TOGETHER = 64            # anchors that go down the lists together
LONG = (-(1 << 63), (1 << 63) - 1)


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding (doubles) of the rows that take part, with a number of their own; written once."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    kept = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    return materialize(kept.select("vec_id", F.col("label").cast("long").alias("label"), x.alias("embedding"))
                       .withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


# ------------------------------------------------------------------ in a task
def components(vectors: list[np.ndarray], scale: float, width: int) -> np.ndarray:
    """floor(scale * x), vectors filled up to ``width``; exact as doubles, or as Python's integers where a
    double is too coarse for scores."""
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = v
    with np.errstate(over="ignore"):
        whole = np.floor(scale * x)
    if not np.isfinite(whole).all():
        return np.array([[math.floor(scale * float(v)) if abs(v) < 1e300 else int(scale) * int(v) for v in r] for r in x], object).reshape(x.shape)
    return whole


def as_integers(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)


def same_kind(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every score is a whole number below 2**53, else as integers."""
    if object not in (a.dtype, b.dtype):
        if a.size == 0 or b.size == 0 or a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < 2.0 ** 53:
            return a, b
    return as_integers(a), as_integers(b)


class Anchors(NamedTuple):
    """Anchors with their windows: ``low`` and ``high`` of each, ``mate`` whether a window takes rows of the anchor's label."""
    row: np.ndarray
    label: np.ndarray
    x: np.ndarray
    windows: list[list[tuple[float, float]]]   # (low, high) by anchor
    mate: bool


class Best:
    """The first k rows (score descending, id, row) of a window, from all blocks so far."""

    def __init__(self, low, high, k: int):
        self.low, self.high, self.k, self.rows = low, high, k, []

    def floor(self):
        """A row must reach this to be taken."""
        return max(self.rows[-1][0], self.low) if len(self.rows) == self.k else self.low

    def full(self) -> bool:
        return len(self.rows) == self.k

    def add(self, found: list[tuple]) -> None:
        self.rows = sorted([*self.rows, *found], key=lambda r: (-r[0], r[1], r[2]))[:self.k]


class Block:
    """Rows of a block with the sorted lists of each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.rows, self.labels, self.x = ids, rows, labels, x
        self.order = np.argsort(x, axis=0, kind="stable")       # ascending by component
        self.sorted = np.take_along_axis(x, self.order, axis=0)

    def met(self, anchors: np.ndarray, done: int, depth: int) -> np.ndarray:
        """Places of the rows that sorted access to ``depth`` meets below ``done``, for any of the anchors."""
        n, seen = len(self.ids), np.zeros(len(self.ids), bool)
        up, down = (anchors > 0).any(axis=0), (anchors < 0).any(axis=0)
        seen[self.order[n - depth:n - done, up]] = True
        seen[self.order[done:depth, down]] = True
        return seen

    def thresholds(self, anchors: np.ndarray, depth: int) -> np.ndarray:
        """For each anchor the score of a row with the values at ``depth`` of all its lists."""
        n = len(self.ids)
        zero = anchors * 0
        return np.maximum(anchors, zero) @ self.sorted[n - depth] + np.minimum(anchors, zero) @ self.sorted[depth - 1]


def search(block: Block, anchors: Anchors, best: list[list[Best]]) -> None:
    """Bring the windows of all anchors up to date with a block."""
    n = len(block.ids)
    a_all, block_x = same_kind(anchors.x, block.x)
    if block_x.dtype != block.x.dtype:
        block = Block(block.ids, block.rows, block.labels, block_x)
    # ids decide among equal scores; places in a block stand for them
    for begin in range(0, len(a_all), TOGETHER):
        active = np.arange(begin, min(begin + TOGETHER, len(a_all)))
        active = active[[bool(best[i]) for i in active]]
        scored, done = np.zeros(n, bool), 0
        for step in STEPS:
            depth = max(1, math.ceil(n * step))
            if not len(active) or depth <= done:
                continue
            a = a_all[active]
            fresh = block.met(a, done, depth) & ~scored if step < 1 else ~scored
            places = np.flatnonzero(fresh)
            scored |= fresh
            done = depth
            if len(places):
                scores = a @ block.x[places].T
                take(block, places, scores, active, anchors, best)
            if step < 1:
                limit = block.thresholds(a, depth)
                # met lists belong to the active anchors; what they have not met scores at most the threshold
                going = [any(t >= w.floor() for w in best[i]) for t, i in zip(limit, active)]
                active = active[going]


def take(block: Block, places: np.ndarray, scores: np.ndarray, active: np.ndarray, anchors: Anchors, best: list[list[Best]]) -> None:
    labels, rows = block.labels[places], block.rows[places]
    for s, i in zip(scores, active):
        windows = best[i]
        floor = min(w.floor() for w in windows)
        fit = (s >= floor) & (s <= max(w.high for w in windows))
        fit &= ((labels == anchors.label[i]) & (rows != anchors.row[i])) if anchors.mate else labels != anchors.label[i]
        which = np.flatnonzero(fit)
        if not len(which):
            continue
        which = which[np.lexsort((rows[which], block.ids[places[which]], np.negative(s[which])))] if s.dtype != object else \
            np.array(sorted(which, key=lambda j: (-s[j], block.ids[places[j]], rows[j])))
        found = s[which]
        for w in windows:
            # scores fall; the first ones within the window
            first = int(np.searchsorted(-found, -w.high, side="left")) if w.high != math.inf else 0
            some = [(int(found[j]), int(block.ids[places[which[j]]]), int(rows[which[j]])) for j in range(first, min(first + w.k, len(which)))]
            some = [r for r in some if r[0] >= w.floor()]
            if some:
                w.add(some)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *(len(v) for v in column)])
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _blocks(batch: pa.RecordBatch, scale: float, width: int) -> Iterator[Block]:
    vectors = _vectors(batch.column("embedding"))
    width = max([width, *map(len, vectors)])
    ids = np.array([LONG[1] if v is None else v for v in batch.column("vec_id").to_pylist()], np.int64)
    rows, labels = batch.column("row").to_numpy(), batch.column("label").to_numpy()
    size = max(256, CELLS // max(width, 1))
    for a in range(0, len(vectors), size):
        yield Block(ids[a:a + size], rows[a:a + size], labels[a:a + size], components(vectors[a:a + size], scale, width))


def _pass(rows: DataFrame, anchors: Anchors, k: int, scale: float) -> DataFrame:
    """anchor, window, score, vec_id, row: the first k rows of each window that each task found."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        # nothing reaches an empty window
        best = [[Best(low if low <= high else math.inf, high, k) for low, high in windows] for windows in anchors.windows]
        width = anchors.x.shape[1]
        for batch in batches:
            for block in _blocks(batch, scale, width):
                wide = block.x.shape[1]
                if wide > width:  # zeros for the anchors' missing components
                    own = anchors._replace(x=np.concatenate([anchors.x, np.zeros((len(anchors.x), wide - width), anchors.x.dtype)], axis=1))
                else:
                    own = anchors
                search(block, own, best)
        out = [(int(anchors.row[i]), w, r) for i, windows in enumerate(best) for w, b in enumerate(windows) for r in b.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
             pa.array([min(max(o[2][0], LONG[0]), LONG[1]) for o in out], pa.int64()),
             pa.array([o[2][1] for o in out], pa.int64()), pa.array([o[2][2] for o in out], pa.int64())],
            names=["anchor", "window", "score", "id", "row"])

    found = rows.mapInArrow(run, "anchor long, window int, score long, id long, row long")
    order = W.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row")
    return materialize(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "negatives-found")


# ----------------------------------------------------------------- the search
def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score between ``low`` and ``high`` hundredths of ``score``."""
    return -(-low * score // 100), high * score // 100


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: float = 256, anchors_at_once: int = 8192) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors are
    the rows whose id is divisible by ``every``.  ``rows`` has vec_id, embedding, label."""
    spark, kept = rows.sparkSession, usable(rows)
    results, held = [], []

    def some(group: list) -> None:
        vectors = [np.array(r.embedding, float) for r in group]
        x = components(vectors, scale, max([0, *map(len, vectors)]))
        row, label = np.array([r.row for r in group], np.int64), np.array([r.label for r in group], np.int64)
        mates = Anchors(row, label, x, [[(-math.inf, math.inf)]] * len(group), True)
        best = _pass(kept, mates, positives, scale)
        # at most `positives` rows for each anchor of the group
        by_anchor: dict[int, list] = {}
        for r in best.orderBy("anchor", "rank").collect():
            by_anchor.setdefault(r.anchor, []).append(r.score)
        windows = [[window_of(s, low, high) for s in by_anchor.get(int(i), [])] for i in row]
        some = _pass(kept, Anchors(row, label, x, windows, False), negatives, scale)
        named = best.select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive"), F.col("score").alias("positive_score"))
        results.append(some.select("anchor", "window", "rank", F.col("id").alias("negative"), F.col("score").alias("negative_score"))
                       .join(named, ["anchor", "window"]))

    for r in kept.where(F.pmod("vec_id", F.lit(every)) == 0).select("row", "label", "embedding").toLocalIterator():
        held.append(r)
        if len(held) == anchors_at_once:
            some(held)
            held = []
    if held:
        some(held)
    shape = "anchor long, window int, rank int, negative long, negative_score long, positive long, positive_score long"
    found = reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], shape)
    ids = kept.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))

    def shown(c: str):
        return F.when(F.col(c) != LONG[1], F.col(c))

    return (found.join(ids, "anchor").select("anchor_id", shown("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                                             shown("negative").alias("negative_id"), "positive_score", "negative_score"))


def relabel(rows: DataFrame, every: int = 7, kinds: int = 10) -> DataFrame:
    """``rows`` with label (label + 1) % kinds where the id is divisible by ``every``."""
    moved = F.when(F.pmod("vec_id", F.lit(every)) == 0, F.pmod(F.col("label") + 1, F.lit(kinds))).otherwise(F.col("label"))
    return rows.select("vec_id", "embedding", moved.alias("label"))

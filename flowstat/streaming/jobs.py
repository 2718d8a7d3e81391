"""Streaming forms of the window, distinct, top-N and join operators.

Event time must be a TIMESTAMP for ``withWatermark`` (a TIMESTAMP_NTZ column
is converted, session zone UTC).  Windows close when the watermark passes
their end; in append mode each window is emitted once, final; in update mode
early results and corrections (allowed lateness) are emitted too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bitmap_hash, duration_str, duration_us, to_micros
from ..operators import distinct, topn, windows
from .snapshots import Snapshots


def with_event_time(df: DataFrame, ts: str, delay="0 seconds", out: str | None = None) -> DataFrame:
    """Event-time column + watermark.  ``delay`` 0 is the ascending
    watermark; a positive delay is the bounded-disorder one.  With allowed
    lateness L, pass ``delay = disorder + L`` and use update mode."""
    out = out or ts
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        # an NTZ wall clock is read as UTC (as in the batch operators), not in the session zone
        df = df.withColumn(out, F.timestamp_micros(to_micros(ts, T.TimestampNTZType())))
    elif out != ts:
        df = df.withColumn(out, F.col(ts))
    return df.withWatermark(out, duration_str(duration_us(delay)))


def after_watermark(ev: DataFrame, ts: str, predicate: Column | None) -> DataFrame:
    """Rows of ``ev`` that satisfy ``predicate``, taken above the watermark.

    Every row of the log moves the event time, also those that are not counted.
    Catalyst moves a plain filter below the watermark node; one that refers to
    the event time stays above it."""
    return ev if predicate is None else ev.where(F.when(F.col(ts).isNotNull(), predicate))


def sliding_count_stream(df: DataFrame, ts: str, keys=None, size="1 hour", slide="5 minutes",
                         delay="0 seconds", method: str = "auto", where: Column | None = None) -> DataFrame:
    """Sliding counts on a stream, of the rows that satisfy ``where``
    (all rows move the watermark).  ``window``: ``F.window`` expands every
    row size/slide times.  ``panes`` (auto above a ratio of 16): count rows
    per tumbling pane of gcd(size, slide) first, then take the sliding
    windows over the panes' event time (``window_time``) - a chained
    time-window aggregation, so the expansion is per pane, not per row.
    Chained aggregations run in append mode only; use ``window`` for update
    mode (allowed lateness with early and corrected results)."""
    ev = after_watermark(with_event_time(df, ts, delay), ts, where)
    size_us, slide_us = duration_us(size), duration_us(slide)
    if method == "auto":
        method = "panes" if size_us / slide_us > windows.RATIO_FOR_DIFFERENCE else "window"
    if method == "window":
        return windows.sliding_count(ev, ts, keys, size, slide, method="window")
    ks = [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))
    g = math.gcd(size_us, slide_us)
    panes = ev.groupBy(F.window(F.col(ts), duration_str(g)).alias("_p"), *ks).agg(F.count(F.lit(1)).alias("_c"))
    w = F.window(F.window_time("_p"), duration_str(size_us), duration_str(slide_us))
    return (panes.groupBy(w.alias("_w"), *ks).agg(F.sum("_c").cast("long").alias("cnt"))
                 .select(*ks, F.col("_w.end").alias("window_end"), "cnt"))


def tumbling_count_stream(df: DataFrame, ts: str, keys=None, size="1 hour", delay="0 seconds",
                          where: Column | None = None, out: str = "cnt") -> DataFrame:
    return windows.tumbling_count(after_watermark(with_event_time(df, ts, delay), ts, where), ts, keys, size, out=out)


def uv_stream(df: DataFrame, ts: str, col: str, size="1 hour", delay="0 seconds", how: str = "exact",
              where: Column | None = None) -> DataFrame:
    """Distinct visitors per window on a stream: ``exact`` (two chained
    aggregates, state grows with visitors per open window), ``bitmap`` (same
    over bitmap positions) or ``approx`` (HyperLogLog, constant state)."""
    ev = after_watermark(with_event_time(df, ts, delay), ts, where)
    if how == "exact":
        return distinct.distinct_per_window_stream(ev, ts, col, size)
    if how == "bitmap":
        return distinct.distinct_per_window_stream(ev.withColumn("_h", bitmap_hash(col)), ts, "_h", size)
    return distinct.distinct_per_window(ev, ts, col, size, "approx")


def top_n_stream(df: DataFrame, ts: str, key: str, size="1 hour", slide="5 minutes", n: int = 5,
                 delay="0 seconds", where: Column | None = None) -> DataFrame:
    """Sliding counts, then the top-N of each window once it closes (append mode).

    A window's counts come out together when it closes; the n best of each (window,
    bucket of keys) are found first, then those of the window, so no list is
    longer than n rows beside one batch of input (see :mod:`flowstat.streaming.ranking`)."""
    from .ranking import ranked
    counts = sliding_count_stream(df, ts, key, size, slide, delay, "auto", where)
    return ranked(counts, key, n, final=True)


def top_n_per_batch(part: str, key: str, n: int, sink: callable):
    """``foreachBatch`` callback: rank each micro-batch of closed windows
    with the batch :func:`top_n` (WindowGroupLimit applies) and hand the
    result to ``sink(df, epoch_id)``.  The sink must consume the whole
    frame (write or collect it; ``show``/``limit`` alone is not enough):
    Spark checks that every state partition of the batch was committed."""
    def run(batch: DataFrame, epoch_id: int):
        sink(topn.top_n(batch, part, key, "cnt", n), epoch_id)
    return run


def changelog_per_batch(keys, state_path: str, sink: callable):
    """``foreachBatch`` callback for a retract stream: diff each batch's
    snapshot against the previous snapshot, emit +/- rows, store the new
    snapshot (two are kept, see :class:`Snapshots`).  A batch diffs against the
    latest *earlier* epoch, so a batch replayed after a failure produces the
    same change log.  Each batch is taken as the complete current snapshot
    (e.g. a complete-mode top-N); an empty batch carries no snapshot and is
    skipped."""
    def run(batch: DataFrame, epoch_id: int):
        if batch.isEmpty():
            return
        state = Snapshots(batch.sparkSession, state_path)
        prev = state.before(epoch_id)
        if prev is None:
            prev = batch.sparkSession.createDataFrame([], batch.schema)
        sink(topn.changelog(prev, batch, keys), epoch_id)
        state.write(batch, epoch_id)
    return run


def top_n_retract_per_batch(part: str, key: str, n: int, state_path: str, sink: callable,
                            score: str = "cnt", rank_col: str = "rn", op_col: str = "op", keep="1 day"):
    """``foreachBatch`` callback turning update-mode window counts into the
    retract stream of a top-n per window (+ rows entering, - rows leaving).

    Counts only grow, so an item can enter a window's top-n only in a batch
    that updates it: the new top-n of an affected window is the top-n of its
    previous top-n (refreshed with this batch's counts) and this batch's
    updated items.  The only state is the top-n rows of each window that may
    still change, carried as a :class:`Snapshots` table at ``state_path``: windows that end more
    than ``keep`` before the latest one are left out (``keep`` must not be shorter than the
    watermark's delay and one window, after which Spark sends no more counts of them).  A replayed batch
    reads the same earlier epoch and gives the same output."""
    def run(batch: DataFrame, epoch_id: int):
        spark, state = batch.sparkSession, Snapshots(batch.sparkSession, state_path)
        columns = [part, key, score, rank_col]
        upd = batch.select(part, key, score).persist()
        if not upd.count():  # one job over all partitions, so that all state is committed
            upd.unpersist()
            return
        affected = upd.select(part).distinct()
        held = state.before(epoch_id)
        if held is None:
            held = spark.createDataFrame([], T.StructType([batch.schema[part], batch.schema[key], batch.schema[score],
                                                           T.StructField(rank_col, T.IntegerType())]))
        prev = held.join(affected, part, "left_semi")
        carried = prev.select(part, key, score).join(upd.select(part, key), [part, key], "left_anti")
        cur = topn.top_n(carried.unionByName(upd), part, key, score, n, rank_col).select(*columns).persist()
        sink(topn.changelog(prev, cur, columns, op_col), epoch_id)
        after = held.join(affected, part, "left_anti").select(*columns).unionByName(cur)
        last = F.expr(f"INTERVAL {duration_us(keep)} MICROSECONDS")
        newest = after.agg(F.max(part).alias("newest"))       # one row
        live = after.join(F.broadcast(newest), F.col(part) >= F.col("newest") - last).select(*columns)
        # a table of n rows for each open window
        state.write(live.coalesce(1), epoch_id)
        upd.unpersist()
        cur.unpersist()
    return run


def running_distinct_per_batch(seq: str, state_path: str, sink: callable, end_col: str = "window_end", out: str = "uv", keep="1 day"):
    """``foreachBatch`` callback over :func:`flowstat.streaming.stateful.first_sightings_stream`:
    for each row the distinct values of its window up to and including it (rows with
    equal ``seq`` count together), handed to ``sink(df, epoch_id)``.

    The first sightings of the micro-batch are summed up in the order of ``seq`` by
    :func:`flowstat.operators.ordered.running_total` (a heavy window is split in chunks) and added to the
    window's number from earlier batches, one row for each window that ends at most ``keep`` before the
    latest one, carried as a :class:`Snapshots` table."""
    def run(batch: DataFrame, epoch_id: int):
        spark, state = batch.sparkSession, Snapshots(batch.sparkSession, state_path)
        batch = batch.persist()
        try:
            if not batch.count():  # one job over all partitions, so that all state is committed
                return
            held = state.before(epoch_id)
            if held is None:
                held = spark.createDataFrame([], T.StructType([batch.schema[end_col], T.StructField("before", T.LongType())]))
            firsts = batch.where("first = 1").select(end_col, seq)
            ran = distinct.running_firsts(firsts, batch.select(end_col, seq), seq, end_col, "in_batch")
            sink(ran.join(held, end_col, "left")
                 .select(seq, end_col, (F.coalesce("before", F.lit(0)) + F.col("in_batch")).cast("long").alias(out)), epoch_id)
            sums = held.unionByName(batch.groupBy(end_col).agg(F.sum("first").cast("long").alias("before"))).groupBy(end_col).agg(F.sum("before").alias("before"))
            last = F.expr(f"INTERVAL {duration_us(keep)} MICROSECONDS")
            newest = sums.agg(F.max(end_col).alias("newest"))  # one row
            state.write(sums.join(F.broadcast(newest), F.col(end_col) >= F.col("newest") - last).select(end_col, "before").coalesce(1), epoch_id)
        finally:
            batch.unpersist()
    return run


def interval_join_stream(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                         lower="-3 seconds", upper="5 seconds", how: str = "inner",
                         left_delay="0 seconds", right_delay="0 seconds",
                         left_where: Column | None = None, right_where: Column | None = None) -> DataFrame:
    """Stream-stream interval join of the rows that satisfy ``left_where`` and
    ``right_where``, with watermarks (moved by all rows) on both sides; state is
    dropped once the watermark passes the interval.  ``how`` inner or
    full_outer (unmatched rows appear once their wait has expired)."""
    lo, hi = duration_us(lower), duration_us(upper)
    lft = after_watermark(with_event_time(left, left_ts, left_delay), left_ts, left_where).withColumnRenamed(on, "_lk")
    rgt = after_watermark(with_event_time(right, right_ts, right_delay), right_ts, right_where).withColumnRenamed(on, "_rk")
    # interval literals let Spark derive the state-eviction bounds from the condition
    cond = F.expr(f"_lk = _rk AND {right_ts} >= {left_ts} + INTERVAL {lo} MICROSECONDS "
                  f"AND {right_ts} <= {left_ts} + INTERVAL {hi} MICROSECONDS")
    j = lft.join(rgt, cond, how)
    return j.withColumn(on, F.coalesce(F.col("_lk"), F.col("_rk"))).drop("_lk", "_rk")

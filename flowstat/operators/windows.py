"""Event-time window counts: tumbling, sliding and two-stage salted.

Sliding windows are aligned to the epoch (like ``F.window``); a window
``[start, start + size)`` is reported by its exclusive end ``window_end``.
Only non-empty windows are returned.

Three physical strategies for a sliding count, all exact:

* ``window``  - ``F.window(ts, size, slide)``: Spark expands each row into
  size/slide copies before the (map-side combined) aggregate.  One shuffle;
  best when size/slide is small.  The only form allowed on a stream.
* ``panes``   - count rows per gcd(size, slide) pane first (partial
  aggregation shrinks the data before any shuffle), then expand each pane
  into its windows and sum.
* ``difference`` - count per pane, turn each pane into a +c at its first
  window end and a -c one slide after its last, take a running sum per key
  over window ends and expand only the resulting constant segments.  Work is
  proportional to panes + result rows instead of rows x size/slide.  The
  running sum is partitioned by (keys, bucket of window ends) so no single
  task ever sees more than one bucket of one key, even for a hot key or a
  keyless count; each bucket owns its window ends (panes near a bucket
  border are sent to both buckets), so results need no final aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (ceil_to, duration_str, duration_us, floor_to, from_micros,
                         to_micros, ts_type)

RATIO_FOR_DIFFERENCE = 16


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _count(weight: str | None):
    return F.count(F.lit(1)) if weight is None else F.sum(F.col(weight)).cast("long")


def tumbling_count(df: DataFrame, ts: str, keys=None, size="1 hour",
                   out: str = "cnt", end_col: str = "window_end", weight: str | None = None) -> DataFrame:
    """Rows (or the sum of ``weight``) per key and tumbling window."""
    ks = _keys(keys)
    w = F.window(F.col(ts), duration_str(duration_us(size)))
    return (df.groupBy(*ks, w.alias("_w"))
              .agg(_count(weight).alias(out))
              .select(*ks, F.col("_w.end").alias(end_col), out))


def sliding_count(df: DataFrame, ts: str, keys=None, size="1 hour", slide="5 seconds",
                  method: str = "auto", bucket="1 day", out: str = "cnt",
                  end_col: str = "window_end", weight: str | None = None) -> DataFrame:
    """Rows per key and sliding window -> keys, window_end, cnt.

    With ``weight`` each row counts as that many rows - used to feed counts
    that were pre-aggregated per pane (see :func:`pane_counts`)."""
    ks = _keys(keys)
    size_us, slide_us = duration_us(size), duration_us(slide)
    if slide_us <= 0 or size_us < slide_us:
        raise ValueError("need 0 < slide <= size")
    if method == "auto":
        ratio = size_us / slide_us
        method = "window" if (df.isStreaming or ratio <= RATIO_FOR_DIFFERENCE) else "difference"
    if method == "window":
        w = F.window(F.col(ts), duration_str(size_us), duration_str(slide_us))
        return (df.groupBy(*ks, w.alias("_w"))
                  .agg(_count(weight).alias(out))
                  .select(*ks, F.col("_w.end").alias(end_col), out))
    if method == "panes":
        return _sliding_panes(df, ts, ks, size_us, slide_us, out, end_col, weight)
    if method == "difference":
        return _sliding_difference(df, ts, ks, size_us, slide_us, duration_us(bucket), out, end_col, weight)
    raise ValueError(f"unknown method {method!r}")


def pane_counts(df: DataFrame, ts: str, keys=None, size="1 hour", slide="5 minutes",
                out: str = "cnt", weight: str | None = None) -> DataFrame:
    """Rows per key and pane of length gcd(size, slide) -> keys, ts (pane
    start, same type), cnt.  Every pane lies inside the same sliding windows
    as its start, so ``sliding_count(panes, ts, keys, size, slide,
    weight=cnt)`` equals the count over the raw rows.  Aggregating to panes
    *before* joining a dimension (page url, customer nation) makes the join
    run over pane counts instead of raw events."""
    ks = _keys(keys)
    dtype = ts_type(df, ts)
    g = math.gcd(duration_us(size), duration_us(slide))
    p = floor_to(to_micros(ts, dtype), g)
    return (df.groupBy(*ks, p.alias("_p")).agg(_count(weight).alias(out))
              .select(*ks, from_micros("_p", dtype).alias(ts), out))


def _pane_counts(df: DataFrame, ts: str, ks: list[str], size_us: int, slide_us: int, weight=None):
    dtype = ts_type(df, ts)
    g = math.gcd(size_us, slide_us)
    t = to_micros(ts, dtype)
    panes = (df.select(*ks, floor_to(t, g).alias("_p"), *([F.col(weight)] if weight else []))
               .groupBy(*ks, "_p").agg(_count(weight).alias("_c")))
    # window starts s (multiples of slide) with  p + g - size <= s <= p
    first_end = ceil_to(F.col("_p") + F.lit(g - size_us), slide_us) + F.lit(size_us)
    last_end = floor_to(F.col("_p"), slide_us) + F.lit(size_us)
    return dtype, panes, first_end, last_end


def _sliding_panes(df, ts, ks, size_us, slide_us, out, end_col, weight=None):
    dtype, panes, first_end, last_end = _pane_counts(df, ts, ks, size_us, slide_us, weight)
    exploded = panes.select(*ks, "_c", F.explode(F.sequence(first_end, last_end, F.lit(slide_us))).alias("_e"))
    return (exploded.groupBy(*ks, "_e").agg(F.sum("_c").cast("long").alias(out))
                    .select(*ks, from_micros("_e", dtype).alias(end_col), out))


def _sliding_difference(df, ts, ks, size_us, slide_us, bucket_us, out, end_col, weight=None):
    dtype, panes, first_end, last_end = _pane_counts(df, ts, ks, size_us, slide_us, weight)
    ranges = panes.select(*ks, "_c", first_end.alias("_fe"), last_end.alias("_le"))
    return _ranges_difference(ranges, ks, dtype, size_us, slide_us, bucket_us, out, end_col)


def _ranges_difference(ranges, ks, dtype, size_us, slide_us, bucket_us, out, end_col):
    """Counts per window end from weighted ranges of window ends
    (``_c`` rows contribute to every end in ``[_fe, _le]``, step slide)."""
    # Each bucket [bD, (b+1)D) of window *ends* is owned by one (key, bucket)
    # task.  A range is shorter than D, so it is sent to the one or two
    # buckets it touches; every end is then produced exactly once and no
    # final aggregation is needed.
    d = max(bucket_us, size_us)
    r = size_us % slide_us                      # window ends are = r (mod slide)
    owners = F.array_distinct(F.array(floor_to(F.col("_fe"), d), floor_to(F.col("_le"), d)))
    deltas = (ranges
              .select(*ks, "_c", "_fe", "_le", F.explode(owners).alias("_b"))
              .select(*ks, "_b", F.explode(F.array(
                  F.struct(F.col("_fe").alias("at"), F.col("_c").alias("d")),
                  F.struct((F.col("_le") + F.lit(slide_us)).alias("at"), (-F.col("_c")).alias("d")),
              )).alias("_x"))
              .select(*ks, "_b", F.col("_x.at").alias("_at"), F.col("_x.d").alias("_d")))
    # Deltas at the same instant need no merging: of tied rows only the last
    # carries the full running sum, and the others get empty segments (their
    # next instant is their own), which the lo <= hi filter drops.
    w = Window.partitionBy(*ks, "_b").orderBy("_at")
    segs = (deltas
            .withColumn("_run", F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("_nxt", F.lead("_at").over(w))
            .where(F.col("_run") > 0))
    lo_b = F.col("_b") + F.pmod(F.lit(r) - F.col("_b"), F.lit(slide_us))          # first end >= bD
    hi_b = (F.col("_b") + F.lit(d - 1)) - F.pmod(F.col("_b") + F.lit(d - 1 - r), F.lit(slide_us))  # last end < (b+1)D
    lo = F.greatest(F.col("_at"), lo_b)
    hi = F.least(F.col("_nxt") - F.lit(slide_us), hi_b)
    return (segs.where(lo <= hi)
                .select(*ks, F.col("_run").cast("long").alias(out),
                        F.explode(F.sequence(lo, hi, F.lit(slide_us))).alias("_e"))
                .select(*ks, from_micros("_e", dtype).alias(end_col), out))


def sliding_count_open(df: DataFrame, ts: str, keys=None, size="10 minutes", slide="5 seconds",
                       watermark: str = "watermark", lateness="1 minute", method: str = "auto",
                       bucket="1 day", out: str = "cnt", end_col: str = "window_end") -> DataFrame:
    """Sliding counts with allowed lateness, as a stream with per-row
    watermarks finally reports them: a row counts in a window only if that
    window was still open when the row arrived, i.e.
    ``end - 1 ms + lateness > watermark`` (``watermark`` is the column with
    the watermark seen by the row, e.g. from :func:`late.split_late`; null =
    no watermark yet).  A row late for some of its windows still counts in
    the others."""
    ks = _keys(keys)
    dtype = ts_type(df, ts)
    size_us, slide_us, late_us = duration_us(size), duration_us(slide), duration_us(lateness)
    g = math.gcd(size_us, slide_us)
    r = size_us % slide_us
    p = floor_to(to_micros(ts, dtype), g)
    fe = ceil_to(p + F.lit(g - size_us), slide_us) + F.lit(size_us)
    le = floor_to(p, slide_us) + F.lit(size_us)
    wm = to_micros(watermark, ts_type(df, watermark))
    need = wm + F.lit(1001 - late_us)                       # first end that is still open
    first_open = need + F.pmod(F.lit(r) - need, F.lit(slide_us))
    lo = F.when(wm.isNull(), fe).otherwise(F.greatest(fe, first_open))
    ranges = (df.select(*ks, lo.alias("_fe"), le.alias("_le"))
                .where(F.col("_fe") <= F.col("_le"))
                .groupBy(*ks, "_fe", "_le").agg(F.count(F.lit(1)).alias("_c")))
    if method == "auto":
        method = "window" if size_us / slide_us <= RATIO_FOR_DIFFERENCE else "difference"
    if method == "window":
        exploded = ranges.select(*ks, "_c", F.explode(F.sequence("_fe", "_le", F.lit(slide_us))).alias("_e"))
        return (exploded.groupBy(*ks, "_e").agg(F.sum("_c").cast("long").alias(out))
                        .select(*ks, from_micros("_e", dtype).alias(end_col), out))
    return _ranges_difference(ranges, ks, dtype, size_us, slide_us, duration_us(bucket), out, end_col)


def salted_count(df: DataFrame, ts: str, size="1 hour", salt_col: str | None = None,
                 n: int = 10, out: str = "cnt", end_col: str = "window_end") -> DataFrame:
    """Two-stage count per tumbling window: partial count per (window, salt),
    then the sum of partials per window end.  The salt is deterministic
    (``pmod(hash(salt_col), n)``), so a retried task recomputes the same
    partials.  Spark's own partial aggregation already protects a plain count
    from a hot window; this form exists for parity with the salted job and as
    a check (it must equal :func:`tumbling_count`)."""
    w = F.window(F.col(ts), duration_str(duration_us(size)))
    salt_src = F.col(salt_col) if salt_col else F.col(ts)
    salt = F.pmod(F.hash(salt_src), F.lit(n))
    stage1 = df.groupBy(w.alias("_w"), salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_c"))
    # stage 2 groups by the window struct, which carries the watermark, so
    # the same two-stage plan also runs on a stream (append mode)
    return (stage1.groupBy("_w").agg(F.sum("_c").alias(out))
                  .select(F.col("_w.end").alias(end_col), out))

"""Distinct visitors per window: exact, one-hash bitmap, approximate, and the
running count that fires per element."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bitmap_hash, duration_str, duration_us, floor_to, from_micros, to_micros, ts_type
from .ordered import running_total


def distinct_per_window(df: DataFrame, ts: str, col: str, size="1 hour", how: str = "exact",
                        keys=None, out: str = "uv", end_col: str = "window_end",
                        rsd: float = 0.01) -> DataFrame:
    """Distinct ``col`` values per tumbling window.

    exact  - ``count(distinct col)``: Spark plans it as a partial aggregate on
             (window, col) shuffled by both, then a count per window, so a hot
             window is spread over all reducers.
    bitmap - distinct values of the one-hash bitmap position of ``col``
             (collisions merge visitors, so it is <= exact).
    approx - HyperLogLog++ (``approx_count_distinct``), constant memory.
    """
    ks = [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))
    w = F.window(F.col(ts), duration_str(duration_us(size)))
    if how == "exact":
        agg = F.count_distinct(F.col(col))
    elif how == "bitmap":
        agg = F.count_distinct(bitmap_hash(col))
    elif how == "approx":
        agg = F.approx_count_distinct(F.col(col), rsd)
    else:
        raise ValueError(how)
    return (df.groupBy(*ks, w.alias("_w")).agg(agg.alias(out))
              .select(*ks, F.col("_w.end").alias(end_col), out))


def bitmap_distinct(df: DataFrame, ts: str, col: str, size="1 hour", slide=None, hashed: bool = True, keys=None,
                    out: str = "uv", end_col: str = "window_end") -> DataFrame:
    """Distinct values per tumbling or sliding window from two-level bitmaps.

    A value's position (its one-hash bitmap position, or with ``hashed=False`` the
    non-negative number itself) is a bucket of 32,768 bits and a place in it.  The
    bitmap of each (pane, bucket) is built by a map-side aggregate; bitmaps of several panes
    are merged for a window by OR, so a row is read once however many windows it lies in; the bits
    of a window's buckets are counted and added.  A bucket is 4 KB at most, and only touched buckets
    exist; a hot window is dealt over as many tasks as it has buckets."""
    ks = [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    pane = math.gcd(size_us, slide_us)
    dtype = ts_type(df, ts)
    rows = df.where(F.col(col).isNotNull()).select(
        *ks, floor_to(to_micros(ts, dtype), pane).alias("_p"), (bitmap_hash(col) if hashed else F.col(col).cast("long")).alias("_v"))
    bits = rows.groupBy(*ks, "_p", F.bitmap_bucket_number("_v").alias("_b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias("_bits"))
    if slide_us != size_us:
        # the ends of the windows that see the pane
        first = floor_to(F.col("_p") + pane - size_us + slide_us - 1, slide_us) + size_us
        last = floor_to(F.col("_p"), slide_us) + size_us
        ends = F.when(first <= last, F.sequence(first, last, F.lit(slide_us)))
        bits = (bits.select(*ks, F.explode(ends).alias("_w"), "_b", "_bits").groupBy(*ks, "_w", "_b")
                .agg(F.bitmap_or_agg("_bits").alias("_bits")))
    else:
        bits = bits.withColumn("_w", F.col("_p") + size_us)
    return (bits.groupBy(*ks, "_w").agg(F.sum(F.bitmap_count("_bits")).alias(out))
            .select(*ks, from_micros("_w", dtype).alias(end_col), out))


def distinct_per_window_stream(df: DataFrame, ts: str, col: str, size="1 hour",
                               out: str = "uv", end_col: str = "window_end") -> DataFrame:
    """Streaming-safe exact distinct: ``count(distinct)`` is rejected on
    streams, two chained aggregates are accepted in append mode."""
    w = F.window(F.col(ts), duration_str(duration_us(size)))
    per_user = df.groupBy(w.alias("_w"), F.col(col)).agg(F.count(F.lit(1)).alias("_n"))
    return (per_user.groupBy("_w").agg(F.count(F.lit(1)).alias(out))
                    .select(F.col("_w.end").alias(end_col), out))


def running_distinct(df: DataFrame, ts: str, seq: str, col: str, size="1 hour",
                     hashed: bool = True, out: str = "uv", end_col: str = "window_end",
                     chunk: int = 1 << 20) -> DataFrame:
    """For every row, the number of distinct ``col`` values (or bitmap
    positions) seen in its tumbling window up to and including that row, in
    ``seq`` (arrival) order - the per-element firing of the bitmap job.

    First sightings come from an aggregate (min seq per window and value),
    which is skew-safe; the running count is a prefix sum over the window
    split into seq chunks (see :func:`running_total`), so a hot window is not
    sorted in one task.
    """
    w = F.window(F.col(ts), duration_str(duration_us(size)))
    v = bitmap_hash(col) if hashed else F.col(col)
    base = df.select(F.col(seq), w.end.alias(end_col), v.alias("_v"))
    return running_firsts(base.groupBy(end_col, "_v").agg(F.min(seq).alias(seq)), base, seq, end_col, out, chunk)


def running_firsts(firsts: DataFrame, rows: DataFrame, seq: str, end_col: str, out: str, chunk: int = 1 << 20) -> DataFrame:
    """seq, window end and ``out`` of every row: the number of first sightings (their
    window end and ``seq``) in its window up to and including its place."""
    # the marker of a first sighting sorts before the row itself (_row 0 < 1)
    both = (firsts.select(end_col, seq, F.lit(1).alias("_first"), F.lit(0).alias("_row"))
            .unionByName(rows.select(end_col, seq, F.lit(0).alias("_first"), F.lit(1).alias("_row"))))
    ran = running_total(both, part=[end_col], order=[seq, "_row"], value="_first",
                        out=out, chunk_col=seq, chunk=chunk)
    return ran.where(F.col("_row") == 1).select(seq, end_col, out)

"""Event-time interval joins.

``right.ts`` in ``[left.ts + lower, left.ts + upper]`` (both ends inclusive)
plus equality on the key.  A plain equi-join on the key would compare every
pair of a key's rows before filtering - a hot key would explode.  Instead
the right side is cut into time buckets of width ``W >= upper - lower`` and
each left row is sent to the (at most two) buckets its interval touches; the
join key is (key, bucket), so only rows that are close in time meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import duration_us, floor_to, to_micros, ts_type


def interval_join(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                  lower="-3 seconds", upper="5 seconds", bucket=None) -> DataFrame:
    """Inner interval join; ``on`` are key columns present on both sides
    (kept once).  Column names other than keys must differ between sides."""
    keys = [on] if isinstance(on, str) else list(on)
    lo, hi = duration_us(lower), duration_us(upper)
    if hi < lo:
        raise ValueError("upper < lower")
    w = max(duration_us(bucket) if bucket else hi - lo, 1_000_000)
    lt = to_micros(left_ts, ts_type(left, left_ts))
    rt = to_micros(right_ts, ts_type(right, right_ts))
    l2 = (left.withColumn("_lt", lt)
              .withColumn("_b", F.explode(F.sequence(floor_to(F.col("_lt") + F.lit(lo), w),
                                                     floor_to(F.col("_lt") + F.lit(hi), w), F.lit(w)))))
    r2 = right.withColumn("_rt", rt).withColumn("_b", floor_to(F.col("_rt"), w))
    cond = [l2[k] == r2[k] for k in keys] + [
        l2["_b"] == r2["_b"],
        r2["_rt"] >= l2["_lt"] + F.lit(lo),
        r2["_rt"] <= l2["_lt"] + F.lit(hi),
    ]
    j = l2.join(r2, cond, "inner")
    others_l = [c for c in left.columns if c not in keys]
    others_r = [c for c in right.columns if c not in keys]
    return j.select(*[l2[k] for k in keys], *[l2[c] for c in others_l], *[r2[c] for c in others_r])


def full_outer_interval(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                        left_id: str, right_id: str, lower="-3 seconds", upper="5 seconds",
                        bucket=None) -> DataFrame:
    """Full outer interval join: matched pairs, and each side's unmatched rows
    with nulls for the other side (keys coalesced).

    ``left_id`` and ``right_id`` name each side's rows: unique and not null.
    The join runs once.  A right row lives in one bucket, so it meets a left row
    at most once; a left row has a copy for each bucket that its interval
    touches, and is unmatched when as many copies stay alone as it has."""
    return _outer(left, right, on, left_ts, right_ts, left_id, right_id, lower, upper, bucket)[0]


def _outer(left, right, on, left_ts, right_ts, left_id, right_id, lower, upper, bucket):
    keys = [on] if isinstance(on, str) else list(on)
    lo, hi = duration_us(lower), duration_us(upper)
    w = max(duration_us(bucket) if bucket else hi - lo, 1_000_000)
    lt = to_micros(left_ts, ts_type(left, left_ts))
    rt = to_micros(right_ts, ts_type(right, right_ts))
    lcols, rcols = left.columns, right.columns
    buckets = F.sequence(floor_to(lt + F.lit(lo), w), floor_to(lt + F.lit(hi), w), F.lit(w))
    l2 = left.select(F.struct(*lcols).alias("_L"), lt.alias("_lt"), F.greatest(F.size(buckets), F.lit(1)).alias("_nb"),
                     *[F.col(k).alias("_lk" + str(i)) for i, k in enumerate(keys)],
                     F.explode_outer(buckets).alias("_lb"))
    r2 = right.select(F.struct(*rcols).alias("_R"), rt.alias("_rt"), floor_to(rt, w).alias("_rb"),
                      *[F.col(k).alias("_rk" + str(i)) for i, k in enumerate(keys)])
    cond = [F.col("_lk" + str(i)) == F.col("_rk" + str(i)) for i in range(len(keys))] + [
        F.col("_lb") == F.col("_rb"),
        F.col("_rt") >= F.col("_lt") + F.lit(lo),
        F.col("_rt") <= F.col("_lt") + F.lit(hi),
    ]
    rows = (l2.join(r2, cond, "full_outer")
            .groupBy(F.col("_L")[left_id].alias("_li"), F.col("_R")[right_id].alias("_ri"))
            .agg(F.count(F.lit(1)).alias("_n"), F.any_value("_L").alias("_L"), F.any_value("_R").alias("_R"),
                 F.any_value("_nb").alias("_nb"))
            .where(F.col("_R").isNotNull() | (F.col("_n") == F.col("_nb"))))
    others_l = [c for c in lcols if c not in keys]
    others_r = [c for c in rcols if c not in keys]
    both = rows.select(*[F.coalesce(F.col("_L")[k], F.col("_R")[k]).alias(k) for k in keys],
                       *[F.col("_L")[c].alias(c) for c in others_l], *[F.col("_R")[c].alias(c) for c in others_r])
    return both, rows, lcols, rcols, others_r


def interval_match(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                   left_id: str, right_id: str, lower="-3 seconds", upper="5 seconds",
                   bucket=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two-sided match with waits -> (matched, left_unmatched, right_unmatched),
    the three parts of :func:`full_outer_interval` (same ids)."""
    _, rows, lcols, rcols, others_r = _outer(left, right, on, left_ts, right_ts, left_id, right_id, lower, upper, bucket)
    has_l, has_r = F.col("_L").isNotNull(), F.col("_R").isNotNull()
    matched = rows.where(has_l & has_r).select(
        *[F.col("_L")[c].alias(c) for c in lcols], *[F.col("_R")[c].alias(c) for c in others_r])
    return (matched, rows.where(~has_r).select(*[F.col("_L")[c].alias(c) for c in lcols]),
            rows.where(~has_l).select(*[F.col("_R")[c].alias(c) for c in rcols]))

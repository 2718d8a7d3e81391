"""Late-row side output of a sliding-window count with allowed lateness.

Spark drops late rows silently; the reference routes them to a side output.
The batch definition (deterministic): the watermark seen by a row is the
largest event time among the rows that arrived *before* it, minus the
disorder bound.  A row is late when even its last sliding window, extended by
the allowed lateness, is closed:
``last_end - 1 ms + lateness <= watermark`` with
``last_end = floor(ts, slide) + size``.  A row that is late for only some of
its windows is still counted in the open ones and is not a late row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import duration_us, floor_to, from_micros, to_micros, ts_type
from .ordered import prefix_max


def watermark_before(df: DataFrame, ts: str, arrival: str, seq: str, delay="1 second",
                     chunk="1 minute", wm_col: str = "watermark") -> DataFrame:
    """Adds the watermark each row sees on arrival: the largest event time
    among rows that arrived before it (arrival order ``arrival``, ties by
    ``seq``) minus ``delay``; null for the first row.  ``arrival`` is a
    timestamp (``chunk`` a duration) or a number such as a line or offset
    number (``chunk`` a count).  The running maximum over the whole arrival
    order is computed by leaves of chunks (see :func:`~flowstat.operators.ordered.prefix_max`),
    so it never runs in one task.  ``df`` is read twice: for the small table of chunks,
    at once, and for the result; write it first where that is dear."""
    dtype = ts_type(df, ts)
    adtype = df.schema[arrival].dataType
    if isinstance(adtype, (T.TimestampType, T.TimestampNTZType)):
        arr, step = to_micros(arrival, adtype), duration_us(chunk)
    else:
        arr, step = F.col(arrival).cast("long"), int(chunk) if isinstance(chunk, int) else 1 << 20
    base = df.withColumn("_t", to_micros(ts, dtype)).withColumn("_arr", arr)
    ran = prefix_max(base, "_arr", seq, "_t", "_mx", step)
    return ran.withColumn(wm_col, from_micros(F.col("_mx") - F.lit(duration_us(delay)), dtype)) \
              .drop("_t", "_arr", "_mx")


def late_flag(df: DataFrame, ts: str, wm_col: str = "watermark", size="10 minutes", slide="5 seconds",
              lateness="1 minute"):
    """True when every sliding window of the row was closed (even with the
    allowed lateness) under the watermark in ``wm_col``."""
    dtype = ts_type(df, ts)
    size_us, slide_us, late_us = (duration_us(x) for x in (size, slide, lateness))
    last_end = floor_to(to_micros(ts, dtype), slide_us) + F.lit(size_us)
    wm = to_micros(wm_col, ts_type(df, wm_col))
    return F.coalesce(last_end - F.lit(1000) + F.lit(late_us) <= wm, F.lit(False))


def split_late(df: DataFrame, ts: str, arrival: str, seq: str, delay="1 second",
               size="10 minutes", slide="5 seconds", lateness="1 minute",
               chunk="1 minute", wm_col: str = "watermark") -> tuple[DataFrame, DataFrame]:
    """-> (on_time, late), both with the ``watermark`` column; see
    :func:`watermark_before` for ``arrival`` and ``chunk``."""
    flagged = watermark_before(df, ts, arrival, seq, delay, chunk, wm_col)
    flagged = flagged.withColumn("_late", late_flag(flagged, ts, wm_col, size, slide, lateness))
    keep = [c for c in df.columns] + [wm_col]
    return (flagged.where(~F.col("_late")).select(*keep),
            flagged.where(F.col("_late")).select(*keep))

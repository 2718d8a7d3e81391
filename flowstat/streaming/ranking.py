"""Sliding counts and rankings on streams, kept up to date row by row of output.

Three steps, each with state of its own:

1. a *pane ring* per key (``PaneRingProcessor``): rows per pane of gcd(size, slide), and
   from them, by running sums, the counts of those open windows that the micro-batch
   changed.  One read and one write of state for a key and micro-batch, instead of
   size / slide copies of every row;
2. the n best rows of each (window, bucket of keys) (``BestRowsProcessor``);
3. the n best rows of each window, out of its buckets' n best (the same processor).

Counts only grow, so a key can enter the n best only when it is itself updated, and n
rows per bucket are all the state a ranking needs.  Every change of a window's ranking puts out
the whole ranking of that window, built from the latest counts of all its keys, whether or not
they occur in the micro-batch.  All state of a window goes when the watermark passes its
end (the delay of the watermark holds the allowed lateness too).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import duration_us, to_micros
from .jobs import after_watermark, with_event_time

_LONG = T.LongType()


def _concat(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(rows)
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)


class PaneRingProcessor(StatefulProcessor):
    """State of a key: the panes that an open window can still see, and their row counts.

    For rows (``t_us``) of a micro-batch, every window that gained rows and is still open
    (its end lies behind the watermark) comes out with its count.  A row none of whose windows is
    open changes nothing."""

    def __init__(self, size_us: int, slide_us: int):
        self.size, self.slide, self.pane = size_us, slide_us, math.gcd(size_us, slide_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", T.StructType([T.StructField("panes", T.BinaryType()), T.StructField("counts", T.BinaryType())]))

    def _held(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.ring.exists():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        panes, counts = self.ring.get()
        return np.frombuffer(panes, np.int64), np.frombuffer(counts, np.int64)

    def _last_end(self, panes: np.ndarray) -> np.ndarray:
        start = panes * self.pane
        return start - np.mod(start, self.slide) + self.size

    def _keep(self, panes: np.ndarray, counts: np.ndarray, wm_us: int) -> None:
        """Store what open windows can see; a timer for the end of the last of them."""
        live = self._last_end(panes) > wm_us
        panes, counts = panes[live], counts[live]
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if len(panes):
            self.ring.update((panes.tobytes(), counts.tobytes()))
            self.handle.registerTimer(-(-int(self._last_end(panes[-1:])[0]) // 1000))
        else:
            self.ring.clear()

    def update(self, t_us: np.ndarray, wm_us: int) -> tuple[np.ndarray, np.ndarray]:
        """Add rows; the ends and counts of the open windows that they changed."""
        new, rows = np.unique(t_us // self.pane, return_counts=True)
        live = self._last_end(new) > wm_us
        new, rows = new[live], rows[live]
        if not len(new):
            return new, new
        panes, counts = self._held()
        both, at = np.unique(np.concatenate([panes, new]), return_inverse=True)
        total = np.bincount(at, np.concatenate([counts, rows]), len(both)).astype(np.int64)
        # the windows over the panes that got rows, each once
        starts = np.unique((self._last_end(new) - self.size)[:, None] - self.slide * np.arange(-(-self.size // self.slide))[None, :])
        seen = np.searchsorted(new, -(-starts // self.pane))      # the first changed pane from the start on
        inside = seen < len(new)
        inside[inside] = new[seen[inside]] * self.pane < starts[inside] + self.size
        starts = starts[inside & (starts + self.size > wm_us)]
        sums = np.concatenate([[0], np.cumsum(total)])
        found = sums[np.searchsorted(both, (starts + self.size) // self.pane)] - sums[np.searchsorted(both, starts // self.pane)]
        self._keep(both, total, wm_us)
        return starts + self.size, found

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ends, counts = self.update(_concat(rows)["t_us"].to_numpy(dtype=np.int64), timerValues.getCurrentWatermarkInMs() * 1000)
        if len(ends):
            yield pd.DataFrame({"key": [key[0]] * len(ends), "window_end": pd.to_datetime(ends, unit="us", utc=True), "cnt": counts})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(*self._held(), timerValues.getCurrentWatermarkInMs() * 1000)
        yield from ()

    def close(self) -> None:
        pass


def sliding_updates_stream(df: DataFrame, ts: str, key: str, size="10 minutes", slide="5 seconds", delay="0 seconds",
                           where: Column | None = None) -> DataFrame:
    """key, window_end, cnt: the latest count of every (key, window) that a micro-batch
    changed, early results and corrections of late rows included (sum of a pane ring)."""
    ev = after_watermark(with_event_time(df, ts, delay), ts, where)
    # without the event-time column: Spark would drop rows that are late themselves though a window of theirs is open
    base = ev.select(F.col(key).alias("key"), to_micros(ts, T.TimestampType()).alias("t_us"))
    schema = T.StructType([T.StructField("key", ev.schema[key].dataType), T.StructField("window_end", T.TimestampType()), T.StructField("cnt", _LONG)])
    out = base.groupBy("key").transformWithStateInPandas(PaneRingProcessor(duration_us(size), duration_us(slide)), schema, "Append", "EventTime",
                                                         eventTimeColumnName="window_end")
    return out.select(F.col("key").alias(key), "window_end", "cnt")


class BestRowsProcessor(StatefulProcessor):
    """State of a group (a window, or a bucket of its keys): its ``n`` best rows.

    Input: latest counts (``key``, ``cnt``), which only grow.  When the n best change they come out
    whole (rank 1 to n), or with ``retract`` as ``-`` rows that no longer hold and ``+`` rows that now do.
    With ``final`` each group gets all its rows in one micro-batch (closed windows): nothing is kept."""

    def __init__(self, n: int, final: bool = False, retract: bool = False):
        self.n, self.final, self.retract = n, final, retract

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if not self.final:
            self.best = handle.getValueState("best", T.StructType([T.StructField("rows", T.StringType())]))

    def merge(self, best: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """The n best of ``best`` and the newer ``rows`` (both key, cnt)."""
        rows = rows.sort_values(["cnt", "key"], ascending=[False, True], kind="stable").drop_duplicates("key")
        old = best[~best["key"].isin(rows["key"])] if len(best) else best
        both = pd.concat([old, rows.head(self.n)], ignore_index=True) if len(old) else rows
        return both.sort_values(["cnt", "key"], ascending=[False, True], kind="stable").head(self.n).reset_index(drop=True)

    def _held(self) -> pd.DataFrame:
        import json
        if self.final or not self.best.exists():
            return pd.DataFrame({"key": [], "cnt": []})
        return pd.DataFrame(json.loads(self.best.get()[0]), columns=["key", "cnt"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import json
        held = now = self._held()
        for part in rows:  # never more than one batch of rows and n more
            now = self.merge(now, part[["key", "cnt"]])
        before, after = ([(k, int(c)) for k, c in zip(f["key"].tolist(), f["cnt"].tolist())] for f in (held, now))
        if before == after:
            return
        if not self.final:
            self.best.update((json.dumps(after),))
            self.handle.registerTimer(-(-pd.Timestamp(key[0]).value // 1_000_000))
        if self.retract:
            old, new = {(i + 1, *x) for i, x in enumerate(before)}, {(i + 1, *x) for i, x in enumerate(after)}
            out = [("-", *x) for x in sorted(old - new, key=lambda x: x[0])] + [("+", *x) for x in sorted(new - old, key=lambda x: x[0])]
        else:
            out = [("", i + 1, *x) for i, x in enumerate(after)]
        yield self.frame(key, out)

    def frame(self, key, out: list[tuple]) -> pd.DataFrame:
        cols = {"window_end": pd.to_datetime([key[0]] * len(out), utc=True)}
        if len(key) > 1:
            cols["bucket"] = [int(key[1])] * len(out)
        cols |= {"rn": np.array([x[1] for x in out], np.int32), "key": [x[2] for x in out], "cnt": [x[3] for x in out]}
        if self.retract:
            cols["op"] = [x[0] for x in out]
        return pd.DataFrame(cols)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.best.clear()
        yield from ()

    def close(self) -> None:
        pass


def ranked(counts: DataFrame, key: str, n: int, buckets: int | None = None, final: bool = False, retract: bool = False) -> DataFrame:
    """window_end, rn, key, cnt (and op with ``retract``) from a stream of latest counts (key, window_end, cnt).

    First the n best of each bucket of a window's keys, in as many tasks as there are, then those of the
    window.  Without ``final``, ``window_end`` must carry a watermark."""
    buckets = buckets or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = counts.schema[key].dataType
    end, rn, k, c = (T.StructField("window_end", T.TimestampType()), T.StructField("rn", T.IntegerType()), T.StructField("key", kind), T.StructField("cnt", _LONG))
    mode, carry = ("None", "") if final else ("EventTime", "window_end")
    named = counts.select("window_end", F.col(key).alias("key"), F.col("cnt").cast("long").alias("cnt"))
    first = (named.withColumn("bucket", F.pmod(F.hash("key"), F.lit(buckets))).groupBy("window_end", "bucket")
             .transformWithStateInPandas(BestRowsProcessor(n, final), T.StructType([end, T.StructField("bucket", T.IntegerType()), rn, k, c]), "Append", mode,
                                         eventTimeColumnName=carry))
    schema = T.StructType([end, rn, k, c, *([T.StructField("op", T.StringType())] if retract else [])])
    best = first.select("window_end", "key", "cnt").groupBy("window_end").transformWithStateInPandas(BestRowsProcessor(n, final, retract), schema, "Append", mode)
    return best.withColumnRenamed("key", key)


def top_n_updates_stream(df: DataFrame, ts: str, key: str, size="10 minutes", slide="5 seconds", n: int = 5, delay="0 seconds",
                         where: Column | None = None, retract: bool = False) -> DataFrame:
    """window_end, rn, key, cnt: the whole ranking of every window whose ranking a micro-batch
    changed (the latest one of a window holds), or its ``+`` / ``-`` rows."""
    return ranked(sliding_updates_stream(df, ts, key, size, slide, delay, where), key, n, retract=retract)

"""Keyed rules on streams with ``transformWithStateInPandas``.

(Input column names must not start with an underscore: the pandas side of
the operator renames such columns positionally.)

State per key: a last event (consecutive failures), a counter per day (click
cap), the create and pay times of an open order (order status), the rows that
the watermark has not passed (the event-time ordered rules, by time bucket) or the
values seen in an open window (distinct count, by window and bucket).  Event-time timers
finalise and expire it.  Input comes as pandas batches per key.  Times are passed as epoch microseconds and turned back into
timestamps on the JVM side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import bitmap_hash, duration_str, duration_us, from_micros, local_day, to_micros
from ..operators.capping import BLACKLIST_WARNING
from ..operators.patterns import LOGIN_WARNING, PAY_WITHOUT_CREATE, PAYED, TIMEOUT
from .jobs import after_watermark, with_event_time

_LONG, _BOOL = T.LongType(), T.BooleanType()


def _concat(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(rows)
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)


# ------------------------------------------------------------------ C1
class ConsecutiveFailProcessor(StatefulProcessor):
    """State: the key's last event (is_fail, time).  A failure whose
    previous event (arrival order, ``seq``) is a failure at most ``gap`` µs
    earlier emits a warning."""

    def __init__(self, gap_us: int, inclusive: bool = True):
        self.gap_us, self.inclusive = gap_us, inclusive

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("f", _BOOL),
                                                               T.StructField("t", _LONG)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows).sort_values("seq", kind="stable")
        f = pdf["is_fail"].to_numpy(dtype=bool)
        t = pdf["t_us"].to_numpy(dtype=np.int64)
        pf, pt = (self.last.get() if self.last.exists() else (False, 0))
        prev_f = np.r_[pf, f[:-1]]
        prev_t = np.r_[pt, t[:-1]]
        gap = t - prev_t
        hit = f & prev_f & ((gap <= self.gap_us) if self.inclusive else (gap < self.gap_us))
        self.last.update((bool(f[-1]), int(t[-1])))
        if not hit.any():
            return
        yield pd.DataFrame({"key": [key[0]] * int(hit.sum()), "first_us": prev_t[hit], "last_us": t[hit],
                            "seq": pdf["seq"].to_numpy()[hit]})

    def close(self) -> None:
        pass


def consecutive_stream(df: DataFrame, key: str, is_fail, ts: str, seq: str, max_gap="2 seconds",
                       inclusive: bool = True, delay="10 seconds", msg: str = LOGIN_WARNING) -> DataFrame:
    ev = with_event_time(df, ts, delay)
    base = ev.select(F.col(key), F.col(seq).alias("seq"), (F.expr(is_fail) if isinstance(is_fail, str) else is_fail)
                     .alias("is_fail"), to_micros(ts, T.TimestampType()).alias("t_us"))
    schema = T.StructType([T.StructField("key", ev.schema[key].dataType), T.StructField("first_us", _LONG),
                           T.StructField("last_us", _LONG), T.StructField("seq", ev.schema[seq].dataType)])
    out = base.groupBy(key).transformWithStateInPandas(
        ConsecutiveFailProcessor(duration_us(max_gap), inclusive), schema, "Append", "None")
    return out.select(F.col("key").alias(key), from_micros("first_us", T.TimestampType()).alias("first_fail"),
                      from_micros("last_us", T.TimestampType()).alias("last_fail"), F.col("seq").alias(seq),
                      F.lit(msg).alias("warning"))


# ------------------------------------------------------------------ B1
class ClickCapProcessor(StatefulProcessor):
    """State: clicks per calendar day (map day -> count).  In arrival order,
    clicks up to ``limit`` of a day pass, click ``limit + 1`` warns, later
    ones are dropped - per day, so a late click of the previous day is still
    counted against that day (as in the batch operator).  A timer two days
    after a day's start drops that day's counter."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getMapState("count", T.StructType([T.StructField("day", _LONG)]),
                                        T.StructType([T.StructField("n", _LONG)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows).sort_values("seq", kind="stable").reset_index(drop=True)
        days = pdf["day_num"].to_numpy(dtype=np.int64)
        before = {}
        for d in np.unique(days):                  # one state lookup per day in the batch
            got = self.count.getValue((int(d),))
            before[int(d)] = got[0] if got else 0
        out_n = pdf.groupby("day_num").cumcount().to_numpy() + 1 + np.array([before[int(d)] for d in days])
        for d, last in pd.Series(out_n).groupby(days).max().items():
            self.count.updateValue((int(d),), (int(last),))
            self.handle.registerTimer((int(d) + 2) * 86_400_000)
        keep = out_n <= self.limit + 1
        if not keep.any():
            return
        res = pdf.loc[keep, ["click", "day_num"]].copy()
        res["channel"] = np.where(out_n[keep] <= self.limit, "passed", "blacklist")
        yield res

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.count.removeKey((int(expiredTimerInfo.getExpiryTimeInMs() // 86_400_000) - 2,))
        yield from ()

    def close(self) -> None:
        pass


def cap_and_flag_stream(df: DataFrame, keys, ts: str, seq: str, limit: int = 100, zone: str = "UTC",
                        delay="0 seconds") -> DataFrame:
    """One tagged stream of whole click rows with their day (``channel`` = passed /
    blacklist); :func:`flowstat.streaming.sinks.fan_out_per_batch` splits it."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    ev = with_event_time(df, ts, delay)
    # a click travels as JSON, so its columns keep their types whatever they are
    micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    base = ev.select(*[F.col(k).alias(f"key{i}") for i, k in enumerate(ks)], F.col(seq).alias("seq"),
                     F.unix_date(local_day(ts, zone, ev.schema[ts].dataType)).cast("long").alias("day_num"),
                     F.to_json(F.struct(*ev.columns), micros).alias("click"))
    schema = T.StructType([T.StructField("click", T.StringType()), T.StructField("day_num", _LONG),
                           T.StructField("channel", T.StringType())])
    out = base.groupBy(*[f"key{i}" for i in range(len(ks))]).transformWithStateInPandas(
        ClickCapProcessor(limit), schema, "Append", "EventTime")
    row = F.from_json("click", T.StructType([T.StructField(f.name, f.dataType) for f in ev.schema]), micros)
    return (out.withColumn("row", row)
            .select("row.*", F.date_from_unix_date(F.col("day_num").cast("int")).alias("day"), "channel",
                    F.when(F.col("channel") == "blacklist", F.lit(BLACKLIST_WARNING)).alias("warning")))


# ------------------------------------------------------------------ C5
class OrderStatusProcessor(StatefulProcessor):
    """State: first create time and the pay times of one order; a timer at
    create + ``within`` (or first pay + ``within`` while no create is seen)
    finalises the order: payed / timeout / pay_without_create.

    A finalised order is remembered for ``keep`` more event time, so a pay that
    comes later belongs to it and says nothing new; a create after a reported
    pay-without-create is still judged.  After that the key's state is dropped,
    and a row later still starts a new order."""

    def __init__(self, within_us: int, keep_us: int):
        self.w, self.keep = within_us, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.create = handle.getValueState("create", T.StructType([T.StructField("t", _LONG)]))
        self.pays = handle.getListState("pays", T.StructType([T.StructField("t", _LONG)]))
        self.done = handle.getValueState("done", T.StructType([T.StructField("created", _BOOL), T.StructField("until", _LONG)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        done = self.done.get() if self.done.exists() else None
        if done is not None and done[0]:
            return
        c = pdf.loc[pdf["is_create"], "t_us"]
        ct = self.create.get()[0] if self.create.exists() else None
        if len(c):
            ct = int(c.min()) if ct is None else min(ct, int(c.min()))
            self.create.update((ct,))
        elif done is not None and ct is None:
            return                                           # more pays without a create
        new_pays = [(int(x),) for x in pdf.loc[pdf["is_pay"], "t_us"]]
        if new_pays:
            self.pays.appendList(new_pays)
        pays = [p[0] for p in self.pays.get()] if self.pays.exists() else []
        if ct is None and not pays:
            return
        due = (ct if ct is not None else min(pays)) + self.w
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(-(-due // 1000))           # ceil: fire only once the deadline has passed
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ct = self.create.get()[0] if self.create.exists() else None
        pays = [p[0] for p in self.pays.get()] if self.pays.exists() else []
        done = self.done.get() if self.done.exists() else None
        self.create.clear()
        self.pays.clear()
        if ct is None and not pays:                          # the time to remember is over
            self.done.clear()
            return
        out = []
        if ct is not None:
            later = [p for p in pays if p >= ct]
            out.append(PAYED if later and min(later) < ct + self.w else TIMEOUT)
        if done is None and pays and (ct is None or min(pays) < ct):
            out.append(PAY_WITHOUT_CREATE)
        until = expiredTimerInfo.getExpiryTimeInMs() + self.keep // 1000
        self.done.update((ct is not None, until))
        self.handle.registerTimer(until)
        if out:
            yield pd.DataFrame({"key": [key[0]] * len(out), "status": out})

    def close(self) -> None:
        pass


def pair_status_stream(df: DataFrame, key: str, is_create, is_pay, ts: str, within="15 minutes",
                       delay="0 seconds", keep="1 day") -> DataFrame:
    """Streaming C5; a finalised order is remembered for ``keep`` of event time."""
    expr = (lambda p: F.expr(p) if isinstance(p, str) else p)
    ev = with_event_time(df, ts, delay)
    base = after_watermark(ev, ts, expr(is_create) | expr(is_pay)).select(
        key, expr(is_create).alias("is_create"), expr(is_pay).alias("is_pay"), to_micros(ts, T.TimestampType()).alias("t_us"))
    schema = T.StructType([T.StructField("key", ev.schema[key].dataType), T.StructField("status", T.StringType())])
    out = base.groupBy(key).transformWithStateInPandas(
        OrderStatusProcessor(duration_us(within), duration_us(keep)), schema, "Append", "EventTime")
    return out.select(F.col("key").alias(key), "status")


# ------------------------------------------------------------------ event-time ordered rules
_ROW = np.dtype([("t", "<i8"), ("seq", "<i8"), ("a", "?"), ("b", "?")])


class EventBuffer:
    """Rows of a key (time, seq, flag a, flag b) in map state by time bucket of ``width`` µs.

    Every call of :meth:`add` writes new entries and reads none; :meth:`take` reads the
    buckets that begin before the watermark and no others, so its work is in proportion to
    the rows it releases and one bucket.  An index (bucket, number of entries, earliest time)
    is kept beside them."""

    def __init__(self, handle: StatefulProcessorHandle, width: int):
        self.width = width
        self.rows = handle.getMapState("buf", T.StructType([T.StructField("bucket", _LONG), T.StructField("part", _LONG)]),
                                       T.StructType([T.StructField("rows", T.BinaryType())]))
        self.index = handle.getValueState("index", T.StructType([T.StructField("buckets", T.BinaryType())]))

    def _buckets(self) -> dict[int, tuple[int, int]]:
        if not self.index.exists():
            return {}
        return {int(b): (int(n), int(t)) for b, n, t in np.frombuffer(self.index.get()[0], "<i8").reshape(-1, 3)}

    def _store(self, buckets: dict[int, tuple[int, int]]) -> None:
        if buckets:
            self.index.update((np.array([(b, n, t) for b, (n, t) in buckets.items()], "<i8").tobytes(),))
        else:
            self.index.clear()

    def add(self, rows: np.ndarray) -> None:
        buckets = self._buckets()
        bucket = rows["t"] // self.width
        for b in np.unique(bucket):
            own = rows[bucket == b]
            n, earliest = buckets.get(int(b), (0, int(own["t"].min())))
            self.rows.updateValue((int(b), n), (own.tobytes(),))
            buckets[int(b)] = (n + 1, min(earliest, int(own["t"].min())))
        self._store(buckets)

    def take(self, before: int) -> np.ndarray:
        """Remove and return the rows earlier than ``before``, by (time, seq)."""
        buckets, found = self._buckets(), [np.empty(0, _ROW)]
        for b in [b for b, (_, earliest) in buckets.items() if earliest < before]:
            n, _ = buckets.pop(b)
            held = np.concatenate([np.frombuffer(self.rows.getValue((b, p))[0], _ROW) for p in range(n)])
            for p in range(n):
                self.rows.removeKey((b, p))
            rest = held[held["t"] >= before]
            if len(rest):
                self.rows.updateValue((b, 0), (rest.tobytes(),))
                buckets[b] = (1, int(rest["t"].min()))
            found.append(held[held["t"] < before])
        if len(found) > 1:
            self._store(buckets)
        ready = np.concatenate(found)
        return ready[np.lexsort((ready["seq"], ready["t"]))]

    def earliest(self) -> int | None:
        return min((t for _, t in self._buckets().values()), default=None)


class _EventTimeOrdered(StatefulProcessor):
    """Buffers a key's rows (time, seq, flag a, flag b) by time bucket and
    releases them in (time, seq) order once the watermark has passed them
    (rows at or after the watermark may still be joined by equal-time rows).
    Subclasses keep a small carry state and implement :meth:`release`."""

    out_columns: list[str] = []
    bucket_us = 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = EventBuffer(handle, self.bucket_us)
        self.init_carry(handle)

    def init_carry(self, handle) -> None:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        if wm > 0:
            pdf = pdf[pdf["t_us"] >= wm]                     # late rows are dropped, as Spark does
        if pdf.empty:
            return
        new = np.empty(len(pdf), _ROW)
        for field, column in (("t", "t_us"), ("seq", "seq"), ("a", "flag_a"), ("b", "flag_b")):
            new[field] = pdf[column].to_numpy()
        self.buf.add(new)
        # one timer at the earliest new row is enough: a firing releases every
        # row the watermark has passed and re-arms for the earliest one left
        self.handle.registerTimer(int(new["t"].min()) // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        ready = self.buf.take(wm).tolist()
        rest = self.buf.earliest()
        if rest is not None:
            self.handle.registerTimer(rest // 1000 + 1)
        out = self.release(key, ready, wm)
        if out:
            yield pd.DataFrame(out, columns=self.out_columns)

    def release(self, key, ready, wm) -> list[tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class StrictNextProcessor(_EventTimeOrdered):
    """Adjacent rows (event-time order) with flag a then flag b, less
    than ``within`` apart.  Carry: the last released row (is a, time)."""

    out_columns = ["key", "first_us", "last_us", "seq"]

    def __init__(self, within_us: int):
        self.w = within_us

    def init_carry(self, handle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("a", _BOOL), T.StructField("t", _LONG)]))

    def release(self, key, ready, wm):
        if not ready:
            return []
        pa, pt = self.last.get() if self.last.exists() else (False, 0)
        arr = np.array([(r[0], r[1], r[2], r[3]) for r in ready], dtype=np.int64)
        t, s, a, b = arr[:, 0], arr[:, 1], arr[:, 2].astype(bool), arr[:, 3].astype(bool)
        prev_a, prev_t = np.r_[pa, a[:-1]], np.r_[pt, t[:-1]]
        hit = prev_a & b & (t - prev_t < self.w)
        self.last.update((bool(a[-1]), int(t[-1])))
        return [(key[0], int(p), int(c), int(q)) for p, c, q in zip(prev_t[hit], t[hit], s[hit])]


class FollowedByProcessor(_EventTimeOrdered):
    """C4: every ``a`` row takes the first later ``b`` row; gap < within ->
    matched, else timeout.  An ``a`` row still waiting when the watermark
    passes its deadline times out.  Carry: the waiting ``a`` rows."""

    out_columns = ["key", "kind", "seq", "t", "then_seq", "then_t"]

    def __init__(self, within_us: int):
        self.w = within_us

    def init_carry(self, handle) -> None:
        self.pending = handle.getListState("pending", T.StructType([T.StructField("t", _LONG),
                                                                     T.StructField("seq", _LONG)]))

    def release(self, key, ready, wm):
        pend = list(self.pending.get()) if self.pending.exists() else []
        out = []
        if ready:
            arr = np.array([(r[0], r[1], r[2], r[3]) for r in ready], dtype=np.int64)
            t, s, a, b = arr[:, 0], arr[:, 1], arr[:, 2].astype(bool), arr[:, 3].astype(bool)
            pays = np.flatnonzero(b)
            if pend and len(pays):                 # waiting creates take the first released pay
                pt, ps = int(t[pays[0]]), int(s[pays[0]])
                out += [(key[0], "matched", cs, ct, ps, pt) if pt - ct < self.w else
                        (key[0], "timeout", cs, ct, None, None) for ct, cs in pend]
                pend = []
            creates = np.flatnonzero(a)
            nxt = np.searchsorted(pays, creates, side="right")   # first pay strictly after each create
            for ci, ni in zip(creates, nxt):
                ct, cs = int(t[ci]), int(s[ci])
                if ni < len(pays):
                    pt, ps = int(t[pays[ni]]), int(s[pays[ni]])
                    out.append((key[0], "matched", cs, ct, ps, pt) if pt - ct < self.w else
                               (key[0], "timeout", cs, ct, None, None))
                else:
                    pend.append((ct, cs))
                    self.handle.registerTimer((ct + self.w) // 1000 + 1)
        keep = []
        for ct, cs in pend:
            if ct + self.w < wm:
                out.append((key[0], "timeout", cs, ct, None, None))
            else:
                keep.append((ct, cs))
        if keep:
            self.pending.put(keep)
        else:
            self.pending.clear()
        return out


class BurstProcessor(_EventTimeOrdered):
    """The first failure (flag a) opens ``[first, first + within]``; a
    reset (flag b) in it cancels it; at expiry >= ``min_count`` failures
    warn.  Carry: (anchor time, count, last failure time)."""

    out_columns = ["key", "first_us", "last_us", "n_fails"]

    def __init__(self, within_us: int, min_count: int):
        self.w, self.min_count = within_us, min_count

    def init_carry(self, handle) -> None:
        self.anchor = handle.getValueState("anchor", T.StructType([T.StructField("a", _LONG), T.StructField("n", _LONG),
                                                                   T.StructField("last", _LONG)]))

    def release(self, key, ready, wm):
        cur = self.anchor.get() if self.anchor.exists() else None
        out = []

        def close(c):
            if c is not None and c[1] >= self.min_count:
                out.append((key[0], int(c[0]), int(c[2]), int(c[1])))

        if ready:
            arr = np.array([(r[0], r[2], r[3]) for r in ready], dtype=np.int64)
            t, fail, reset = arr[:, 0], arr[:, 1].astype(bool), arr[:, 2].astype(bool)
            fails, resets = np.flatnonzero(fail), np.flatnonzero(reset & ~fail)
            i, n = 0, len(t)
            while i < n:                           # one step per window, not per row
                if cur is None:
                    j = fails[np.searchsorted(fails, i)] if np.searchsorted(fails, i) < len(fails) else n
                    if j >= n:
                        break
                    cur = (int(t[j]), 1, int(t[j]))
                    self.handle.registerTimer((int(t[j]) + self.w) // 1000 + 1)
                    i = j + 1
                    continue
                end = int(np.searchsorted(t, cur[0] + self.w, side="right"))   # first row after the window
                end = max(end, i)
                k = np.searchsorted(resets, i)
                if k < len(resets) and resets[k] < end:          # a success inside the window cancels it
                    cur, i = None, int(resets[k]) + 1
                    continue
                lo, hi = np.searchsorted(fails, i), np.searchsorted(fails, end)
                if hi > lo:
                    cur = (cur[0], cur[1] + int(hi - lo), int(t[fails[hi - 1]]))
                if end >= n:
                    break
                close(cur)
                cur, i = None, end
        if cur is not None and cur[0] + self.w < wm:
            close(cur)
            cur = None
        if cur is None:
            self.anchor.clear()
        else:
            self.anchor.update(tuple(int(x) for x in cur))
        return out


def _buffered(processor: _EventTimeOrdered, delay) -> _EventTimeOrdered:
    """Buckets of a 64th of the watermark's delay, a tenth of a second at least."""
    processor.bucket_us = max(100_000, duration_us(delay) // 64)
    return processor


def _ordered_input(df, key, a, b, ts, seq, delay):
    """Rows with either flag; all rows move the watermark."""
    expr = (lambda p: F.expr(p) if isinstance(p, str) else p)
    ev = with_event_time(df, ts, delay)
    base = after_watermark(ev, ts, expr(a) | expr(b)).select(
        key, F.col(seq).alias("seq"), expr(a).alias("flag_a"), expr(b).alias("flag_b"),
        to_micros(ts, T.TimestampType()).alias("t_us"))
    return ev, base


def match_next_stream(df: DataFrame, key: str, first, second, ts: str, seq: str, within="2 seconds",
                      delay="10 seconds", msg: str = LOGIN_WARNING) -> DataFrame:
    """Streaming C3.  Every row of the key takes part in adjacency (a row
    matching neither predicate breaks a pair), so all rows are buffered."""
    ev = with_event_time(df, ts, delay)
    base = ev.select(key, F.col(seq).alias("seq"), (F.expr(first) if isinstance(first, str) else first).alias("flag_a"),
                     (F.expr(second) if isinstance(second, str) else second).alias("flag_b"),
                     to_micros(ts, T.TimestampType()).alias("t_us"))
    schema = T.StructType([T.StructField("key", ev.schema[key].dataType), T.StructField("first_us", _LONG),
                           T.StructField("last_us", _LONG), T.StructField("seq", _LONG)])
    out = base.groupBy(key).transformWithStateInPandas(_buffered(StrictNextProcessor(duration_us(within)), delay), schema,
                                                       "Append", "EventTime")
    return out.select(F.col("key").alias(key), from_micros("first_us", T.TimestampType()).alias("first_fail"),
                      from_micros("last_us", T.TimestampType()).alias("last_fail"), F.col("seq").alias(seq),
                      F.lit(msg).alias("warning"))


def followed_by_stream(df: DataFrame, key: str, first, then, ts: str, seq: str, within="15 minutes",
                       delay="0 seconds") -> DataFrame:
    """Streaming C4 -> one tagged frame: kind = matched / timeout."""
    ev, base = _ordered_input(df, key, first, then, ts, seq, delay)
    schema = T.StructType([T.StructField("key", ev.schema[key].dataType), T.StructField("kind", T.StringType()),
                           T.StructField("seq", _LONG), T.StructField("t", _LONG),
                           T.StructField("then_seq", _LONG), T.StructField("then_t", _LONG)])
    out = base.groupBy(key).transformWithStateInPandas(_buffered(FollowedByProcessor(duration_us(within)), delay), schema,
                                                       "Append", "EventTime")
    return out.select(F.col("key").alias(key), "kind", F.col("seq").alias(seq),
                      from_micros("t", T.TimestampType()).alias(ts), F.col("then_seq"),
                      from_micros("then_t", T.TimestampType()).alias("then_ts"))


def burst_stream(df: DataFrame, key: str, is_fail, is_reset, ts: str, seq: str, within="2 seconds",
                 min_count: int = 2, delay="10 seconds", msg: str = LOGIN_WARNING) -> DataFrame:
    """Streaming C2."""
    ev, base = _ordered_input(df, key, is_fail, is_reset, ts, seq, delay)
    schema = T.StructType([T.StructField("key", ev.schema[key].dataType), T.StructField("first_us", _LONG),
                           T.StructField("last_us", _LONG), T.StructField("n_fails", _LONG)])
    out = base.groupBy(key).transformWithStateInPandas(_buffered(BurstProcessor(duration_us(within), min_count), delay), schema,
                                                       "Append", "EventTime")
    return out.select(F.col("key").alias(key), from_micros("first_us", T.TimestampType()).alias("first_fail"),
                      from_micros("last_us", T.TimestampType()).alias("last_fail"), "n_fails",
                      F.lit(msg).alias("warning"))


# ------------------------------------------------------------------ T7
class LateFlagProcessor(StatefulProcessor):
    """Stateless use of the state API: it only reads the micro-batch's
    watermark (which Spark does not expose to plain expressions) and flags
    rows whose last window, extended by the allowed lateness, is already
    closed: ``floor(t, slide) + size - 1 ms + lateness <= watermark``."""

    def __init__(self, size_us: int, slide_us: int, lateness_us: int, names: list[str]):
        self.size, self.slide, self.late, self.names = size_us, slide_us, lateness_us, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        for pdf in rows:
            t = pdf["t_us"].to_numpy(dtype=np.int64)
            last_end = t - np.mod(t, self.slide) + self.size
            out = pdf[self.names].copy()
            out["late"] = (wm > 0) & (last_end - 1000 + self.late <= wm)
            yield out

    def close(self) -> None:
        pass


def split_late_stream(df: DataFrame, ts: str, size="10 minutes", slide="5 seconds", lateness="1 minute",
                      delay="1 second", spread: int | None = None) -> DataFrame:
    """Streaming late-row side output: every row with a ``late`` flag (split
    it with a filter in ``foreachBatch``).  The watermark is Spark's, i.e.
    per micro-batch, so a row counts as late against the watermark of the
    batch it arrives in.  Rows are spread over ``spread`` groups by a hash
    (no state is kept, the grouping only parallelises the check); by default four
    for each shuffle partition."""
    spread = spread or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ev = with_event_time(df, ts, delay)
    names = [c for c in ev.columns]
    # a copy of the event time, to which the watermark does not belong: else Spark itself drops the rows looked for,
    # once the watermark that they missed is one micro-batch old
    base = ev.withColumn("t_us", to_micros(ts, T.TimestampType())).withColumn(ts, F.timestamp_micros("t_us")).withColumn(
        "spread_key", F.pmod(F.hash(*[F.col(c) for c in names]), F.lit(spread)))
    schema = T.StructType(list(ev.schema.fields) + [T.StructField("late", _BOOL)])
    proc = LateFlagProcessor(duration_us(size), duration_us(slide), duration_us(lateness), names)
    return base.groupBy("spread_key").transformWithStateInPandas(proc, schema, "Append", "EventTime")


# ------------------------------------------------------------------ A10 / T9
class FirstSightingsProcessor(StatefulProcessor):
    """Per (window, bucket of values): the values seen so far, in map state by a second
    hash of the value, so that a micro-batch reads and writes only the parts that its rows
    touch.  Every row comes out with ``first`` = 1 if its value is seen for the first time
    (in the order of ``seq``), else 0.  A timer at the window's end clears the state; rows of a
    window that the watermark has passed are dropped."""

    PARTS = 256

    def __init__(self, buckets: int):
        self.buckets = buckets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", T.StructType([T.StructField("part", _LONG)]),
                                       T.StructType([T.StructField("values", T.BinaryType())]))

    def fresh(self, h: np.ndarray) -> np.ndarray:
        """Whether each of the distinct values ``h`` is new; they are seen from now on."""
        part = (h // self.buckets) % self.PARTS
        new = np.zeros(len(h), bool)
        for p in np.unique(part):                  # one read for each part that has rows
            at = np.flatnonzero(part == p)
            got = self.seen.getValue((int(p),))
            known = np.frombuffer(got[0], np.int64) if got else np.empty(0, np.int64)
            new[at] = ~np.isin(h[at], known)
            if new[at].any():
                self.seen.updateValue((int(p),), (np.sort(np.concatenate([known, h[at][new[at]]])).tobytes(),))
        return new

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows).sort_values("seq", kind="stable")
        end_us = int(pdf["end_us"].iloc[0])
        if end_us <= timerValues.getCurrentWatermarkInMs() * 1000:
            return
        values, at = np.unique(pdf["h"].to_numpy(dtype=np.int64), return_index=True)
        first = np.zeros(len(pdf), dtype=np.int32)
        first[at] = self.fresh(values)
        self.handle.registerTimer(-(-end_us // 1000))
        yield pd.DataFrame({"seq": pdf["seq"].to_numpy(), "end_us": pdf["end_us"].to_numpy(), "first": first})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def first_sightings_stream(df: DataFrame, ts: str, seq: str, col: str, size="1 hour", hashed: bool = True,
                           delay="0 seconds", where=None, buckets: int | None = None) -> DataFrame:
    """seq, window_end, first of every row: 1 where the row's value (or bitmap position) is the
    window's first.  State is keyed by (window, bucket of the value), so a window's traffic is dealt
    over ``buckets`` groups (by default four for each shuffle partition);
    :func:`flowstat.streaming.jobs.running_distinct_per_batch` adds the running count."""
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ev = after_watermark(with_event_time(df, ts, delay), ts, where)
    w = F.window(F.col(ts), duration_str(duration_us(size)))
    v = bitmap_hash(col) if hashed else F.col(col).cast("long")
    base = ev.select(F.col(seq).alias("seq"), to_micros(w.end, T.TimestampType()).alias("end_us"), v.alias("h")).withColumn(
        "bucket", F.pmod("h", F.lit(buckets)))
    schema = T.StructType([T.StructField("seq", _LONG), T.StructField("end_us", _LONG), T.StructField("first", T.IntegerType())])
    out = base.groupBy("end_us", "bucket").transformWithStateInPandas(FirstSightingsProcessor(buckets), schema, "Append", "EventTime")
    return out.select(F.col("seq").alias(seq), from_micros("end_us", T.TimestampType()).alias("window_end"), "first")

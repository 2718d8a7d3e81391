"""Event patterns per key: consecutive failures, strict next, followed-by
with timeout, failure bursts, and two-event order status.

All of them are window or aggregate expressions over (key, order); the
order-dependent ones use the chunked helpers of ``ordered`` so a hot key is
split over many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import duration_us, floor_to, from_micros, to_micros, ts_type
from ..session import written
from .ordered import heavy_rows, neighbour, running_total, sessionize_split

# ---------------------------------------------------------------- fixed values
LOGIN_WARNING = "login fail"
PAYED, TIMEOUT, PAY_WITHOUT_CREATE = "payed", "timeout", "pay_without_create"
# ------------------------------------------------------------------------------

DEFAULT_SEQ_CHUNK = 1 << 20
DEFAULT_TIME_CHUNK = "1 hour"


def _pred(df: DataFrame, p) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def consecutive(df: DataFrame, key: str, is_fail, ts: str, seq: str, max_gap="2 seconds",
                inclusive: bool = True, min_gap=None, msg: str = LOGIN_WARNING,
                chunk: int = DEFAULT_SEQ_CHUNK) -> DataFrame:
    """Two failures in a row of one key in *arrival* order (``seq``) whose
    event times differ by at most ``max_gap`` (``< max_gap`` when not
    inclusive).  There is no lower bound unless ``min_gap`` is given, so an
    out-of-order pair (negative gap) also warns.
    -> key, first_fail, last_fail, seq (of the second failure), warning."""
    dtype = ts_type(df, ts)
    base = df.select(key, ts, seq, _pred(df, is_fail).alias("_f"), to_micros(ts, dtype).alias("_t"))
    withprev = neighbour(base, key, [seq], ["_f", "_t", ts], chunk_col=seq, chunk=chunk, prefix="p_")
    gap = F.col("_t") - F.col("p__t")
    g = duration_us(max_gap)
    ok = (gap <= g) if inclusive else (gap < g)
    if min_gap is not None:
        ok = ok & (gap >= duration_us(min_gap))
    hit = F.col("_f") & F.coalesce(F.col("p__f"), F.lit(False)) & ok
    return withprev.where(hit).select(key, F.col("p_" + ts).alias("first_fail"), F.col(ts).alias("last_fail"),
                                      seq, F.lit(msg).alias("warning"))


def match_next(df: DataFrame, key: str, first, second, ts: str, seq: str, within="2 seconds",
               chunk=DEFAULT_TIME_CHUNK, msg: str = LOGIN_WARNING) -> DataFrame:
    """Strict contiguity ``begin(first).next(second).within(t)``: adjacent
    rows of a key in *event-time* order (ties by ``seq``), the second less
    than ``within`` after the first.  Overlapping matches are all kept.
    -> key, first_fail, last_fail, seq (of the second), warning."""
    dtype = ts_type(df, ts)
    base = df.select(key, ts, seq, _pred(df, first).alias("_a"), _pred(df, second).alias("_b"),
                     to_micros(ts, dtype).alias("_t"))
    withnext = neighbour(base, key, ["_t", seq], ["_b", "_t", ts, seq], chunk_col="_t",
                         chunk=duration_us(chunk), prefix="n_", direction="lead")
    hit = F.col("_a") & F.coalesce(F.col("n__b"), F.lit(False)) & (F.col("n__t") - F.col("_t") < duration_us(within))
    return withnext.where(hit).select(key, F.col(ts).alias("first_fail"), F.col("n_" + ts).alias("last_fail"),
                                      F.col("n_" + seq).alias(seq), F.lit(msg).alias("warning"))


def followed_by(df: DataFrame, key: str, first, then, ts: str, seq: str, within="15 minutes",
                chunk=DEFAULT_TIME_CHUNK) -> tuple[DataFrame, DataFrame]:
    """Relaxed contiguity ``begin(first).followedBy(then).within(t)`` with a
    timeout side output.  Every ``first`` row takes the first later ``then``
    row of its key (event-time order, ties by ``seq``); other rows are
    skipped.  Gap < ``within`` -> matched, otherwise (or none) -> timed out.
    The first later row is a suffix minimum over (ts, seq), computed chunk by
    chunk - one pass, no self-join.
    -> (matched: key, seq, ts, then_seq, then_ts;  timeout: key, seq, ts)."""
    dtype = ts_type(df, ts)
    base = (df.select(key, ts, seq, _pred(df, first).alias("_a"), _pred(df, then).alias("_b"),
                      to_micros(ts, dtype).alias("_t"))
              .where(F.col("_a") | F.col("_b")))
    val = F.when(F.col("_b"), F.struct(F.col("_t").alias("t"), F.col(seq).alias("s")))
    ran = running_total(base, part=[key], order=["_t", seq], value=val, out="_nx", chunk_col="_t",
                        chunk=duration_us(chunk), agg="min", exclusive=True, descending=True)
    firsts = ran.where(F.col("_a"))
    ok = F.col("_nx").isNotNull() & (F.col("_nx.t") - F.col("_t") < duration_us(within))
    matched = firsts.where(ok).select(key, seq, ts, F.col("_nx.s").alias("then_seq"),
                                      from_micros(F.col("_nx.t"), dtype).alias("then_ts"))
    timeout = firsts.where(~ok).select(key, seq, ts)
    return matched, timeout


def pair_status(df: DataFrame, key: str, is_create, is_pay, ts: str, within="15 minutes",
                out: str = "status") -> DataFrame:
    """Order status tolerant of pay-before-create, by aggregates per key:
    first create c; first pay at or after it p.  ``c.ts <= p.ts < c.ts +
    within`` -> payed, otherwise timeout; a pay earlier than the first
    create, or a pay with no create -> pay_without_create.
    The first create up to each pay is a running minimum (creates before pays at
    equal times), and one aggregate per key takes the rest: the input is read
    once, besides the count of rows per key."""
    w = duration_us(within)
    dtype = ts_type(df, ts)
    base = df.select(key, to_micros(ts, dtype).alias("_t"), _pred(df, is_create).alias("_c"),
                     _pred(df, is_pay).alias("_p")).where("_c OR _p")
    base = base.withColumns({"_o": (~F.col("_c")).cast("int"), "_create": F.when(F.col("_c"), F.col("_t"))})
    ran = running_total(base, part=[key], order=["_t", "_o"], value="_create", out="_seen", chunk_col="_t",
                        chunk=duration_us(DEFAULT_TIME_CHUNK), agg="min")
    s = ran.groupBy(key).agg(F.min("_create").alias("_ct"), F.min(F.when(F.col("_p"), F.col("_t"))).alias("_pt0"),
                             F.min(F.when(F.col("_p") & F.col("_seen").isNotNull(), F.col("_t"))).alias("_p1"))
    created = F.when(F.col("_ct").isNotNull(),
                     F.when(F.col("_p1").isNotNull() & (F.col("_p1") < F.col("_ct") + F.lit(w)), F.lit(PAYED))
                      .otherwise(F.lit(TIMEOUT)))
    orphan = F.when(F.col("_pt0").isNotNull() & (F.col("_ct").isNull() | (F.col("_pt0") < F.col("_ct"))),
                    F.lit(PAY_WITHOUT_CREATE))
    # both kinds of row come out of one projection (no union re-reading the input)
    return s.select(key, F.explode(F.array_compact(F.array(created, orphan))).alias(out))


def burst(df: DataFrame, key: str, is_fail, is_reset, ts: str, seq: str, within="2 seconds",
          min_count: int = 2, msg: str = LOGIN_WARNING, chunk=DEFAULT_TIME_CHUNK) -> DataFrame:
    """Failure burst with a timer: the first failure of a key opens a window
    ``[first, first + within]``; when it expires, >= ``min_count`` failures in
    it give one warning (first, last); a reset row (success) in the window,
    after the first failure, cancels it.  The next failure after expiry or
    reset opens a new window (event-time order, ties by ``seq``).

    Anchors chain greedily, which no window expression states, so the scan
    runs in pandas - but only over *runs*: maximal stretches of a key's
    failures with no reset between them and no gap above ``within``, each
    followed by the resets up to the next run.  No window crosses a run
    border, and only a run's last window can be cancelled (by the reset that
    ends the run), so runs are independent.  Run ids come from a chunked
    sessionize pass (never a whole key in one task).  A run of more than
    ``HEAVY_ROWS`` failures is split itself, see :func:`long_run_bursts`."""
    dtype = ts_type(df, ts)
    wus = duration_us(within)
    base = (df.select(key, seq, to_micros(ts, dtype).alias("_t"), _pred(df, is_fail).alias("_f"),
                      _pred(df, is_reset).alias("_r"))
              .where(F.col("_f") | F.col("_r")))

    def starts(prev, cur):
        return cur["_f"] & (prev["_f"].isNull() | ~prev["_f"] | (cur["_t"] - prev["_t"] > wus))

    runs, split = sessionize_split(base, key, ["_t", seq], ["_f", "_t"], starts, chunk_col="_t", chunk=duration_us(chunk),
                                   out="_run", flag="_start")
    schema = T.StructType([T.StructField(key, df.schema[key].dataType)]
                          + [T.StructField(c, T.LongType()) for c in ("first_fail_us", "last_fail_us", "n_fails")])
    # secondary sort: runs are hashed over all tasks, each task streams its
    # runs in (key, run, time) order through a constant-memory scan
    rows, long_bursts = runs.where(F.col("_run") > 0).select(key, "_run", "_t", seq, "_f"), None
    if split:  # no run is longer than its key
        rows = written(rows, "burst-runs")
        long = rows.where("_f").groupBy(key, "_run").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy_rows()).select(
            F.col(key).alias("_lk"), F.col("_run").alias("_lr"))
        same = F.col(key).eqNullSafe(F.col("_lk")) & (F.col("_run") == F.col("_lr"))
        if not long.isEmpty():
            long_bursts = long_run_bursts(rows.join(long, same, "left_semi"), key, wus, min_count, schema)
            rows = rows.join(long, same, "left_anti")
    ordered = rows.repartition(key, "_run").sortWithinPartitions(key, "_run", "_t", seq)
    res = ordered.mapInPandas(_burst_scanner(key, wus, min_count, schema.fieldNames()), schema=schema)
    if long_bursts is not None:
        res = res.unionByName(long_bursts)
    return res.select(key, from_micros("first_fail_us", dtype).alias("first_fail"),
                      from_micros("last_fail_us", dtype).alias("last_fail"), "n_fails",
                      F.lit(msg).alias("warning"))


def long_run_bursts(rows: DataFrame, key: str, wus: int, min_count: int, schema: T.StructType, chunk_windows: int = 256) -> DataFrame:
    """Bursts of long runs (key, _run, _t, _f), each dealt over many tasks.

    The failure times of a run are cut in chunks of ``chunk_windows`` windows.  An anchor at t is
    followed by the first failure after t + within, at most one more window away, so each time has a
    link to its next anchor in its chunk or the next one.  Inside a chunk the links are doubled
    until they leave it; that gives each time at which a chunk may be entered the
    time at which the next one is.  These chunk links are doubled in turn, log2 of the number of chunks
    times, while the times reached from a run's first failure are marked.  Each chunk then
    knows its first anchor and finds its windows by itself."""
    width = max(1, wus) * chunk_windows
    same = [key, "_run"]
    resets = rows.where(~F.col("_f")).groupBy(*same).agg(F.min("_t").alias("_reset"))
    times = rows.where("_f").groupBy(*same, "_t").agg(F.count(F.lit(1)).alias("_n"))
    own = floor_to(F.col("_t"), width)
    # a chunk also sees the beginning of the next one
    seen = F.when(F.col("_t") - own < 2 * wus + 2, F.array(own, own - width)).otherwise(F.array(own))
    dealt = written(times.withColumn("_c", F.explode(seen)), "burst-chunks")
    kinds = rows.schema[key].dataType
    link_schema = T.StructType([T.StructField(key, kinds), *[T.StructField(c, T.LongType()) for c in ("_run", "_at", "_to")]])

    def exits(t: np.ndarray, end: int) -> np.ndarray:
        """For each time of the chunk the place of the first anchor behind its end (len(t) if there is none)."""
        nxt = np.append(np.searchsorted(t, t + wus, side="right"), len(t))
        inside = np.append(t < end, False)
        while True:
            going = inside[nxt]
            if not going.any():
                return nxt[:-1]
            nxt = np.where(going, nxt[nxt], nxt)

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        begin = int(pdf["_c"].iloc[0])
        t = np.sort(pdf["_t"].to_numpy())
        to = exits(t, begin + width)
        entry = np.flatnonzero((t < begin + 2 * wus + 2) & (t < begin + width) & (to < len(t)))
        return pd.DataFrame({key: [pdf[key].iloc[0]] * len(entry), "_run": int(pdf["_run"].iloc[0]), "_at": t[entry], "_to": t[to[entry]]})

    def joined(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
        """a's rows with b's _to (as _next) where a's column ``on`` is b's _at."""
        b = b.select(F.col(key).alias("_bk"), F.col("_run").alias("_br"), F.col("_at").alias("_ba"), F.col("_to").alias("_next"))
        return a.join(b, F.col(key).eqNullSafe(F.col("_bk")) & (F.col("_run") == F.col("_br")) & (F.col(on) == F.col("_ba")))

    marks = times.groupBy(*same).agg(F.min("_t").alias("_at"))
    # a run begins anywhere in its first chunk, which has a link for its beginning only
    first = dealt.join(marks.select(F.col(key).alias("_bk"), F.col("_run").alias("_br"), floor_to(F.col("_at"), width).alias("_bc")),
                       F.col(key).eqNullSafe(F.col("_bk")) & (F.col("_run") == F.col("_br")) & (F.col("_c") == F.col("_bc"))).select(*dealt.columns)

    def first_link(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.sort(pdf["_t"].to_numpy())
        to = int(exits(t, int(pdf["_c"].iloc[0]) + width)[0])
        found = [(pdf[key].iloc[0], int(pdf["_run"].iloc[0]), int(t[0]), int(t[to]))] if to < len(t) else []
        return pd.DataFrame(found, columns=[key, "_run", "_at", "_to"])

    chunked = dealt.groupBy(*same, "_c").applyInPandas(links, link_schema)
    jump = written(chunked.unionByName(first.groupBy(*same, "_c").applyInPandas(first_link, link_schema)).distinct(), "burst-links")
    while not jump.isEmpty():  # marks reach twice as far each time
        marks = written(marks.unionByName(joined(marks, jump, "_at").select(*same, F.col("_next").alias("_at"))).distinct(), "burst-marks")
        jump = written(joined(jump, jump, "_to").select(*same, "_at", F.col("_next").alias("_to")), "burst-links")

    entered = marks.groupBy(F.col(key).alias("_bk"), F.col("_run").alias("_br"), floor_to(F.col("_at"), width).alias("_bc")).agg(F.min("_at").alias("_at"))
    chunks = dealt.join(entered, F.col(key).eqNullSafe(F.col("_bk")) & (F.col("_run") == F.col("_br")) & (F.col("_c") == F.col("_bc"))).drop("_bk", "_br", "_bc")
    known = resets.select(F.col(key).alias("_bk"), F.col("_run").alias("_br"), "_reset")
    chunks = chunks.join(known, F.col(key).eqNullSafe(F.col("_bk")) & (F.col("_run") == F.col("_br")), "left").drop("_bk", "_br")

    def windows(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t")
        t, n = pdf["_t"].to_numpy(), np.concatenate([[0], np.cumsum(pdf["_n"].to_numpy())])
        end, reset, out = int(pdf["_c"].iloc[0]) + width, pdf["_reset"].iloc[0], []
        i = int(np.searchsorted(t, int(pdf["_at"].iloc[0])))
        while i < len(t) and t[i] < end:
            j = int(np.searchsorted(t, t[i] + wus, side="right"))
            # only a run's last window can be cancelled, by the reset that ends the run
            cancelled = j == len(t) and not pd.isna(reset) and reset <= t[i] + wus
            if n[j] - n[i] >= min_count and not cancelled:
                out.append((pdf[key].iloc[0], int(t[i]), int(t[j - 1]), int(n[j] - n[i])))
            i = j
        return pd.DataFrame(out, columns=schema.fieldNames())

    return chunks.groupBy(*same, "_c").applyInPandas(windows, schema)


def _burst_scanner(key: str, wus: int, min_count: int, names: list[str]):
    """Greedy anchor scan over batches sorted by (key, run, time, seq).
    Anchors are found with ``searchsorted`` (a loop over anchors, not rows).
    A run continuing into the next batch keeps only the failures of its
    still-open window, so memory is bounded by one window of one key, not
    by the length of a run."""

    def scan_group(kv, t, f, final, out):
        seg, resets = t[f], t[~f]
        final = final or len(resets) > 0          # a reset ends the run's failures
        i = 0
        while i < len(seg):
            j = int(np.searchsorted(seg, seg[i] + wus, side="right"))
            if j == len(seg) and not final:
                return i                           # window may still grow: carry from here
            cancelled = j == len(seg) and len(resets) > 0 and resets[0] <= seg[i] + wus
            if j - i >= min_count and not cancelled:
                out.append((kv, int(seg[i]), int(seg[j - 1]), j - i))
            i = j
        return None

    def frame(out):
        if not out:
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        return pd.DataFrame(out, columns=names)

    def scan(batches):
        carry = None
        for pdf in batches:
            if carry is not None and not carry.empty:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            carry = None
            if pdf.empty:
                continue
            k, r = pdf[key].to_numpy(), pdf["_run"].to_numpy()
            t, f = pdf["_t"].to_numpy(), pdf["_f"].to_numpy(dtype=bool)
            brk = np.flatnonzero((k[1:] != k[:-1]) | (r[1:] != r[:-1])) + 1
            starts, ends = np.r_[0, brk], np.r_[brk, len(t)]
            out = []
            for n, (s0, e0) in enumerate(zip(starts, ends)):
                last = n == len(starts) - 1
                open_at = scan_group(k[s0], t[s0:e0], f[s0:e0], not last, out)
                if last and open_at is not None:
                    fails = pdf.iloc[s0:e0][f[s0:e0]]
                    carry = fails.iloc[open_at:]
            yield frame(out)
        if carry is not None and not carry.empty:
            out = []
            scan_group(carry[key].iloc[0], carry["_t"].to_numpy(), carry["_f"].to_numpy(dtype=bool), True, out)
            yield frame(out)

    return scan

"""Order-dependent window computations that stay balanced under skew.

A per-key ordered window (``lag``, running sums) sends each key to one task; a
key holding a third of all rows would then be sorted by a single task.  So the
rows of each key are counted first (one row per key and task is shuffled).  If no
key has more than ``HEAVY_ROWS`` rows, the window runs per key: one exchange.
Otherwise the heavy keys, and only they, are split in chunks of a numeric leading
order column (``chunk_col``; a sequence number or an event time in microseconds);
the window runs inside each (key, chunk), and a summary of the heavy keys' chunks
(a partial, skew-safe aggregate, with a window over chunks only) carries values
across chunk borders, joined back on (key, chunk).  Without a key the whole order
is split.  Results are exact, whatever the chunk and the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import floor_to
from ..session import written

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


# Rows of one key that one task may order.
HEAVY_ROWS = 1 << 20


def heavy_rows() -> int:
    return HEAVY_ROWS


def _chunked(df: DataFrame, parts: list, chunk_col: str, chunk: int) -> tuple[DataFrame, bool]:
    """``df`` with the chunk ``_ck`` of each row (one chunk for a light key) and
    ``_heavy``; and whether any key is heavy (then its chunks need repair)."""
    if not parts:
        return df.withColumns({"_ck": floor_to(F.col(chunk_col), chunk), "_heavy": F.lit(True)}), True
    counts = df.groupBy(*[_col(p).alias(f"_h{i}") for i, p in enumerate(parts)]).agg(F.count(F.lit(1)).alias("_hn"))
    heavy = counts.where(F.col("_hn") > HEAVY_ROWS)
    n = heavy.count()
    if not n:
        return df.withColumns({"_ck": F.lit(0), "_heavy": F.lit(False)}), False
    # few rows: at most one for each HEAVY_ROWS rows of input
    side = F.broadcast(heavy) if n <= 10_000 else heavy
    same = [_col(p).eqNullSafe(F.col(f"_h{i}")) for i, p in enumerate(parts)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    marked = df.join(side, on, "left").withColumn("_heavy", F.col("_hn").isNotNull())
    marked = marked.withColumn("_ck", F.when(F.col("_heavy"), floor_to(F.col(chunk_col), chunk)).otherwise(F.lit(0)))
    return marked.drop("_hn", *[f"_h{i}" for i in range(len(parts))]), True


def _with_chunks(local: DataFrame, chunks: DataFrame, parts: list) -> DataFrame:
    """``local`` left-joined to the table of chunks (keys may be null)."""
    named = chunks.select(*[_col(p).alias(f"_c{i}") for i, p in enumerate(parts)],
                          *[F.col(c).alias("_cc" if c == "_ck" else c) for c in chunks.columns if c not in parts])
    on = F.col("_ck") == F.col("_cc")
    for i, p in enumerate(parts):
        on = on & _col(p).eqNullSafe(F.col(f"_c{i}"))
    return local.join(named, on, "left").drop("_cc", *[f"_c{i}" for i in range(len(parts))])


def running_total(df: DataFrame, part, order, value, out: str, chunk_col: str, chunk: int,
                  agg: str = "sum", exclusive: bool = False, descending: bool = False) -> DataFrame:
    """``agg(value)`` over the rows of each ``part`` group that come before
    (``exclusive``) or up to (inclusive) each row in ``order``; with
    ``descending`` the order is reversed (a suffix aggregate).  ``chunk_col``
    must be the leading column of ``order`` (numeric)."""
    parts, orders = _list(part), _list(order)
    fn = _AGG[agg]
    ords = [(_col(o).desc() if descending else _col(o).asc()) for o in orders]
    val = _col(value)
    with_ck, split = _chunked(df, parts, chunk_col, chunk)
    w = (Window.partitionBy(*parts, "_ck") if split else Window.partitionBy(*parts)).orderBy(*ords)
    frame = w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    local = with_ck.withColumn("_loc", fn(val).over(frame))
    if not split:
        alone = F.coalesce("_loc", F.lit(0)) if agg == "sum" else F.col("_loc")
        return local.withColumn(out, alone).drop("_ck", "_heavy", "_loc")
    totals = with_ck.where("_heavy").groupBy(*parts, "_ck").agg(fn(val).alias("_tot"))
    ck_order = F.col("_ck").desc() if descending else F.col("_ck").asc()
    cw = Window.partitionBy(*parts).orderBy(ck_order).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(*parts, "_ck", fn("_tot").over(cw).alias("_off"))
    joined = _with_chunks(local, offs, parts)
    if agg == "sum":
        res = F.coalesce(F.col("_off"), F.lit(0)) + F.coalesce(F.col("_loc"), F.lit(0))
    elif agg == "max":
        res = F.greatest(F.col("_off"), F.col("_loc"))
    else:
        res = F.least(F.col("_off"), F.col("_loc"))
    return joined.withColumn(out, res).drop("_ck", "_heavy", "_loc", "_off")


# Marks a chunk may be cut at, and cut tables up to which one is broadcast (a row has at most MARKS numbers).
MARKS = 256
CUT_CHUNKS = 1000
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def prefix_max(df: DataFrame, order: str, seq: str, value: str, out: str, chunk: int) -> DataFrame:
    """Adds ``out``: the largest ``value`` of the rows before each row in the order
    (``order``, ``seq``), nulls first; null for the first row.  There is no key, so the
    whole order is cut in a tree of two levels: chunks of ``order`` (a number), and inside a
    chunk of more than ``HEAVY_ROWS`` rows leaves of about that many, cut at quantiles
    of ``order``; a single value that fills a leaf is cut further by blocks of ``seq`` (an
    integer).  A leaf holds a few times ``HEAVY_ROWS`` rows, or 1 / ``MARKS`` of its
    chunk if that is more; take a finer ``chunk`` then.

    One aggregate (a row per chunk and task is shuffled) gives each chunk's rows and largest value;
    it is written, since it is read for the heavy chunks and for the maxima before
    each chunk.  ``df`` itself is then shuffled once, by leaf."""
    # no leaf key is null: the join with the maxima then keeps the shuffle of the window
    rows = df.withColumn("_ck", F.coalesce(floor_to(F.col(order).cast("long"), chunk), F.lit(_FIRST)))
    chunks = written(rows.groupBy("_ck").agg(F.max(value).alias("_top"), F.count(F.lit(1)).alias("_n")), "prefix-chunks")
    # one row per chunk, whatever the number of rows in it
    before = Window.orderBy("_ck").rowsBetween(Window.unboundedPreceding, -1)
    offs = chunks.select("_ck", F.max("_top").over(before).alias("_off"))
    leaf = ["_ck"]
    heavy = chunks.where(F.col("_n") > HEAVY_ROWS)
    if not heavy.isEmpty():
        # quantiles are approximate: written, so that all uses cut at the same places
        rows = _leaves(rows, written(_cuts(rows, heavy, order), "prefix-cuts"), order, seq)
        leaf = ["_ck", "_sub", "_tie"]
        inside = Window.partitionBy("_ck").orderBy("_sub", "_tie").rowsBetween(Window.unboundedPreceding, -1)
        tops = rows.groupBy(*leaf).agg(F.max(value).alias("_top"))
        tops = tops.select(*leaf, F.max("_top").over(inside).alias("_in"))
        offs = tops.join(offs, "_ck").select(*leaf, F.greatest("_off", "_in").alias("_off"))
    within = Window.partitionBy(*leaf).orderBy(order, seq).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_loc", F.max(value).over(within))
    return local.join(offs, leaf, "left").withColumn(out, F.greatest("_off", "_loc")).drop(*leaf, "_loc", "_off")


def _place(order: str) -> Column:
    return F.coalesce(F.col(order).cast("long"), F.lit(_FIRST))


def _cuts(rows: DataFrame, heavy: DataFrame, order: str) -> DataFrame:
    """_ck, _cuts (first values of the leaves after the first), _hot (those that fill a leaf alone) of heavy chunks."""
    inside = rows.select("_ck", _place(order).alias("_at")).join(heavy.select("_ck", "_n"), "_ck")
    marks = inside.groupBy("_ck").agg(
        F.percentile_approx("_at", [i / MARKS for i in range(1, MARKS)], F.lit(10_000)).alias("_q"), F.max("_n").alias("_n"))
    every = F.greatest(F.lit(1), F.floor(F.lit(MARKS * HEAVY_ROWS) / F.col("_n"))).cast("int")
    kept = marks.select("_ck", F.filter("_q", lambda c, i: (i + 1) % every == 0).alias("_q"))
    return kept.select("_ck", F.array_distinct("_q").alias("_cuts"),
                       F.array_distinct(F.filter("_q", lambda c, i: F.get("_q", i - 1) == c)).alias("_hot"))


def _leaves(rows: DataFrame, cuts: DataFrame, order: str, seq: str) -> DataFrame:
    """``rows`` with the leaf (_ck, _sub, _tie) of each; leaves sort as their rows do."""
    side = F.broadcast(cuts) if cuts.count() <= CUT_CHUNKS else cuts
    at = _place(order)
    sub = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c <= at)))
    tie = F.lit(_LAST)
    if isinstance(rows.schema[seq].dataType, T.IntegralType):
        tie = F.when(F.array_contains("_hot", at), F.coalesce(floor_to(F.col(seq).cast("long"), HEAVY_ROWS), F.lit(_FIRST))).otherwise(tie)
    return rows.join(side, "_ck", "left").withColumns({"_sub": sub, "_tie": tie}).drop("_cuts", "_hot")


def neighbour(df: DataFrame, part, order, cols, chunk_col: str, chunk: int,
              prefix: str = "prev_", direction: str = "lag") -> DataFrame:
    """Adds ``prefix + c`` = value of ``c`` in the previous (``lag``) or next
    (``lead``) row of the same ``part`` group in ``order`` - exact ``lag`` /
    ``lead``, chunk by chunk for heavy keys.  The row a neighbouring chunk needs
    comes from a partial aggregate (one row per heavy key and chunk leaves each
    map task)."""
    parts, orders, cs = _list(part), _list(order), _list(cols)
    with_ck, split = _chunked(df, parts, chunk_col, chunk)
    w = (Window.partitionBy(*parts, "_ck") if split else Window.partitionBy(*parts)).orderBy(*[_col(o) for o in orders])
    shift = F.lag if direction == "lag" else F.lead
    if not split:
        return with_ck.withColumns({prefix + c: shift(F.col(c)).over(w) for c in cs}).drop("_ck", "_heavy")
    local = with_ck.withColumn("_edge", shift(F.lit(1)).over(w).isNull())
    for c in cs:
        local = local.withColumn(prefix + c, shift(F.col(c)).over(w))
    ordkey = F.struct(*[_col(o) for o in orders])
    payload = F.struct(*[F.col(c) for c in cs])
    pick = F.max_by if direction == "lag" else F.min_by
    ends = with_ck.where("_heavy").groupBy(*parts, "_ck").agg(pick(payload, ordkey).alias("_end"))
    cw = Window.partitionBy(*parts).orderBy("_ck")
    across = ends.select(*parts, "_ck", shift("_end").over(cw).alias("_nb"))
    joined = _with_chunks(local, across, parts)
    for c in cs:
        joined = joined.withColumn(prefix + c, F.when(F.col("_edge"), F.col("_nb")[c]).otherwise(F.col(prefix + c)))
    return joined.drop("_ck", "_heavy", "_edge", "_nb")


def sessionize(df: DataFrame, part, order, cols, starts, chunk_col: str, chunk: int,
               out: str = "session", flag: str = "is_start") -> DataFrame:
    """Sessions of each group, see :func:`sessionize_split`."""
    return sessionize_split(df, part, order, cols, starts, chunk_col, chunk, out, flag)[0]


def sessionize_split(df: DataFrame, part, order, cols, starts, chunk_col: str, chunk: int,
                     out: str = "session", flag: str = "is_start") -> tuple[DataFrame, bool]:
    """The sessions, and whether any group has more than ``HEAVY_ROWS`` rows.  Gaps and islands in one chunked pass: ``starts(prev, cur)`` says
    whether a row opens a new session given the previous row of its group
    (``prev[c]`` is null for a group's first row); ``out`` numbers the
    sessions 1, 2, ... per group in ``order`` (0 before the first start).

    For light keys that is one window.  For heavy ones a window per (key, chunk) yields the local previous row and the local
    count of starts; the per-chunk summary (first row, last row, inner
    starts) is aggregated on that window's own partitioning, so it costs no
    extra shuffle; a window over chunks repairs each chunk's first row and
    gives the offsets, joined back on (key, chunk)."""
    parts, orders, cs = _list(part), _list(order), _list(cols)
    with_ck, split = _chunked(df, parts, chunk_col, chunk)
    w = (Window.partitionBy(*parts, "_ck") if split else Window.partitionBy(*parts)).orderBy(*[_col(o) for o in orders])
    prev = {c: F.lag(F.col(c)).over(w) for c in cs}
    cur = {c: F.col(c) for c in cs}
    if not split:
        opened = with_ck.withColumn(flag, F.coalesce(starts(prev, cur), F.lit(False)))
        number = F.sum(F.col(flag).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return opened.withColumn(out, number).select(*[c for c in df.columns], out, flag), False
    local = (with_ck.withColumn("_edge", F.lag(F.lit(1)).over(w).isNull())
                    .withColumn("_ls", F.coalesce(starts(prev, cur), F.lit(False)))
                    .withColumn("_inner", F.when(F.col("_edge"), F.lit(0)).otherwise(F.col("_ls").cast("long"))))
    local = local.withColumn("_lc", F.sum("_inner").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ordkey = F.struct(*[_col(o) for o in orders])
    payload = F.struct(*[F.col(c) for c in cs])
    summary = local.where("_heavy").groupBy(*parts, "_ck").agg(F.min_by(payload, ordkey).alias("_first"),
                                                F.max_by(payload, ordkey).alias("_last"),
                                                F.sum("_inner").alias("_n"))
    cw = Window.partitionBy(*parts).orderBy("_ck")
    pl = F.lag("_last").over(cw)
    first_start = F.coalesce(starts({c: pl[c] for c in cs}, {c: F.col("_first")[c] for c in cs}), F.lit(False))
    chunks = (summary.withColumn("_fs", first_start.cast("long"))
                     .withColumn("_tot", F.col("_n") + F.col("_fs"))
                     .withColumn("_off", F.coalesce(F.sum("_tot").over(cw.rowsBetween(Window.unboundedPreceding, -1)),
                                                    F.lit(0)))
                     .select(*parts, "_ck", "_fs", "_off"))
    joined = _with_chunks(local, chunks, parts)
    # a light key is one chunk: its first row's start is its own
    first = F.coalesce(F.col("_fs"), (F.col("_edge") & F.col("_ls")).cast("long"), F.lit(0))
    light = F.sum(F.col("_ls").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    joined = joined.withColumn("_light", light)
    return (joined.withColumn(out, F.when(F.col("_heavy"), F.col("_off") + F.col("_fs") + F.col("_lc")).otherwise(F.col("_light")))
                  .withColumn(flag, F.when(F.col("_edge"), first == 1).otherwise(F.col("_ls")))
                  .drop("_ck", "_heavy", "_light", "_edge", "_ls", "_inner", "_lc", "_fs", "_off")), True

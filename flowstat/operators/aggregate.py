"""User-defined window aggregates: create, add, merge, result.

An :class:`Aggregate` says how an accumulator begins, takes up rows, joins another one and ends.
``aggregate_windows`` runs it per key and tumbling or sliding window:

1. map side, each task takes up its rows per (keys, pane) in Arrow batches and puts out one
   accumulator for each (keys, pane) that it met - the partial aggregation that a hot key or
   a window without keys needs;
2. accumulators, not rows, are copied to the windows that see their pane, and shuffled once by
   (keys, window);
3. the final step joins a window's accumulators, at most one for each task and pane, as a
   sorted Arrow stream that holds one of them, and puts out its result.

An accumulator is a tuple whose fields have SQL types (``state``), so it is shuffled as plain
columns; nothing is pickled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import duration_us, floor_to, from_micros, to_micros, ts_type


class Aggregate(NamedTuple):
    """``state`` and ``result_type`` are SQL types (a struct's fields, a type).

    ``add`` gets the accumulator and the rows of one group (a pandas frame of the columns asked
    for) and may get them in any number of pieces and any order; ``merge`` must be associative and commutative."""

    state: str
    result_type: str
    create: Callable[[], tuple]
    add: Callable[[tuple, pd.DataFrame], tuple]
    merge: Callable[[tuple, tuple], tuple]
    result: Callable[[tuple], Any]


def count_rows() -> Aggregate:
    return Aggregate("n bigint", "bigint", lambda: (0,), lambda a, rows: (a[0] + len(rows),), lambda a, b: (a[0] + b[0],), lambda a: a[0])


def mean_of(column: str) -> Aggregate:
    """Mean of the values that are not null; null without any."""
    def add(a, rows):
        v = rows[column].dropna()
        return a[0] + float(v.sum()), a[1] + len(v)

    return Aggregate("total double, n bigint", "double", lambda: (0.0, 0), add, lambda a, b: (a[0] + b[0], a[1] + b[1]),
                     lambda a: a[0] / a[1] if a[1] else None)


def _python(x):
    return x.item() if hasattr(x, "item") else x


def aggregate_windows(df: DataFrame, ts: str, keys, agg: Aggregate, columns=(), size="1 hour", slide=None,
                      out: str = "value", end_col: str = "window_end", most_groups: int = 50_000) -> DataFrame:
    """keys, window end and ``out`` of every window with rows.  A task holds at most
    ``most_groups`` accumulators; beyond that it puts out what it has and goes on.  Rows without an event time
    belong to no window; null keys are a group."""
    ks = [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else size_us
    pane = math.gcd(size_us, slide_us)
    dtype, names = ts_type(df, ts), [*ks, "w_pane"]
    state = T._parse_datatype_string(agg.state)
    key_fields = [T.StructField(k, df.schema[k].dataType) for k in ks]
    fields = [f"w_s{i}" for i in range(len(state.fields))]
    shuffled = [T.StructField(n, f.dataType) for n, f in zip(fields, state.fields)]
    rows = df.where(F.col(ts).isNotNull()).select(*ks, floor_to(to_micros(ts, dtype), pane).alias("w_pane"),
                                                  *[c for c in dict.fromkeys(columns) if c not in ks])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}

        def frame() -> pd.DataFrame:
            return pd.DataFrame([(*k, *a) for k, a in held.items()], columns=[*names, *fields]).astype({f: object for f in [*ks, *fields]})

        for batch in batches:
            for k, part in batch.groupby(names, sort=False, dropna=False):
                k = tuple(None if pd.isna(x) else _python(x) for x in k)
                held[k] = agg.add(held.get(k) or agg.create(), part)
            if len(held) >= most_groups:
                yield frame()
                held = {}
        if held:
            yield frame()

    parts = rows.mapInPandas(partial, T.StructType([*key_fields, T.StructField("w_pane", T.LongType()), *shuffled]))
    first = floor_to(F.col("w_pane") + pane - size_us + slide_us - 1, slide_us) + size_us
    last = floor_to(F.col("w_pane"), slide_us) + size_us
    ends = F.explode(F.when(first <= last, F.sequence(first, last, F.lit(slide_us)))) if slide_us != size_us else F.col("w_pane") + size_us
    dealt = parts.select(*ks, ends.alias("w_end"), *fields)

    schema = T.StructType([*key_fields, T.StructField("w_end", T.LongType()), T.StructField(out, T._parse_datatype_string(agg.result_type))])
    shape = to_arrow_schema(schema)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, whole, done = None, None, []
        for batch in batches:  # sorted: the accumulators of a window follow each other, one is held
            columns = [c.to_pylist() for c in batch.columns]
            for key, acc in zip(zip(*columns[:len(ks) + 1]), zip(*columns[len(ks) + 1:])):
                if key != now:
                    if now is not None:
                        done.append((*now, agg.result(whole)))
                    now, whole = key, agg.create()
                whole = agg.merge(whole, acc)
            if done:
                yield _batch(done, shape)
                done = []
        if now is not None:
            yield _batch([(*now, agg.result(whole))], shape)

    done = dealt.select(*ks, "w_end", *fields).repartition(*ks, "w_end").sortWithinPartitions(*ks, "w_end").mapInArrow(final, schema)
    return done.select(*ks, from_micros("w_end", dtype).alias(end_col), out)


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(shape)], schema=shape)

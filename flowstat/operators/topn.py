"""Top-N per window, its text report, and the change log between rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import from_micros, to_micros


def top_n(df: DataFrame, part, key: str, score: str = "cnt", n: int = 5,
          rank_col: str = "rn") -> DataFrame:
    """Rows ranked by ``score`` desc, ties by ``key`` asc, kept while rank <= n.

    ``row_number() <= n`` lets Catalyst insert a WindowGroupLimit before the
    exchange, so each map task forwards at most n rows per partition value
    instead of every candidate.
    """
    parts = [part] if isinstance(part, str) else list(part)
    w = Window.partitionBy(*parts).orderBy(F.col(score).desc(), F.col(key).asc())
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= n))


def report(ranked: DataFrame, part: str, key: str, score: str = "cnt", rank_col: str = "rn",
           ts_format: str = "yyyy-MM-dd HH:mm:ss", out: str = "report") -> DataFrame:
    """One text line per window of a ranked frame:
    ``window_end=<time> | 1: <key>=<k> <score>=<v> | 2: ...`` (rank order)."""
    entry = F.struct(F.col(rank_col).alias("r"),
                     F.format_string(f"%d: {key}=%s {score}=%d", F.col(rank_col),
                                     F.col(key).cast("string"), F.col(score)).alias("s"))
    return (ranked.groupBy(part)
                  .agg(F.sort_array(F.collect_list(entry)).alias("_l"))
                  .select(part, F.concat(F.lit(f"{part}="), F.date_format(part, ts_format), F.lit(" | "),
                                         F.array_join(F.transform("_l", lambda x: x["s"]), " | ")).alias(out)))


def changelog(prev: DataFrame, cur: DataFrame, keys, op_col: str = "op") -> DataFrame:
    """Rows of ``cur`` not in ``prev`` as '+', rows of ``prev`` not in ``cur``
    as '-' (a retract stream between two snapshots, multiset semantics on
    ``keys``).  One union and one aggregate (a single shuffle on the keys,
    map-side combined), never a driver-side diff."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    both = (cur.select(*ks, F.lit(1).alias("_d"))
               .unionByName(prev.select(*ks, F.lit(-1).alias("_d"))))
    net = both.groupBy(*ks).agg(F.sum("_d").alias("_n")).where(F.col("_n") != 0)
    return (net.select(*ks, F.when(F.col("_n") > 0, F.lit("+")).otherwise(F.lit("-")).alias(op_col),
                       F.explode(F.array_repeat(F.lit(1), F.abs(F.col("_n")).cast("int"))).alias("_x"))
               .drop("_x"))


def ranking_changelog(ranked: DataFrame, part: str, key: str, step_us: int,
                      rank_col: str = "rn", op_col: str = "op") -> DataFrame:
    """Change log of a per-window ranking over successive windows: at window
    end ``w`` a key entering the ranking (absent at ``w - step``) is '+', a
    key leaving it is '-'.  Rank changes of a key that stays are '-' then '+'
    of the (key, rank) pair, like a retract stream of a top-N table."""
    dtype = ranked.schema[part].dataType
    later = from_micros(to_micros(part, dtype) + F.lit(step_us), dtype)
    # a ranked row enters at its window and leaves at the next; what stays cancels out
    steps = F.explode(F.array(F.struct(F.col(part).alias("_w"), F.lit(1).alias("_d")), F.struct(later.alias("_w"), F.lit(-1).alias("_d"))))
    net = (ranked.select(key, rank_col, steps.alias("_s")).groupBy(F.col("_s._w").alias(part), key, rank_col)
           .agg(F.sum("_s._d").alias("_n")).where("_n <> 0"))
    return net.select(part, key, rank_col, F.when(F.col("_n") > 0, "+").otherwise("-").alias(op_col))

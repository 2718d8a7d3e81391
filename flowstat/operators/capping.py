"""Click cap with a blacklist side output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import local_day, ts_type
from .ordered import running_total

# ---------------------------------------------------------------- fixed values
BLACKLIST_WARNING = "abnormal click"
# ------------------------------------------------------------------------------


def cap_and_flag(df: DataFrame, keys, ts: str, seq: str, limit: int = 100, zone: str = "UTC",
                 day_col: str = "day", msg: str = BLACKLIST_WARNING,
                 chunk: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Per (keys, calendar day in ``zone``) in arrival order: the first
    ``limit`` clicks pass; click ``limit + 1`` emits one warning; it and all
    later clicks of that day are dropped.  The click number is a running
    count split into ``seq`` chunks, so one hot (user, ad) pair does not
    land in one task.  -> (passed rows, warnings)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    dayed = df.withColumn(day_col, local_day(ts, zone, ts_type(df, ts)))
    numbered = running_total(dayed, part=[*ks, day_col], order=[seq], value=F.lit(1), out="_n",
                             chunk_col=seq, chunk=chunk)
    passed = numbered.where(F.col("_n") <= limit).drop("_n")
    warned = numbered.where(F.col("_n") == limit + 1).select(*ks, day_col, seq, F.lit(msg).alias("warning"))
    return passed, warned

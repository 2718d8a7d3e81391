"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def shared(spark: SparkSession, name: str) -> str:
    """The folder ``name`` under the shared folder that ``spark.checkpoint.dir`` names
    (a folder of its own where the setting is unset, as in local tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm/{name}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder in the shared folder."""
    return shared(spark, f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later
    stages restart from the files, whichever executors are lost."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and \\x09-\\x0D."""
    return F.regexp_count(text, F.lit("[^ \\x09-\\x0D]+"))


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until it is none of the columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def hash_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most ``rows`` rows, about that many (all of a smaller ``df``), chosen by a hash of ``key``.

    Rows of equal key are chosen together; a key too frequent for what is left of the
    sample is passed over, so the bound holds.  No task sorts or reads the
    candidates of all others; the same rows are chosen whatever the partitions."""
    n = df.count()
    if n <= rows:
        return df
    parts, bins = 1 << 40, 4096
    h = F.xxhash64(*key)
    some = df.where(F.pmod(h, F.lit(parts)) < int(parts * min(1.0, 2 * rows / n)))
    at = F.pmod(F.shiftrightunsigned(h, 40), F.lit(bins))
    taken, left = [], rows
    # ``bins`` rows at most
    for value, count in sorted(map(tuple, some.groupBy(at.alias("at")).count().collect())):
        if count <= left:
            taken.append(value)
            left -= count
    return some.where(at.isin(taken)) if taken else some.limit(0)

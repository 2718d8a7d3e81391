"""Shuffled sharding by a Feistel permutation with cycle walking, in DataFrame functions only.

Every row gets a global row number 0..n-1: rows are ordered by a hash of id and
text, dealt over ``buckets`` hash ranges, numbered inside each range by one
window and offset by the counts of the ranges before (a table of ``buckets``
rows).  A Feistel network over Z_a x Z_b with a * b >= n permutes the numbers;
results of n or more are walked on along their cycle.  A walk passes through
distinct numbers outside the range only, of which there are a * b - n, so that
many steps always end it; a is searched to keep this rest small.

Position p of the permutation goes to shard p mod shards, slot p div shards:
counts are at most one apart (law ``rows``) and both follow from the row number
alone.  The same rows and seed give the same result whatever the partitions.

Cases.  Null text has size 1 and crc32 0.  Null ids hash as the empty string.
Repeated rows are separate rows.  Very long texts are only measured and hashed.  Empty
tables give an empty result.  Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, whole


def domain(n: int, tries: int = 2000) -> tuple[int, int]:
    """a, b near the root of n with a * b >= n and a small rest."""
    root = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return min(((a, -(-n // a)) for a in range(root, root + min(tries, root))), key=lambda x: (x[0] * x[1], x[0])) if n else (1, 1)


def feistel(number: Column, a: int, b: int, seed: int, rounds: int = 6) -> Column:
    """One pass of the permutation of 0..a*b-1."""
    start = F.struct(F.floor(number / b).cast("long").alias("l"), F.pmod(number, F.lit(b)).alias("r"))
    keys = F.array(*[F.lit(k) for k in range(rounds)])

    def step(s: Column, k: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(F.lit(seed), k, s["r"]), F.lit(a)), F.lit(a))
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(F.lit(seed), k, s["l"]), F.lit(b)), F.lit(b))
        return F.when(k % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), right.alias("r")))

    return F.aggregate(keys, start, step, lambda s: s["l"] * F.lit(b) + s["r"])


def permute(number: Column, n: int, seed: int) -> Column:
    """The permuted place of a row number among 0..n-1."""
    a, b = domain(n)
    rest = a * b - n
    first = feistel(number, a, b, seed)
    if not rest:
        return first
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(rest)), first,
                       lambda x, _: F.when(x < n, x).otherwise(feistel(x, a, b, seed)))
    return walk


def row_numbers(rows: DataFrame, order: list[str], buckets: int = 4096) -> DataFrame:
    """``rows`` with ``row_number`` 0..n-1 in the order of a hash of the columns ``order``."""
    key = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]))
    # the first 13 hex digits as a number, so that ranges of it keep the order of the hash
    high = F.conv(F.substring("rn_key", 1, 13), 16, 10).cast("long")
    keyed = rows.withColumn("rn_key", key).withColumn("rn_bucket", F.floor(high / ((1 << 52) // buckets)).cast("int"))
    counts = keyed.groupBy("rn_bucket").agg(F.count(F.lit(1)).alias("rn_n"))
    before = W.orderBy("rn_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("rn_bucket", F.coalesce(F.sum("rn_n").over(before), F.lit(0)).alias("rn_offset"))
    inside = F.row_number().over(W.partitionBy("rn_bucket").orderBy("rn_key", *order))
    # at most `buckets` rows
    return (keyed.withColumn("rn_inside", inside).join(F.broadcast(offsets), "rn_bucket")
            .withColumn("row_number", F.col("rn_offset") + F.col("rn_inside") - 1)
            .drop("rn_key", "rn_bucket", "rn_inside", "rn_offset"))


def shard(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = whole("text")
    rows = materialize(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                                   F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("th")), "shard-rows")
    n = rows.count()
    place = permute(F.col("row_number"), n, seed)
    return (row_numbers(rows, ["doc_id", "text_crc32", "th"]).withColumn("place", place)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
                    F.floor(F.col("place") / shards).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))

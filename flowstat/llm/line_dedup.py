"""Line deduplication over overlapping windows of three lines, in DataFrame functions only.

A window is three consecutive lines of a text (lines end at ``\\n``).  Windows
are hashed to two 64-bit values, windows that occur more than once anywhere are
found by one aggregate (combined in each task before the shuffle), and every
occurrence but the first one is marked; first is by ``doc_id``, then by the
text's hash, then by position.  The marked windows' positions are merged per
document and the lines they cover are taken out.

Cases.  Null text gives an empty text with no lines.  A text of fewer than
three lines has no window and stays whole.  Windows of three empty lines do
not count.  Rows with equal ``doc_id`` and equal text are one document and get
the same answer.  Null ids come first.  Windows are told apart by their two hashes, 128 bits, and
not compared beyond them.  Very long texts are split whole, a row of the shuffle for each of their
windows; windows that many texts share are joined under Spark's skew handling.  Empty tables give an empty
result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

WIDTH = 3


def _keyed(docs: DataFrame) -> DataFrame:
    text = whole("text")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th"))


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, th, pos, h1, h2: one row for each window."""
    lines = F.split("text", "\n")
    n = F.size("lines")
    at = [F.element_at("lines", F.col("pos") + k) for k in range(1, WIDTH + 1)]
    return (_keyed(docs).select("doc_id", "th", lines.alias("lines")).where(n >= WIDTH)
            .select("doc_id", "th", "lines", F.explode(F.sequence(F.lit(0), n - WIDTH)).alias("pos"))
            .where(F.concat(*at) != "")
            .select("doc_id", "th", "pos", F.xxhash64(*at).alias("h1"), F.xxhash64(F.lit(1), *reversed(at)).alias("h2")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, text (what is left)."""
    found = windows(docs)
    repeated = (found.groupBy("h1", "h2")
                .agg(F.min(F.struct("doc_id", "th", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("h1", "h2", "first"))
    later = (found.join(repeated, ["h1", "h2"])
             .where(~F.struct("doc_id", "th", "pos").eqNullSafe(F.col("first")))
             .groupBy("doc_id", "th").agg(F.collect_set("pos").alias("starts"))
             .select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), "starts"))
    keyed = _keyed(docs)
    lines = F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(F.split("text", "\n"))
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + WIDTH - 1)))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), covered),
                       lambda i: F.element_at("lines", i + 1))
    joined = (keyed.join(later, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left")
              .withColumn("lines", lines)
              .withColumn("left", F.when(F.col("starts").isNull(), F.col("lines")).otherwise(left)))
    return joined.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                         (F.size("lines") - F.size("left")).cast("long").alias("n_removed"),
                         F.array_join("left", "\n").alias("text"))

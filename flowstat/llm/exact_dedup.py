"""Exact deduplication as a stream with disk-backed keyed state.

One streaming aggregate keyed by the text's SHA-256 is the state.  It has no
watermark and so never expires, it lives in RocksDB on the executors' disks
(changelog and snapshots go to the query's checkpoint), and it keeps for each
digest the stable identifier of the row that stays, that row's content locator
(file and row number in it) and the number of rows seen.  Spark combines each
task's rows before the shuffle, so a text held by a third of all rows costs one
row per task.  Every micro-batch writes its changed state rows to a folder of
its epoch; a batch that is run again overwrites the same folder.

A digest hit is a candidate only.  The rows of digests seen more than once are
compared byte by byte with the content that the locator points to; hits whose
bytes differ (a digest collision) are grouped anew by their whole text.

Cases.  Null text counts as empty.  Null ``doc_id`` sorts below every number,
so it stays only if the whole group has null ids (``keep_id`` is then null).
Repeated rows form a group; of rows with the same largest id the last by
locator stays, so exactly one row per group has ``kept``.  Empty tables give
an empty result.  Very long texts are hashed and compared whole; joins on a digest that
many rows share are split by Spark's skew handling.  Other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, scratch, shared, whole

# State on disk.  Files are not preallocated (a store for each partition would
# hold megabytes of air), and a batch uploads its changes instead of all files.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(df: DataFrame, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    locator = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return df.select("doc_id", locator.alias("loc"), digest(whole("text")).alias("digest"), *more)


def run_stream(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256,
               name: str | None = None, **source_options) -> DataFrame:
    """Drain the Parquet files at ``path`` through the keyed state and return its
    rows: digest, keep_id, keep_loc, n.

    ``source_options`` go to the file source (``maxFilesPerTrigger``,
    ``maxBytesPerTrigger``); the state is kept across the micro-batches.  With a
    ``name`` it is kept across calls as well, in a folder of that name in the shared
    folder: the next call with the same name, path and digest reads new files only.
    """
    folder = shared(spark, f"dedup-{name}") if name else scratch(spark, "dedup")
    out, checkpoint = f"{folder}/state", f"{folder}/stream"
    pattern = path.rstrip("/")
    if pattern[-1].isalnum():
        # a pattern instead of a plain path: the source then takes a single file as well as a folder
        pattern = pattern[:-1] + f"[{pattern[-1]}]"
    reader = spark.readStream.schema("doc_id long, text string").options(**source_options)
    state = (_rows(reader.parquet(pattern), digest)
             .groupBy("digest").agg(F.max(F.struct("doc_id", "loc")).alias("top"), F.count(F.lit(1)).alias("n"))
             .select("digest", F.col("top.doc_id").alias("keep_id"), F.col("top.loc").alias("keep_loc"), "n"))

    def write_epoch(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        (state.writeStream.outputMode("update").foreachBatch(write_epoch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = spark.createDataFrame([], state.schema).schema
    if not _exists(spark, out):
        return spark.createDataFrame([], schema)
    epochs = spark.read.schema(schema).parquet(out)  # and the epoch, which is not used
    # the state only grows: a digest's last row is the one with the highest count
    return (epochs.groupBy("digest").agg(F.max_by(F.struct("keep_id", "keep_loc", "n"), "n").alias("s"))
            .select("digest", "s.keep_id", "s.keep_loc", "s.n"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def unequal_hits(docs: DataFrame, state: DataFrame, digest: Callable[[Column], Column] = sha256,
                 rows_per_salt: int = 2000) -> DataFrame:
    """Compare every hit's bytes with the kept row's content.

    Returns (digest, loc, text) of the rows of digests under which at least
    one hit has other bytes; empty unless the digest collides.  Large groups
    are salted by their known size.
    """
    repeated = state.where("n > 1").select("digest", "keep_loc", "n")
    grouped = materialize(_rows(docs, digest, whole("text").alias("text")).join(repeated, "digest"), "dedup-hits")
    salts = F.ceil(F.col("n") / rows_per_salt).cast("int")
    is_keeper = F.col("loc") == F.col("keep_loc")
    kept = (grouped.where(is_keeper)
            .select("digest", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("text").alias("kept_text")))
    hits = grouped.where(~is_keeper).select(
        "digest", F.pmod(F.xxhash64("loc"), salts).cast("int").alias("salt"), "text")
    bad = hits.join(kept, ["digest", "salt"]).where("text <> kept_text").select("digest").distinct()
    return grouped.join(materialize(bad, "dedup-collisions"), "digest", "left_semi").select("digest", "doc_id", "loc", "text")


def exact_dedup(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256,
                name: str | None = None, **source_options) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, keep_id,
    group_size, kept, text_sha256.  With a ``name`` (see :func:`run_stream`) the files of
    earlier calls must still be in the table, which may have grown."""
    docs = spark.read.schema("doc_id long, text string").parquet(path)
    state = materialize(run_stream(spark, path, digest, name, **source_options), "dedup-final")
    rows = _rows(docs, digest, sha256(whole("text")).alias("text_sha256")).join(state, "digest", "left")
    unequal = unequal_hits(docs, state, digest)
    if not unequal.isEmpty():
        regrouped = unequal.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "loc")).alias("top"), F.count(F.lit(1)).alias("m"))
        fixed = unequal.join(regrouped, ["digest", "text"]).select("loc", "top", "m")
        rows = (rows.join(fixed, "loc", "left")
                .withColumns({"keep_id": F.when(F.col("m").isNull(), F.col("keep_id")).otherwise(F.col("top.doc_id")),
                              "keep_loc": F.coalesce("top.loc", "keep_loc"), "n": F.coalesce("m", "n")}))
    return rows.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                       (F.col("loc") == F.col("keep_loc")).alias("kept"), "text_sha256")

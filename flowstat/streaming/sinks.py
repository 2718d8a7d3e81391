"""Labelled stream sinks.  Checkpoints live under ``spark.checkpoint.dir``, in
a folder named by the query and by what identifies its input, so a restarted
driver finds them again and two runs over different inputs do not share one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir


def checkpoint_location(spark: SparkSession, name: str, identity: str = "") -> str:
    """The same folder for the same name and identity (the job's inputs and
    parameters, as text), in every session of this configuration."""
    tag = f"-{hashlib.sha256(identity.encode()).hexdigest()[:16]}" if identity else ""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}{tag}"


def write_stream(df: DataFrame, name: str, fmt: str = "console", mode: str = "append",
                 trigger: dict | None = None, path: str | None = None,
                 foreach_batch: Callable[[DataFrame, int], None] | None = None,
                 options: dict | None = None, identity: str = "") -> StreamingQuery:
    """Start ``df`` as a named streaming query.

    fmt: ``console`` (the labelled print of the original jobs, every row of
    each batch unless the option ``numRows`` asks for a preview), ``memory`` (a
    table named ``name``, for tests), ``parquet``/``json``/``kafka`` (``path`` /
    options), or ``foreach_batch`` with a callback.  ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (e.g. ``{"processingTime": "1 second"}``
    replaces the jobs' output throttling by sleep).  ``identity`` names the
    input, see :func:`checkpoint_location`."""
    options = dict(options or {})
    w = df.writeStream.queryName(name).outputMode(mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif fmt == "console":
        w = w.foreachBatch(print_batch(name, options.pop("numRows", None)))
    else:
        w = w.format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    if fmt != "memory":
        w = w.option("checkpointLocation", checkpoint_location(df.sparkSession, name, identity))
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()


def print_batch(label: str, preview_rows: int | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback printing each batch, row by row as they arrive
    from the executors (never the whole batch in the driver); all rows, or the
    first ``preview_rows`` and how many there were."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        print(f"== {label} (batch {epoch_id})\n{' | '.join(batch.columns)}")
        batch.persist()
        try:
            batch.count()  # one job over all partitions, so that all state is committed
            print_rows(batch, preview_rows)
        finally:
            batch.unpersist()
    return run


def print_rows(df: DataFrame, preview_rows: int | None = None) -> None:
    n = 0
    for row in df.toLocalIterator():
        if preview_rows is None or n < preview_rows:
            print(" | ".join(map(str, row)))
        n += 1
    if preview_rows is not None and n > preview_rows:
        print(f"... a preview: {preview_rows} of {n} rows")


def epoch_folder(folder: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback writing every row of a batch to ``folder``, one
    partition for each epoch; a batch that is run again replaces its own."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("epoch", F.lit(epoch_id)).write.format(fmt).mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").save(folder))
    return run


def fan_out_per_batch(channel_col: str, targets: dict, fmt: str = "parquet"):
    """``foreachBatch`` callback splitting one tagged stream (main output and
    side outputs in a ``channel`` column) into one table per channel.

    ``targets`` maps a channel value to a folder (or to a callable taking
    ``(df, epoch_id)``).  The batch is cached once for the several writes;
    folders are written partitioned by epoch with dynamic overwrite, so a
    micro-batch replayed after a failure replaces its own rows instead of
    duplicating them."""
    def run(batch: DataFrame, epoch_id: int):
        batch.persist()
        try:
            for channel, target in targets.items():
                part = batch.where(F.col(channel_col) == channel).drop(channel_col)
                (target if callable(target) else epoch_folder(target, fmt))(part, epoch_id)
        finally:
            batch.unpersist()
    return run

"""Small tables that a ``foreachBatch`` callback carries from micro-batch to micro-batch.

Each epoch writes the whole table to a folder of its own and reads that of the latest earlier
epoch, so a micro-batch that is run again gives the same result.  Older folders are
deleted: two are left however long the stream runs.  What no longer matters must be left out of the
table by the caller (windows that the watermark has passed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """The table's folders under ``path`` (in the shared checkpoint location)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files = self.folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def epochs(self) -> list[int]:
        """Epochs whose table is complete."""
        if not self.files.exists(self.folder):
            return []
        named = [s.getPath() for s in self.files.listStatus(self.folder) if s.getPath().getName().startswith("epoch=")]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(p.getName()[6:]) for p in named if self.files.exists(done(p, "_SUCCESS")))

    def before(self, epoch: int) -> DataFrame | None:
        """The table as it was before ``epoch``; None at the beginning."""
        earlier = [e for e in self.epochs() if e < epoch]
        return self.spark.read.parquet(f"{self.path}/epoch={earlier[-1]}") if earlier else None

    def write(self, table: DataFrame, epoch: int) -> None:
        """The table as it is after ``epoch``; earlier ones than the last before it go."""
        table.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        done = self.epochs()
        earlier = [e for e in done if e < epoch]
        for e in earlier[:-1]:
            self.files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/epoch={e}"), True)

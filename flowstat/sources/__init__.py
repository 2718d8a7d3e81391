"""Sources: typed CSV logs, the space-separated access log, line streams
(file / socket / Kafka), and the replay of a file into a topic."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ACCESS_LOG_TIME_FORMAT, epoch_to_ts, to_micros
from ..schemas import RECORDS


def _typed(df: DataFrame, unit: str) -> DataFrame:
    return df.withColumn("ts", epoch_to_ts("timestamp", unit))


def parse_uri(path: str) -> tuple[str, dict]:
    """``socket://host:port`` -> ("socket", {host, port});
    ``kafka://server1,server2/topic`` -> ("kafka", {servers, topic});
    anything else -> ("file", {path})."""
    if path.startswith("socket://"):
        host, _, port = path[len("socket://"):].rpartition(":")
        return "socket", {"host": host, "port": int(port)}
    if path.startswith("kafka://"):
        servers, _, topic = path[len("kafka://"):].partition("/")
        return "kafka", {"servers": servers, "topic": topic}
    return "file", {"path": path}


def _stream_lines(spark: SparkSession, path: str) -> DataFrame | None:
    kind, args = parse_uri(path)
    if kind == "socket":
        return socket_lines(spark, args["host"], args["port"])
    if kind == "kafka":
        return kafka_lines(spark, args["servers"], args["topic"])
    return None


def read_records(spark: SparkSession, path: str, kind: str, stream: bool = False,
                 mode: str = "FAILFAST", with_seq: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """A headerless CSV log of record ``kind`` (see ``schemas.RECORDS``) with
    an explicit schema -> typed columns + ``ts`` (event time) + ``seq``.

    ``mode='FAILFAST'`` stops on a malformed line like the original jobs;
    ``'PERMISSIVE'`` nulls bad fields instead and, with ``corrupt_col``,
    keeps the raw text of a malformed line in that column.  An empty (unquoted) field
    reads as null, so the empty tx id of a create row can never join.
    ``seq`` is the arrival order of a batch: files by name, lines by place.  Streams carry
    ``arrival``, a string that sorts as the rows of a micro-batch arrived (see :func:`stream_arrival`; from
    Kafka the broker's time, partition and offset).  With ``stream=True`` the path may be
    ``socket://host:port`` or ``kafka://servers/topic`` (one record per
    message).
    """
    lines = _stream_lines(spark, path) if stream else None
    if lines is not None:                      # socket / Kafka: one CSV record per message
        parsed = parse_csv_lines(lines, kind, mode=mode, corrupt_col=corrupt_col)
        if with_seq and "offset" in parsed.columns:
            # one partition's rows are in the order of their offsets; those of several partitions in the order of the broker's times
            place = [F.lpad(c.cast("string"), 19, "0") for c in (F.unix_micros("timestamp"), F.col("partition"), F.col("offset"))]
            parsed = parsed.withColumns({"seq": F.col("offset"), "arrival": F.concat_ws("|", *place)})
        return parsed
    schema, unit = RECORDS[kind]
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    reader = (spark.readStream if stream else spark.read).schema(schema).option("mode", mode)
    if corrupt_col:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    df = reader.csv(path)
    if with_seq:
        df = stream_arrival(df) if stream else arrival_order(df)
    return _typed(df, unit)


def stream_arrival(df: DataFrame, out: str = "arrival") -> DataFrame:
    """Lines of a file stream with ``out``, a string that sorts as the lines arrived: files by
    modification time, then path (as the file source takes them up), splits by their place
    in the file, lines by their place in the split.  Keyed state sees one micro-batch after the other, so
    ordering the rows of each micro-batch by it orders a key's rows across the whole stream.

    A split is read by one task from its beginning on, so a count of the task's lines tells their
    order (Spark has no row number for text files, nor a growing id on streams)."""
    def number(c: Column | str, width: int = 19) -> Column:
        return F.lpad((F.col(c) if isinstance(c, str) else c).cast("string"), width, "0")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            place = pa.array(range(n, n + batch.num_rows), pa.int64())
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[*batch.schema.names, "line_place"])

    meta = F.col("_metadata")
    split = F.concat_ws("|", number(F.unix_micros(meta["file_modification_time"])), meta["file_path"], number(meta["file_block_start"]))
    lines = df.select("*", split.alias("line_split"))
    numbered = lines.mapInArrow(counted, T.StructType([*lines.schema.fields, T.StructField("line_place", T.LongType())]))
    return numbered.withColumn(out, F.concat_ws("|", "line_split", number("line_place"))).drop("line_split", "line_place")


def arrival_order(df: DataFrame, out: str = "seq") -> DataFrame:
    """Lines of a batch file read with ``out``, increasing by file path, then by
    place in the file.  Spark deals the files' splits over tasks in an order of its
    own; inside a split lines are read in order.  The splits (a row for each) are
    ranked, and a line's number is its split's rank above its number in the task."""
    split = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    lines = df.select("*", *[c.alias(k) for k, c in split.items()], F.monotonically_increasing_id().alias("_id"))
    splits = df.select(*[c.alias(k) for k, c in split.items()]).distinct()
    ranked = splits.withColumn("_rank", F.row_number().over(W.orderBy("_file", "_block")) - 1)
    number = F.shiftleft(F.col("_rank").cast("long"), 33) + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.join(ranked, ["_file", "_block"]).withColumn(out, number).drop("_file", "_block", "_id", "_rank")


def parse_access_log(lines: DataFrame, value_col: str = "value", zone: str = "UTC",
                     time_format: str = ACCESS_LOG_TIME_FORMAT, keep: list[str] | None = None) -> DataFrame:
    """Space-separated access-log lines -> ip, user_id, ts, method, url
    (fields 0, 1, 3, 5, 6) and the columns ``keep`` of the input.  The time is a wall clock in ``zone``; ``ts`` is
    the instant (TIMESTAMP), independent of the session zone."""
    parts = F.split(F.col(value_col), " ")
    wall = F.to_timestamp_ntz(parts.getItem(3), F.lit(time_format))
    utc_wall = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return lines.select(
        parts.getItem(0).alias("ip"),
        parts.getItem(1).alias("user_id"),
        F.timestamp_micros(to_micros(utc_wall, T.TimestampNTZType())).alias("ts"),
        parts.getItem(5).alias("method"),
        parts.getItem(6).alias("url"),
        *(keep or []),
    )


def read_access_log(spark: SparkSession, path: str, stream: bool = False, zone: str = "UTC") -> DataFrame:
    """Access log from files, or on a stream from ``socket://`` / ``kafka://``."""
    lines = _stream_lines(spark, path) if stream else None
    if lines is None:
        lines = (spark.readStream if stream else spark.read).text(path)
    return parse_access_log(lines, zone=zone)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Line stream from a socket (``value`` string column)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_lines(spark: SparkSession, servers: str, topic: str, group: str | None = None,
                starting_offsets: str = "latest", stream: bool = True) -> DataFrame:
    """Kafka topic -> ``value`` string plus ``partition``, ``offset`` and ``timestamp``
    (an arrival order).  Needs the spark-sql-kafka package on the classpath."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if stream:
        reader = reader.option("startingOffsets", starting_offsets)
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp")


def parse_csv_lines(lines: DataFrame, kind: str, value_col: str = "value", mode: str = "FAILFAST",
                    corrupt_col: str | None = None) -> DataFrame:
    """CSV lines already in a string column (socket / Kafka) -> typed record;
    ``mode`` and ``corrupt_col`` as in :func:`read_records`."""
    schema, unit = RECORDS[kind]
    options = {"mode": mode}
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_col
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lines.select(F.from_csv(F.col(value_col), ddl, options).alias("_r"), *[c for c in lines.columns if c != value_col])
    return _typed(parsed.select("_r.*", *[c for c in parsed.columns if c != "_r"]), unit)


def replay_lines(spark: SparkSession, source: str, fmt: str = "kafka", target: str | None = None, **options):
    """Write every line of a text file as one message (``value``) of a sink:
    ``kafka`` (options ``topic`` and ``kafka.bootstrap.servers``), or any
    batch file format at ``target`` (used by the tests)."""
    writer = spark.read.text(source).write.format(fmt)
    for k, v in options.items():
        writer = writer.option(k, v)
    if fmt == "kafka":
        return writer.save()
    return writer.mode("overwrite").save(target)

"""Message topics (S1, S2) and topic writes (K1).

With the Kafka connector on the classpath, pass ``kafka={...}`` options and the
topic is a real Kafka topic.  Without it (this container, tests) a topic is a
folder of parquet files with the Kafka-like columns ``value`` (the message
text), ``timestamp``, ``segment`` and ``offset``: appending a write adds files, and the file
stream source picks them up in order.  Parquet keeps messages whole (a comment
may contain newlines), unlike a text file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_SCHEMA = "value STRING, timestamp TIMESTAMP, segment BIGINT, offset BIGINT"
#: messages of one key in the order they were sent
ORDER = ("timestamp", "segment", "offset")


def write_topic(df: DataFrame, path: str, segment: int = 0, value: str = "value",
                files: int | None = None) -> None:
    """K1: append ``df[value]`` as messages.  ``timestamp`` is the time of the write (as a
    broker stamps messages), ``segment`` may number writes, and ``offset`` orders messages
    inside one (unique, increasing per file)."""
    out = df.select(F.col(value).cast("string").alias("value"))
    if files:
        out = out.repartition(files)
    out = out.select("value", F.current_timestamp().alias("timestamp"), F.lit(segment).cast("bigint").alias("segment"),
                     F.monotonically_increasing_id().alias("offset"))
    out.write.mode("append").parquet(path)


def resend(spark: SparkSession, path: str, segment: int, files: int) -> None:
    """K1: the messages of segment 0 of a topic once more, as ``segment``; they are copied as they lie,
    file by file, into ``files`` files at most.  (Read together, small files would share a task, and the
    batch that gets the file it writes would wait for that.)"""
    from moodwatch.sinks.changelog import names
    parts = [read_topic(spark, f"{path}/{name}", stream=False).where(F.col("segment") == 0)
             for name in names(spark, path) or () if name.startswith("part-")]
    if parts:
        write_topic(reduce(DataFrame.union, parts).coalesce(files), path, segment=segment)


def write_topic_batch(df: DataFrame, path: str, batch_id: int, value: str = "value") -> None:
    """K1 from a micro-batch: its messages as the folder ``batch_id=<id>`` of a topic, with the id
    as ``segment``.  A batch that was written to its end is not written again, so a replay
    sends no message twice."""
    from moodwatch.sinks.changelog import exists
    folder = f"{path}/batch_id={int(batch_id)}"
    if exists(df.sparkSession, f"{folder}/_SUCCESS"):
        return
    (df.select(F.col(value).cast("string").alias("value"), F.current_timestamp().alias("timestamp"),
               F.lit(int(batch_id)).cast("bigint").alias("segment"), F.monotonically_increasing_id().alias("offset"))
     .write.mode("overwrite").parquet(folder))


def write_kafka(df: DataFrame, servers: str, topic: str, value: str = "value", key: str | None = None) -> None:
    """K1 with the Kafka connector: one message per row.  With ``key`` (e.g. ``user_id``) the
    messages of one key stay in one partition, in order."""
    keyed = [] if key is None else [F.col(key).cast("string").alias("key")]
    (df.select(*keyed, F.col(value).cast("string").alias("value")).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def read_topic(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
               max_files_per_trigger: int | None = None, stream: bool = True) -> DataFrame:
    """``value, timestamp, segment, offset`` from the earliest message on.

    ``kafka`` options (``kafka.bootstrap.servers``, ``subscribe``,
    ``maxOffsetsPerTrigger``) select the Kafka source; the message key is dropped
    and ``partition`` stands in for ``segment``.
    """
    if kafka is not None:
        reader = spark.readStream if stream else spark.read
        raw = reader.format("kafka").option("startingOffsets", "earliest").options(**kafka).load()
        return raw.select(F.col("value").cast("string").alias("value"), "timestamp",
                          F.col("partition").cast("bigint").alias("segment"), F.col("offset"))
    if not stream:
        return spark.read.schema(TOPIC_SCHEMA).parquet(path)
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of text lines (``value``) from files appearing under ``path``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S2 over a socket (same shape as :func:`read_lines`; not for production)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def read_table_stream(spark: SparkSession, path: str, schema=None, max_files_per_trigger: int | None = None):
    """A parquet table as a stream source.  ``path`` may be a directory or a glob;
    a single file must be given as a glob (the file source lists directories)."""
    reader = spark.readStream.schema(schema if schema is not None else spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)

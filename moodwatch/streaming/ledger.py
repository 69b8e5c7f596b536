"""W9 exactly and without state: a ledger of the ids seen, by event day.

Spark's own deduplication keeps every id in state, or forgets ids behind a watermark.  Here
the ids seen lie in a table ``event_day=<day>/batch_id=<id>``; a micro-batch is joined
against the days of its own rows only, so its cost is that of its rows and those days,
whatever the age of the ledger, and the query keeps no state at all.

A row is known by its key and the day of its event: a re-sent message has both.  Of the rows of
one batch that share them one is kept.  Rows without a key are kept all.  A replayed batch
doesn't see its own entries and replaces them, in the ledger and in the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodwatch.sinks import changelog
from moodwatch.streaming import jobs

DAY, KEY = "event_day", "event_key"
NO_DAY = "1970-01-01"


def _seen(spark, ledger: str, days: list, batch_id: int) -> DataFrame | None:
    """(event_key, event_day) of earlier batches for some days; None where there are none."""
    folders = [f"{ledger}/{DAY}={d}" for d in days if changelog.exists(spark, f"{ledger}/{DAY}={d}")]
    if not folders:
        return None
    log = spark.read.schema(f"{KEY} string, {changelog.BATCH} bigint, {DAY} date").option("basePath", ledger).parquet(*folders)
    return log.where(F.col(changelog.BATCH) < batch_id).select(KEY, DAY)


def _dated(rows: DataFrame, key: str, event_time: str) -> DataFrame:
    return rows.withColumns({KEY: F.col(key).cast("string"), DAY: F.coalesce(F.to_date(event_time), F.lit(NO_DAY).cast("date"))})


def unseen(named: DataFrame, batch_id: int, ledger: str) -> DataFrame:
    """The rows (with key and day) of a batch that no earlier batch had, one a key and day."""
    days = [r[0] for r in named.select(DAY).distinct().collect()]  # the days of one batch
    one = named.dropDuplicates([KEY, DAY])
    seen = _seen(named.sparkSession, ledger, days, batch_id)
    return one if seen is None else one.join(seen, [KEY, DAY], "left_anti")


def enter(rows: DataFrame, batch_id: int, ledger: str) -> None:
    """Enter the keys of a batch: a folder a day and batch, so that a replay replaces its own."""
    (rows.where(F.col(KEY).isNotNull()).select(KEY, DAY, F.lit(batch_id).cast("bigint").alias(changelog.BATCH))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, changelog.BATCH).parquet(ledger))


def dedup_app(rows: DataFrame, sink: str, ledger: str, checkpoint: str, key: str = "comment_id", event_time: str = "ts",
              trigger: str = jobs.DEFAULT_TRIGGER, available_now: bool = False) -> StreamingQuery:
    """Write each row once, however late its repeats come; batches land in ``sink``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        dated = _dated(batch, key, event_time).persist()
        try:
            fresh = unseen(dated.where(F.col(KEY).isNotNull()), batch_id, ledger)
            nameless = dated.where(F.col(KEY).isNull())
            changelog.write_batch(fresh.unionByName(nameless).drop(KEY, DAY), sink, batch_id)
        finally:
            dated.unpersist()
        written = spark.read.schema(batch.schema).parquet(f"{sink}/{changelog.BATCH}={batch_id}")
        enter(_dated(written, key, event_time), batch_id, ledger)

    spark = rows.sparkSession
    jobs.claim(spark, sink, checkpoint)
    changelog.create(spark, ledger)
    w = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()

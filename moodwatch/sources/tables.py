"""Table sources and point reads (S3, S4, S5, S7) and the monitor append (K6).

The monitor table lives in a relational database in the original system; with
a JDBC URL it is read through ``spark.read.jdbc`` (one query, or
``numPartitions`` range queries on ``monitor_id``), otherwise from parquet.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwatch.sinks import changelog

#: times that a writer looks for a free range of ids
TRIES = 200
MONITOR_COLUMNS = ("monitor_id", "name", "words", "created")


def read_monitors(spark: SparkSession, path: str | None = None, url: str | None = None,
                  table: str = "monitors", properties: dict | None = None,
                  id_column: str = "id", partitions: int | None = None) -> DataFrame:
    """S3: ``(monitor_id, name, words, created)`` from JDBC or parquet."""
    if url is not None:
        props = dict(properties or {})
        if partitions:
            bounds = (spark.read.jdbc(url, f"(SELECT min({id_column}) lo, max({id_column}) hi FROM {table}) b",
                                      properties=props).first())
            df = spark.read.jdbc(url, table, column=id_column, lowerBound=bounds["lo"] or 0,
                                 upperBound=(bounds["hi"] or 0) + 1, numPartitions=partitions, properties=props)
        else:
            df = spark.read.jdbc(url, table, properties=props)
        return df.select(F.col(id_column).cast("bigint").alias("monitor_id"), "name", "words",
                         F.col("date").cast("date").alias("created"))
    return spark.read.parquet(path).select(*MONITOR_COLUMNS)


def append_monitors_table(rows: DataFrame, path: str | None = None, url: str | None = None,
                          table: str = "monitors", properties: dict | None = None) -> None:
    """K6 write: append new monitor rows (ids from :func:`operators.monitors.append_monitors`)."""
    if url is not None:
        out = rows.select(F.col("monitor_id").alias("id"), "name", "words", F.col("created").alias("date"))
        out.write.mode("append").jdbc(url, table, properties=dict(properties or {}))
    else:  # ids are BIGINT in the table, whatever the caller's type
        rows.select(F.col("monitor_id").cast("bigint"), "name", "words", F.col("created").cast("date")) \
            .write.mode("append").parquet(path)


def register_monitors(new: DataFrame, path: str, order: Sequence[str] = ("name",), created=None) -> tuple[int, int]:
    """K6 with several writers: append ``(name, words)`` rows to the table at ``path`` under ids of
    their own; returns the first and the last id.

    A writer reserves its range of ids before it writes, by a file that only one can create
    (``_ids/<first id>``, with the last id in it); who comes second takes the next range.  A
    writer that dies leaves a gap, never an id twice.  Ids follow ``order``."""
    from moodwatch.operators.monitors import dense_ids
    from moodwatch.session import materialize
    spark = new.sparkSession
    rows = materialize(new.select("name", "words"))
    n = rows.count()
    if not n:
        return 0, -1
    written = any(name.startswith("part-") for name in changelog.names(spark, path) or ())
    known = spark.read.parquet(path).agg(F.max("monitor_id")).first()[0] if written else None
    first = (known or 0) + 1
    tries = 0
    while not _reserve(spark, f"{path}/_ids", first, first + n - 1):
        tries += 1
        if tries > TRIES:
            raise RuntimeError(f"a reservation under {path}/_ids was never finished; delete it if its writer is gone")
        time.sleep(0.05)
        taken = [changelog.read_note(spark, f"{path}/_ids/{name}") for name in changelog.names(spark, f"{path}/_ids") or ()]
        first = max([first, *(int(last) + 1 for last in taken if last)])
    day = F.current_date() if created is None else F.lit(created).cast("date")
    ids = dense_ids(rows, list(order), first, "monitor_id")
    # side by side writers of one folder delete each other's temporary files: each writes a folder of
    # its own, whose finished files are then moved
    own = f"{path}/_new/{first:020d}"
    append_monitors_table(ids.select("monitor_id", "name", "words", day.alias("created")), own)
    changelog.move_files(spark, own, path)
    return first, first + n - 1


def _reserve(spark: SparkSession, folder: str, first: int, last: int) -> bool:
    """Whether the ids from ``first`` to ``last`` are this writer's now."""
    for name in changelog.names(spark, folder) or ():
        held = changelog.read_note(spark, f"{folder}/{name}")
        if not held or int(name) <= last and first <= int(held):
            return False  # taken, or about to be
    try:
        changelog.write_note(spark, f"{folder}/{first:020d}", str(last))
    except Exception as e:  # the file system's own exception, whichever it is
        if "exist" not in str(e).lower():
            raise
        return False
    return True


def save_bucketed(df: DataFrame, key: str, buckets: int, path: str, name: str | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key`` at ``path`` and
    return it read back.

    A join on ``key`` against a bucketed table shuffles only the other side
    (into the table's buckets): the profile view is joined by every micro-batch
    of the gender stream, so it is written once this way instead of being
    re-shuffled per batch.  ``buckets`` is fixed per table (a multiple of the
    cluster's cores; ``spark.sql.shuffle.partitions`` of the joins matched to it).
    """
    import uuid
    spark = df.sparkSession
    name = name or f"moodwatch_{uuid.uuid4().hex[:12]}"
    # one task a bucket: as many files as buckets, not buckets x tasks
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def profile_column(profiles: DataFrame, column: str, key: str = "user_id") -> DataFrame:
    """One profile attribute per user; the scan reads only these two columns."""
    return profiles.select(key, column)


def get(table: DataFrame, key_column: str, key) -> DataFrame:
    """S7 get: rows with ``key_column == key`` (pushed to the scan as a filter)."""
    return table.where(F.col(key_column) == F.lit(key))


def scan(spark: SparkSession, path: str) -> DataFrame:
    """S7 scan: the whole table."""
    return spark.read.parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """One JSON response per file -> ``raw`` text (plus ``<key>=<value>``
    folder columns, e.g. ``monitor_id=3``, found by partition discovery).  Parse
    with :func:`moodwatch.operators.records.extract_posts` / ``extract_comments``."""
    return spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "raw")

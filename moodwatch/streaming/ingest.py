"""Ingest as a stream (R5, J2): search and comment responses to the three topics.

Search responses are tagged with the monitor that owns their URL.  A comment response meets
the posts it answers in a stream-stream join on ``post_id``: each side waits in state until
the other came, at most ``delay`` by event time (``fetched_at``), whichever is first.  A post
seen again within the delay counts once.  Nothing is kept longer than the delay, so state
is bounded by the responses of that time.

One query writes all topics: a micro-batch is one folder of each topic, and a replayed batch
that was written to its end is left as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodwatch.functions.constants import COMMENT_FIELDS, POST_FIELDS, USER_FIELDS
from moodwatch.functions.lines import encode_fields
from moodwatch.operators import records
from moodwatch.session import materialize
from moodwatch.sources import topics
from moodwatch.streaming import jobs

TOPICS = ("wz", "user", "com")


def _author(user: str):
    return F.when(F.col(f"{user}.user_id").isNotNull(),
                  F.struct(F.lit("user").alias("topic"), encode_fields([f"{user}.{f}" for f in USER_FIELDS]).alias("value")))


def _messages(rows: DataFrame, topic: str, fields) -> DataFrame:
    """A row's own message and its author's, so that each response is parsed once for both."""
    own = F.struct(F.lit(topic).alias("topic"), encode_fields(list(fields)).alias("value"))
    return rows.select(F.explode_outer(F.array(own, _author("user"))).alias("m")).where("m is not null").select("m.topic", "m.value")


def ingest_stream(search: DataFrame, comments: DataFrame, owners: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Streams of responses -> (topic, value).

    ``search``: (url, raw, fetched_at); ``comments``: (post_id, raw, fetched_at); ``owners``: the
    static (url, monitor_id).  Responses later than ``delay`` behind the newest are dropped, as
    are comments whose post isn't fetched within it."""
    posts = records.extract_posts(records.tag_with_monitor(search, owners), keep=("monitor_id", "fetched_at"))
    seen = (posts.select(F.col("post_id").alias("_post"), "monitor_id", F.col("fetched_at").alias("_seen"))
            .withWatermark("_seen", delay).dropDuplicatesWithinWatermark(["_post", "monitor_id"]))
    answers = comments.withColumn("post_id", F.col("post_id").cast("string")).withWatermark("fetched_at", delay)
    near = F.expr(f"fetched_at between _seen - interval {delay} and _seen + interval {delay}")
    tagged = answers.join(seen, (F.col("post_id") == F.col("_post")) & near)
    com = records.extract_comments(tagged.select("raw", "monitor_id"), keep=("monitor_id",))
    return _messages(posts, "wz", POST_FIELDS).unionByName(_messages(com, "com", COMMENT_FIELDS))


def ingest_app(search: DataFrame, comments: DataFrame, owners: DataFrame, base: str, checkpoint: str, delay: str = "1 hour",
               trigger: str = jobs.DEFAULT_TRIGGER, available_now: bool = False,
               state_partitions: int | None = None) -> StreamingQuery:
    """Run :func:`ingest_stream` into the topics ``<base>/wz``, ``user`` and ``com``.  ``owners`` are
    computed once a start: a micro-batch would run their whole plan again."""
    spark = search.sparkSession
    lines = ingest_stream(search, comments, materialize(owners), delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name in TOPICS:
                topics.write_topic_batch(batch.where(F.col("topic") == name), f"{base}/{name}", batch_id)
        finally:
            batch.unpersist()

    jobs.claim(spark, base, checkpoint)
    w = lines.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    with jobs.settings(spark, {} if state_partitions is None else {"spark.sql.shuffle.partitions": str(state_partitions)}):
        return w.start()

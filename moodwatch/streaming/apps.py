"""The monitor as running applications: ingest, four streaming apps, read side.

* :func:`ingest` turns fetched search/comment responses into the three topics
  (``wz`` posts, ``user`` profiles, ``com`` comments), each record tagged with
  the monitor that owns the search URL.
* :func:`sentiment_app`, :func:`word_cloud_app`, :func:`profile_app` and
  :func:`moodwatch.streaming.arrival.gender_app` (genders from keyed state;
  :func:`gender_app` takes a fixed profile table) are the long-running stream
  jobs; each writes a change log under its own sink folder, with its own checkpoint.
* :func:`read_trend`, :func:`read_word_cloud`, :func:`read_gender`,
  :func:`read_profiles` answer the dashboard queries from those sinks.

Additive totals default to per-batch deltas (no state store); pass
``stateful=True`` for running totals kept in the state store and re-emitted in
``update`` mode.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodwatch.functions.constants import COMMENT_FIELDS, TREND_POINTS
from moodwatch.operators import bayes, joins, metrics, model, records, serve, text
from moodwatch.session import materialize
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import jobs


# --- ingest (batch or stream) ------------------------------------------------------
def ingest(search: DataFrame, comments: DataFrame, owners: DataFrame) -> dict[str, DataFrame]:
    """Responses -> topic lines.

    ``search``: ``(url, raw)`` search responses; ``comments``: ``(post_id, raw)``
    comment responses of a post; ``owners``: ``(url, monitor_id)`` from
    :func:`moodwatch.operators.monitors.url_owner`.  Returns ``{"wz", "user",
    "com"}`` DataFrames with a ``value`` column.
    """
    tagged = records.tag_with_monitor(search, owners)
    # posts feed three outputs: the responses are parsed once (a stream can't be stored here)
    posts = records.extract_posts(tagged)
    posts = posts if posts.isStreaming else materialize(posts)
    post_monitor = posts.select("post_id", "monitor_id").distinct()
    answers = comments.withColumn("post_id", F.col("post_id").cast("string"))
    com = records.extract_comments(answers.join(post_monitor, "post_id"), keep=("monitor_id",))
    users = records.author_union(posts, com)
    return {
        "wz": records.encode_posts(posts),
        "user": records.encode_users(users),
        "com": records.encode_lines(com, COMMENT_FIELDS),
    }


def write_topics(lines: dict[str, DataFrame], base: str, segment: int = 0) -> None:
    """K1 for every topic: ``<base>/<topic>``; a later write is newer (see ``topics.ORDER``)."""
    for name, df in lines.items():
        topics.write_topic(df, f"{base}/{name}", segment=segment)


# --- stream apps ---------------------------------------------------------------------------
def _delta(lines: DataFrame, keys, sums, sink: str, checkpoint: str, prepare, rejects: str | None, trigger: str,
           available_now: bool, **kw) -> StreamingQuery:
    """Comments decoded once; what ``prepare`` makes of the valid ones is summed, the others
    go to the reject sink (or are dropped, where there is none)."""
    rows = jobs.comments(lines, keep_invalid=rejects is not None, **kw)
    return jobs.delta_upsert(rows, keys, sums, sink, checkpoint, available_now=available_now, trigger=trigger,
                             prepare=prepare, rejects=rejects)


def _stateful(totals: DataFrame, sink: str, checkpoint: str, rejects: str | None, trigger: str, available_now: bool,
              state_partitions: int | None) -> StreamingQuery:
    if rejects is not None:
        raise ValueError("running totals in the state store have no reject sink; use the default form")
    return jobs.upsert(totals, sink, checkpoint, trigger=trigger, available_now=available_now, state_partitions=state_partitions)


def sentiment_app(lines: DataFrame, fitted: PipelineModel, sink: str, checkpoint: str, stateful: bool = False,
                  trigger: str = jobs.DEFAULT_TRIGGER, available_now: bool = False,
                  state_partitions: int | None = None, rejects: str | None = None, **kw) -> StreamingQuery:
    """L1: ``com`` lines -> hourly positive/negative/neutral per monitor."""
    if stateful:
        return _stateful(jobs.trend(lines, fitted, **kw), sink, checkpoint, rejects, trigger, available_now, state_partitions)
    keys, sums = jobs.trend_sums()
    return _delta(lines, keys, sums, sink, checkpoint, lambda c: model.neutral_band(model.score(fitted, c)), rejects,
                  trigger, available_now, **kw)


def word_cloud_app(lines: DataFrame, sink: str, checkpoint: str, stateful: bool = False,
                   trigger: str = jobs.DEFAULT_TRIGGER, available_now: bool = False,
                   state_partitions: int | None = None, rejects: str | None = None, **kw) -> StreamingQuery:
    """L2: ``com`` lines -> word counts per monitor."""
    if stateful:
        return _stateful(jobs.word_cloud(lines, **kw), sink, checkpoint, rejects, trigger, available_now, state_partitions)
    return _delta(lines, ["monitor_id", "word"], None, sink, checkpoint,
                  lambda c: text.explode_tokens(text.segment(c), ["monitor_id"]), rejects, trigger, available_now, **kw)


def gender_app(lines: DataFrame, profiles: DataFrame, sink: str, checkpoint: str, hot: DataFrame | None = None,
               stateful: bool = False, trigger: str = jobs.DEFAULT_TRIGGER, available_now: bool = False,
               state_partitions: int | None = None, rejects: str | None = None, heavy: str | None = None,
               share: float = 0.01, **kw) -> StreamingQuery:
    """L3 against a fixed profile table: ``com`` lines -> comments per gender.  Genders as of
    arrival, with profiles that come while the stream runs, are :func:`arrival.gender_app`.

    ``heavy`` names a sink of sketches of the commenters: each batch adds its own, and its join
    salts the users that had ``share`` of all comments in the batches before.  No comment is
    read for the list alone."""
    if heavy is not None and not stateful:
        def around(valid: DataFrame, batch_id: int) -> DataFrame:
            changelog.write_batch(joins.key_sketch(valid, "user_id"), heavy, batch_id)
            known = read_heavy(valid.sparkSession, heavy, share, before=batch_id)
            return metrics.gender_join(valid, profiles, None if known is None else known.select("user_id"))

        jobs.claim(lines.sparkSession, heavy, checkpoint)
        return jobs.delta_upsert(jobs.comments(lines, keep_invalid=rejects is not None, **kw), ["monitor_id", "gender"], None, sink, checkpoint,
                                 available_now=available_now, trigger=trigger, rejects=rejects, around=around)
    if stateful:
        return _stateful(jobs.gender(lines, profiles, hot, **kw), sink, checkpoint, rejects, trigger, available_now, state_partitions)
    return _delta(lines, ["monitor_id", "gender"], None, sink, checkpoint, lambda c: metrics.gender_join(c, profiles, hot),
                  rejects, trigger, available_now, **kw)


def profile_app(user_lines: DataFrame, sink: str, checkpoint: str, trigger: str = jobs.DEFAULT_TRIGGER,
                available_now: bool = False, rejects: str | None = None) -> StreamingQuery:
    """K2: ``user`` lines -> profile change log (newest message per user wins)."""
    rows = records.decode_users(user_lines, keep_invalid=rejects is not None)
    return jobs.upsert(rows, sink, checkpoint, trigger=trigger, available_now=available_now,
                       output_mode="append", rejects=rejects)


def learn_app(labelled: DataFrame, sink: str, checkpoint: str, trigger: str = jobs.DEFAULT_TRIGGER,
              available_now: bool = False, **columns) -> StreamingQuery:
    """M5 as a stream of labelled rows (doc_id, text, label): each batch adds its sums to the
    sink, and :func:`read_model` makes the model of all rows so far.  Rows are read once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        changelog.write_batch(bayes.increments(batch, **columns), sink, batch_id)

    jobs.claim(labelled.sparkSession, sink, checkpoint)
    w = labelled.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


# --- read side -----------------------------------------------------------------------------
def read_profiles(spark: SparkSession, sink: str, snapshot: str | None = None) -> DataFrame:
    """Latest profile per user, in order of arrival: the batch, then the order of messages.
    No profile has arrived where the sink has no batch yet; a missing sink raises."""
    if not changelog.batches(spark, sink):
        return spark.createDataFrame([], records.decode_users(spark.createDataFrame([], "value string")).schema)
    return changelog.latest_view(spark, sink, ["user_id"], topics.ORDER, snapshot)


def read_model(spark: SparkSession, sink: str, snapshot: str | None = None) -> bayes.NaiveBayesTable:
    """The Naive Bayes model of all rows that :func:`learn_app` has read."""
    return bayes.fit_log(changelog.totals_view(spark, sink, bayes.LOG_KEYS, bayes.LOG_SUMS, snapshot))


def read_heavy(spark: SparkSession, sink: str, share: float, before: int | None = None) -> DataFrame | None:
    """(user_id, n) of the users with ``share`` of all comments so far (or in the batches ``before``
    one), from the sink of sketches; None where there is no batch."""
    wanted = [i for i in changelog.batches(spark, sink) if before is None or i < before]
    if not wanted:
        return None
    return joins.heavy_keys(changelog.read_log(spark, sink, upto=wanted[-1]), "user_id", share)


def read_rejects(spark: SparkSession, sink: str) -> DataFrame:
    """The lines that a running app couldn't decode: (batch_id, value, reason)."""
    return changelog.read_log(spark, sink, schema="value string, reason string").select(changelog.BATCH, "value", "reason")


# keys and values of each running-total sink
SINKS = {
    "trend": (["monitor_id", "hour"], ["positive", "negative", "neutral"]),
    "words": (["monitor_id", "word"], ["n"]),
    "gender": (["monitor_id", "gender"], ["n"]),
    "users": (["user_id"], []),
    "model": (bayes.LOG_KEYS, bayes.LOG_SUMS),
}


def _counts(spark, sink, what, stateful, snapshot=None, **of):
    """A running-total sink; values given by key (monitor, word) prune the read."""
    keys, values = SINKS[what]
    of = {k: v for k, v in of.items() if v is not None}
    if stateful:
        return changelog.latest_view(spark, sink, keys, snapshot=snapshot, of=of)
    return changelog.totals_view(spark, sink, keys, values, snapshot=snapshot, of=of)


def compact_sink(spark: SparkSession, what: str, sink: str, snapshot: str, stateful: bool = False) -> int | None:
    """Fold a sink's new batches into its snapshot, clustered by its first key (every read
    query asks about one monitor)."""
    keys, values = SINKS[what]
    if what == "users":
        return changelog.compact(spark, sink, keys, snapshot, topics.ORDER, cluster_by="user_id")
    day_of = "hour" if what == "trend" else None
    if stateful:
        return changelog.compact(spark, sink, keys, snapshot, cluster_by="monitor_id", day_of=day_of)
    return changelog.compact_totals(spark, sink, keys, values, snapshot, "term" if what == "model" else "monitor_id", day_of)


def read_trend(spark: SparkSession, sink: str, monitor_id=None, stateful: bool = False,
               points: int | None = None, snapshot: str | None = None) -> DataFrame:
    """Q1: the trend (newest ``points`` hours per monitor when given).  For one monitor the
    snapshot is read backwards by day, as far as the points are."""
    wide = _trend(spark, sink, monitor_id, stateful, points, snapshot)
    return wide if points is None else serve.trend_last(wide, points, monitor_id)


def _trend(spark, sink, monitor_id, stateful, points, snapshot) -> DataFrame:
    if points is None or monitor_id is None or snapshot is None:
        return _counts(spark, sink, "trend", stateful, snapshot, monitor_id=monitor_id)
    keys, values = SINKS["trend"]
    return changelog.newest(spark, sink, keys, values, snapshot, "hour", points, {"monitor_id": monitor_id}, additive=not stateful)


def read_series(spark: SparkSession, sink: str, monitor_id=None, stateful: bool = False,
                points: int = TREND_POINTS, snapshot: str | None = None) -> DataFrame:
    """Q3+Q4: the aligned series of the trend chart, per monitor."""
    return serve.trend_series(_trend(spark, sink, monitor_id, stateful, points, snapshot), points)


def read_word(spark: SparkSession, sink: str, monitor_id, word: str, stateful: bool = False,
              snapshot: str | None = None) -> DataFrame:
    """Q8: the count of one word in one monitor, from the sink."""
    return serve.word_lookup(_counts(spark, sink, "words", stateful, snapshot, monitor_id=monitor_id, word=word), monitor_id, word)


def read_word_cloud(spark: SparkSession, sink: str, monitor_id=None, stateful: bool = False,
                    top: int | None = None, snapshot: str | None = None) -> DataFrame:
    """Q7: ``(name, value)`` per word."""
    return serve.word_cloud(_counts(spark, sink, "words", stateful, snapshot, monitor_id=monitor_id), monitor_id, top)


def read_gender(spark: SparkSession, sink: str, monitor_id=None, stateful: bool = False,
                snapshot: str | None = None) -> DataFrame:
    """Q5+Q6: 男 / 女 / 其它 with their shares."""
    counts = _counts(spark, sink, "gender", stateful, snapshot, monitor_id=monitor_id)
    return serve.gender_share(serve.gender_breakdown(counts, monitor_id))

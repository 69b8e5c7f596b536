"""Stream plans: the batch pipelines run as Structured Streaming queries.

Each query writes the driver's rows into a topic folder (as the crawler
would), runs the streaming job over it with ``availableNow`` in ``BATCHES``
micro-batches (each takes one topic file per core, as a Kafka batch takes one
split per partition; state or deltas carry across batches), and returns the
read view of the sink -- a batch DataFrame whose rows must equal the batch query
of the same pipeline.  All folders are fresh sub-folders of the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwatch.operators import bayes, model, records
from moodwatch.plans import batch
from moodwatch.session import fresh_dir, materialize, parallelism, pin_utc
from moodwatch.sinks import changelog
from moodwatch.sources import fixtures as fx
from moodwatch.sources import topics
from moodwatch.streaming import jobs

# Micro-batches per stream run.  A topic partition is a file here; each batch
# takes one file per core, as a Kafka batch takes one split per partition.
BATCHES = 4


def _parts(spark: SparkSession) -> int:
    return parallelism(spark)


def _topic_files(spark: SparkSession) -> int:
    return BATCHES * _parts(spark)


def _comment_topic(spark: SparkSession, d: str, copies: int = 1) -> str:
    """The ``com`` topic: every comment line, ``copies`` times (re-sent crawls)."""
    path = fresh_dir(spark, "topic-com")
    for seg in range(copies):  # BATCHES micro-batches in total, whatever the number of copies
        _send_comments(spark, d, path, seg, max(_parts(spark), _topic_files(spark) // copies))
    return path


def _send_comments(spark: SparkSession, d: str, path: str, segment: int, files: int) -> None:
    """Every comment line into a topic: the first time in the ``files`` parts in which the comments are
    joined, without another shuffle of their texts; a later segment re-sends the lines of the first.
    Spark joins in as many parts as the session has shuffle partitions where these are more; they are
    put together, as the number of files is that of the micro-batches."""
    if segment == 0:
        topics.write_topic(batch.comment_lines(spark, d, parts=files).coalesce(files), path, segment=0)
    else:
        topics.resend(spark, path, segment, files)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return topics.read_topic(spark, path, max_files_per_trigger=_parts(spark))


def _run(spark, stream_df: DataFrame, name: str, output_mode: str = "update") -> str:
    sink = fresh_dir(spark, f"sink-{name}")
    jobs.run_to_end(stream_df, sink, fresh_dir(spark, f"ckpt-{name}"), output_mode,
                    state_partitions=2 * _parts(spark))
    return sink


def q_stream_word_counts(spark, d):
    lines = _read(spark, _comment_topic(spark, d))
    out = jobs.word_cloud(lines)
    return jobs.latest(spark, _run(spark, out, "words"), ["monitor_id", "word"], out.schema)


def _run_delta(spark, rows: DataFrame, keys, sums, name: str) -> str:
    sink = fresh_dir(spark, f"sink-{name}")
    q = jobs.delta_upsert(rows, keys, sums, sink, fresh_dir(spark, f"ckpt-{name}"), available_now=True)
    q.awaitTermination()
    return sink


def q_stream_word_counts_delta(spark, d):
    """L2 as a stateless stream: per-batch word-count deltas, summed on read."""
    rows = jobs.word_rows(_read(spark, _comment_topic(spark, d)))
    sink = _run_delta(spark, rows, ["monitor_id", "word"], None, "words-delta")
    return changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"])


def q_stream_word_cloud_compacted(spark, d):
    """L2 read through incremental compaction: the topic is streamed and the
    sink compacted; then every comment is re-sent (counted again, D2), streamed
    and compacted incrementally; the read is snapshot + newer batches."""
    from moodwatch.streaming import apps
    topic = fresh_dir(spark, "topic-com")
    sink, ckpt, snap = fresh_dir(spark, "sink-wc"), fresh_dir(spark, "ckpt-wc"), fresh_dir(spark, "snap-wc")
    for seg in range(2):
        _send_comments(spark, d, topic, seg, 2 * _parts(spark))
        q = jobs.delta_upsert(jobs.word_rows(_read(spark, topic)), ["monitor_id", "word"], None, sink, ckpt,
                              available_now=True)
        q.awaitTermination()
        apps.compact_sink(spark, "words", sink, snap)
    return changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"], snapshot=snap)


def _trend_sink(spark, d) -> str:
    """The trend sink of the events stream (not a query)."""
    return _run_delta(spark, _scored_stream(spark, d, max_files=None), *jobs.trend_sums(), "trend-delta")


def q_stream_trend_delta(spark, d):
    """L1 (stand-in scores) as a stateless stream of per-batch trend deltas."""
    keys, sums = jobs.trend_sums()
    sink = _trend_sink(spark, d)
    return changelog.totals_view(spark, sink, keys, list(sums))


def q_stream_gender_counts_delta(spark, d):
    """L3 as a stateless stream: stream-static join with profiles, per-batch
    gender deltas, summed on read."""
    from moodwatch.operators import metrics
    joined = metrics.gender_join(jobs.comments(_read(spark, _comment_topic(spark, d))), fx.users(spark, d))
    sink = _run_delta(spark, joined, ["monitor_id", "gender"], None, "gender-delta")
    return changelog.totals_view(spark, sink, ["monitor_id", "gender"], ["n"])


def q_stream_gender_counts(spark, d):
    lines = _read(spark, _comment_topic(spark, d))
    out = jobs.gender(lines, fx.users(spark, d))
    return jobs.latest(spark, _run(spark, out, "gender"), ["monitor_id", "gender"], out.schema)


def q_stream_trend(spark, d):
    """L1 end to end on a stream with the hashing model (rows-only check)."""
    lines = _read(spark, _comment_topic(spark, d))
    out = jobs.trend(lines, batch.trained_model(spark, d))
    return jobs.latest(spark, _run(spark, out, "trend"), ["monitor_id", "hour"], out.schema)


def q_stream_trend_vocab(spark, d):
    """L1 as a stateless stream with the model over exact terms: each batch is scored by joins
    inside ``foreachBatch`` (exact oracle)."""
    fitted = batch.trained_terms(spark, d)
    keys, sums = jobs.trend_sums()
    sink = fresh_dir(spark, "sink-trend-vocab")
    jobs.delta_upsert(jobs.comments(_read(spark, _comment_topic(spark, d))), keys, sums, sink, fresh_dir(spark, "ckpt-trend-vocab"),
                      available_now=True, prepare=lambda b: model.neutral_band(bayes.score(fitted, b, "comment_id"))).awaitTermination()
    return changelog.totals_view(spark, sink, keys, list(sums))


def _scored_stream(spark, d, max_files: int | None = None):
    pin_utc(spark)
    ev = topics.read_table_stream(spark, f"{d.rstrip('/')}/events*.parquet",
                                  fx.table(spark, d, "events").schema, max_files)
    return _scored(ev)


def _scored(ev: DataFrame) -> DataFrame:
    p0 = (F.col("event_id") % 101).cast("double") / F.lit(100.0)
    s = ev.select(F.col("event_id").alias("comment_id"), F.col("event_type").alias("monitor_id"),
                  F.col("ts").alias("created_at"), p0.alias("p0"), (F.lit(1.0) - p0).alias("p1"))
    return model.neutral_band(s.withColumn("hour", F.date_trunc("hour", "created_at").cast("timestamp_ntz")))


def q_stream_trend_scored(spark, d):
    """L1 trend from the events table read as a stream (stand-in scores)."""
    from moodwatch.operators import metrics
    out = metrics.trend_wide(_scored_stream(spark, d))
    return jobs.latest(spark, _run(spark, out, "trend-scored"), ["monitor_id", "hour"], out.schema)


def q_stream_trend_windowed(spark, d):
    """The same trend with event-time windows and a watermark."""
    out = jobs.windowed_trend(_scored_stream(spark, d))
    return jobs.latest(spark, _run(spark, out, "trend-window"), ["monitor_id", "hour"], out.schema)


def q_stream_profiles(spark, d):
    """K2 on a stream: two ingests with default arguments, an older state of every profile
    and then the current one; the newest message per user wins."""
    from moodwatch.streaming import apps
    path = fresh_dir(spark, "topic-user")
    users = fx.users(spark, d)
    older = users.withColumn("followers_count", F.col("followers_count") - 1).withColumn(
        "description", F.lit(None).cast("string"))
    half = max(_parts(spark), _topic_files(spark) // 2)
    topics.write_topic(records.encode_users(older), path, files=half)
    topics.write_topic(records.encode_users(users), path, files=half)
    sink = fresh_dir(spark, "sink-profiles")
    apps.profile_app(_read(spark, path), sink, fresh_dir(spark, "ckpt-profiles"), available_now=True).awaitTermination()
    return apps.read_profiles(spark, sink)


def q_stream_gender_arrival(spark, d):
    """J1 + K2 from keyed state: half of the comments arrive before any profile, then the
    profiles, then the rest; each step restarts the query from its checkpoint.  The heaviest
    commenters' keys are salted."""
    from moodwatch.operators import joins
    from moodwatch.streaming import arrival
    users, com, sink, ckpt = (fresh_dir(spark, n) for n in ("topic-user", "topic-com", "sink-arrival", "ckpt-arrival"))
    lines = batch.comment_lines(spark, d)
    hot = [r.user_id for r in joins.hot_keys(fx.comments(spark, d), "user_id", share=0.01).collect()]  # 100 at most
    changelog.create(spark, users)
    for step in range(3):
        if step == 1:
            topics.write_topic(records.encode_users(fx.users(spark, d)), users, files=_parts(spark))
        else:
            topics.write_topic(lines.where(fx.key_number("comment_id") % 2 == step // 2), com, files=_parts(spark))
        arrival.gender_app(_read(spark, com), _read(spark, users), sink, ckpt, hot=hot, available_now=True,
                           state_partitions=2 * _parts(spark)).awaitTermination()
    return changelog.totals_view(spark, sink, ["monitor_id", "gender"], ["n"])


def q_stream_word_lookup(spark, d):
    """Q8 from the compacted sink, where the cluster folder prunes."""
    from moodwatch.streaming import apps
    sink, snap = fresh_dir(spark, "sink-lookup"), fresh_dir(spark, "snap-lookup")
    apps.word_cloud_app(_read(spark, _comment_topic(spark, d)), sink, fresh_dir(spark, "ckpt-lookup"),
                        available_now=True).awaitTermination()
    apps.compact_sink(spark, "words", sink, snap)
    return apps.read_word(spark, sink, batch.WORD_CLOUD_MONITOR, batch.LOOKUP_WORD, snapshot=snap)


def q_stream_trend_series(spark, d):
    """Q3+Q4 from the compacted trend sink."""
    from moodwatch.streaming import apps
    sink, snap = _trend_sink(spark, d), fresh_dir(spark, "snap-series")
    apps.compact_sink(spark, "trend", sink, snap)
    s = apps.read_series(spark, sink, snapshot=snap)
    return s.select("monitor_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("x", "y1", "y2", "y3")])


def q_stream_late_rows(spark, d):
    """Rows behind the watermark are dropped.  The first run reads every event, the second
    the same events moved 10 years back; totals stay those of the first."""
    sink, ckpt, folder = (fresh_dir(spark, n) for n in ("sink-late", "ckpt-late", "late-events"))
    events = fx.table(spark, d, "events")
    for years in (0, 10):
        events.withColumn("ts", F.col("ts") - F.expr(f"interval {years} years")).write.mode("append").parquet(folder)
        rows = _scored(topics.read_table_stream(spark, folder, events.schema))
        jobs.run_to_end(jobs.windowed_trend(rows), sink, ckpt, state_partitions=2 * _parts(spark))
    return changelog.latest_view(spark, sink, ["monitor_id", "hour"])


def mangled_lines(spark, d) -> DataFrame:
    """Comment lines of which some can't be decoded: by the comment's number, one in seven has
    no last field, one in seven no time, one in seven is empty."""
    lines = batch.comment_lines(spark, d)
    k = fx.key_number("comment_id") % 7
    return lines.select(F.when(k == 1, F.substring_index("value", "|", 5))
                        .when(k == 2, F.replace("value", F.lit("+0000"), F.lit("noon")))
                        .when(k == 3, F.lit("")).otherwise(F.col("value")).alias("value"))


def q_stream_ingest_lines(spark, d):
    """R5+J2 as a stream: a third of the comment responses comes before the posts, the rest after;
    each step restarts the query.  Responses are fetched within an hour, the delay is two."""
    from moodwatch.streaming import ingest
    search, comments = batch.crawled(spark, d)
    base, ckpt, folders = fresh_dir(spark, "topics"), fresh_dir(spark, "ckpt-ingest"), [fresh_dir(spark, n) for n in ("searched", "answered")]

    def fetched(number: str):
        return F.timestamp_add("MINUTE", F.col(number) % 60, F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("fetched_at")

    search = search.select("url", "raw", fetched("r"))
    comments = comments.select("post_id", "raw", fetched("post_id"))
    for folder in folders:
        changelog.create(spark, folder)
    owners = materialize(batch.q_url_owner(spark, d))  # once for all three starts
    for step in range(3):
        new = search if step == 1 else comments.where((F.col("post_id") % 3 == 0) == F.lit(step == 0))
        new.repartition(_parts(spark)).write.mode("append").parquet(folders[step != 1])
        read = [topics.read_table_stream(spark, f, x.schema, _parts(spark)) for f, x in zip(folders, (search, comments), strict=True)]
        ingest.ingest_app(*read, owners, base, ckpt, "2 hours", available_now=True, state_partitions=2 * _parts(spark)).awaitTermination()
    parts = [topics.read_topic(spark, f"{base}/{t}", stream=False).select(F.lit(t).alias("topic"), "value") for t in ingest.TOPICS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_stream_rejects(spark, d):
    """R7+R8 in a running app: one decode a batch, valid comments counted by word, the others in
    the reject sink under the same batch ids.  Rows of both sinks."""
    from moodwatch.streaming import apps
    topic, sink, rejects, ckpt = (fresh_dir(spark, n) for n in ("topic-mangled", "sink-mangled", "sink-rejects", "ckpt-mangled"))
    topics.write_topic(mangled_lines(spark, d), topic, files=_topic_files(spark))
    apps.word_cloud_app(_read(spark, topic), sink, ckpt, available_now=True, rejects=rejects).awaitTermination()
    counted = changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"])
    bad = apps.read_rejects(spark, rejects).groupBy("value", "reason").agg(F.count("*").alias("n"))
    return (counted.select("monitor_id", "word", F.lit(None).cast("string").alias("reason"), "n")
            .unionByName(bad.select(F.lit(None).cast("string").alias("monitor_id"), F.col("value").alias("word"), "reason", "n")))


def q_stream_comment_dedup(spark, d):
    """Every comment arrives twice; dropDuplicates keeps one per id."""
    lines = _read(spark, _comment_topic(spark, d, copies=2))
    out = jobs.comments(lines, dedup=True).select("comment_id", "monitor_id", "like_count", "user_id", "text")
    sink = _run(spark, out, "dedup", output_mode="append")
    return changelog.read_log(spark, sink).drop(changelog.BATCH)


def q_stream_comment_dedup_within(spark, d):
    """W9 with bounded state: ids are forgotten once the watermark passed them by the delay."""
    lines = _read(spark, _comment_topic(spark, d, copies=2))
    out = jobs.comments(lines, dedup_within="60 days").select("comment_id", "monitor_id", "like_count", "user_id", "text")
    sink = _run(spark, out, "dedup-within", output_mode="append")
    return changelog.read_log(spark, sink).drop(changelog.BATCH)


def q_stream_comment_dedup_ledger(spark, d):
    """W9 exactly: every comment arrives twice; the second copies are found in the ledger."""
    from moodwatch.streaming import ledger
    sink, book, ckpt = (fresh_dir(spark, n) for n in ("sink-ledger", "ledger", "ckpt-ledger"))
    lines = _read(spark, _comment_topic(spark, d, copies=2))
    ledger.dedup_app(jobs.comments(lines), sink, book, ckpt, available_now=True).awaitTermination()
    return changelog.read_log(spark, sink).select("comment_id", "monitor_id", "like_count", "user_id", "text")


def q_stream_model(spark, d):
    """M5 as a stream: the labelled rows arrive in three batches, compacted in between; the model of
    the log scores all documents as one fit does."""
    from moodwatch.streaming import apps
    folder, sink, snap, ckpt = (fresh_dir(spark, n) for n in ("labelled", "sink-model", "snap-model", "ckpt-model"))
    labelled = fx.labelled(spark, d)
    for part in range(3):
        labelled.where(F.col("doc_id") % 3 == part).write.mode("append").parquet(folder)
        apps.learn_app(topics.read_table_stream(spark, folder, labelled.schema), sink, ckpt, available_now=True).awaitTermination()
        if part < 2:
            apps.compact_sink(spark, "model", sink, snap)
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    s = bayes.score(apps.read_model(spark, sink, snap), docs, "doc_id")
    return s.select("doc_id", "prediction", F.round("p0", 6).alias("p0"), F.round("p1", 6).alias("p1"))


def _gender_heavy(spark, d) -> tuple[str, str]:
    """The gender sink and the sink of sketches of a run that salts heavy users (not a query)."""
    from moodwatch.streaming import apps
    sink, heavy = fresh_dir(spark, "sink-gender-heavy"), fresh_dir(spark, "sketches")
    users = fx.users(spark, d)
    apps.gender_app(_read(spark, _comment_topic(spark, d)), users, sink, fresh_dir(spark, "ckpt-gender-heavy"), available_now=True,
                    heavy=heavy).awaitTermination()
    return sink, heavy


def q_stream_heavy_users(spark, d):
    """J1's heavy users from sketches merged over the batches: users with 1% of all comments."""
    from moodwatch.streaming import apps
    return apps.read_heavy(spark, _gender_heavy(spark, d)[1], 0.01)


def q_stream_gender_heavy(spark, d):
    """J1+A4 where each batch salts the users that were heavy before."""
    return changelog.totals_view(spark, _gender_heavy(spark, d)[0], ["monitor_id", "gender"], ["n"])


def q_stream_line_word_count(spark, d):
    """S2 + T4 + A5: document texts replayed as a text line stream, split on commas."""
    path = fresh_dir(spark, "lines")
    fx.table(spark, d, "documents").select("text").repartition(_topic_files(spark)).write.text(path)
    out = jobs.split_word_count(topics.read_lines(spark, path, max_files_per_trigger=_parts(spark)))
    return jobs.latest(spark, _run(spark, out, "linecount"), ["word"], out.schema)


def stream_queries():
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_stream_") and callable(fn)}

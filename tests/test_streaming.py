"""Stream = batch across restarts, replay-safe sinks."""

import pytest

from pyspark.sql import functions as F

from moodwatch.operators import text
from moodwatch.plans import batch
from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import jobs


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("files", [1, 2, 5])
def test_stream_equals_batch_over_restarts(spark, sf_small, files):
    """SURVEY §5.3: the same rows in 1, 2 and N files, one file per trigger,
    restarting from the checkpoint after every file."""
    lines = batch.comment_lines(spark, sf_small)
    topic, sink, ckpt = fresh_dir(spark, "t"), fresh_dir(spark, "s"), fresh_dir(spark, "c")
    # the rows split into `files` disjoint files by a hash of the line (every row lands in exactly one)
    bucket = F.pmod(F.xxhash64("value"), F.lit(files))
    for k in range(files):
        topics.write_topic(lines.where(bucket == k), topic, segment=k, files=1)
        jobs.run_to_end(jobs.word_cloud(topics.read_topic(spark, topic, max_files_per_trigger=1)), sink, ckpt,
                        state_partitions=4)
    got = jobs.latest(spark, sink, ["monitor_id", "word"], None)
    cols = ["monitor_id", "word", "n"]
    assert _rows(got, cols) == _rows(batch.word_counts(spark, sf_small), cols)


def test_replayed_batch_replaces_itself(spark):
    sink = fresh_dir(spark, "replay")
    df = spark.createDataFrame([("a", 1)], "k string, n long")
    changelog.write_batch(df, sink, 0)
    changelog.write_batch(df, sink, 0)
    changelog.write_batch(df.withColumn("n", F.lit(5).cast("long")), sink, 1)
    assert changelog.read_log(spark, sink).count() == 2
    assert changelog.latest_view(spark, sink, ["k"]).first().n == 5


def test_compacted_snapshot_plus_newer_batches(spark):
    sink, snap = fresh_dir(spark, "log"), fresh_dir(spark, "snap")
    for b, n in enumerate([1, 2, 3]):
        changelog.write_batch(spark.createDataFrame([("a", n), ("b", 10 * n)], "k string, n long"), sink, b)
    changelog.compact(spark, sink, ["k"], snap)
    changelog.write_batch(spark.createDataFrame([("a", 7)], "k string, n long"), sink, 3)
    got = {r.k: r.n for r in changelog.latest_view(spark, sink, ["k"], snapshot=snap).collect()}
    assert got == {"a": 7, "b": 30}


def test_line_stream_word_count(spark):
    path = fresh_dir(spark, "lines")
    spark.createDataFrame([("a,b",), ("b,c,",)], "value string").write.text(path)
    out = jobs.split_word_count(topics.read_lines(spark, path))
    sink = fresh_dir(spark, "lc")
    jobs.run_to_end(out, sink, fresh_dir(spark, "lcc"))
    got = {r.word: r.n for r in jobs.latest(spark, sink, ["word"], out.schema).collect()}
    assert got == {"a": 1, "b": 2, "c": 1}


def test_preview_to_memory_sink_and_watermark_dedup(spark, sf_small):
    lines = batch.comment_lines(spark, sf_small)
    topic = fresh_dir(spark, "t2")
    topics.write_topic(lines, topic, segment=0, files=2)
    topics.write_topic(lines, topic, segment=1, files=2)
    stream = jobs.comments(topics.read_topic(spark, topic), dedup_within="1 day")
    q = (stream.select("comment_id").writeStream.format("memory").queryName("dedup_preview")
         .option("checkpointLocation", fresh_dir(spark, "c2")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT count(*) AS n, count(DISTINCT comment_id) AS d FROM dedup_preview").first()
    assert got.n == got.d == batch.decoded_comments(spark, sf_small).count()


def test_delta_totals_with_compaction_and_replay(spark):
    sink, snap = fresh_dir(spark, "dlog"), fresh_dir(spark, "dsnap")
    mk = lambda rows: spark.createDataFrame(rows, "k string, n long")
    changelog.write_batch(mk([("a", 1), ("b", 2)]), sink, 0)
    changelog.write_batch(mk([("a", 3)]), sink, 1)
    changelog.write_batch(mk([("a", 3)]), sink, 1)  # replay of batch 1 replaces itself
    changelog.compact_totals(spark, sink, ["k"], ["n"], snap)
    changelog.write_batch(mk([("b", 5), ("c", 1)]), sink, 2)
    got = {r.k: r.n for r in changelog.totals_view(spark, sink, ["k"], ["n"], snapshot=snap).collect()}
    assert got == {"a": 4, "b": 7, "c": 1}
    assert {r.k: r.n for r in changelog.totals_view(spark, sink, ["k"], ["n"]).collect()} == got


def test_delta_stream_equals_batch(spark, sf_small):
    lines = batch.comment_lines(spark, sf_small)
    topic, sink = fresh_dir(spark, "dt"), fresh_dir(spark, "ds")
    topics.write_topic(lines, topic, segment=0, files=3)
    q = jobs.delta_upsert(jobs.word_rows(topics.read_topic(spark, topic, max_files_per_trigger=1)),
                          ["monitor_id", "word"], None, sink, fresh_dir(spark, "dc"), available_now=True)
    q.awaitTermination()
    got = changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"])
    cols = ["monitor_id", "word", "n"]
    assert _rows(got, cols) == _rows(batch.word_counts(spark, sf_small), cols)


def test_processing_time_trigger(spark, sf_small):
    lines = batch.comment_lines(spark, sf_small)
    topic, sink = fresh_dir(spark, "pt"), fresh_dir(spark, "pts")
    topics.write_topic(lines, topic, files=2)
    q = jobs.upsert(jobs.word_cloud(topics.read_topic(spark, topic)), sink, fresh_dir(spark, "ptc"),
                    trigger="1 second", state_partitions=4)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = jobs.latest(spark, sink, ["monitor_id", "word"], None)
    cols = ["monitor_id", "word", "n"]
    assert _rows(got, cols) == _rows(batch.word_counts(spark, sf_small), cols)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"  # restored after start


def test_delta_stream_survives_restart(spark, sf_small):
    lines = batch.comment_lines(spark, sf_small)
    topic, sink, ckpt = fresh_dir(spark, "rt"), fresh_dir(spark, "rs"), fresh_dir(spark, "rc")

    def run():
        q = jobs.delta_upsert(jobs.word_rows(topics.read_topic(spark, topic, max_files_per_trigger=1)),
                              ["monitor_id", "word"], None, sink, ckpt, available_now=True)
        q.awaitTermination()

    topics.write_topic(lines, topic, segment=0, files=2)
    run()
    topics.write_topic(lines, topic, segment=1, files=2)
    run()  # same checkpoint: only the new files are read
    got = changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"])
    want = batch.word_counts(spark, sf_small).withColumn("n", F.col("n") * 2)
    cols = ["monitor_id", "word", "n"]
    assert _rows(got, cols) == _rows(want, cols)


def test_incremental_compaction_partitioned_by_monitor(spark):
    sink, snap = fresh_dir(spark, "ilog"), fresh_dir(spark, "isnap")
    mk = lambda rows: spark.createDataFrame(rows, "monitor_id int, word string, n long")
    changelog.write_batch(mk([(1, "a", 1), (2, "b", 2)]), sink, 0)
    assert changelog.compact_totals(spark, sink, ["monitor_id", "word"], ["n"], snap, "monitor_id") == 0
    changelog.write_batch(mk([(1, "a", 3)]), sink, 1)
    assert changelog.compact_totals(spark, sink, ["monitor_id", "word"], ["n"], snap, "monitor_id") == 1
    changelog.write_batch(mk([(1, "c", 5)]), sink, 2)
    view = changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"], snapshot=snap)
    assert sorted(tuple(r) for r in view.collect()) == [(1, "a", 4), (1, "c", 5), (2, "b", 2)]
    of_one = changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"], snapshot=snap, of={"monitor_id": 1})
    assert sorted(tuple(r) for r in of_one.collect()) == [(1, "a", 4), (1, "c", 5)]


def test_batch_landing_while_compacting(spark, monkeypatch):
    """A batch that lands after the version is fixed is counted once, and keys keep their text."""
    sink, snap = fresh_dir(spark, "rlog"), fresh_dir(spark, "rsnap")
    mk = lambda rows: spark.createDataFrame(rows, "monitor_id string, word string, n long")
    changelog.write_batch(mk([("01", "a", 5), ("1", "a", 1), ("", "a", 7)]), sink, 0)
    real = changelog._new_batches

    def slow(*args):
        out = real(*args)
        changelog.write_batch(mk([("1", "a", 10)]), sink, 1)
        return out

    monkeypatch.setattr(changelog, "_new_batches", slow)
    assert changelog.compact_totals(spark, sink, ["monitor_id", "word"], ["n"], snap, "monitor_id") == 0
    monkeypatch.setattr(changelog, "_new_batches", real)
    want = [("", "a", 7), ("01", "a", 5), ("1", "a", 11)]
    for _ in range(2):
        view = changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"], snapshot=snap)
        assert sorted(tuple(r) for r in view.collect()) == want
        changelog.compact_totals(spark, sink, ["monitor_id", "word"], ["n"], snap, "monitor_id")
    assert changelog.expire(spark, sink, snap, keep=0) == [0, 1]
    assert sorted(tuple(r) for r in changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"], snapshot=snap).collect()) == want


def test_files_of_a_run_are_bounded(spark):
    sink, snap = fresh_dir(spark, "flog"), fresh_dir(spark, "fsnap")
    rows = spark.range(20_000).select((F.col("id") % 3000).alias("monitor_id"), F.col("id").cast("string").alias("word"), F.lit(1).cast("long").alias("n"))
    changelog.write_batch(rows.repartition(16), sink, 0)
    changelog.compact_totals(spark, sink, ["monitor_id", "word"], ["n"], snap, "monitor_id")
    (run,) = changelog.runs(spark, snap)
    assert run.rows == 20_000 and run.clusters == list(range(changelog.CLUSTERS))
    assert len(spark.read.parquet(f"{snap}/{run.path}").inputFiles()) <= changelog.CLUSTERS


def test_missing_sink_and_foreign_checkpoint(spark, sf_small):
    with pytest.raises(FileNotFoundError):
        jobs.latest(spark, fresh_dir(spark, "nothing"), ["k"], "k string")
    sink, ckpt = fresh_dir(spark, "claimed"), fresh_dir(spark, "ck")
    jobs.claim(spark, sink, ckpt)
    jobs.claim(spark, sink, ckpt + "/")
    with pytest.raises(ValueError):
        jobs.claim(spark, sink, fresh_dir(spark, "other"))
    assert jobs.latest(spark, sink, ["k"], "k string").collect() == []


def test_complete_mode_sink(spark, sf_small):
    """W2 parity mode: every key re-emitted each batch; the latest view is the same."""
    lines = batch.comment_lines(spark, sf_small)
    topic, sink = fresh_dir(spark, "cm"), fresh_dir(spark, "cms")
    topics.write_topic(lines, topic, files=2)
    jobs.run_to_end(jobs.word_cloud(topics.read_topic(spark, topic, max_files_per_trigger=1)), sink,
                    fresh_dir(spark, "cmc"), output_mode="complete", state_partitions=4)
    got = jobs.latest(spark, sink, ["monitor_id", "word"], None)
    cols = ["monitor_id", "word", "n"]
    assert _rows(got, cols) == _rows(batch.word_counts(spark, sf_small), cols)


def test_console_preview(spark, sf_small):
    """K8: the console sink runs (it prints from the JVM, so check the progress)."""
    lines = batch.comment_lines(spark, sf_small)
    topic = fresh_dir(spark, "pv")
    topics.write_topic(lines, topic, files=1)
    q = jobs.preview(jobs.word_cloud(topics.read_topic(spark, topic)), rows=3, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == lines.count()


def test_late_rows_are_written_side_by_side(spark, sf_small, monkeypatch):
    """Each run's events are written by the tasks that read them; the late ones change no total."""
    from moodwatch.plans import streams
    folders, table = {}, streams.fx.table
    monkeypatch.setattr(streams, "fresh_dir", lambda s, n: folders.setdefault(n, fresh_dir(s, n)))
    monkeypatch.setattr(streams.fx, "table", lambda s, d, n: table(s, d, n).repartition(3) if n == "events" else table(s, d, n))
    got = streams.q_stream_late_rows(spark, sf_small)
    assert len(spark.read.parquet(folders["late-events"]).inputFiles()) == 6
    assert got.agg({"hour": "min"}).first()[0] >= table(spark, sf_small, "events").selectExpr("cast(date_trunc('HOUR', min(ts)) as timestamp_ntz)").first()[0]


def test_comment_topic_moves_each_text_once(spark, sf_small):
    """The topic is written in the parts of the join, and re-sent lines are those of the first segment."""
    from moodwatch.plans import batch, streams
    from moodwatch.sources import topics
    lines = batch.comment_lines(spark, sf_small, parts=6)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert lines.rdd.getNumPartitions() == 6 and "RoundRobin" not in plan
    want = sorted(r.value for r in batch.comment_lines(spark, sf_small).collect())
    sent = topics.read_topic(spark, streams._comment_topic(spark, sf_small, copies=2), stream=False)
    for segment in (0, 1):
        assert sorted(r.value for r in sent.where(sent.segment == segment).collect()) == want

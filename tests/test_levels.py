"""Levelled compaction of the change log, and reads of one key that prune it."""

import math
import re

import pytest
from pyspark.sql import functions as F

from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.streaming import apps

KEYS = ["monitor_id", "word"]


def _batch(spark, b, rows=200):
    return spark.range(rows).select(F.concat(F.lit("m"), F.col("id") % 20).alias("monitor_id"),
                                    F.concat(F.lit("w"), F.col("id") + 10 * b).alias("word"), F.lit(1).cast("long").alias("n")).coalesce(1)


def _rows(df):
    return sorted(tuple(r) for r in df.select("monitor_id", "word", "n").collect())


@pytest.fixture(scope="module")
def grown(spark):
    """64 batches, compacted one by one: the sink, the snapshot and the rows each compaction wrote."""
    sink, snap, written = fresh_dir(spark, "lv-sink"), fresh_dir(spark, "lv-snap"), []
    for b in range(64):
        changelog.write_batch(_batch(spark, b, 40), sink, b)
        changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id")
        written.append(changelog.runs(spark, snap)[-1])
    return sink, snap, written


def test_rows_are_rewritten_a_logarithmic_number_of_times(spark, grown):
    sink, snap, written = grown
    assert _rows(changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap)) == _rows(changelog.totals_view(spark, sink, KEYS, ["n"]))
    levels = round(math.log(64, changelog.FANOUT)) + 1
    assert sum(r.rows for r in written) <= 64 * 40 * levels  # a full rewrite a batch would be over 32 times all rows
    live = changelog.runs(spark, snap)
    assert len(live) <= (changelog.FANOUT - 1) * levels
    assert [(a.last + 1) for a in live[:-1]] == [b.first for b in live[1:]] and live[0].first == 0 and live[-1].last == 63
    assert max(r.level for r in written) == levels - 1


def test_expire_deletes_what_no_manifest_names(spark, grown):
    sink, snap, _ = grown
    before = _rows(changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap))
    assert len(changelog.names(spark, f"{snap}/{changelog.RUNS}")) == 64
    changelog.expire(spark, sink, snap, keep=0)
    named = {r.path for n in changelog._manifests(spark, snap) for r in changelog._manifest(spark, snap, n)}
    assert set(changelog.names(spark, f"{snap}/{changelog.RUNS}")) == {p.split("/")[1] for p in named}
    assert changelog.batches(spark, sink) == []
    assert _rows(changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap)) == before


def test_newest_row_wins_across_levels(spark):
    sink, snap = fresh_dir(spark, "lw-sink"), fresh_dir(spark, "lw-snap")
    for b in range(9):
        rows = [("a", b), (f"only{b}", b)] + ([("b", None)] if b == 5 else [("b", 1)] if b < 5 else [])
        changelog.write_batch(spark.createDataFrame(rows, "k string, n long"), sink, b)
        changelog.compact(spark, sink, ["k"], snap, cluster_by="k")
    changelog.write_batch(spark.createDataFrame([("a", 99)], "k string, n long"), sink, 9)
    got = {r.k: r.n for r in changelog.latest_view(spark, sink, ["k"], snapshot=snap).collect()}
    assert got == {"a": 99, "b": None} | {f"only{b}": b for b in range(9)}
    assert {r.level for r in changelog.runs(spark, snap)} == {0, 1}
    assert [r.n for r in changelog.latest_view(spark, sink, ["k"], snapshot=snap, of={"k": "only3"}).collect()] == [3]


def test_batch_landing_in_the_middle_of_a_merge(spark, monkeypatch):
    sink, snap = fresh_dir(spark, "lm-sink"), fresh_dir(spark, "lm-snap")
    real = changelog._write_run

    def slow(df, *args):
        out = real(df, *args)
        changelog.write_batch(_batch(spark, 100 + args[3]), sink, args[3] + 1)  # the next batch, while this one is folded
        return out

    monkeypatch.setattr(changelog, "_write_run", slow)
    changelog.write_batch(_batch(spark, 0), sink, 0)
    for _ in range(6):
        changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id")
    assert changelog.latest_version(spark, snap) == 5 and changelog.batches(spark, sink)[-1] == 6
    assert _rows(changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap)) == _rows(changelog.totals_view(spark, sink, KEYS, ["n"]))


def test_half_written_manifest_is_skipped_and_a_second_writer_fails(spark):
    sink, snap = fresh_dir(spark, "lh-sink"), fresh_dir(spark, "lh-snap")
    changelog.write_batch(_batch(spark, 0), sink, 0)
    changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id")
    changelog.write_note(spark, f"{snap}/{changelog.MANIFEST}/{1:012d}", '[{"path": "runs/')
    changelog.write_batch(_batch(spark, 1), sink, 1)
    assert changelog.latest_version(spark, snap) == 0
    assert changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id") == 1
    assert _rows(changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap)) == _rows(changelog.totals_view(spark, sink, KEYS, ["n"]))
    with pytest.raises(Exception, match="exist"):
        changelog.write_note(spark, f"{snap}/{changelog.MANIFEST}/{2:012d}", "[]")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_key_reads_one_folder(spark):
    sink, snap = fresh_dir(spark, "lp-sink"), fresh_dir(spark, "lp-snap")
    for b in range(2):
        changelog.write_batch(_batch(spark, b, 5000), sink, b)
        apps.compact_sink(spark, "words", sink, snap)
    changelog.write_batch(_batch(spark, 2, 5000), sink, 2)
    got = apps.read_word(spark, sink, "m7", "w27", snapshot=snap)
    assert _rows(got) == [("m7", "w27", 2)]  # as word 27 of batch 0 and 7 of batch 2
    plan = _plan(got)
    assert plan.count(f"PartitionFilters: [isnotnull({changelog.CLUSTER}") == 2
    assert "EqualTo(monitor_id,m7)" in plan and "EqualTo(word,w27)" in plan
    files = {f.split(f"{changelog.CLUSTER}=")[1].split("/")[0] for r in changelog.runs(spark, snap)
             for f in changelog._read_run(spark, snap, r, {"monitor_id": "m7"}).inputFiles()}
    assert len(files) >= 1
    cloud = apps.read_word_cloud(spark, sink, "m7", snapshot=snap)
    assert sorted(tuple(r) for r in cloud.collect()) == [r for r in _rows(changelog.totals_view(spark, sink, KEYS, ["n"])) if r[0] == "m7"]


def test_missing_cluster_reads_no_run(spark):
    sink, snap = fresh_dir(spark, "lc-sink"), fresh_dir(spark, "lc-snap")
    changelog.write_batch(spark.createDataFrame([("m1", "a", 1)], "monitor_id string, word string, n long"), sink, 0)
    apps.compact_sink(spark, "words", sink, snap)
    (run,) = changelog.runs(spark, snap)
    others = [m for m in (f"x{i}" for i in range(40)) if changelog._read_run(spark, snap, run, {"monitor_id": m}) is None]
    assert len(others) > 20 and len(run.clusters) == 1
    assert apps.read_word(spark, sink, others[0], "a", snapshot=snap).collect() == []


def test_text_keys_have_bloom_filters(spark):
    sink, snap = fresh_dir(spark, "lb-sink"), fresh_dir(spark, "lb-snap")
    # more different text than a dictionary page holds (a dictionary prunes as well, and then takes the filter's place)
    many = spark.range(12_000).select(F.lit("m1").alias("monitor_id"), F.concat(F.sha2(F.col("id").cast("string"), 512), "id").alias("word"),
                                      F.lit(1).cast("long").alias("n"))
    changelog.write_batch(many, sink, 0)
    apps.compact_sink(spark, "words", sink, snap)
    (run,) = changelog.runs(spark, snap)
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(spark.read.parquet(f"{snap}/{run.path}").inputFiles()[0])
    hadoop = jvm.org.apache.parquet.hadoop
    reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(file, spark.sparkContext._jsc.hadoopConfiguration()))
    chunks = reader.getFooter().getBlocks().get(0).getColumns()
    filters = {c.getPath().toDotString(): c.getBloomFilterOffset() > 0 for c in (chunks.get(i) for i in range(chunks.size()))}
    reader.close()
    assert filters["word"] and not filters["n"]


def test_batches_without_rows(spark):
    sink, snap = fresh_dir(spark, "le-sink"), fresh_dir(spark, "le-snap")
    for b in range(2):
        changelog.write_batch(_batch(spark, 0, 0), sink, b)
        changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id")
    changelog.expire(spark, sink, snap, keep=0)
    assert changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap).collect() == []
    changelog.write_batch(_batch(spark, 0, 3), sink, 2)
    changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id")
    assert changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap).count() == 3


def _hours(spark, start, n, monitor="m1", step=1):
    return spark.range(n).select(F.lit(monitor).alias("monitor_id"),
                                 F.expr(f"timestamp_ntz'{start}' + make_interval(0, 0, 0, 0, cast(id as int) * {step})").alias("hour"),
                                 F.lit(1).cast("long").alias("positive"), F.lit(0).cast("long").alias("negative"), F.lit(2).cast("long").alias("neutral"))


def test_trend_of_one_monitor_reads_the_newest_days_only(spark):
    sink, snap = fresh_dir(spark, "ld-sink"), fresh_dir(spark, "ld-snap")
    for b, start in enumerate(("2024-01-01 00:00:00", "2024-03-01 00:00:00", "2024-05-01 00:00:00")):
        # m1 has every hour, m2 one hour in a week
        both = _hours(spark, start, 24 * 40).unionByName(_hours(spark, start, 6, "m2", 24 * 7))
        changelog.write_batch(both, sink, b)
        apps.compact_sink(spark, "trend", sink, snap)
    changelog.write_batch(_hours(spark, "2024-06-09 20:00:00", 6), sink, 3)  # repeats four hours of the last run
    whole = {m: [r for r in sorted(changelog.totals_view(spark, sink, ["monitor_id", "hour"], ["positive", "negative", "neutral"]).collect(),
                                   key=lambda r: r.hour) if r.monitor_id == m] for m in ("m1", "m2")}
    for m, n in (("m1", 50), ("m1", 5), ("m1", 2000), ("m2", 50), ("m2", 7), ("m3", 50)):
        got = apps.read_trend(spark, sink, m, points=n, snapshot=snap)
        assert [(r.hour, r.positive, r.neutral) for r in got.collect()] == [(r.hour, r.positive, r.neutral) for r in whole.get(m, [])[-n:]], (m, n)
    view = apps._trend(spark, sink, "m1", False, 50, snap)
    plan = _plan(view)
    since = re.findall(rf"PartitionFilters: \[[^\]]*{changelog.DAY}#\d+ >= (\d{{4}}-\d\d-\d\d)", plan)
    assert len(since) == 3 and min(since) >= "2024-06-06"
    read = changelog._with_snapshot(spark, sink, snap, of={"monitor_id": "m1"}, since=since[0]).select(F.input_file_name().alias("f")).distinct()
    days = {r.f.split(f"{changelog.DAY}=")[1].split("/")[0] for r in read.collect() if changelog.DAY in r.f}
    assert len(days) <= 4 and min(days) >= "2024-06-06"
    series = apps.read_series(spark, sink, "m1", snapshot=snap).first()
    assert len(series.x) == 50 and series.y1[-1] == 1
    (run,) = [r for r in changelog.runs(spark, snap) if r.last == 2]
    assert run.days[0] == "2024-05-01" and run.days[-1] == "2024-06-09"


def test_totals_are_folded_where_they_are_laid_out(spark, monkeypatch):
    """A clustered run of totals takes one shuffle, that of its layout."""
    sink, snap, plans = fresh_dir(spark, "lo-sink"), fresh_dir(spark, "lo-snap"), []
    real = changelog._write_run

    def seen(df, *args):
        plans.append(_plan(df))
        return real(df, *args)

    monkeypatch.setattr(changelog, "_write_run", seen)
    for b in range(5):  # the fourth is merged with the runs before it
        changelog.write_batch(_batch(spark, b).unionByName(spark.createDataFrame([(None, None, 1), (None, "w", None)], "monitor_id string, word string, n long")), sink, b)
        changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id")
    assert all(p.count("Exchange") == 1 and f"Exchange hashpartitioning({changelog.CLUSTER}" in p for p in plans), plans
    got = {tuple(r) for r in changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap).collect()}
    assert got == {tuple(r) for r in changelog.totals_view(spark, sink, KEYS, ["n"]).collect()}
    assert (None, None, 5) in got and (None, "w", None) in got
    assert all(set(spark.read.parquet(f"{snap}/{r.path}").columns) == {*KEYS, "n", changelog.CLUSTER} for r in changelog.runs(spark, snap))


@pytest.mark.parametrize("fold", ["totals", "latest"])
def test_splits_of_a_run_grow_with_its_rows(spark, monkeypatch, fold):
    """A cluster's rows, here all, are written by more tasks the more rows there are, from the first level on."""
    monkeypatch.setattr(changelog, "SPLIT_ROWS", 500, raising=False)
    for rows, least, most in ((400, 1, 1), (5000, 5, 10)):
        sink, snap = fresh_dir(spark, "sg-sink"), fresh_dir(spark, "sg-snap")
        changelog.write_batch(spark.range(rows).selectExpr("'m' AS monitor_id", "concat('w', id) AS word", "id AS n"), sink, 0)
        if fold == "totals":
            changelog.compact_totals(spark, sink, KEYS, ["n"], snap, "monitor_id")
            view = changelog.totals_view(spark, sink, KEYS, ["n"], snapshot=snap)
        else:
            changelog.compact(spark, sink, KEYS, snapshot=snap, cluster_by="monitor_id")
            view = changelog.latest_view(spark, sink, KEYS, snapshot=snap)
        (run,) = changelog.runs(spark, snap)
        assert least <= len(spark.read.parquet(f"{snap}/{run.path}").inputFiles()) <= most
        assert _rows(view) == sorted(("m", f"w{i}", i) for i in range(rows))


def test_topic_has_the_files_of_its_batches(spark, tmp_path):
    """As many files as asked for, where the session has more shuffle partitions."""
    from moodwatch.plans import streams
    from moodwatch.sources import topics
    d, path = str(tmp_path), fresh_dir(spark, "tf-topic")
    ids = spark.range(300)
    ids.selectExpr("id AS doc_id", "concat('text ', id) AS text", "'s' AS source").write.parquet(f"{d}/documents.parquet")
    ids.selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "1.0D AS value").write.parquet(f"{d}/events.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for segment in range(2):
            streams._send_comments(spark, d, path, segment, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sent = topics.read_topic(spark, path, stream=False)
    assert sent.count() == 600 and len(sent.inputFiles()) <= 8
    sizes = {k: sorted(r.n for r in sent.where(F.col("segment") == k).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) for k in (0, 1)}
    assert len(sizes[0]) == 4 and sizes[0] == sizes[1]  # re-sent in files of the same sizes
    assert sent.select("segment", "value").distinct().count() == 600

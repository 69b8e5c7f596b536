"""Exact deduplication by a ledger of event days."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import ledger

SCHEMA = "comment_id string, ts timestamp_ntz, n int, event string"


class Run:
    def __init__(self, spark):
        self.spark = spark
        self.source, self.sink, self.book, self.ckpt = (fresh_dir(spark, n) for n in ("ld-src", "ld-sink", "ld-book", "ld-ck"))

    def send(self, *rows):
        self.spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

    def run(self):
        rows = topics.read_table_stream(self.spark, self.source, self.spark.createDataFrame([], SCHEMA).schema, 1)
        q = ledger.dedup_app(rows, self.sink, self.book, self.ckpt, available_now=True)
        q.awaitTermination()
        return q

    def got(self):
        return sorted((r.comment_id, r.n) for r in changelog.read_log(self.spark, self.sink).collect() if r.comment_id) + \
            [r.n for r in changelog.read_log(self.spark, self.sink).collect() if not r.comment_id]


def day(k, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=k)


def test_repeats_of_any_age_are_dropped(spark):
    r = Run(spark)
    r.send(("a", day(0), 1), ("b", day(0, 5), 2), ("a", day(0), 1), (None, day(0), 7))
    r.run()
    r.send(("c", day(400), 3), ("b", day(0, 5), 9), (None, day(0), 7))  # a year later, b again
    r.run()
    r.send(("a", day(0), 9), ("c", day(400), 9), ("d", None, 4))
    r.run()
    r.send(("d", None, 9), ("a", day(1), 5))  # the same id on another day is another event
    q = r.run()
    assert r.got() == [("a", 1), ("a", 5), ("b", 2), ("c", 3), ("d", 4), 7, 7]
    assert all(not p["stateOperators"] for p in q.recentProgress)


def test_only_the_days_of_a_batch_are_read(spark):
    book = fresh_dir(spark, "ld-days")
    for b in range(5):
        rows = spark.createDataFrame([(f"k{b}", day(b))], "comment_id string, ts timestamp_ntz")
        ledger.enter(ledger._dated(rows, "comment_id", "ts"), b, book)
    named = ledger._dated(spark.createDataFrame([("k3", day(3)), ("x", day(3)), ("y", day(9))], "comment_id string, ts timestamp_ntz"), "comment_id", "ts")
    fresh = ledger.unseen(named, 7, book)
    assert sorted(r.comment_id for r in fresh.collect()) == ["x", "y"]
    seen = ledger._seen(spark, book, [day(3).date(), day(9).date()], 7)
    assert len(seen.inputFiles()) == 1 and "event_day=2024-01-04" in seen.inputFiles()[0]
    assert ledger._seen(spark, book, [day(3).date()], 3).collect() == []  # a replayed batch doesn't see itself


@pytest.mark.parametrize("lost", ["sink", "ledger"])
def test_replay_writes_the_same(spark, monkeypatch, lost):
    r = Run(spark)
    r.send(("a", day(0), 1))
    r.run()
    r.send(("a", day(0), 9), ("b", day(0), 2))
    name, owner = ("write_batch", changelog) if lost == "sink" else ("enter", ledger)
    real, seen = getattr(owner, name), []

    def flaky(df, *args):
        real(df, *args)
        if not seen:
            seen.append(1)
            raise RuntimeError("lost after writing")

    monkeypatch.setattr(owner, name, flaky)
    with pytest.raises(StreamingQueryException):
        r.run()
    r.run()
    r.send(("b", day(0), 9))
    r.run()
    assert r.got() == [("a", 1), ("b", 2)]


def test_hot_key_is_one_row(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("comment_id"), F.lit(day(0)).cast("timestamp_ntz").alias("ts"), F.col("id").alias("n"))
    named = ledger._dated(rows.repartition(8), "comment_id", "ts")
    assert ledger.unseen(named, 0, fresh_dir(spark, "ld-hot")).count() == 1

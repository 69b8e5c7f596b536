"""Ingest as a stream: responses in any order, replays, and what is too late."""

import json

from pyspark.sql import functions as F

from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import ingest

RESPONSE = "url string, raw string, fetched_at timestamp"
ANSWER = "post_id long, raw string, fetched_at timestamp"


class Crawl:
    def __init__(self, spark):
        self.spark = spark
        self.base, self.ckpt, self.searched, self.answered = (fresh_dir(spark, n) for n in ("in-base", "in-ck", "in-s", "in-a"))
        for f in (self.searched, self.answered):
            changelog.create(spark, f)
        self.owners = spark.createDataFrame([("u1", 10), ("u2", 20)], "url string, monitor_id long")

    def _send(self, folder, schema, rows):
        df = self.spark.createDataFrame([(k, raw, minute) for k, raw, minute in rows], schema.replace("fetched_at timestamp", "m int"))
        (df.withColumn("fetched_at", F.timestamp_add("MINUTE", "m", F.lit("2024-01-01 00:00:00").cast("timestamp"))).drop("m")
         .coalesce(1).write.mode("append").parquet(folder))

    def search(self, *rows):
        """(url, post id, minute)"""
        self._send(self.searched, RESPONSE, [(u, json.dumps({"data": {"cards": [{"mblog": {"id": p, "mid": p, "text": "<b>t</b>", "user": {"id": f"w{p}"}}}]}}), m)
                                             for u, p, m in rows])

    def answer(self, *rows):
        """(post id, comment id, minute)"""
        self._send(self.answered, ANSWER, [(p, json.dumps({"data": {"data": [{"id": c, "text": "x", "like_count": 1, "user": {"id": f"r{c}"}}]}}), m) for p, c, m in rows])

    def run(self):
        read = [topics.read_table_stream(self.spark, f, self.spark.createDataFrame([], s).schema) for f, s in ((self.searched, RESPONSE), (self.answered, ANSWER))]
        q = ingest.ingest_app(*read, self.owners, self.base, self.ckpt, "1 hour", available_now=True, state_partitions=2)
        q.awaitTermination()
        return q

    def lines(self, topic):
        return sorted(r.value for r in topics.read_topic(self.spark, f"{self.base}/{topic}", stream=False).collect())


def test_comments_before_and_after_their_post(spark):
    c = Crawl(spark)
    c.answer((1, 100, 0), (9, 900, 0))
    c.run()
    c.search(("u1", 1, 10), ("u2", 2, 10), ("unknown", 3, 10))
    c.run()
    c.answer((2, 200, 20), (1, 101, 30), (3, 300, 30))
    c.run()
    assert [x.split("|")[:2] for x in c.lines("com")] == [["100", "10"], ["101", "10"], ["200", "20"]]
    assert [x.split("|")[:3] for x in c.lines("wz")] == [["1", "10", "w1"], ["2", "20", "w2"]]
    assert [x.split("|")[0] for x in c.lines("user")] == ["r100", "r101", "r200", "w1", "w2"]


def test_a_post_seen_twice_tags_a_comment_once(spark):
    c = Crawl(spark)
    c.search(("u1", 1, 0), ("u1", 1, 5), ("u2", 1, 6))
    c.answer((1, 100, 10))
    c.run()
    assert [x.split("|")[1] for x in c.lines("com")] == ["10", "20"]  # once a monitor
    assert len(c.lines("wz")) == 3


def test_state_is_dropped_behind_the_watermark(spark):
    c = Crawl(spark)
    c.search(("u1", 1, 0))
    c.answer((1, 100, 5))
    c.run()
    c.search(("u1", 2, 600))
    c.answer((2, 200, 600))
    c.run()
    c.search(("u1", 3, 601))
    c.answer((1, 101, 602), (3, 300, 602))  # post 1 is ten hours old
    q = c.run()
    assert [x.split("|")[0] for x in c.lines("com")] == ["100", "200", "300"]
    rows = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in q.recentProgress]
    assert rows[-1] <= 8


def test_a_finished_batch_is_not_written_again(spark):
    path = fresh_dir(spark, "in-batch")
    topics.write_topic_batch(spark.createDataFrame([("a",)], "value string"), path, 3)
    topics.write_topic_batch(spark.createDataFrame([("b",)], "value string"), path, 3)
    topics.write_topic_batch(spark.createDataFrame([("c",)], "value string"), path, 4)
    assert sorted((r.value, r.segment) for r in topics.read_topic(spark, path, stream=False).collect()) == [("a", 3), ("c", 4)]


def test_owners_are_computed_once_a_start(spark):
    """A micro-batch reads the finished owners, not the tables that they are made of."""
    table = fresh_dir(spark, "in-owned")
    c = Crawl(spark)
    c.owners.write.parquet(table)
    c.owners = spark.read.parquet(table).groupBy("url").agg(F.max("monitor_id").alias("monitor_id"))
    c.search(("u1", 1, 0))
    c.answer((1, 100, 1))
    plan = c.run()._jsq.explainInternal(False)
    assert "TransformWithState" not in plan and "StreamingSymmetricHashJoin" in plan and "max(monitor_id" not in plan
    assert [x.split("|")[:2] for x in c.lines("com")] == [["100", "10"]]


def test_last_keywords_have_all_owners(spark):
    from moodwatch.operators import monitors
    words = spark.createDataFrame([(3, "a,b"), (1, "b,c,b"), (2, "a"), (None, "d,a"), (2, "a"), (9, None)], "monitor_id long, words string")
    keywords = monitors.keyword_explode(words)
    last = monitors.last_keywords(keywords)
    assert last.count() == 4
    got, want = (sorted(map(tuple, monitors.url_owner(monitors.url_frontier(k)).collect()), key=str) for k in (last, keywords))
    assert got == want

"""Genders as of arrival, from keyed state."""

import random

import pytest

from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import arrival

WHEN = "Mon Jan 01 10:00:00 +0800 2024"


class System:
    """Two topics, a sink and a model of it: genders by user, counts by (monitor, gender)."""

    def __init__(self, spark, hot=None):
        self.spark, self.hot, self.sent = spark, hot, 0
        self.com, self.usr, self.sink, self.ckpt = (fresh_dir(spark, n) for n in ("ar-com", "ar-usr", "ar-sink", "ar-ck"))
        changelog.create(spark, self.com)
        changelog.create(spark, self.usr)
        self.known, self.want = {}, {}

    def _send(self, path, lines, files=1):
        self.sent += 1
        topics.write_topic(self.spark.createDataFrame([(x,) for x in lines], "value string"), path, segment=self.sent, files=files)

    def profiles(self, *rows):
        self._send(self.usr, [f"{u}|name|{g}|about|1|1" for u, g in rows])
        self.known |= {str(u): g for u, g in rows if u is not None}

    def comments(self, *rows, files=2):
        self._send(self.com, [f"{i}|{m}|{WHEN}|1|{u}|text" for i, (m, u) in enumerate(rows)], files)
        self.pending = rows

    def run(self):
        q = arrival.gender_app(topics.read_topic(self.spark, self.com), topics.read_topic(self.spark, self.usr), self.sink, self.ckpt,
                               self.hot, available_now=True, state_partitions=4)
        q.awaitTermination()
        for m, u in getattr(self, "pending", ()):
            key = m, self.known.get(str(u))
            self.want[key] = self.want.get(key, 0) + 1
        self.pending = ()
        return q

    def check(self):
        got = changelog.totals_view(self.spark, self.sink, ["monitor_id", "gender"], ["n"]).collect()
        assert {(r.monitor_id, r.gender): r.n for r in got} == self.want


def test_profile_later_than_the_first_comment(spark):
    s = System(spark)
    s.comments(("m1", 7), ("m1", None), ("m2", 8))
    s.run()
    s.check()  # nobody is known yet
    s.profiles((7, "m"), (8, "f"), (9, None))
    s.run()
    s.comments(("m1", 7), ("m2", 8), ("m2", 9), ("m2", 10), ("m1", None))
    s.run()  # restarted from the checkpoint: the genders come from the state
    s.check()
    s.profiles((7, "f"), (7, "m"), (7, "f"))
    s.comments(("m1", 7), ("m1", 7), ("m3", 7))
    s.run()  # a batch's profiles arrive before its comments, and the newest one counts
    s.check()


def test_hot_users_and_restarts_equal_the_model(spark):
    rng = random.Random(3)
    s = System(spark, hot=[1, "2"])
    for step in range(3):
        s.profiles(*[(u, rng.choice("mf")) for u in rng.sample(range(12), 5)])
        users = [1] * 60 + [2] * 20 + [None] * 20 + [rng.randrange(14) for _ in range(40)]
        rng.shuffle(users)
        s.comments(*[(f"m{rng.randrange(4)}", u) for u in users])
        s.run()
        s.check()
    s.hot = None
    s.comments(("m1", 1))
    s.run()  # without a list the sink's own one is used
    s.check()
    s.hot = [1]
    with pytest.raises(ValueError, match="hot"):
        s.run()


def test_hot_comments_are_dealt_over_keys(spark):
    lines = spark.createDataFrame([(f"{i}|m|{WHEN}|1|1|text",) for i in range(500)], "value string")
    path = fresh_dir(spark, "ar-dealt")
    topics.write_topic(lines, path, files=1)
    comments = topics.read_topic(spark, path, stream=False).withColumn("user_id", arrival.F.lit("1"))
    salted, profiles = arrival._salted(comments, comments.limit(1), ["1"])
    assert salted.groupBy("salt").count().agg({"count": "max"}).first()[0] < 100
    assert profiles.count() == arrival.SALTS


def test_a_batch_scans_no_profile_log(spark):
    s = System(spark)
    s.profiles((7, "m"))
    s.run()
    s.comments(("m1", 7))
    q = s.run()
    s.check()
    read = [p["sources"] for p in q.recentProgress if p["numInputRows"]]
    assert [x["numInputRows"] for x in read[-1] if s.usr in x["description"]] == [0]
    plan = q._jsq.explainInternal(False)
    assert "TransformWithState" in plan and s.sink not in plan and "Join" not in plan


def test_too_many_hot_users(spark):
    with pytest.raises(ValueError):
        System(spark, hot=range(arrival.MAX_HOT + 1)).run()


def test_the_operator_is_called_by_bucket_not_by_user(spark, monkeypatch):
    """500 profiles and comments in 8 buckets: 8 keys in the state operator's input, all users known."""
    monkeypatch.setattr(arrival, "BUCKETS", 8)
    s = System(spark)
    s.profiles(*[(u, "mf"[u % 2]) for u in range(0, 500, 2)], *[(u, "f") for u in range(1, 500, 2)])
    s.run()
    s.comments(*[(f"m{u % 3}", u) for u in range(600)])
    q = s.run()
    s.check()
    assert "user_id" not in arrival.KEYS
    lines = topics.read_topic(spark, s.com, stream=False)
    comments = arrival.records.decode_comments(lines).select("user_id")
    assert comments.select(arrival.bucket("user_id")).distinct().count() == 8
    assert "bucket" in q._jsq.explainInternal(False)

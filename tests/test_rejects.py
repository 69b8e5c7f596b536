"""Dead letters of the running apps: accepted and rejected rows of a batch land together."""

import pytest
from pyspark.errors import StreamingQueryException

from moodwatch import cli
from moodwatch.operators import metrics, records, text
from moodwatch.plans import batch, streams
from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import apps, arrival

WHEN = "Mon Jan 01 10:00:00 +0800 2024"


def _rejects(spark, sink):
    return sorted((r.value, r.reason) for r in apps.read_rejects(spark, sink).collect())


@pytest.mark.parametrize("lost", ["rejects", "totals"])
def test_split_equals_batch_after_a_replay(spark, sf_small, monkeypatch, lost):
    lines = streams.mangled_lines(spark, sf_small)
    topic, sink, bad, ckpt = (fresh_dir(spark, n) for n in ("rj-topic", "rj-sink", "rj-bad", "rj-ck"))
    topics.write_topic(lines, topic, files=4)
    real, seen = changelog.write_batch, []

    def flaky(df, path, batch_id, seq=None):
        real(df, path, batch_id, seq)
        if batch_id == 1 and path == (bad if lost == "rejects" else sink) and not seen:
            seen.append(path)
            raise RuntimeError("lost after writing")

    monkeypatch.setattr(changelog, "write_batch", flaky)

    def run():
        apps.word_cloud_app(topics.read_topic(spark, topic, max_files_per_trigger=1), sink, ckpt, available_now=True,
                            rejects=bad).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert seen and changelog.batches(spark, sink) == changelog.batches(spark, bad) == [0, 1, 2, 3]
    want = metrics.word_counts(text.explode_tokens(text.segment(records.decode_comments(lines)), ["monitor_id"]))
    got = apps.read_word_cloud(spark, sink)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("monitor_id", "word", "n").collect()))
    rejected = sorted((r.value, r.reason) for r in records.comment_rejects(lines).collect())
    assert _rejects(spark, bad) == rejected and len({r for _, r in rejected}) == 2


def test_every_app_keeps_its_rejects(spark, sf_small):
    com, usr = fresh_dir(spark, "rj-com"), fresh_dir(spark, "rj-usr")
    good, short = f"abc|m1|{WHEN}|1|u77|text", "1|m1"
    topics.write_topic(spark.createDataFrame([(good,), (short,)], "value string"), com, files=1)
    topics.write_topic(spark.createDataFrame([("u77|n|f|d|1|1",), ("u78|",)], "value string"), usr, files=1)
    out = {n: (fresh_dir(spark, f"rj-{n}"), fresh_dir(spark, f"rj-{n}-ck"), fresh_dir(spark, f"rj-{n}-bad"))
           for n in ("trend", "gender", "users", "arrival")}

    def start(app, name, *args):
        sink, ckpt, bad = out[name]
        app(*args, sink, ckpt, available_now=True, rejects=bad).awaitTermination()
        return sink

    read = lambda path: topics.read_topic(spark, path)
    start(apps.sentiment_app, "trend", read(com), batch.trained_model(spark, sf_small))
    profiles = apps.read_profiles(spark, start(apps.profile_app, "users", read(usr)))
    assert [(r.user_id, r.gender) for r in profiles.collect()] == [("u77", "f")]
    for name, app, second in (("gender", apps.gender_app, profiles), ("arrival", arrival.gender_app, read(usr))):
        sink = start(app, name, read(com), second)
        assert [tuple(r) for r in changelog.totals_view(spark, sink, ["monitor_id", "gender"], ["n"]).collect()] == [("m1", "f", 1)]
    for name, want in (("trend", [(short, "arity")]), ("gender", [(short, "arity")]), ("users", [("u78|", "arity")]),
                       ("arrival", [(short, "arity"), ("u78|", "arity")])):
        assert _rejects(spark, out[name][2]) == want, name


def test_no_rejects_where_repeats_are_dropped_or_state_is_kept(spark):
    path = fresh_dir(spark, "rj-none")
    changelog.create(spark, path)
    lines = topics.read_topic(spark, path)
    with pytest.raises(ValueError):
        apps.word_cloud_app(lines, "s", "c", rejects="r", dedup=True)
    with pytest.raises(ValueError):
        apps.word_cloud_app(lines, "s", "c", rejects="r", stateful=True)


def test_cli_rejects_and_gender_as_of_arrival(spark):
    com, usr, sink, bad = (fresh_dir(spark, n) for n in ("rc-com", "rc-usr", "rc-sink", "rc-bad"))
    topics.write_topic(spark.createDataFrame([(f"a|m1|{WHEN}|1|u1|t",), (f"b|m1|{WHEN}|1|u2|t",), ("x",)], "value string"), com, files=1)
    topics.write_topic(spark.createDataFrame([("u1|n|m|d|1|1",)], "value string"), usr, files=1)
    cli.main(["gender", "--topic", com, "--users-topic", usr, "--sink", sink, "--hot", "u1,u9", "--once", "--rejects", bad], spark)
    shown = cli.main(["show", "--what", "rejects", "--sink", bad], spark)
    assert [(r.value, r.reason) for r in shown.collect()] == [("x", "arity")]
    shares = cli.main(["show", "--what", "gender", "--sink", sink, "--monitor", "m1"], spark)
    assert sorted((r.name, r.value) for r in shares.collect()) == [("其它", 1), ("男", 1)]

"""A micro-batch that fails after its output was written is replayed on restart
and replaces that output: totals stay exactly-once."""

import pytest
from pyspark.errors import StreamingQueryException

from moodwatch.plans import batch
from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import jobs


def _flaky_writes(monkeypatch, fail_batch=1):
    real = changelog.write_batch
    seen = {"failed": False}

    def flaky(df, path, batch_id, seq=None):
        real(df, path, batch_id, seq)
        if batch_id == fail_batch and not seen["failed"]:
            seen["failed"] = True
            raise RuntimeError("lost after writing the batch, before the commit")

    monkeypatch.setattr(changelog, "write_batch", flaky)
    return seen


def _rows(df):
    return sorted((r.monitor_id, r.word, r.n) for r in df.collect())


@pytest.mark.parametrize("stateful", [False, True])
def test_replay_after_failure_is_exactly_once(spark, sf_small, monkeypatch, stateful):
    lines = batch.comment_lines(spark, sf_small)
    topic, sink, ckpt = fresh_dir(spark, "ft"), fresh_dir(spark, "fs"), fresh_dir(spark, "fc")
    topics.write_topic(lines, topic, files=3)
    seen = _flaky_writes(monkeypatch)

    def run():
        src = topics.read_topic(spark, topic, max_files_per_trigger=1)
        if stateful:
            q = jobs.upsert(jobs.word_cloud(src), sink, ckpt, available_now=True, state_partitions=4)
        else:
            q = jobs.delta_upsert(jobs.word_rows(src), ["monitor_id", "word"], None, sink, ckpt, available_now=True)
        q.awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert seen["failed"]
    run()  # restart from the checkpoint: batch 1 runs again and overwrites its folder
    got = (jobs.latest(spark, sink, ["monitor_id", "word"], None) if stateful
           else changelog.totals_view(spark, sink, ["monitor_id", "word"], ["n"]))
    assert _rows(got) == _rows(batch.word_counts(spark, sf_small))

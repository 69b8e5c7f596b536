"""Streaming jobs (W1-W9) and their sinks (K2-K5, K7, K8).

The running totals are ordinary streaming aggregations: Spark keeps per-key
state in the state store (RocksDB when configured) and, in ``update`` mode,
emits the keys a micro-batch changed.  Each emitted batch goes through
``foreachBatch`` into the change log of :mod:`moodwatch.sinks.changelog`
(overwrite of ``batch_id=<id>``), so a replayed batch replaces itself and the
checkpoint makes the pipeline exactly-once.  One checkpoint folder per query;
``spark.sql.shuffle.partitions`` is fixed for the life of a checkpoint.

Additive totals can skip the state store altogether (:func:`delta_upsert`):
each micro-batch is aggregated on its own inside ``foreachBatch`` and the read
side sums the per-batch deltas.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodwatch.functions.constants import LABEL_NEGATIVE, LABEL_NEUTRAL, LABEL_POSITIVE
from moodwatch.operators import metrics, model, records, text
from moodwatch.sinks import changelog

DEFAULT_TRIGGER = "5 seconds"


# --- stream definitions (pure DataFrame -> DataFrame) -----------------------------
def comments(lines: DataFrame, clock12: bool = False, dedup: bool = False,
             dedup_within: str | None = None, keep_invalid: bool = False) -> DataFrame:
    """R7+R8 on a topic.  ``dedup`` drops repeated comment ids (W9): with
    ``dedup_within`` (a delay such as ``'1 day'``) state is bounded by an event
    time watermark, otherwise it is kept for every id ever seen.  ``keep_invalid`` keeps
    lines that can't be decoded, with a ``_reason``, for a reject sink."""
    c = records.decode_comments(lines.select("value"), clock12=clock12, keep_invalid=keep_invalid)
    if keep_invalid and (dedup or dedup_within):
        raise ValueError("a reject has no comment id: rejects can't be kept where repeats are dropped")
    if dedup_within:
        return (c.withColumn("event_time", F.col("ts").cast("timestamp"))
                .withWatermark("event_time", dedup_within)
                .dropDuplicatesWithinWatermark(["comment_id"]).drop("event_time"))
    if dedup:
        return c.dropDuplicates(["comment_id"])
    return c


def word_cloud(lines: DataFrame, **kw) -> DataFrame:
    """L2: running (monitor_id, word) -> n."""
    return metrics.word_counts(text.explode_tokens(text.segment(comments(lines, **kw)), ["monitor_id"]))


def trend(lines: DataFrame, fitted: PipelineModel, **kw) -> DataFrame:
    """L1: running (monitor_id, hour) -> positive, negative, neutral.  The model
    is bound when the stream is defined (loaded once, not per batch)."""
    scored = model.neutral_band(model.score(fitted, comments(lines, **kw)))
    return metrics.trend_wide(scored)


def gender(lines: DataFrame, profiles: DataFrame, hot: DataFrame | None = None, **kw) -> DataFrame:
    """L3: stream-static join with the profile view, then running counts.
    Gender is resolved when a comment arrives (a later profile change does not
    revise counts already made).  ``hot`` user ids are salted over many tasks."""
    return metrics.gender_counts(metrics.gender_join(comments(lines, **kw), profiles, hot))


def windowed_trend(labelled: DataFrame, event_time: str = "created_at", watermark: str = "1 hour") -> DataFrame:
    """W7/W8 with a watermark: tumbling one-hour windows, state dropped once the
    watermark passes a window; rows later than the watermark are ignored."""
    def n(v):
        return F.sum(F.when(F.col("label") == F.lit(v), 1).otherwise(0)).cast("bigint")

    t = labelled.withColumn("_et", F.col(event_time).cast("timestamp")).withWatermark("_et", watermark)
    return (t.groupBy("monitor_id", F.window("_et", "1 hour").alias("w"))
            .agg(n(LABEL_POSITIVE).alias("positive"), n(LABEL_NEGATIVE).alias("negative"),
                 n(LABEL_NEUTRAL).alias("neutral"))
            .select("monitor_id", F.col("w.start").cast("timestamp_ntz").alias("hour"),
                    "positive", "negative", "neutral"))


def split_word_count(lines: DataFrame, sep: str = ",") -> DataFrame:
    """A5 on a line stream: ``a,b,c`` lines -> running word -> n."""
    return metrics.word_counts(text.split_words(lines, "value", sep), keys=("word",))


# --- sinks ----------------------------------------------------------------------------
def claim(spark, sink: str, checkpoint: str) -> None:
    """Bind a sink to one checkpoint.  Batch ids count from 0 in every checkpoint, so a second
    query, or the same one with a new checkpoint, would overwrite batches of the first: the
    sink's first writer leaves its checkpoint's path there, and any other is refused."""
    changelog.create(spark, sink)
    mine, owner = checkpoint.rstrip("/"), changelog.read_note(spark, f"{sink}/_writer")
    if owner is None:
        changelog.write_note(spark, f"{sink}/_writer", mine)
    elif owner != mine:
        raise ValueError(f"{sink} is written with the checkpoint {owner}, not {checkpoint}")


def _claim_all(spark, checkpoint: str, *sinks: str | None) -> None:
    for sink in sinks:
        if sink is not None:
            claim(spark, sink, checkpoint)


@contextmanager
def settings(spark, conf: dict[str, str]):
    """Session settings that hold while a query starts (it keeps them)."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def accepted(batch: DataFrame, batch_id: int, rejects: str | None):
    """The valid rows of a micro-batch.  With a reject sink the batch is decoded once: it is
    kept while rows with a ``_reason`` go there, as (value, reason) under the same batch id,
    and the others to wherever the caller writes them."""
    if rejects is None:
        yield batch
        return
    batch.persist()
    try:
        bad = batch.where("_reason is not null").select("value", F.col("_reason").alias("reason"))
        changelog.write_batch(bad, rejects, batch_id)
        yield batch.where("_reason is null").drop("_reason", "value")
    finally:
        batch.unpersist()


def upsert(df: DataFrame, sink: str, checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
           available_now: bool = False, output_mode: str = "update", name: str | None = None,
           state_partitions: int | None = None, rejects: str | None = None) -> StreamingQuery:
    """K3/K4/K5 (running totals) and K2/K7 (rows, ``output_mode='append'``):
    every micro-batch is written to ``sink`` as ``batch_id=<id>``; ``rejects`` as in
    :func:`delta_upsert`.

    ``state_partitions`` sets the shuffle/state partition count of this query
    (recorded in its checkpoint at the first start and fixed afterwards; size
    it to the cluster, a few times the cores).  The session setting is only
    changed while the query starts.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        with accepted(batch, batch_id, rejects) as rows:
            changelog.write_batch(rows, sink, batch_id)

    _claim_all(df.sparkSession, checkpoint, sink, rejects)
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    with settings(df.sparkSession, {} if state_partitions is None else {"spark.sql.shuffle.partitions": str(state_partitions)}):
        return w.start()


def delta_upsert(rows: DataFrame, keys: Sequence[str], sums: dict[str, object] | None, sink: str,
                 checkpoint: str, available_now: bool = False, trigger: str | None = DEFAULT_TRIGGER,
                 name: str | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None, rejects: str | None = None,
                 around: Callable[[DataFrame, int], DataFrame] | None = None) -> StreamingQuery:
    """Additive running totals without a state store.  ``prepare`` turns a batch's rows into
    the rows to sum, e.g. by a join with a table as it is when the batch arrives.  ``rejects``:
    a second sink for the rows with a ``_reason`` (see :func:`comments`); a replayed batch
    replaces its rows in both.  ``around`` is ``prepare`` with the batch's id, for what
    depends on the batches before.

    Each micro-batch of raw ``rows`` is aggregated inside ``foreachBatch`` (an
    ordinary batch plan: partial aggregation, AQE) and written as that batch's
    delta to ``batch_id=<id>``; :func:`moodwatch.sinks.changelog.totals_view`
    sums the deltas.  No per-key state lives on executors, so an unbounded key
    space (every word ever seen) costs nothing between batches, and a replayed
    batch overwrites its own delta.  ``sums`` maps output column -> Column to
    sum (``None``: a row count ``n``).
    """
    exprs = ({"n": F.count(F.lit(1))} if sums is None else
             {k: F.sum(v) for k, v in sums.items()})

    def write(batch: DataFrame, batch_id: int) -> None:
        with accepted(batch, batch_id, rejects) as valid:
            made = around(valid, batch_id) if around is not None else valid if prepare is None else prepare(valid)
            delta = made.groupBy(*keys).agg(*[e.cast("bigint").alias(k) for k, e in exprs.items()])
            changelog.write_batch(delta, sink, batch_id)

    _claim_all(rows.sparkSession, checkpoint, sink, rejects)
    w = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def word_rows(lines: DataFrame, **kw) -> DataFrame:
    """L2 without the aggregate: one row per (monitor_id, word)."""
    return text.explode_tokens(text.segment(comments(lines, **kw)), ["monitor_id"])


def trend_sums() -> tuple[list[str], dict[str, object]]:
    """Keys and summed label indicators of the trend, for :func:`delta_upsert`
    over labelled rows."""
    return ["monitor_id", "hour"], {
        name: F.when(F.col("label") == F.lit(v), 1).otherwise(0)
        for name, v in (("positive", LABEL_POSITIVE), ("negative", LABEL_NEGATIVE), ("neutral", LABEL_NEUTRAL))}


def preview(df: DataFrame, rows: int = 20, output_mode: str = "update",
            available_now: bool = False) -> StreamingQuery:
    """K8: the first rows of every batch on stdout."""
    w = df.writeStream.outputMode(output_mode).format("console").option("numRows", rows)
    return (w.trigger(availableNow=True) if available_now else w).start()


def run_to_end(df: DataFrame, sink: str, checkpoint: str, output_mode: str = "update",
               state_partitions: int | None = None) -> None:
    """Process everything available now (W1 ``availableNow``) and stop."""
    q = upsert(df, sink, checkpoint, available_now=True, output_mode=output_mode,
               state_partitions=state_partitions)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()


def latest(spark, sink: str, keys: Sequence[str], schema, seq: Sequence[str] = ()) -> DataFrame:
    """Read side of an upsert sink; empty with ``schema`` when nothing was written."""
    if not changelog.batches(spark, sink):  # raises where there is no sink
        return spark.createDataFrame([], schema)
    return changelog.latest_view(spark, sink, keys, seq)

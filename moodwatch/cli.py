"""Command line for the running system (use with ``spark-submit``; ship the
package with ``--py-files moodwatch.zip``).

    spark-submit moodwatch/cli.py train  --labelled L.parquet --model M
    spark-submit moodwatch/cli.py words  --topic T/com --sink S/words [--stateful]
    spark-submit moodwatch/cli.py trend  --topic T/com --model M --sink S/trend
    spark-submit moodwatch/cli.py gender --topic T/com --users-topic T/user --sink S/gender [--hot 17,4711]
    spark-submit moodwatch/cli.py users  --topic T/user --sink S/users
    spark-submit moodwatch/cli.py compact --what trend|words|gender --sink S/x --snapshot S/x-snap
    spark-submit moodwatch/cli.py show   --what trend|words|gender|users|rejects --sink S/x [--monitor ID] [--snapshot ...]

``gender`` reads both topics and keeps each user's gender as state: a comment counts
under the gender known when it arrives.  ``--hot`` names users with very many comments,
whose keys are salted; it is fixed at the sink's first start.

The master, executors and ``spark.checkpoint.dir`` come from spark-submit; each
stream keeps its checkpoint under ``<checkpoint dir>/checkpoints/<command>-<hash of
the sink's path>`` unless ``--checkpoint`` is given.  ``--once`` processes what is available and
stops (``availableNow``); otherwise the stream runs with a processing-time
trigger until stopped.
"""

from __future__ import annotations

import argparse
import hashlib
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="moodwatch")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train", help="fit the sentiment model on (text, label) rows and save it")
    t.add_argument("--labelled", required=True)
    t.add_argument("--model", required=True)
    for name in ("words", "trend", "gender", "users"):
        s = sub.add_parser(name)
        source = s.add_mutually_exclusive_group(required=True)
        source.add_argument("--topic", help="folder of a file topic")
        source.add_argument("--kafka", help="servers/topic, e.g. host:9092,host2:9092/com")
        s.add_argument("--max-offsets", type=int, help="Kafka messages a batch (rate limit)")
        s.add_argument("--sink", required=True)
        s.add_argument("--checkpoint")
        s.add_argument("--trigger", default="5 seconds")
        s.add_argument("--once", action="store_true")
        s.add_argument("--max-files", type=int)
        s.add_argument("--rejects", help="sink folder for lines that can't be decoded")
        if name != "users":
            s.add_argument("--state-partitions", type=int)
        if name in ("words", "trend"):
            s.add_argument("--stateful", action="store_true")
            s.add_argument("--dedup-within", help="drop repeated comment ids within this event-time delay")
        if name == "trend":
            s.add_argument("--model", required=True)
        if name == "gender":
            users = s.add_mutually_exclusive_group(required=True)
            users.add_argument("--users-topic", help="folder of the user topic")
            users.add_argument("--users-kafka", help="servers/topic of the user topic")
            s.add_argument("--hot", help="comma-separated ids of users with very many comments")
    r = sub.add_parser("show", help="print a read-side query")
    r.add_argument("--what", choices=("trend", "series", "words", "word", "gender", "users", "rejects"), required=True)
    r.add_argument("--word")
    r.add_argument("--sink", required=True)
    r.add_argument("--monitor")
    r.add_argument("--stateful", action="store_true")
    r.add_argument("--snapshot")
    r.add_argument("--rows", type=int, default=50)
    c = sub.add_parser("compact", help="fold a sink into a new snapshot version")
    c.add_argument("--what", choices=("trend", "words", "gender", "users"), required=True)
    c.add_argument("--expire", action="store_true", help="delete the folded batches")
    c.add_argument("--sink", required=True)
    c.add_argument("--snapshot", required=True)
    c.add_argument("--stateful", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    from moodwatch.operators import model
    from moodwatch.session import pin_utc, shared_dir
    from moodwatch.sinks import changelog
    from moodwatch.sources import topics
    from moodwatch.streaming import apps, arrival

    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"moodwatch-{args.cmd}").getOrCreate()
    pin_utc(spark)

    if args.cmd == "train":
        fitted = model.train(spark.read.parquet(args.labelled))
        fitted.write().overwrite().save(args.model)
        return fitted

    if args.cmd == "compact":
        version = apps.compact_sink(spark, args.what, args.sink, args.snapshot, args.stateful)
        if args.expire:
            changelog.expire(spark, args.sink, args.snapshot)
        return version

    if args.cmd == "show":
        snap = args.snapshot
        read = {"trend": lambda: apps.read_trend(spark, args.sink, args.monitor, args.stateful, args.rows, snap),
                "words": lambda: apps.read_word_cloud(spark, args.sink, args.monitor, args.stateful, snapshot=snap),
                "gender": lambda: apps.read_gender(spark, args.sink, args.monitor, args.stateful, snap),
                "series": lambda: apps.read_series(spark, args.sink, args.monitor, args.stateful, snapshot=snap),
                "word": lambda: apps.read_word(spark, args.sink, args.monitor, args.word, args.stateful, snap),
                "users": lambda: apps.read_profiles(spark, args.sink, snap),
                "rejects": lambda: apps.read_rejects(spark, args.sink)}[args.what]()
        read.show(args.rows, truncate=False)
        return read

    # one checkpoint a sink, named by its whole path; the sink refuses any other (jobs.claim)
    name = hashlib.sha256(args.sink.rstrip("/").encode()).hexdigest()[:16]
    checkpoint = args.checkpoint or f"{shared_dir(spark)}/checkpoints/{args.cmd}-{name}"
    def topic(folder: str | None, kafka: str | None):
        options = None
        if kafka:
            servers, _, name = kafka.rpartition("/")
            options = {"kafka.bootstrap.servers": servers, "subscribe": name}
            if args.max_offsets:
                options["maxOffsetsPerTrigger"] = str(args.max_offsets)
        return topics.read_topic(spark, folder, options, max_files_per_trigger=args.max_files)

    lines = topic(args.topic, args.kafka)
    common = dict(trigger=args.trigger, available_now=args.once, rejects=args.rejects)
    if args.cmd == "users":
        q = apps.profile_app(lines, args.sink, checkpoint, **common)
    elif args.cmd == "gender":
        hot = args.hot.split(",") if args.hot else None
        q = arrival.gender_app(lines, topic(args.users_topic, args.users_kafka), args.sink, checkpoint, hot,
                               state_partitions=args.state_partitions, **common)
    else:
        extra = dict(stateful=args.stateful, state_partitions=args.state_partitions,
                     dedup_within=args.dedup_within)
        if args.cmd == "words":
            q = apps.word_cloud_app(lines, args.sink, checkpoint, **common, **extra)
        else:
            q = apps.sentiment_app(lines, model.load(args.model), args.sink, checkpoint, **common, **extra)
    q.awaitTermination()
    return q


if __name__ == "__main__":
    main(sys.argv[1:])

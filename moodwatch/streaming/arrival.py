"""J1 + K2 from keyed state: the gender of a comment's author as of its arrival.

Profile and comment messages are one stream keyed by a hash of the user.  A stateful operator
keeps each user's gender (map state in the RocksDB store: one entry a user, read and written
alone); a micro-batch moves only its own messages, whatever the number of profiles: there is no
scan and no shuffle of the profile log.  A batch's profiles arrive before its comments.

* Users share ``BUCKETS`` keys, so that the operator is called once a bucket and not once a
  user: a call costs far more than an entry.

* Comments without a user never reach the operator: their gender is null.
* ``hot`` users are dealt over ``SALTS`` keys: each of their comments goes to one
  of them, their profile messages to all.  The list is bounded (``MAX_HOT``) and
  fixed for the life of a sink, since state is kept by salted key.
* The operator counts as it reads: for a user and batch it holds one number a
  monitor, and no comment text reaches it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from moodwatch.operators import records
from moodwatch.sinks import changelog
from moodwatch.sources import topics
from moodwatch.streaming import jobs

#: keys over which a hot user's comments are dealt
SALTS = 32
#: hot users at most
MAX_HOT = 1000
#: keys that the users share, fixed like the salts
BUCKETS = 8192
KEYS = ["bucket", "salt"]
COUNTS = "monitor_id string, gender string, n bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class GenderState(StatefulProcessor):
    """A bucket's messages of a batch: the newest profile of each user goes to the state, the
    comments are counted by monitor under the gender that is known then."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.gender = handle.getMapState("gender", "user_id string", "gender string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, comments, counts = {}, Counter(), Counter()
        for frame in rows:
            said = frame["is_comment"].to_numpy(dtype=bool)
            comments.update(zip(frame["user_id"][said], frame["monitor_id"][said].astype(object).where(frame["monitor_id"][said].notna(), None), strict=True))
            profiles = frame[~said]
            for user, gender, *order in zip(profiles["user_id"], profiles["gender"], *(profiles[c] for c in topics.ORDER), strict=True):
                if user not in newest or order > newest[user][0]:
                    newest[user] = order, None if pd.isna(gender) else gender
        for user, (_, gender) in newest.items():
            self.gender.updateValue((user,), (gender,))
        known = {user: gender for user, (_, gender) in newest.items()}
        for (user, monitor), n in comments.items():
            if user not in known:
                found = self.gender.getValue((user,))
                known[user] = None if found is None else found[0]
            counts[monitor, known[user]] += n
        if counts:
            yield pd.DataFrame({"monitor_id": pd.Series([m for m, _ in counts], dtype=object),
                                "gender": pd.Series([g for _, g in counts], dtype=object), "n": list(counts.values())})

    def close(self) -> None:
        pass


def bucket(user: str) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(BUCKETS)).cast("int")


def _salted(comments: DataFrame, profiles: DataFrame, hot: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The salt column: any of ``SALTS`` for a hot user's comment, all of them for their profiles, else 0."""
    if not hot:
        zero = F.lit(0)
        return comments.withColumn("salt", zero), profiles.withColumn("salt", zero)
    heavy = F.col("user_id").isin(list(hot))
    one = F.when(heavy, F.pmod(F.xxhash64("offset", "segment", "timestamp"), F.lit(SALTS))).otherwise(0).cast("int")
    every = F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return comments.withColumn("salt", one), profiles.withColumn("salt", F.explode(every))


def gender_at_arrival(comment_lines: DataFrame, user_lines: DataFrame, hot: Sequence[str] = (),
                      rejects: bool = False) -> DataFrame:
    """Streams of ``com`` and ``user`` messages -> (monitor_id, gender, n), additive over batches.
    With ``rejects`` the lines of both that can't be decoded come as well, with a ``_reason``."""
    order = list(topics.ORDER)
    comments = records.decode_comments(comment_lines).select("user_id", "monitor_id", *order)
    profiles = records.decode_users(user_lines).where("user_id is not null").select("user_id", "gender", *order)
    known, profiles = (x.withColumn("bucket", bucket("user_id")) for x in _salted(comments.where("user_id is not null"), profiles, hot))
    messages = (known.withColumn("gender", F.lit(None).cast("string")).withColumn("is_comment", F.lit(True))
                .unionByName(profiles.withColumn("monitor_id", F.lit(None).cast("string")).withColumn("is_comment", F.lit(False))))
    resolved = messages.groupBy(*KEYS).transformWithStateInPandas(
        statefulProcessor=GenderState(), outputStructType=COUNTS, outputMode="Append", timeMode="None")
    nobody = comments.where("user_id is null").select("monitor_id", F.lit(None).cast("string").alias("gender"), F.lit(1).cast("bigint").alias("n"))
    counts = resolved.unionByName(nobody)
    if not rejects:
        return counts
    bad = (records.comment_rejects(comment_lines.select("value")).unionByName(records.user_rejects(user_lines.select("value")))
           .withColumnRenamed("reason", "_reason"))
    return counts.unionByName(bad, allowMissingColumns=True)


def _fixed_hot(spark: SparkSession, sink: str, hot: Sequence[str] | None) -> list[str]:
    """The hot users of a sink: those of its first start.  Others are refused, their state would
    lie under other keys."""
    changelog.create(spark, sink)
    kept = changelog.read_note(spark, f"{sink}/_hot")
    if kept is None:
        users = sorted({str(u) for u in hot or ()})
        if len(users) > MAX_HOT:
            raise ValueError(f"{len(users)} hot users; {MAX_HOT} at most")
        changelog.write_note(spark, f"{sink}/_hot", "\n".join(users))
        return users
    users = kept.split("\n") if kept else []
    if hot is not None and sorted({str(u) for u in hot}) != users:
        raise ValueError(f"{sink} was started with other hot users")
    return users


def gender_app(comment_lines: DataFrame, user_lines: DataFrame, sink: str, checkpoint: str, hot: Sequence[str] | None = None,
               trigger: str = jobs.DEFAULT_TRIGGER, available_now: bool = False,
               state_partitions: int | None = None, rejects: str | None = None) -> StreamingQuery:
    """L3 with genders as of arrival, from one query over both topics.  ``hot``: ids of users
    with very many comments (only the first start may set them)."""
    spark = comment_lines.sparkSession
    counts = gender_at_arrival(comment_lines, user_lines, _fixed_hot(spark, sink, hot), rejects is not None)
    conf = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    with jobs.settings(spark, conf):
        return jobs.delta_upsert(counts, ["monitor_id", "gender"], {"n": F.col("n")}, sink, checkpoint,
                                 available_now=available_now, trigger=trigger, rejects=rejects)

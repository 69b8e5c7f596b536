"""Joins and running aggregates.

All counts are ``groupBy(...).agg(count)``: Spark plans a partial aggregate
before the shuffle, so a hot key (one monitor or one word carrying a third of
all rows) is collapsed to one row per map task before it is exchanged.  The
same functions run on streaming DataFrames, where the state store keeps the
running totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.functions.constants import LABEL_NEGATIVE, LABEL_NEUTRAL, LABEL_POSITIVE, LABEL_NAMES


#: stand-in keys over which rows without a join key are spread
NULL_KEYS = 1 << 20


def word_counts(words: DataFrame, keys=("monitor_id", "word")) -> DataFrame:
    """A3 (and A5 with ``keys=("word",)``): occurrences per key."""
    return words.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def gender_join(comments: DataFrame, profiles: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Comment left-join profile on ``user_id`` -> ``gender`` (null when the
    profile or its gender is missing).

    ``profiles`` must be unique on ``user_id`` (use the latest view of the
    change log).  Only ``user_id, gender`` are selected, so the profile scan
    reads two columns.  No broadcast is forced: the profile table grows with the
    user base, so the planner (and AQE at run time) picks broadcast only when the
    measured size fits the threshold, else a shuffled join with skew splitting.
    In a stream, gender is resolved when the comment arrives and later profile
    edits do not revise old counts; a batch run re-joins everything.

    ``hot`` (a bounded list of user ids, see :func:`moodwatch.operators.joins.hot_keys`)
    salts heavy commenters over many tasks, for streams where AQE's skew
    handling does not apply.
    """
    g = profiles.select("user_id", "gender")
    if hot is not None:
        from moodwatch.operators.joins import salted_join
        return salted_join(comments, g, "user_id", hot, "left")
    # comments without a user match nothing: stand-in keys deal them over many tasks, and
    # whatever those might match is dropped
    others = [c for c in comments.columns if c != "user_id"]
    stand_in = F.lit(-1) - F.pmod(F.xxhash64(*others), F.lit(NULL_KEYS))
    kind = comments.schema["user_id"].dataType
    if kind != g.schema["user_id"].dataType:
        raise TypeError(f"user ids are {kind.simpleString()} in comments and {g.schema['user_id'].dataType.simpleString()} in profiles: cast one side")
    keyed = comments.withColumn("_user_key", F.coalesce("user_id", stand_in.cast(kind)))
    joined = keyed.join(g.select(F.col("user_id").alias("_user_key"), F.col("gender").alias("_gender")), "_user_key", "left")
    return joined.select(*comments.columns, F.when(F.col("user_id").isNotNull(), F.col("_gender")).alias("gender"))


def gender_counts(joined: DataFrame) -> DataFrame:
    """A4: comments (not distinct people) per (monitor, gender); null gender is a key."""
    return joined.groupBy("monitor_id", "gender").agg(F.count(F.lit(1)).alias("n"))


def sentiment_counts(labelled: DataFrame) -> DataFrame:
    """A1: comments per (monitor, hour, label)."""
    return labelled.groupBy("monitor_id", "hour", "label").agg(F.count(F.lit(1)).alias("n"))


def trend_wide(labelled: DataFrame) -> DataFrame:
    """A1+A2 in one aggregate: (monitor, hour) -> positive, negative, neutral.

    Conditional sums keep all three counters on one row, so in a stream's update
    mode a changed hour re-emits every label (packing changed label rows alone
    would lose the unchanged ones).  One shuffle, one state store.
    """
    def n(v):
        return F.sum(F.when(F.col("label") == F.lit(v), F.lit(1)).otherwise(F.lit(0))).cast("bigint")

    return labelled.groupBy("monitor_id", "hour").agg(
        n(LABEL_POSITIVE).alias("positive"),
        n(LABEL_NEGATIVE).alias("negative"),
        n(LABEL_NEUTRAL).alias("neutral"),
    )


def pack_trend(wide: DataFrame) -> DataFrame:
    """A2 text form: ``0.0:n|1.0:n|2.0:n`` (labels with a zero count omitted,
    labels in ascending order)."""
    parts = [F.when(F.col(name) > 0, F.concat(F.lit(f"{label}:"), F.col(name).cast("string")))
             for label, name in sorted(LABEL_NAMES.items())]
    return wide.select("monitor_id", "hour", F.concat_ws("|", *parts).alias("packed"))

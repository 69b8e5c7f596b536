"""Read-side queries (Q1-Q8) over the running-total tables.

These run on small, already aggregated tables (one row per monitor-hour,
monitor-gender, monitor-word); they filter on the partition/sort key so a
parquet layout by ``monitor_id`` prunes files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodwatch.functions.constants import (GENDER_FEMALE, GENDER_MALE, GENDER_NAME_FEMALE, GENDER_NAME_MALE,
                                           GENDER_NAME_OTHER, LABEL_NEGATIVE, LABEL_NEUTRAL, LABEL_POSITIVE,
                                           TREND_POINTS)
from moodwatch.functions.timefmt import hour_label


def trend_last(wide: DataFrame, n: int = TREND_POINTS, monitor_id=None) -> DataFrame:
    """Q1: newest ``n`` hours per monitor (or of one monitor), returned ascending.

    One monitor: a top-``n`` by hour, then ascending.  All monitors: ``row_number``
    over ``monitor_id`` ordered by hour descending; Spark plans a window group-limit
    so each task keeps at most ``n`` rows per monitor before the shuffle, and the
    rows come sorted by monitor and hour.
    """
    if monitor_id is not None:
        newest = wide.where(F.col("monitor_id") == F.lit(monitor_id)).orderBy(F.col("hour").desc()).limit(n)
        return newest.orderBy("hour")
    w = Window.partitionBy("monitor_id").orderBy(F.col("hour").desc())
    return (wide.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
            .orderBy("monitor_id", "hour"))


def unpack_trend(packed: DataFrame, col: str = "packed") -> DataFrame:
    """Q2: ``label:count|...`` -> three counters, absent labels as 0."""
    m = F.str_to_map(F.col(col), F.lit(r"\|"), F.lit(":"))

    def get(v):
        return F.coalesce(F.element_at(m, F.lit(str(v))).cast("bigint"), F.lit(0).cast("bigint"))

    return packed.select("monitor_id", "hour", get(LABEL_POSITIVE).alias("positive"),
                         get(LABEL_NEGATIVE).alias("negative"), get(LABEL_NEUTRAL).alias("neutral"))


def trend_series(wide: DataFrame, n: int = TREND_POINTS, clock12: bool = False) -> DataFrame:
    """Q3+Q4: per monitor, aligned series x (hour labels), y1 positive,
    y2 negative, y3 neutral over the newest ``n`` hours in ascending order.
    Each group holds at most ``n`` rows, so the collect is bounded."""
    last = trend_last(wide, n)
    pts = F.sort_array(F.collect_list(F.struct(
        F.col("hour").alias("h"), hour_label("hour", clock12).alias("x"),
        F.col("positive").alias("y1"), F.col("negative").alias("y2"), F.col("neutral").alias("y3"))))
    return last.groupBy("monitor_id").agg(pts.alias("_p")).select(
        "monitor_id",
        F.transform("_p", lambda s: s["x"]).alias("x"),
        F.transform("_p", lambda s: s["y1"]).alias("y1"),
        F.transform("_p", lambda s: s["y2"]).alias("y2"),
        F.transform("_p", lambda s: s["y3"]).alias("y3"),
    )


def gender_name(col: str = "gender"):
    return (F.when(F.col(col) == F.lit(GENDER_MALE), F.lit(GENDER_NAME_MALE))
            .when(F.col(col) == F.lit(GENDER_FEMALE), F.lit(GENDER_NAME_FEMALE))
            .otherwise(F.lit(GENDER_NAME_OTHER)))


def gender_breakdown(counts: DataFrame, monitor_id=None) -> DataFrame:
    """Q5: m -> 男, f -> 女, anything else (empty, null, no profile) merged into one 其它 row."""
    df = counts if monitor_id is None else counts.where(F.col("monitor_id") == F.lit(monitor_id))
    return (df.groupBy("monitor_id", gender_name().alias("name"))
            .agg(F.sum("n").cast("bigint").alias("value")))


def gender_share(breakdown: DataFrame, digits: int = 6) -> DataFrame:
    """Q6: each name's share of the monitor's comments, in percent."""
    w = Window.partitionBy("monitor_id")
    pct = F.round(F.col("value") * F.lit(100.0) / F.sum("value").over(w), digits)
    return breakdown.withColumn("share", pct)


def word_cloud(counts: DataFrame, monitor_id=None, top: int | None = None) -> DataFrame:
    """Q7: ``(name, value)`` per word; every word unless ``top`` asks for a top-k."""
    df = counts if monitor_id is None else counts.where(F.col("monitor_id") == F.lit(monitor_id))
    df = df.select("monitor_id", F.col("word").alias("name"), F.col("n").alias("value"))
    if top is None:
        return df
    w = Window.partitionBy("monitor_id").orderBy(F.col("value").desc(), F.col("name"))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top).drop("_rn")


def word_lookup(counts: DataFrame, monitor_id, word: str) -> DataFrame:
    """Q8: the count of one word in one monitor (no row when absent)."""
    return counts.where((F.col("monitor_id") == F.lit(monitor_id)) & (F.col("word") == F.lit(word)))

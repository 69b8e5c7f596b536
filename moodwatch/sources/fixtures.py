"""Views over the driver's tables that stand in for the crawler's inputs.

Each view is a plain DataFrame over the parquet files, so its size grows with
the scale factor and Catalyst prunes columns down to the scan.  The SQL twins
used by the DuckDB oracle live in :mod:`moodwatch.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwatch.functions.constants import KEYWORD_SEPARATOR


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_key(number) -> Column:
    """The user id of a number: every fifth is not numeric."""
    n = F.col(number) if isinstance(number, str) else number
    return F.when(n % 5 == 0, F.concat(F.lit("u"), n.cast("string"))).otherwise(n.cast("string"))


def comment_key(number) -> Column:
    """The comment id of a number: every third is not numeric."""
    n = F.col(number) if isinstance(number, str) else number
    return F.when(n % 3 == 0, F.concat(F.lit("c"), n.cast("string"))).otherwise(n.cast("string"))


def key_number(column: str) -> Column:
    """The number in an id of :func:`user_key` or :func:`comment_key`."""
    return F.regexp_replace(column, "^[a-z]", "").cast("bigint")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User profiles: one per customer but every seventh (those users have no profile);
    one market segment has no gender."""
    c = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0")
    gender = (F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit("m"))
              .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), F.lit("f")))
    return c.select(
        user_key("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        gender.alias("gender"),
        F.col("c_mktsegment").alias("description"),
        F.col("c_nationkey").cast("bigint").alias("follow_count"),
        F.floor(F.abs("c_acctbal")).cast("bigint").alias("followers_count"),
    )


def comments(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Comments: text from documents, time and author from the matching event.  ``parts``: the
    number of partitions, those of the join itself."""
    d = table(spark, sf_dir, "documents")
    e = table(spark, sf_dir, "events")
    if parts is not None:
        d, e = d.repartition(parts, "doc_id"), e.repartition(parts, "event_id")
    return d.join(e, d.doc_id == e.event_id).select(
        comment_key(d.doc_id).alias("comment_id"),
        d.source.alias("monitor_id"),
        e.ts.alias("created_at"),
        F.floor(F.abs(e.value)).cast("bigint").alias("like_count"),
        user_key(e.user_id).alias("user_id"),
        d.text.alias("text"),
    )


def monitors(spark: SparkSession, sf_dir: str, sep: str = KEYWORD_SEPARATOR) -> DataFrame:
    """The monitor table ``(monitor_id, name, words, created)``: one monitor per
    customer, tracking its nation, region and market segment, joined by ``sep``
    as a user types the list.  Monitors share keywords heavily (every segment
    keyword is shared by about a fifth of all monitors)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("monitor_id"), F.col("c_name").alias("name"),
                    F.concat_ws(sep, "n_name", "r_name", "c_mktsegment").alias("words"),
                    F.lit("2024-01-01").cast("date").alias("created")))


def new_monitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitors to append: one per supplier, tracking its nation."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_name").alias("name"),
                                                             F.col("n_name").alias("words"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in model output so the trend has an exact oracle."""
    e = table(spark, sf_dir, "events")
    p0 = (F.col("event_id") % 101).cast("double") / F.lit(100.0)
    return e.select(
        F.col("event_id").alias("comment_id"),
        F.col("event_type").alias("monitor_id"),
        F.col("ts").alias("created_at"),
        p0.alias("p0"),
        (F.lit(1.0) - p0).alias("p1"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows; class 1 (toxic) is the negative class."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select("doc_id", "text", F.col("toxic").cast("double").alias("label"))


def profile_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile change log: every event is an update of its user's profile,
    ordered by event time then event id."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "user_id",
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("description"),
        F.floor(F.abs("value")).cast("bigint").alias("followers_count"),
        F.col("props"),
    )

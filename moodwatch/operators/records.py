"""Record extraction and codecs.

Wire records are ``|``-joined text lines (one per topic message).  Decoding is
split/cast on the JVM; rows that the original jobs could not have processed go
to a reject output instead of failing the batch.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodwatch.functions.constants import (COMMENT_FIELDS, COMMENT_MID_SLOT, COMMENT_POST_SLOT, DEFAULT_COMMENT_TEMPLATE,
                                           FIELD_SEPARATOR, NULL_TEXT, POST_FIELDS, USER_FIELDS)
from moodwatch.functions.lines import encode_fields, has_arity
from moodwatch.functions.text import strip_tags
from moodwatch.functions.timefmt import format_created_at, hour_bucket, parse_created_at

VALUE = "value"


# --- R6: encode -------------------------------------------------------------
def encode_lines(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows -> ``value`` lines with the given fields in order (plus ``keep`` columns)."""
    return df.select(*keep, encode_fields(list(fields)).alias(VALUE))


def encode_comments(comments: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Comment rows (``created_at`` as a UTC timestamp) -> ``com`` topic lines."""
    df = comments.withColumn("created_at", format_created_at("created_at"))
    return encode_lines(df, COMMENT_FIELDS, keep)


def encode_users(users: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return encode_lines(users, USER_FIELDS, keep)


def encode_posts(posts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return encode_lines(posts, POST_FIELDS, keep)


# --- R7: arity filter ---------------------------------------------------------
def arity_filter(lines: DataFrame, n: int = 6, col: str = VALUE) -> DataFrame:
    """Keep lines with exactly ``n`` fields (JVM split: trailing empties dropped)."""
    return lines.where(has_arity(col, n))


def arity_rejects(lines: DataFrame, n: int = 6, col: str = VALUE) -> DataFrame:
    return lines.where(~has_arity(col, n) | F.col(col).isNull())


# --- R8-R10: decode -----------------------------------------------------------
def _fields(col: str = VALUE):
    """Field ``i`` of a line that passed :func:`has_arity` (for those lines the
    first fields of a plain split and of the JVM split are the same)."""
    parts = F.split(F.col(col), re.escape(FIELD_SEPARATOR), -1)
    return lambda i: F.get(parts, i)


def decode_comments(lines: DataFrame, col: str = VALUE, clock12: bool = False,
                    keep_invalid: bool = False) -> DataFrame:
    """``com`` lines -> typed comments with event time and hour bucket.

    Output: comment_id, monitor_id, created_at (raw text), ts, hour, like_count,
    user_id, text, plus any other input columns.  Ids are text, as on the wire; an
    absent one (``None``) is null.  Lines with the wrong arity or an unparsable
    ``created_at`` are dropped (see :func:`comment_rejects`) unless ``keep_invalid``,
    which keeps the line and adds ``_reason`` (null: the line is valid).
    """
    f = _fields(col)
    other = [c for c in lines.columns if c != col or keep_invalid]  # rejects keep the raw line
    ts = parse_created_at(f(2))
    out = lines.select(
        *other,
        _id(f(0)).alias("comment_id"),
        f(1).alias("monitor_id"),
        f(2).alias("created_at"),
        ts.alias("ts"),
        f(3).try_cast("bigint").alias("like_count"),
        _id(f(4)).alias("user_id"),
        f(5).alias("text"),
        _reject_reason(has_arity(col, 6), ts).alias("_reason"),
    ).withColumn("hour", hour_bucket("ts", clock12))
    if keep_invalid:
        return out
    return out.where(F.col("_reason").isNull()).drop("_reason")


def _id(field: Column) -> Column:
    return F.nullif(field, F.lit(NULL_TEXT))


def _reject_reason(arity_ok: Column, ts: Column | None = None) -> Column:
    """Why a line can't be decoded (null: it can): arity, created_at."""
    reason = F.when(arity_ok.isNull() | ~arity_ok, F.lit("arity"))
    return reason if ts is None else reason.when(ts.isNull(), F.lit("created_at"))


def comment_rejects(lines: DataFrame, col: str = VALUE) -> DataFrame:
    """The side output of :func:`decode_comments`: lines it would drop, with a reason."""
    d = decode_comments(lines, col, keep_invalid=True)
    return d.where(F.col("_reason").isNotNull()).select(*lines.columns, F.col("_reason").alias("reason"))


def decode_users(lines: DataFrame, col: str = VALUE, keep_invalid: bool = False) -> DataFrame:
    """``user`` lines -> typed profile rows (the literal text ``None`` is null; the id is text).
    Lines that can't be decoded go to :func:`user_rejects`, or are kept with a ``_reason``."""
    f = _fields(col)
    other = [c for c in lines.columns if c != col or keep_invalid]

    def text(i):
        v = f(i)
        return F.when(v == "None", F.lit(None).cast("string")).otherwise(v)

    out = lines.select(
        *other,
        _id(f(0)).alias("user_id"),
        text(1).alias("user_name"),
        text(2).alias("gender"),
        text(3).alias("description"),
        f(4).try_cast("bigint").alias("follow_count"),
        f(5).try_cast("bigint").alias("followers_count"),
        _reject_reason(has_arity(col, 6)).alias("_reason"),
    )
    return out if keep_invalid else out.where(F.col("_reason").isNull()).drop("_reason")


def user_rejects(lines: DataFrame, col: str = VALUE) -> DataFrame:
    """The side output of :func:`decode_users`: lines it drops, with a reason."""
    return (lines.withColumn("reason", _reject_reason(has_arity(col, 6))).where(F.col("reason").isNotNull())
            .select(*lines.columns, "reason"))


# --- S5 / R1-R5: JSON responses -------------------------------------------------
# Ids are text on the wire: responses carry them as numbers or as strings, and a
# STRING field reads both.
USER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("screen_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("follow_count", T.LongType()),
    T.StructField("followers_count", T.LongType()),
])
MBLOG_SCHEMA = T.StructType([
    T.StructField("created_at", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("mid", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("reposts_count", T.LongType()),
    T.StructField("comments_count", T.LongType()),
    T.StructField("attitudes_count", T.LongType()),
    T.StructField("user", USER_SCHEMA),
])
SEARCH_SCHEMA = T.StructType([T.StructField("data", T.StructType([
    T.StructField("cards", T.ArrayType(T.StructType([T.StructField("mblog", MBLOG_SCHEMA)]))),
]))])
COMMENT_ITEM_SCHEMA = T.StructType([
    T.StructField("created_at", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("like_count", T.LongType()),
    T.StructField("user", USER_SCHEMA),
])
COMMENTS_SCHEMA = T.StructType([T.StructField("data", T.StructType([
    T.StructField("data", T.ArrayType(COMMENT_ITEM_SCHEMA)),
]))])


def _user_cols(u: str):
    return [
        F.col(f"{u}.id").alias("user_id"),
        F.col(f"{u}.screen_name").alias("user_name"),
        F.col(f"{u}.gender").alias("gender"),
        F.col(f"{u}.description").alias("description"),
        F.col(f"{u}.follow_count").alias("follow_count"),
        F.col(f"{u}.followers_count").alias("followers_count"),
    ]


def extract_posts(responses: DataFrame, raw: str = "raw", keep: Sequence[str] = ("monitor_id",)) -> DataFrame:
    """Search responses -> one row per card (post + its author, text tag-stripped).

    Cards without ``mblog`` are skipped (the original would raise).
    """
    # explode_outer + null filter: ``explode`` would let the optimizer copy the
    # JSON parse into an inferred filter and parse every response twice
    cards = responses.select(*keep, F.explode_outer(F.from_json(raw, SEARCH_SCHEMA)["data"]["cards"]).alias("card"))
    m = "card.mblog"
    return cards.where(F.col("card").isNotNull() & F.col(m).isNotNull()).select(
        *keep,
        F.col(f"{m}.id").alias("post_id"),
        F.col(f"{m}.mid").alias("mid"),
        F.col(f"{m}.created_at").alias("created_at"),
        strip_tags(f"{m}.text").alias("text"),
        F.col(f"{m}.source").alias("source"),
        F.col(f"{m}.reposts_count").alias("reposts_count"),
        F.col(f"{m}.comments_count").alias("comments_count"),
        F.col(f"{m}.attitudes_count").alias("attitudes_count"),
        F.struct(*_user_cols(f"{m}.user")).alias("user"),
    ).withColumn("user_id", F.col("user.user_id"))


def comment_frontier(posts: DataFrame, template: str = DEFAULT_COMMENT_TEMPLATE) -> DataFrame:
    """The requests for the comments of posts: one row a (post_id, mid) with its URL.  The ids fill
    ``$1`` and ``$2`` as they are; a post without one of them has no request."""
    url = F.replace(F.replace(F.lit(template), F.lit(COMMENT_POST_SLOT), F.col("post_id")), F.lit(COMMENT_MID_SLOT), F.col("mid"))
    return posts.where("post_id is not null and mid is not null").select("post_id", "mid", url.alias("url")).distinct()


def extract_comments(responses: DataFrame, raw: str = "raw", keep: Sequence[str] = ("monitor_id",)) -> DataFrame:
    """R2: comment responses -> one row per comment.  A response without ``data``
    or without the inner ``data`` list yields no rows and no error."""
    items = (responses.select(*keep, F.explode_outer(F.from_json(raw, COMMENTS_SCHEMA)["data"]["data"]).alias("c"))
             .where(F.col("c").isNotNull()))  # explode_outer: parse once (see extract_posts)
    return items.select(
        *keep,
        F.col("c.id").alias("comment_id"),
        F.col("c.created_at").alias("created_at"),
        F.col("c.like_count").alias("like_count"),
        F.col("c.user.id").alias("user_id"),
        strip_tags("c.text").alias("text"),
        F.struct(*_user_cols("c.user")).alias("user"),
    )


def author_union(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Authors of posts and of comments as one user-record stream (bag union;
    the profile upsert resolves repeats)."""
    return (posts.select("user.*").unionByName(comments.select("user.*"))
            .where(F.col("user_id").isNotNull()))


def tag_with_monitor(rows: DataFrame, frontier: DataFrame, url: str = "url") -> DataFrame:
    """Attach the URL's owning monitor (frontier = one row per url)."""
    return rows.join(frontier.select(url, "monitor_id"), url, "inner")

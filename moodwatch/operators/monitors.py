"""Monitor expansion (E1-E4), monitor append (K6) and the monitor list (Q9)."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwatch.functions.constants import (DEFAULT_SEARCH_TEMPLATE, KEYWORD_SEPARATOR, PAGES_PER_KEYWORD,
                                           URL_KEYWORD_SLOT, URL_PAGE_SLOT)
from moodwatch.functions.lines import jvm_split
from moodwatch.functions.text import url_encode_path
from moodwatch.session import materialize, parallelism

#: (url, monitor) pairs that one task holds, about
PAIRS_A_TASK = 500_000


def keyword_explode(monitors: DataFrame, separators: str = KEYWORD_SEPARATOR) -> DataFrame:
    """``(monitor_id, words)`` -> one row per (monitor_id, keyword) with its
    position in the list.

    One separator (the default comma) splits exactly like the scheduler: JVM
    split rules, spaces kept (``"a, b"`` gives ``" b"``).  Several separator
    characters (e.g. ``", "``, what the monitor form allows) split on any run of
    them, so ``"a, b"`` gives ``a`` and ``b``.
    """
    seps = "".join(dict.fromkeys(separators))
    if len(seps) == 1:
        parts = jvm_split(F.col("words"), seps)
    else:
        parts = jvm_split(F.col("words"), "[" + re.escape(seps) + "]+", regex=True)
    return monitors.select("monitor_id", F.posexplode(parts).alias("keyword_pos", "keyword"))


def pair_parts(keywords: DataFrame, pages: int = PAGES_PER_KEYWORD) -> int:
    """Tasks that hold about ``PAIRS_A_TASK`` (url, monitor) pairs each.  One count of the keywords."""
    return max(parallelism(keywords.sparkSession), math.ceil(keywords.count() * pages / PAIRS_A_TASK))


def url_frontier(keywords: DataFrame, template: str = DEFAULT_SEARCH_TEMPLATE,
                 pages: int = PAGES_PER_KEYWORD, parts: int | None = None) -> DataFrame:
    """E2+E3: each keyword, percent-encoded, fills ``$1``; pages 0..pages-1 fill ``$2``.
    ``parts`` deals the keywords over so many tasks before each becomes ``pages`` rows."""
    if parts is not None:
        keywords = keywords.repartition(parts, *keywords.columns)
    enc = url_encode_path("keyword")
    filled = F.replace(F.lit(template), F.lit(URL_KEYWORD_SLOT), enc)
    return (keywords.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
            .withColumn("url", F.replace(filled, F.lit(URL_PAGE_SLOT), F.col("page").cast("string"))))


def last_keywords(keywords: DataFrame) -> DataFrame:
    """(keyword, monitor_id): the last monitor of each keyword.  Every row of a keyword fills the same
    URLs, so these rows have the owners of all (:func:`url_owner`), and the pages multiply them only."""
    return keywords.groupBy("keyword").agg(F.max("monitor_id").alias("monitor_id"))


def url_owner(frontier: DataFrame, owner: str = "last",
              order: Sequence[str] = ("monitor_id", "keyword_pos"), parts: int | None = None) -> DataFrame:
    """The monitor a fetched URL is credited to.

    ``owner='last'`` reproduces the scheduler, where a later monitor sharing a
    keyword overwrites the URL's owner (order = monitor table order, then keyword
    position); ``'all'`` keeps every (url, monitor) pair.  ``max_by`` is a
    partial aggregate, so a URL shared by many monitors is reduced map-side.

    Pairs hardly repeat, so ``'all'`` doesn't reduce them map-side: that would hold
    every pair of a task in memory.  They are dealt over ``parts`` tasks first (see
    :func:`pair_parts`), by default counted from the frontier.
    """
    if owner == "all":
        if parts is None:
            parts = pair_parts(frontier, 1)
        return frontier.select("url", "monitor_id").repartition(parts, "url", "monitor_id").distinct()
    if owner != "last":
        raise ValueError("owner must be 'last' or 'all'")
    order = list(order)
    if order[0] == "monitor_id":
        # every row of one URL carries the same keyword, so later positions only
        # break ties inside one monitor: the owner is the largest id (hash aggregate)
        return frontier.groupBy("url").agg(F.max("monitor_id").alias("monitor_id"))
    key = F.struct(*[F.col(c) for c in order])
    return frontier.groupBy("url").agg(F.max_by("monitor_id", key).alias("monitor_id"))


def dense_ids(df: DataFrame, order: Sequence[str], start: int | Column = 1, out: str = "id") -> DataFrame:
    """Dense consecutive ids in ``order`` without funnelling rows through one task.

    Range-partitions by ``order`` and sorts each partition, counts rows per
    partition (one small row per partition), turns the counts into offsets and
    adds each row's position inside its partition.  ``start`` is an int or a
    scalar Column (e.g. a scalar subquery).
    """
    # materialised once so partition sizes and positions come from the same
    # partitioning (and stay fixed if a task is recomputed)
    ranked = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33)))
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    base = F.lit(start) if isinstance(start, int) else start
    return (ranked.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (base + F.col("_off") + F.col("_pos")).cast("bigint"))
            .drop("_pid", "_pos", "_off"))


def append_monitors(existing: DataFrame, new: DataFrame, order: Sequence[str] = ("name",),
                    created=None) -> DataFrame:
    """K6: new ``(name, words)`` rows get ids after the current maximum, in ``order``,
    and today's date unless ``created`` is given.  Returns the rows to append."""
    start = existing.agg((F.coalesce(F.max("monitor_id"), F.lit(0)) + F.lit(1)).cast("bigint")).scalar()
    ids = dense_ids(new, list(order), start, "monitor_id")
    day = F.current_date() if created is None else F.lit(created).cast("date")
    return ids.select(F.col("monitor_id").cast("bigint"), "name", "words", day.alias("created"))


def monitor_page(monitors: DataFrame, search: str | None = None, page: int = 1, size: int = 10,
                 sort: str = "monitor_id", descending: bool = False) -> DataFrame:
    """Q9: the monitor table filtered by a search text on any column, sorted by
    ``sort`` (ties by id, so pages are stable), one page.  Paging is the feature
    here (a sorted top-k with an offset)."""
    df = monitors
    if search:
        cond = None
        for c in ("monitor_id", "name", "words", "created"):
            hit = F.col(c).cast("string").contains(F.lit(search))
            cond = hit if cond is None else (cond | hit)
        df = df.where(cond)
    key = F.col(sort).desc() if descending else F.col(sort).asc()
    ties = [] if sort == "monitor_id" else [F.col("monitor_id")]
    return df.orderBy(key, *ties).offset((page - 1) * size).limit(size)

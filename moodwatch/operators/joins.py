"""Skew-safe equi-joins: salt the hot keys.

AQE splits skewed sort-merge partitions in batch queries, but not in
streaming micro-batches, and a stream-static join whose static side is too big
to broadcast shuffles every batch by the key.  When one user (or any key)
carries a large share of the rows, that key's rows would all land in one task.
``salted_join`` spreads the rows of a bounded list of hot keys over
``buckets`` salt values and replicates only those keys' rows of the small side
``buckets`` times; cold keys keep salt 0 and are not replicated.  The big side
is read once (a broadcast left join against the hot-key list tags it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.session import materialize

# Hot-key lists are broadcast; never more keys than this.
MAX_HOT_KEYS = 100_000
DEFAULT_BUCKETS = 32
# Keys that a frequent-items sketch follows.
TRACKED = 20_000


def hot_keys(df: DataFrame, key: str, share: float = 0.01, top: int | None = None) -> DataFrame:
    """Keys holding at least ``share`` of the rows (at most ``1/share`` keys),
    or the ``top`` most frequent keys.  Counting is a partial aggregate; the
    per-key counts are materialised once and both the total and the list are
    read from them (``df`` is scanned once)."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if top is not None:
        if top > MAX_HOT_KEYS:
            raise ValueError(f"top={top} exceeds MAX_HOT_KEYS={MAX_HOT_KEYS}")
        return counts.orderBy(F.col("_n").desc(), F.col(key)).limit(top).select(key)
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    if share * MAX_HOT_KEYS < 1:
        raise ValueError(f"share={share} could select more than MAX_HOT_KEYS={MAX_HOT_KEYS} keys")
    counts = materialize(counts)
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") >= total * F.lit(share)).select(key)


def key_sketch(df: DataFrame, key: str, tracked: int = TRACKED) -> DataFrame:
    """(rows, sketch) in one row: the rows with a key, and a frequent-items sketch of the keys as text.
    Sketches of parts are merged by :func:`heavy_keys`; one pass, one row a task."""
    named = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_k"))
    return named.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(_k, {tracked})").alias("sketch"))


def heavy_keys(sketches: DataFrame, key: str, share: float, tracked: int = TRACKED) -> DataFrame:
    """(key, n) of the keys with at least ``share`` of all rows, from sketches of all parts.

    Counts are exact while there are fewer different keys than ``tracked``, and then too large or
    small by about ``4 / tracked`` of all rows at most, so ``share`` has to be well above that."""
    if share * tracked < 100:
        raise ValueError(f"a share of {share} needs a sketch of at least {100 / share:.0f} items")
    parts = sketches.where("rows > 0")
    merged = parts.agg(F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")).where("rows > 0")
    found = merged.select("rows", F.expr(f"inline(approx_top_k_estimate(sketch, {int(1 / share) + 1}))").alias("_k", "n"))
    return found.where(F.col("n") >= F.col("rows") * F.lit(share)).select(F.col("_k").alias(key), F.col("n").cast("bigint").alias("n"))


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: DataFrame, how: str = "left",
                buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """``big.join(small, key, how)`` with hot keys spread over ``buckets`` tasks.

    ``small`` must be unique on ``key``; ``hot`` is a bounded key list (see
    :func:`hot_keys`), broadcast to tag both sides.  The salt of a big row is a
    hash of the row, so a recomputed task salts it the same way.  Works on a
    streaming ``big`` with static ``small``/``hot``.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports 'left' and 'inner'")
    flags = F.broadcast(hot.select(key).distinct().withColumn("_hot", F.lit(True)))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    salted_big = (big.join(flags, key, "left")
                  # a null key matches nothing; its rows are spread like a hot key's
                  .withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), F.pmod(row_hash, F.lit(buckets)))
                              .otherwise(F.lit(0)).cast("int"))
                  .drop("_hot"))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    salted_small = small.join(flags, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_big.join(salted_small, [key, "_salt"], how).drop("_salt")

"""Helpers shared by the training-data operators.

Each helper is a DataFrame job: running totals, hand-over through the shared
folder, Arrow passes over two columns and connected components of an edge table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moodwatch.session import fresh_dir


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends
    there, and a lost executor costs only the tasks that were running."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: rows that a pass works on at once
ROWS = 2000
#: what a worker keeps between tasks: (its key, the object) by name
_kept: dict[str, tuple[object, object]] = {}


def kept(name: str, key: object, make: Callable[[], object]) -> object:
    """One object a worker and name, made anew for another key."""
    if _kept.get(name, (None,))[0] != key:
        _kept.pop(name, None)
        _kept[name] = key, make()
    return _kept[name][1]


def release(keep: str = "") -> None:
    """Let go of what this worker has :func:`kept`, but for one name."""
    for name in [n for n in _kept if n != keep]:
        del _kept[name]


def arrow_pass(df: DataFrame, columns: list[str], schema: str | StructType,
               make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], keep: str = "",
               rows: int = ROWS) -> DataFrame:
    """Run a batch function over ``columns``.  ``make`` is called once a task, on the
    executor, so that it can open models and caches there.  A worker outlives its tasks:
    what it has kept goes, but for ``keep``, before it does other work."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keep)
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):  # a batch in the worker's own form takes several times its size
                out = work(batch.slice(at, rows))
                if out is not None and out.num_rows:
                    yield out

    return df.select(*columns).mapInArrow(run, schema)


def running_total(df: DataFrame, order: list[str], value: Column | str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in ``order``.

    Rows are dealt by range, so each task sums a slice; only one sum a slice meets in
    one place.  Equal keys stay in one slice, so ``order`` should end in a key with few
    equal rows."""
    spark = df.sparkSession
    value = F.col(value) if isinstance(value, str) else value
    ranged = stored(df.withColumn("_value", value.cast("long"))
                    .repartitionByRange(partitions(spark), *order)
                    .withColumn("_slice", F.spark_partition_id()), "ranged")
    return slice_total(ranged, "_slice", order, "_value", out).drop("_slice", "_value")


def slice_total(df: DataFrame, slice_col: str, order: list[str], value: str, out: str,
                sums_of: DataFrame | None = None) -> DataFrame:
    """:func:`running_total` over rows whose ``slice_col`` already ascends with ``order``.
    ``sums_of``: a cheaper frame with the same slices and values to take the sums from."""
    before = Window.orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    bases = ((df if sums_of is None else sums_of).groupBy(slice_col).agg(F.sum(value).alias("_sum"))
             .select(slice_col, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")))
    return (df.join(F.broadcast(bases), slice_col)  # one row a slice
            .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_base"))


#: keys with at least one of so many rows are joined where the rows lie
HOT = 1000


def hot_join(rows: DataFrame, found: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of written ``rows`` with ``found``, which is unique on ``key`` and has in ``count`` the
    rows of each key.  Keys of a thousandth of all those rows or more (``HOT`` at most) are sent to
    the rows, so that no task gets all rows of one key; the others are dealt by key."""
    found = stored(found, "join_keys")
    least = F.lit((found.agg(F.sum(count)).first()[0] or 0) / HOT)
    hot = F.broadcast(found.where(F.col(count) >= least))
    near = rows.join(hot, key)
    far = rows.join(hot.select(key), key, "left_anti").join(found.where(F.col(count) < least), key)
    return near.unionByName(far)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b; any ordered type): rows (node, component)
    with the smallest node of each component, for every node that has an edge.

    Alternating large-star and small-star steps: each step hangs the neighbours of a
    node under its smallest neighbour, so paths halve and no step moves more rows than
    there are edges.  A hub is only ever reduced by ``min``; its neighbours are joined to
    that minimum, never gathered."""
    spark = edges.sparkSession
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "edges")
    last = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = stored(large, "large_star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b")))
                 .where("a <> b").distinct())
        now = stored(small, "small_star")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") / F.lit(2.0 ** 20)),
                        F.bit_xor(F.xxhash64("a", "b"))).first()
        state = (state[0], state[2])
        if state == last or not state[0]:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.groupBy("b").agg(F.lit(1).alias("_")).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

"""The registered query set: name -> (spark, sf_dir) -> DataFrame.

Queries without an entry in :func:`moodwatch.plans.oracle.oracle_sql` are
checked rows-only (model scoring with feature hashing has no SQL form).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from moodwatch.plans import batch

Query = Callable[[SparkSession, str], DataFrame]


def batch_queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in vars(batch).items() if name.startswith("q_") and callable(fn)}


def _utc(fn: Query) -> Query:
    """All wall-clock logic of the package is UTC (D16): pin the session zone
    before the query is built."""
    from moodwatch.session import pin_utc

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    from moodwatch.plans import streams
    out = dict(batch_queries())
    out.update(streams.stream_queries())
    return {name: _utc(fn) for name, fn in out.items()}


def oracle_sql() -> dict[str, str]:
    from moodwatch.plans.oracle import oracle_sql as sql
    known = queries()
    return {k: v for k, v in sql().items() if k in known}

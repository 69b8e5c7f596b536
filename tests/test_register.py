"""Monitors registered by several writers get ids of their own."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from moodwatch.session import fresh_dir
from moodwatch.sinks import changelog
from moodwatch.sources import tables


def _new(spark, who, n):
    return spark.range(n).select(F.format_string(f"{who}-%03d", "id").alias("name"), F.lit("a,b").alias("words"))


def test_ids_are_dense_and_in_order(spark):
    path = fresh_dir(spark, "rg-one")
    assert tables.register_monitors(_new(spark, "a", 5), path) == (1, 5)
    assert tables.register_monitors(_new(spark, "b", 0), path) == (0, -1)
    assert tables.register_monitors(_new(spark, "b", 7), path, created="2024-02-01") == (6, 12)
    rows = sorted(tuple(r)[:2] for r in tables.read_monitors(spark, path).collect())
    assert rows == [(k + 1, f"a-{k:03d}") for k in range(5)] + [(k + 6, f"b-{k:03d}") for k in range(7)]


def test_writers_side_by_side(spark):
    path = fresh_dir(spark, "rg-many")
    tables.register_monitors(_new(spark, "x", 3), path)
    with ThreadPoolExecutor(4) as pool:
        ranges = list(pool.map(lambda k: tables.register_monitors(_new(spark, f"w{k}", 10 + k), path), range(4)))
    ids = [r.monitor_id for r in tables.read_monitors(spark, path).collect()]
    assert len(ids) == len(set(ids)) == 3 + sum(10 + k for k in range(4))
    taken = sorted(ranges)
    assert all(a[1] < b[0] for a, b in zip(taken, taken[1:]))


def test_a_range_in_the_making_is_not_taken(spark):
    """Another writer has read the same maximum and reserved first."""
    path = fresh_dir(spark, "rg-race")
    tables.register_monitors(_new(spark, "a", 4), path)
    changelog.write_note(spark, f"{path}/_ids/{5:020d}", "9")  # reserved, nothing written yet
    assert tables.register_monitors(_new(spark, "b", 2), path) == (10, 11)
    assert not tables._reserve(spark, f"{path}/_ids", 8, 8) and not tables._reserve(spark, f"{path}/_ids", 3, 6)


def test_one_of_many_writers_writes_a_note(spark):
    path = fresh_dir(spark, "rg-note")

    def written(k):
        try:
            changelog.write_note(spark, f"{path}/{k // 8}", str(k))
        except Exception as e:
            assert "exist" in str(e).lower()
            return 0
        return 1

    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(written, range(8 * 100))) == 100

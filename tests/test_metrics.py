"""Joins, aggregates, read queries and monitor operators with hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from moodwatch.operators import metrics, model, monitors, serve
from moodwatch.sinks.changelog import latest


def test_gender_breakdown_merges_other(spark):
    comments = spark.createDataFrame([(i, "m1", u) for i, u in enumerate([1, 2, 3, 4, 5, 99])],
                                     "comment_id int, monitor_id string, user_id bigint")
    profiles = spark.createDataFrame([(1, "m"), (2, "f"), (3, "n"), (4, ""), (5, None)],
                                     "user_id bigint, gender string")
    counts = metrics.gender_counts(metrics.gender_join(comments, profiles))
    got = {r.name: r.value for r in serve.gender_breakdown(counts).collect()}
    assert got == {"男": 1, "女": 1, "其它": 4}
    share = {r.name: r.share for r in serve.gender_share(serve.gender_breakdown(counts)).collect()}
    assert abs(sum(share.values()) - 100.0) < 1e-6


def test_neutral_band_is_strict(spark):
    df = spark.createDataFrame([(1, 0.625, 0.375), (2, 0.75, 0.25)], "id int, p0 double, p1 double")
    got = {r.id: r.label for r in model.neutral_band(df).collect()}
    assert got == {1: 2.0, 2: 0.0}
    got = {r.id: r.label for r in model.neutral_band(df, threshold=0.25).collect()}
    assert got == {1: 0.0, 2: 0.0}


def test_url_owner_last_and_all(spark):
    mons = spark.createDataFrame([(1, "x,shared"), (2, "shared,y")], "monitor_id int, words string")
    fr = monitors.url_frontier(monitors.keyword_explode(mons), template="u?q=$1&p=$2", pages=1)
    last = {r.url: r.monitor_id for r in monitors.url_owner(fr).collect()}
    assert last["u?q=shared&p=0"] == 2
    allp = sorted((r.url, r.monitor_id) for r in monitors.url_owner(fr, "all").collect() if "shared" in r.url)
    assert allp == [("u?q=shared&p=0", 1), ("u?q=shared&p=0", 2)]


def test_keyword_explode_separators(spark):
    mons = spark.createDataFrame([(1, "a b,c")], "monitor_id int, words string")
    assert [r.keyword for r in monitors.keyword_explode(mons).collect()] == ["a b", "c"]
    assert [r.keyword for r in monitors.keyword_explode(mons, ", ").collect()] == ["a", "b", "c"]


def test_profile_latest_newer_null_wins(spark):
    log = spark.createDataFrame([(1, 1, "old"), (1, 2, None), (2, 1, "z")], "user_id int, seq int, description string")
    got = {r.user_id: r.description for r in latest(log, ["user_id"], ["seq"]).collect()}
    assert got == {1: None, 2: "z"}


def test_dense_ids_are_consecutive(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k")).repartition(7)
    out = monitors.dense_ids(df, ["k"], start=10, out="nid").collect()
    assert sorted((r.k, r.nid) for r in out) == [(k, k + 10) for k in range(1000)]


def test_append_monitors_after_max(spark):
    existing = spark.createDataFrame([(3, "a", "x", None)], "monitor_id int, name string, words string, created date")
    new = spark.createDataFrame([("c", "w"), ("b", "v")], "name string, words string")
    got = [(r.monitor_id, r.name) for r in monitors.append_monitors(existing, new, created="2024-01-01")
           .orderBy("monitor_id").collect()]
    assert got == [(4, "b"), (5, "c")]


def test_monitor_page(spark):
    mons = spark.createDataFrame([(i, f"n{i}", "k", dt.date(2024, 1, 1)) for i in range(1, 8)],
                                 "monitor_id int, name string, words string, created date")
    got = [r.monitor_id for r in monitors.monitor_page(mons, None, page=2, size=3).collect()]
    assert got == [4, 5, 6]


def test_trend_last_and_series(spark):
    rows = [("m", dt.datetime(2024, 1, 1, h), h, 0, 1) for h in range(5)]
    wide = spark.createDataFrame(rows, "monitor_id string, hour timestamp_ntz, positive long, negative long, neutral long")
    assert serve.trend_last(wide, 3).count() == 3
    s = serve.trend_series(wide, 3).first()
    assert s.x == ["2024-01-01 02", "2024-01-01 03", "2024-01-01 04"] and s.y1 == [2, 3, 4]


def test_pack_unpack_roundtrip(spark):
    wide = spark.createDataFrame([("m", dt.datetime(2024, 1, 1), 10, 0, 6)],
                                 "monitor_id string, hour timestamp_ntz, positive long, negative long, neutral long")
    packed = metrics.pack_trend(wide)
    assert packed.first().packed == "0.0:10|2.0:6"
    r = serve.unpack_trend(packed).first()
    assert (r.positive, r.negative, r.neutral) == (10, 0, 6)


def test_dedup_keeps_latest(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (2, 0, 1)], "comment_id int, crawl int, like_count int")
    assert df.count() == 3
    got = {r.comment_id: r.like_count for r in latest(df, ["comment_id"], ["crawl"]).collect()}
    assert got == {1: 6, 2: 1}


def test_monitor_table_roundtrip_and_get(spark):
    from moodwatch.session import fresh_dir
    from moodwatch.sources import tables
    path = fresh_dir(spark, "monitors")
    first = spark.createDataFrame([(1, "a", "x,y", dt.date(2024, 1, 1))],
                                  "monitor_id int, name string, words string, created date")
    tables.append_monitors_table(first, path)
    new = monitors.append_monitors(tables.read_monitors(spark, path),
                                   spark.createDataFrame([("b", "z")], "name string, words string"),
                                   created="2024-01-02")
    tables.append_monitors_table(new, path)
    got = sorted((r.monitor_id, r.name) for r in tables.read_monitors(spark, path).collect())
    assert got == [(1, "a"), (2, "b")]
    assert tables.get(tables.scan(spark, path), "monitor_id", 2).first().words == "z"


def test_url_owner_all_deals_its_pairs_over_tasks(spark, monkeypatch):
    """No task holds more than a bounded number of pairs, though all come from one task and are small."""
    monkeypatch.setattr(monitors, "PAIRS_A_TASK", 100)
    words = spark.createDataFrame([(i, f"k{i % 7},own{i}") for i in range(200)] * 2, "monitor_id long, words string").coalesce(1)
    keywords = monitors.keyword_explode(words)
    parts = monitors.pair_parts(keywords)
    assert parts == 80
    for frontier, given in ((monitors.url_frontier(keywords), None), (monitors.url_frontier(keywords, parts=parts), parts)):
        pairs = monitors.url_owner(frontier, "all", parts=given).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in pairs.groupBy("task").count().collect()]
        assert sum(sizes) == 200 * 2 * 10 and max(sizes) < 200


def test_url_tag_joins_frontier_owner(spark):
    from moodwatch.operators import records
    mons = spark.createDataFrame([(1, "k")], "monitor_id int, words string")
    owner = monitors.url_owner(monitors.url_frontier(monitors.keyword_explode(mons), template="s?q=$1&p=$2"))
    fetched = spark.createDataFrame([("s?q=k&p=3", "r1"), ("other", "r2")], "url string, raw string")
    got = [(r.raw, r.monitor_id) for r in records.tag_with_monitor(fetched, owner).collect()]
    assert got == [("r1", 1)]


def test_monitor_page_sorted_by_name_desc(spark):
    mons = spark.createDataFrame([(i, f"n{i % 3}", "k", dt.date(2024, 1, 1)) for i in range(1, 8)],
                                 "monitor_id int, name string, words string, created date")
    got = [(r.name, r.monitor_id) for r in monitors.monitor_page(mons, page=1, size=4, sort="name",
                                                                  descending=True).collect()]
    assert got == [("n2", 2), ("n2", 5), ("n1", 1), ("n1", 4)]


def test_profile_column_reads_two_columns(spark, sf_small):
    """A one-attribute lookup scans only the key and that attribute."""
    from moodwatch.session import fresh_dir
    from moodwatch.sources import fixtures as fx
    from moodwatch.sources import tables
    path = fresh_dir(spark, "profiles")
    fx.users(spark, sf_small).write.parquet(path)
    col = tables.profile_column(spark.read.parquet(path), "gender")
    col.collect()
    plan = col._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:string,gender:string>" in plan


def test_neutral_band_default_threshold_edges(spark):
    """D3 at 0.3: just below is neutral (values exact in binary); 0.65 - 0.35 is
    0.30000000000000004 in doubles, so not below 0.3 -> keeps the prediction."""
    rows = [(1, 0.6484375, 0.3515625), (2, 0.65, 0.35), (3, 0.35, 0.65), (4, 0.5, 0.5)]
    df = spark.createDataFrame(rows, "id int, p0 double, p1 double")
    got = {r.id: r.label for r in model.neutral_band(df).collect()}
    assert got == {1: 2.0, 2: 0.0, 3: 1.0, 4: 2.0}

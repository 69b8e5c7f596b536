"""A third of all rows on one key: results stay whole and equal to the plain plan."""

import re

from pyspark.sql import functions as F

from moodwatch.operators import joins, metrics, text
from moodwatch.plans import batch
from moodwatch.session import fresh_dir
from moodwatch.sources import fixtures as fx
from moodwatch.sources import topics
from moodwatch.streaming import jobs


def _skewed_comments(spark, sf):
    c = batch.decoded_comments(spark, sf)
    # every comment whose id is in the lower third goes to user 1 and monitor "hot"
    number = fx.key_number("comment_id")
    cut = c.select(number.alias("k")).approxQuantile("k", [1 / 3], 0.0)[0]
    hot = number <= F.lit(cut)
    return (c.withColumn("user_id", F.when(hot, F.lit("1")).otherwise(F.col("user_id")))
            .withColumn("monitor_id", F.when(hot, F.lit("hot")).otherwise(F.col("monitor_id"))))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hot_user_salted_join_equals_plain_join(spark, sf_small):
    c = _skewed_comments(spark, sf_small)
    users = fx.users(spark, sf_small)
    hot = joins.hot_keys(c, "user_id", share=0.2)
    assert [r.user_id for r in hot.collect()] == ["1"]
    plain = metrics.gender_counts(metrics.gender_join(c, users))
    split = metrics.gender_counts(metrics.gender_join(c, users, hot))
    assert _rows(plain) == _rows(split)
    assert sum(r.n for r in split.collect()) == c.count()
    # the hot user's rows are spread over many join keys (user_id, salt)
    from moodwatch.operators.joins import salted_join
    j = salted_join(c, users.select("user_id", "gender"), "user_id", hot)
    assert j.count() == c.count()


def test_hot_monitor_word_counts_are_whole(spark, sf_small):
    c = _skewed_comments(spark, sf_small)
    words = text.explode_tokens(text.segment(c), ["monitor_id"])
    counts = metrics.word_counts(words)
    assert counts.agg(F.sum("n")).first()[0] == words.count()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # pre-aggregated before the shuffle


def test_stream_gender_with_hot_keys(spark, sf_small):
    lines = batch.comment_lines(spark, sf_small)
    topic = fresh_dir(spark, "skew-topic")
    topics.write_topic(lines, topic, files=2)
    users = fx.users(spark, sf_small)
    hot = joins.hot_keys(batch.decoded_comments(spark, sf_small), "user_id", top=3)
    out = jobs.gender(topics.read_topic(spark, topic, max_files_per_trigger=1), users, hot)
    sink = fresh_dir(spark, "skew-sink")
    jobs.run_to_end(out, sink, fresh_dir(spark, "skew-ckpt"))
    got = jobs.latest(spark, sink, ["monitor_id", "gender"], out.schema)
    want = metrics.gender_counts(metrics.gender_join(batch.decoded_comments(spark, sf_small), users))
    assert _rows(got.select("monitor_id", "gender", "n")) == _rows(want.select("monitor_id", "gender", "n"))


def test_bucketed_profiles_are_not_shuffled(spark, sf_small):
    from moodwatch.sources.tables import save_bucketed
    profiles = save_bucketed(fx.users(spark, sf_small).select("user_id", "gender"), "user_id", 8,
                             fresh_dir(spark, "bucketed"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a profile table too big to broadcast
    try:
        j = metrics.gender_join(batch.decoded_comments(spark, sf_small), profiles)
        j.write.format("noop").mode("overwrite").save()
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "SelectedBucketsCount: 8 out of 8" in plan
        # one exchange on user_id: the comments are shuffled into the buckets, the profile scan is not
        assert len(re.findall(r"Exchange hashpartitioning\(_user_key", plan)) == 1
        assert _rows(metrics.gender_counts(j)) == _rows(metrics.gender_counts(
            metrics.gender_join(batch.decoded_comments(spark, sf_small), fx.users(spark, sf_small))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stream_batches_read_bucketed_profiles_in_place(spark, sf_small):
    """Each micro-batch shuffles only its comments into the profile buckets."""
    from moodwatch.sources import topics
    from moodwatch.sources.tables import save_bucketed
    profiles = save_bucketed(fx.users(spark, sf_small).select("user_id", "gender"), "user_id", 8,
                             fresh_dir(spark, "sbucketed"))
    topic = fresh_dir(spark, "sbt")
    topics.write_topic(batch.comment_lines(spark, sf_small), topic, files=2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stateful in (True, False):
            lines = topics.read_topic(spark, topic, max_files_per_trigger=1)
            if stateful:
                q = jobs.upsert(jobs.gender(lines, profiles), fresh_dir(spark, "sbs"), fresh_dir(spark, "sbc"),
                                available_now=True, state_partitions=8)
            else:
                joined = metrics.gender_join(jobs.comments(lines), profiles)
                q = jobs.delta_upsert(joined, ["monitor_id", "gender"], None, fresh_dir(spark, "sbs"),
                                      fresh_dir(spark, "sbc"), available_now=True)
            q.awaitTermination()
            plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
            final = plan.split("== Initial Plan ==")[0]  # AQE runs the stateless micro-batches
            assert "SelectedBucketsCount: 8 out of 8" in final
            assert len(re.findall(r"Exchange hashpartitioning\(_user_key", final)) == 1, (stateful, final)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_without_a_user_are_spread(spark):
    """Null keys match nothing and don't meet in one task, plain or salted."""
    from moodwatch.operators.joins import salted_join
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = spark.range(4000).select(F.col("id").alias("comment_id"), F.when(F.col("id") % 4 == 0, F.col("id") % 50).alias("user_id"),
                                     F.lit("m").alias("monitor_id"))
        p = spark.range(50).select(F.col("id").alias("user_id"), F.lit("f").alias("gender"))
        hot = spark.createDataFrame([(0,)], "user_id long")
        for joined in (metrics.gender_join(c, p), salted_join(c, p, "user_id", hot)):
            rows = joined.select("comment_id", "user_id", "gender", F.spark_partition_id().alias("task")).collect()
            assert len(rows) == 4000 and all((r.gender is None) == (r.user_id is None) for r in rows)
            tasks = [sum(r.user_id is None for r in rows if r.task == t) for t in {r.task for r in rows}]
            assert max(tasks) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_keys_from_merged_sketches(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit("warm"))
                                      .otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user_id"))
    parts = [joins.key_sketch(rows.where(F.pmod(F.xxhash64("user_id", F.rand(1)), F.lit(4)) == k), "user_id") for k in range(4)]
    parts.append(joins.key_sketch(spark.createDataFrame([(None,)], "user_id string"), "user_id"))
    sketches = parts[0]
    for p in parts[1:]:
        sketches = sketches.unionByName(p)
    path = fresh_dir(spark, "sketches")
    joins.key_sketch(rows, "user_id").unionByName(joins.key_sketch(spark.createDataFrame([], "user_id string"), "user_id")).write.parquet(path)
    found = {r.user_id: r.n for r in joins.heavy_keys(spark.read.parquet(path), "user_id", 0.01).collect()}
    exact = {r.user_id: r["count"] for r in rows.groupBy("user_id").count().where("count >= 300").collect()}
    assert set(found) == set(exact) == {"hot", "warm"}
    assert all(abs(found[k] - exact[k]) <= 4 * 30_000 / joins.TRACKED for k in exact)
    assert {r.user_id for r in joins.heavy_keys(sketches, "user_id", 0.01).collect()} == set(exact)


def test_small_share_needs_a_larger_sketch(spark):
    import pytest
    with pytest.raises(ValueError):
        joins.heavy_keys(joins.key_sketch(spark.createDataFrame([("a",)], "k string"), "k", 100), "k", 0.01, 100)


def test_stream_salts_who_was_heavy_before(spark, sf_small):
    from moodwatch.sinks import changelog
    from moodwatch.streaming import apps
    c = _skewed_comments(spark, sf_small)
    from moodwatch.operators import records
    topic, sink, heavy = fresh_dir(spark, "hv-topic"), fresh_dir(spark, "hv-sink"), fresh_dir(spark, "hv-sketches")
    lines = records.encode_comments(c.drop("created_at").withColumnRenamed("ts", "created_at"))
    topics.write_topic(lines, topic, files=3)
    users = fx.users(spark, sf_small)
    apps.gender_app(topics.read_topic(spark, topic, max_files_per_trigger=1), users, sink, fresh_dir(spark, "hv-ck"), available_now=True,
                    heavy=heavy, share=0.2).awaitTermination()
    got = changelog.totals_view(spark, sink, ["monitor_id", "gender"], ["n"])
    want = metrics.gender_counts(metrics.gender_join(records.decode_comments(lines), users))
    assert _rows(got.select("monitor_id", "gender", "n")) == _rows(want)
    assert [r.user_id for r in apps.read_heavy(spark, heavy, 0.2).collect()] == ["1"]
    assert apps.read_heavy(spark, heavy, 0.2, before=0) is None and apps.read_heavy(spark, heavy, 0.2, before=1).first().user_id == "1"

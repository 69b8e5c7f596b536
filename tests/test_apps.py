"""End to end: responses -> topics -> stream apps -> read side, against batch."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from moodwatch.operators import metrics, monitors, records, text
from moodwatch.plans import batch
from moodwatch.session import fresh_dir
from moodwatch.sources import fixtures as fx
from moodwatch.sources import topics
from moodwatch.streaming import apps


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_ingest_apps_and_read_side(spark, sf_small):
    owners = monitors.url_owner(monitors.url_frontier(monitors.keyword_explode(fx.monitors(spark, sf_small))))
    # test fixture: the i-th search response is the answer to the i-th frontier URL
    numbered = owners.withColumn("i", F.row_number().over(Window.orderBy("url")) - 1)
    search = (batch.search_responses(spark, sf_small).withColumnRenamed("monitor_id", "i")
              .join(numbered, "i").select("url", "raw"))
    comments = batch.comment_responses(spark, sf_small).withColumnRenamed("monitor_id", "post_id")
    lines = apps.ingest(search, comments, owners)
    base = fresh_dir(spark, "topics")
    apps.write_topics(lines, base)

    com = topics.read_topic(spark, f"{base}/com", max_files_per_trigger=1)
    usr = topics.read_topic(spark, f"{base}/user", max_files_per_trigger=1)
    sinks = {k: fresh_dir(spark, f"sink-{k}") for k in ("words", "words_s", "gender", "users", "trend", "trend_s")}
    ck = {k: fresh_dir(spark, f"ck-{k}") for k in sinks}
    apps.profile_app(usr, sinks["users"], ck["users"], available_now=True).awaitTermination()
    profiles = apps.read_profiles(spark, sinks["users"])
    fitted = batch.trained_model(spark, sf_small)
    for q in (apps.word_cloud_app(com, sinks["words"], ck["words"], available_now=True),
              apps.word_cloud_app(com, sinks["words_s"], ck["words_s"], stateful=True, available_now=True),
              apps.gender_app(com, profiles, sinks["gender"], ck["gender"], available_now=True),
              apps.sentiment_app(com, fitted, sinks["trend"], ck["trend"], available_now=True),
              apps.sentiment_app(com, fitted, sinks["trend_s"], ck["trend_s"], stateful=True, available_now=True)):
        q.awaitTermination()

    decoded = records.decode_comments(lines["com"])
    assert decoded.count() > 0
    want_words = metrics.word_counts(text.explode_tokens(text.segment(decoded), ["monitor_id"]))
    cols = ["monitor_id", "word", "n"]
    got = apps.read_word_cloud(spark, sinks["words"]).withColumnRenamed("name", "word").withColumnRenamed("value", "n")
    got_s = apps.read_word_cloud(spark, sinks["words_s"], stateful=True)
    assert _rows(got, cols) == _rows(want_words, cols)
    assert _rows(got_s.withColumnRenamed("name", "word").withColumnRenamed("value", "n"), cols) == _rows(want_words, cols)

    want_g = metrics.gender_counts(metrics.gender_join(decoded, records.decode_users(lines["user"]).dropDuplicates(["user_id"])))
    gcols = ["monitor_id", "name", "value"]
    from moodwatch.operators import serve
    assert _rows(apps.read_gender(spark, sinks["gender"]), gcols) == _rows(serve.gender_breakdown(want_g), gcols)

    tcols = ["monitor_id", "hour", "positive", "negative", "neutral"]
    delta, state = apps.read_trend(spark, sinks["trend"]), apps.read_trend(spark, sinks["trend_s"], stateful=True)
    assert _rows(delta, tcols) == _rows(state, tcols)
    assert delta.agg(F.sum(F.col("positive") + F.col("negative") + F.col("neutral"))).first()[0] == decoded.count()
    assert apps.read_trend(spark, sinks["trend"], points=3).groupBy("monitor_id").count().agg(F.max("count")).first()[0] <= 3

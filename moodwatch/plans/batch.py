"""Batch plans: the three pipelines of the monitor (trend, word cloud, gender)
and the ingest side, composed from the operators over the fixture views.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables; nothing is collected.  :mod:`moodwatch.plans.registry` exposes
them as the query set checked against :mod:`moodwatch.plans.oracle`.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwatch.functions.text import strip_tags
from moodwatch.functions.timefmt import format_created_at, hour_bucket
from moodwatch.operators import bayes, metrics, model, monitors, records, serve, text
from moodwatch.session import pin_utc
from moodwatch.sinks.changelog import latest
from moodwatch.sources import fixtures as fx

# Parameters of the single-key read queries (any existing key works).
WORD_CLOUD_MONITOR = "src0"
TREND_MONITOR = "click"
LOOKUP_WORD = "the"
TABLE_GET_KEY = "43"
PAGE_SEARCH = "A"
PAGE_NUMBER = 2
PAGE_SIZE = 2
APPEND_DATE = "2024-02-01"
# Phrases that hold every word of the dictionary and of the stop list.
HAN_PHRASES = ("北京加油了", "数加的ABC牛逼", "过年好，北京 加油", "ｑｑ数加", "牛逼北京加油数加过了的")
# Han characters that stand for the letters a to z.
LATIN = "abcdefghijklmnopqrstuvwxyz"
HAN_LETTERS = "".join(chr(0x4E00 + i) for i in range(26))
# Turns per comment response page (a response is one bounded JSON document).
COMMENT_PAGE = 20


# --- L2: comment lines -> word cloud -------------------------------------------
def comment_lines(spark: SparkSession, d: str, parts: int | None = None) -> DataFrame:
    """The ``com`` topic as the crawler would have written it."""
    pin_utc(spark)
    return records.encode_comments(fx.comments(spark, d, parts), keep=["comment_id"])


def comment_lines_valid(spark, d):
    """Lines with six fields."""
    return records.arity_filter(comment_lines(spark, d).select("value"))


def decoded_comments(spark, d, clock12: bool = False):
    """R8-R10 over the whole topic."""
    return records.decode_comments(comment_lines(spark, d).select("value"), clock12=clock12)


def segmented(spark, d):
    return text.segment(decoded_comments(spark, d))


def words(spark, d):
    return text.explode_tokens(segmented(spark, d), ["monitor_id"])


def word_counts(spark, d):
    return metrics.word_counts(words(spark, d))


# --- L1 with the stand-in scores: trend -------------------------------------------
def neutral_labelled(spark, d, clock12: bool = False):
    pin_utc(spark)
    s = fx.scored(spark, d).withColumn("hour", hour_bucket("created_at", clock12))
    return model.neutral_band(s)


def trend_wide(spark, d, clock12: bool = False):
    return metrics.trend_wide(neutral_labelled(spark, d, clock12))


# --- L3: gender ------------------------------------------------------------------
def gender_joined(spark, d):
    return metrics.gender_join(decoded_comments(spark, d), fx.users(spark, d))


def gender_counts(spark, d):
    return metrics.gender_counts(gender_joined(spark, d))


# --- ingest: JSON responses --------------------------------------------------------
def search_responses(spark, d) -> DataFrame:
    """Search responses made from the driver's pages: every page is a card whose
    text is the page's HTML and whose author is the user with the page's id;
    ten consecutive pages form one response (one response per monitor-page of
    the frontier)."""
    p = fx.table(spark, d, "pages")
    u = fx.users(spark, d)
    pu = p.join(u, fx.user_key("page_id") == u.user_id, "left")
    user = F.struct(F.col("user_id").alias("id"), F.col("user_name").alias("screen_name"), "gender",
                    "description", "follow_count", "followers_count")
    mblog = F.struct(
        F.col("page_id").alias("id"), F.col("page_id").alias("mid"), F.col("html").alias("text"),
        F.col("url").alias("source"), F.length("html").cast("bigint").alias("reposts_count"),
        F.length("url").cast("bigint").alias("comments_count"), F.col("page_id").alias("attitudes_count"),
        user.alias("user"))
    resp = F.floor(F.col("page_id") / 10).cast("bigint")
    return (pu.groupBy(resp.alias("monitor_id"))
            .agg(F.collect_list(F.struct(mblog.alias("mblog"))).alias("cards"))
            .select("monitor_id", F.to_json(F.struct(F.struct("cards").alias("data"))).alias("raw")))


def comment_responses(spark, d) -> DataFrame:
    """Comment responses made from conversations: the turns of a conversation are
    its comments (posted ``turn`` hours after 2024-01-01), served in pages of
    ``COMMENT_PAGE`` turns."""
    c = fx.table(spark, d, "conversations")
    u = fx.users(spark, d)
    cu = c.join(u, fx.user_key(c.conv_id + c.turn) == u.user_id, "left")
    user = F.struct(F.col("user_id").alias("id"), F.col("user_name").alias("screen_name"), "gender",
                    "description", "follow_count", "followers_count")
    posted = F.timestamp_add("HOUR", F.col("turn"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    item = F.struct(
        format_created_at(posted).alias("created_at"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text"),
        F.col("turn").alias("like_count"), user.alias("user"))
    items = F.collect_list(item)
    # one response per page of COMMENT_PAGE turns, as the comment API pages its
    # results: a response never holds more than COMMENT_PAGE comments, however
    # long the conversation
    page = F.floor(F.col("turn") / F.lit(COMMENT_PAGE))
    return (cu.groupBy(F.col("conv_id").alias("monitor_id"), page.alias("_page"))
            .agg(items.alias("items"))
            .select("monitor_id", F.to_json(F.struct(F.struct(F.col("items").alias("data")).alias("data"))).alias("raw")))


# --- model ---------------------------------------------------------------------------
@lru_cache(maxsize=8)
def _trained(spark: SparkSession, d: str, terms: bool):
    return bayes.fit(fx.labelled(spark, d)) if terms else model.train(fx.labelled(spark, d))


def trained_model(spark, d):
    """M5: fitted once per (session, data) and reused by every query."""
    return _trained(spark, d, False)


def trained_terms(spark, d) -> bayes.NaiveBayesTable:
    """M5 over exact terms, as tables; fitted once per (session, data)."""
    return _trained(spark, d, True)


def sentiment_scored(spark, d):
    """L1: decoded comments scored by the hashing model, then the neutral band."""
    m = trained_model(spark, d)
    return model.neutral_band(model.score(m, decoded_comments(spark, d)))


def sentiment_trend(spark, d):
    return metrics.trend_wide(sentiment_scored(spark, d))


# --- the query set -------------------------------------------------------------------
def q_record_encode(spark, d):
    return comment_lines(spark, d)


def q_record_filter(spark, d):
    return comment_lines_valid(spark, d)


def q_post_lines(spark, d):
    """R6 for the ``wz`` topic: posts extracted from search responses."""
    posts = records.extract_posts(search_responses(spark, d))
    return records.encode_posts(posts, keep=["post_id"])


def q_user_lines(spark, d):
    """R6 for the ``user`` topic: authors of posts and comments."""
    users = records.author_union(records.extract_posts(search_responses(spark, d)),
                                 records.extract_comments(comment_responses(spark, d)))
    return records.encode_users(users)


def q_record_decode(spark, d):
    return decoded_comments(spark, d).select("comment_id", "monitor_id", "created_at", "like_count",
                                             "user_id", "text")


def q_record_rejects(spark, d):
    return records.comment_rejects(comment_lines(spark, d).select("value"))


def q_created_at_parse(spark, d):
    return decoded_comments(spark, d).select("comment_id", "ts")


def q_hour_bucket(spark, d):
    return decoded_comments(spark, d).select("comment_id", "hour")


def q_hour_bucket_12h(spark, d):
    return decoded_comments(spark, d, clock12=True).select("comment_id", "hour")


def q_segment(spark, d):
    s = text.join_tokens(segmented(spark, d), "tokens", "comment_text")
    return s.select("comment_id", "monitor_id", "comment_text", F.size("tokens").alias("n_tokens"))


def _segmented_by_table(s: DataFrame) -> DataFrame:
    return text.join_tokens(s, "tokens", "comment_text").select(
        "comment_id", "monitor_id", "comment_text", F.size("tokens").alias("n_tokens"))


def q_segment_dict(spark, d):
    """T1 with the dictionary as a table, longest word first; must equal ``segment``."""
    from moodwatch.functions.constants import EXTENSION_WORDS
    from moodwatch.operators.segmenter import segment_with_dictionary
    dictionary = spark.createDataFrame([(w,) for w in EXTENSION_WORDS], "word string")
    return _segmented_by_table(segment_with_dictionary(decoded_comments(spark, d), dictionary, "comment_id"))


def in_han(text) -> Column:
    """Text written in Han characters, one for each of the letters a to z."""
    return F.translate(F.lower(text), LATIN, HAN_LETTERS)


def han_written(spark, d) -> tuple[DataFrame, DataFrame]:
    """Documents to be written in Han characters, and a dictionary of the short words
    (2 to 4 letters) that then stand in them: longer words fall into overlapping ones."""
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    # runs of letters and digits that will be 2 to 4 Han characters; each once a text, written so when they are few
    short = F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![\p{L}\p{N}])([a-z[\p{IsHan}&&[\p{L}\p{N}]]]{2,4}+)(?![\p{L}\p{N}])"), F.lit(1))
    words = docs.select(F.explode_outer(F.array_distinct(short)).alias("word")).where("word is not null").distinct()
    return docs, words.select(F.translate("word", LATIN, HAN_LETTERS).alias("word")).distinct()


def q_segment_coarse(spark, d):
    """T1 in the coarsest way: the fewest tokens, with a dictionary made from all documents."""
    from moodwatch.operators.segmenter import segment_with_dictionary
    docs, words = han_written(spark, d)
    s = segment_with_dictionary(docs, words, "doc_id", mode="coarsest", written=in_han)
    return s.select("doc_id", F.array_join("tokens", " ").alias("comment_text"), F.size("tokens").alias("n_tokens"))


def han_comments(spark, d) -> DataFrame:
    """Comments with Chinese text: to each text words are added that depend on its id, so that
    every dictionary and stop word occurs, alone, joined to Latin letters and inside a run."""
    k = fx.key_number("comment_id")
    phrases = F.array(*[F.lit(p) for p in HAN_PHRASES])
    extra = F.concat(F.element_at(phrases, (k % len(HAN_PHRASES) + 1).cast("int")), F.lit(" "),
                     F.element_at(phrases, (F.floor(k / 7) % len(HAN_PHRASES) + 1).cast("int")), k.cast("string"))
    return decoded_comments(spark, d).withColumn("text", F.concat("text", extra))


def q_segment_han(spark, d):
    s = text.join_tokens(text.segment(han_comments(spark, d)), "tokens", "comment_text")
    return s.select("comment_id", "monitor_id", "comment_text", F.size("tokens").alias("n_tokens"))


def q_word_counts_han(spark, d):
    return metrics.word_counts(text.explode_tokens(text.segment(han_comments(spark, d)), ["monitor_id"]))


def q_word_counts(spark, d):
    return word_counts(spark, d)


def q_word_cloud(spark, d):
    return serve.word_cloud(word_counts(spark, d), WORD_CLOUD_MONITOR)


def q_word_cloud_top(spark, d):
    return serve.word_cloud(word_counts(spark, d), top=20)


def q_word_lookup(spark, d):
    return serve.word_lookup(word_counts(spark, d), WORD_CLOUD_MONITOR, LOOKUP_WORD)


def q_word_split_count(spark, d):
    docs = fx.table(spark, d, "documents").select(F.col("text").alias("value"))
    return metrics.word_counts(text.split_words(docs), keys=("word",))


def q_neutral_band(spark, d):
    lab = neutral_labelled(spark, d)
    return lab.select("comment_id", "monitor_id", "hour", "label", model.label_name().alias("label_name"))


def q_sentiment_counts(spark, d):
    return metrics.sentiment_counts(neutral_labelled(spark, d))


def q_trend_wide(spark, d):
    return trend_wide(spark, d)


def q_trend_wide_12h(spark, d):
    return trend_wide(spark, d, clock12=True)


def q_trend_pack(spark, d):
    return metrics.pack_trend(trend_wide(spark, d))


def q_trend_unpack(spark, d):
    return serve.unpack_trend(metrics.pack_trend(trend_wide(spark, d)))


def q_trend_last50(spark, d):
    return serve.trend_last(trend_wide(spark, d))


def q_trend_last50_one(spark, d):
    """Q1 for one monitor, as the dashboard asks for it."""
    return serve.trend_last(trend_wide(spark, d), monitor_id=TREND_MONITOR)


def q_trend_series(spark, d):
    s = serve.trend_series(trend_wide(spark, d))
    return s.select("monitor_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
                                    for c in ("x", "y1", "y2", "y3")])


def q_trend_series_12h(spark, d):
    """Q3/Q4 with the 12-hour clock of the original read side (``hh`` labels)."""
    s = serve.trend_series(trend_wide(spark, d, clock12=True), clock12=True)
    return s.select("monitor_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
                                    for c in ("x", "y1", "y2", "y3")])


def q_profile_latest(spark, d):
    return latest(fx.profile_log(spark, d), ["user_id"], ["updated_at", "seq"])


def q_gender_join(spark, d):
    return gender_joined(spark, d).select("comment_id", "monitor_id", "user_id", "gender")


def q_gender_counts(spark, d):
    return gender_counts(spark, d)


def q_gender_counts_split(spark, d):
    """J1+A4 with heavy commenters (>= 1% of comments each) salted over many
    join tasks; must equal ``gender_counts``."""
    from moodwatch.operators.joins import hot_keys
    c = decoded_comments(spark, d)
    hot = hot_keys(c, "user_id", share=0.01)
    return metrics.gender_counts(metrics.gender_join(c, fx.users(spark, d), hot))


def q_gender_counts_bucketed(spark, d):
    """J1+A4 against the profile view stored bucketed by ``user_id`` (the
    co-located form used when profiles are too big to broadcast); must equal
    ``gender_counts``."""
    from moodwatch.session import fresh_dir, parallelism
    from moodwatch.sources.tables import save_bucketed
    profiles = save_bucketed(fx.users(spark, d).select("user_id", "gender"), "user_id",
                             2 * parallelism(spark), fresh_dir(spark, "profiles-bucketed"))
    return metrics.gender_counts(metrics.gender_join(decoded_comments(spark, d), profiles))


def q_gender_breakdown(spark, d):
    return serve.gender_breakdown(gender_counts(spark, d))


def q_gender_share(spark, d):
    return serve.gender_share(serve.gender_breakdown(gender_counts(spark, d)))


def q_keyword_explode(spark, d):
    return monitors.keyword_explode(fx.monitors(spark, d))


def q_keyword_explode_typed(spark, d):
    """E1 on lists typed as ``"A, B, C"``: the scheduler's comma split keeps the
    spaces (``" B"``), as the original did (D13)."""
    return monitors.keyword_explode(fx.monitors(spark, d, sep=", "))


def q_keyword_explode_multi(spark, d):
    """E1 with the form's separators (comma or space, D13): ``"A, B, C"`` gives
    clean keywords, and ``MIDDLE EAST`` two."""
    return monitors.keyword_explode(fx.monitors(spark, d, sep=", "), separators=", ")


def q_url_frontier(spark, d):
    return monitors.url_frontier(monitors.keyword_explode(fx.monitors(spark, d))).select(
        "monitor_id", "keyword", "page", "url")


def q_url_owner(spark, d):
    return monitors.url_owner(monitors.url_frontier(monitors.last_keywords(monitors.keyword_explode(fx.monitors(spark, d)))))


def q_url_owner_all(spark, d):
    """E4 with ``owner='all'``: every (url, monitor) pair."""
    keywords = monitors.keyword_explode(fx.monitors(spark, d))
    parts = monitors.pair_parts(keywords)
    return monitors.url_owner(monitors.url_frontier(keywords, parts=parts), owner="all", parts=parts)


def q_monitor_list(spark, d):
    return fx.monitors(spark, d).select("monitor_id", "name", "words", "created")


def q_monitor_page(spark, d):
    return monitors.monitor_page(q_monitor_list(spark, d), PAGE_SEARCH, PAGE_NUMBER, PAGE_SIZE)


def q_monitor_page_sorted(spark, d):
    """Q9 sorted by name, descending (the list widget's column sort)."""
    return monitors.monitor_page(q_monitor_list(spark, d), PAGE_SEARCH, PAGE_NUMBER, PAGE_SIZE,
                                 sort="name", descending=True)


def q_monitor_append(spark, d):
    """K6: supplier monitors appended after the customer monitors, ids in name order."""
    return monitors.append_monitors(fx.monitors(spark, d), fx.new_monitors(spark, d), order=("name",),
                                    created=APPEND_DATE)


def q_table_get(spark, d):
    from moodwatch.sources.tables import get
    return get(fx.users(spark, d), "user_id", TABLE_GET_KEY)


def q_html_strip(spark, d):
    return fx.table(spark, d, "pages").select("page_id", strip_tags("html").alias("text"))


def q_json_posts(spark, d):
    return records.extract_posts(search_responses(spark, d)).drop("user")


def q_json_posts_files(spark, d):
    """S5 from files: every search response stored as one JSON file under
    ``monitor_id=<id>/``, read back whole (``wholetext``) and parsed."""
    from moodwatch.session import fresh_dir
    from moodwatch.sources.tables import read_responses
    path = fresh_dir(spark, "responses")
    (search_responses(spark, d).write
     .partitionBy("monitor_id").option("maxRecordsPerFile", 1).text(path))
    raw = read_responses(spark, path).withColumn("monitor_id", F.col("monitor_id").cast("bigint"))
    return records.extract_posts(raw).drop("user")


def q_json_comments(spark, d):
    return records.extract_comments(comment_responses(spark, d)).drop("user")


def q_author_union(spark, d):
    return records.author_union(records.extract_posts(search_responses(spark, d)),
                                records.extract_comments(comment_responses(spark, d)))


def q_comment_frontier(spark, d):
    """The comment requests of all posts: (post id, mid) -> URL."""
    return records.comment_frontier(records.extract_posts(search_responses(spark, d)))


def crawled(spark, d) -> tuple[DataFrame, DataFrame]:
    """Search and comment responses of a crawl: response r answers the search for nation r % 25's
    name, page r % 10 (url, r, raw), and conversation c holds the comments of post c (post_id, raw)."""
    from moodwatch.functions.constants import DEFAULT_SEARCH_TEMPLATE, URL_KEYWORD_SLOT, URL_PAGE_SLOT
    from moodwatch.functions.text import url_encode_path
    nation = fx.table(spark, d, "nation")
    r = F.col("r")
    url = F.replace(F.replace(F.lit(DEFAULT_SEARCH_TEMPLATE), F.lit(URL_KEYWORD_SLOT), url_encode_path("n_name")),
                    F.lit(URL_PAGE_SLOT), (r % 10).cast("string"))
    search = (search_responses(spark, d).withColumnRenamed("monitor_id", "r")
              .join(nation, r % 25 == F.col("n_nationkey")).select(url.alias("url"), "r", "raw"))
    return search, comment_responses(spark, d).withColumnRenamed("monitor_id", "post_id")


def q_ingest_lines(spark, d):
    """R5+J2: the whole ingest; posts belong to the monitor that owns the URL of their response.
    All three topics' lines."""
    from moodwatch.streaming import apps
    search, comments = crawled(spark, d)
    lines = apps.ingest(search.drop("r"), comments, q_url_owner(spark, d))
    parts = [df.select(F.lit(topic).alias("topic"), "value") for topic, df in lines.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_monitor_table(spark, d):
    """S3 and the K6 write: the monitor table written, new monitors appended, all read back."""
    from moodwatch.session import fresh_dir
    from moodwatch.sources.tables import append_monitors_table, read_monitors
    path = fresh_dir(spark, "monitor-table")
    append_monitors_table(fx.monitors(spark, d), path)
    append_monitors_table(q_monitor_append(spark, d), path)
    return read_monitors(spark, path)


def q_monitor_register(spark, d):
    """K6 by two writers: the suppliers registered in two parts, each with a range of ids of its own."""
    from moodwatch.session import fresh_dir
    from moodwatch.sources.tables import append_monitors_table, read_monitors, register_monitors
    path = fresh_dir(spark, "monitor-register")
    append_monitors_table(fx.monitors(spark, d), path)
    new = fx.new_monitors(spark, d)
    half = F.length("name") + F.ascii(F.substring("name", -1, 1))
    for part in range(2):
        register_monitors(new.where(half % 2 == part), path, created=APPEND_DATE)
    return read_monitors(spark, path)


def q_sentiment_loaded(spark, d):
    """The model saved, loaded and applied."""
    from moodwatch.session import fresh_dir
    path = fresh_dir(spark, "model")
    trained_model(spark, d).write().save(path)
    s = model.neutral_band(model.score(model.load(path), decoded_comments(spark, d)))
    return s.select("comment_id", "monitor_id", "hour", "prediction", "label", model.label_name().alias("label_name"))


def q_table_put(spark, d):
    """K7: every profile put, then every second one again without a gender; the last put wins."""
    from moodwatch.session import fresh_dir
    from moodwatch.sinks import changelog
    path, u = fresh_dir(spark, "table-put"), fx.users(spark, d)
    changelog.write_batch(u, path, 0)
    changelog.write_batch(u.where(fx.key_number("user_id") % 2 == 0).withColumn("gender", F.lit(None).cast("string")), path, 1)
    return changelog.latest_view(spark, path, ["user_id"])


def q_comment_dedup(spark, d):
    """The topic holds every comment twice (a re-crawl with one more like);
    keep the newest copy of each comment id."""
    crawls = decoded_comments(spark, d).withColumn("crawl", F.explode(F.array(F.lit(0), F.lit(1))))
    both = crawls.withColumn("like_count", F.col("like_count") + F.col("crawl"))
    return latest(both, ["comment_id"], ["crawl"]).select(
        "comment_id", "monitor_id", "like_count", "user_id", "text")


def q_tfidf(spark, d):
    return model_tfidf(spark, d)


def model_tfidf(spark, d):
    """M2+M3 relationally: per (doc, term) tf and tf*idf with idf = ln((N+1)/(df+1))."""
    from moodwatch.operators.tfidf import tfidf
    lab = model.model_input(fx.labelled(spark, d))
    return tfidf(lab, "doc_id", "comment_text")


def q_nb_vocab_score(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    s = bayes.score(trained_terms(spark, d), docs, "doc_id")
    return s.select("doc_id", "prediction", F.round("p0", 6).alias("p0"), F.round("p1", 6).alias("p1"))


def q_sentiment_score(spark, d):
    s = sentiment_scored(spark, d)
    return s.select("comment_id", "monitor_id", "hour", "prediction", "label",
                    model.label_name().alias("label_name"))


def q_sentiment_trend_vocab(spark, d):
    """L1 end to end with the model over exact terms (recomputable in SQL):
    decode -> segment -> tokenizer -> counts -> IDF -> Naive Bayes -> neutral
    band -> hourly trend per monitor."""
    scored = bayes.score(trained_terms(spark, d), decoded_comments(spark, d), "comment_id")
    return metrics.trend_wide(model.neutral_band(scored))


def q_sentiment_trend(spark, d):
    return sentiment_trend(spark, d)


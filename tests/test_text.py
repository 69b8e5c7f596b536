"""Segmentation and word splitting."""

from pyspark.sql import functions as F

from moodwatch.functions.text import tokens, url_encode_path
from moodwatch.operators import text


def _tok(spark, s, **kw):
    return spark.createDataFrame([(s,)], "t string").select(tokens("t", **kw).alias("x")).first().x


def test_dictionary_longest_first_and_stop_words(spark):
    assert _tok(spark, "武汉北京加油的abc 123") == ["武", "汉", "北京加油", "abc", "123"]


def test_underscore_separates_words(spark):
    assert _tok(spark, "a_b a") == ["a", "b", "a"]


def test_full_width_and_case_fold(spark):
    assert _tok(spark, "ＡＢＣ　Été 了") == ["abc", "été"]


def test_custom_dictionary_with_spaces(spark):
    assert _tok(spark, "of the best of them", dictionary=["of the"], stop_words=[]) == ["of the", "best", "of", "them"]


def test_split_words_drops_trailing_empties(spark):
    df = spark.createDataFrame([("a,b,,",), (",x",), (",,,",)], "value string")
    got = sorted(r.word for r in text.split_words(df).collect())
    assert got == ["", "a", "b", "x"]


def test_url_encode_matches_python_quote(spark):
    from urllib.parse import quote
    words = ["UNITED STATES", "a/b~c*d+e", "武汉", "x&y=z"]
    df = spark.createDataFrame([(w,) for w in words], "k string")
    got = [r.u for r in df.select(url_encode_path("k").alias("u")).collect()]
    assert got == [quote(w) for w in words]


def test_dictionary_table_path_equals_regex_path(spark, sf_small):
    from moodwatch.operators.segmenter import segment_with_dictionary
    from moodwatch.sources import fixtures as fx
    words = ["of the", "de la", "und die", "the", "北京加油", "数加", "Ｔhe ＥND"]
    docs = fx.table(spark, sf_small, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, "武汉北京加油的abc 123 of them of the end, THE END")], "doc_id long, text string"))
    a = {r.doc_id: r.tokens for r in text.segment(docs, dictionary=words).collect()}
    d = spark.createDataFrame([(w,) for w in words], "w string")
    b = {r.doc_id: r.tokens for r in segment_with_dictionary(docs, d, "doc_id").collect()}
    assert a == b
    assert a[-1] == ["武", "汉", "北京加油", "abc", "123", "of", "them", "of the", "end", "the end"]


def test_segmentation_regex_evaluated_once_per_row(spark, sf_small):
    """explode would let the optimizer copy the regex into an inferred filter."""
    from moodwatch.plans import batch
    for df in (batch.word_counts(spark, sf_small), batch.q_segment(spark, sf_small)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_extract_all") == 1, plan


def test_stop_words_as_a_table(spark, sf_small):
    """T2 with a stop list held as a table: anti-join after the explode equals
    filtering inside the token array."""
    from moodwatch.plans import batch
    c = batch.decoded_comments(spark, sf_small)
    stop = ["the", "de", "und", "la"]
    inline = text.explode_tokens(text.segment(c, stop_words=stop), ["monitor_id"])
    words = text.explode_tokens(text.segment(c, stop_words=[]), ["monitor_id"])
    table = text.remove_stop_words(words, spark.createDataFrame([(w,) for w in stop], "w string"))
    rows = lambda df: sorted((r.monitor_id, r.word) for r in df.collect())
    assert rows(table) == rows(inline)


def test_long_run_is_one_token(spark):
    """A run of a million letters neither overflows the matcher's stack nor is cut."""
    run = "a" * 1_000_000
    assert _tok(spark, f"x {run} 好{run}") == ["x", run, "好", run]


def test_cheaper_classes_hold_the_same_characters(spark):
    """Every character: what a run and what a Han character is, and full-width ones next to others."""
    from moodwatch.functions import text as T
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000]
    blocks = spark.createDataFrame([("".join(map(chr, points[i:i + 2048])),) for i in range(0, len(points), 2048)], "s string")

    def found(pattern):
        return F.regexp_extract_all("s", F.lit(f"({pattern})"), F.lit(1))

    same = blocks.select((found(T._RUN_CHAR) == found(r"[\p{L}\p{N}&&[^\p{IsHan}]]")).alias("run"), (found(T._HAN) == found(r"\p{IsHan}")).alias("han"),
                         (T.normalize("s", False) == F.translate("s", T._FULL_WIDTH, T._HALF_WIDTH)).alias("wide"), F.size(found(T._HAN)).alias("n"))
    rows = same.collect()
    assert all(r.run and r.han and r.wide for r in rows) and sum(r.n for r in rows) > 90_000
    assert spark.createDataFrame([(None,)], "s string").select(T.normalize("s").alias("x")).first().x is None

"""Property tests: each draws many inputs and checks them in one Spark job."""

import re
from urllib.parse import quote

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from moodwatch.functions.lines import field_count, has_arity, jvm_split
from moodwatch.functions.text import tokens, url_encode_path

SETTINGS = dict(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def java_split(s: str, sep: str) -> list[str]:
    """String.split(regex) with limit 0, for a literal separator."""
    if s == "":
        return [""]
    parts = re.split(re.escape(sep), s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(**SETTINGS)
@given(st.lists(st.text(alphabet="ab|\n,", max_size=14), min_size=40, max_size=80))
def test_jvm_split_matches_java(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, s string")
    for sep in ("|", ","):
        got = {r.i: (r.p, r.n, r.a2, r.a3, r.a6) for r in df.select(
            "i", jvm_split("s", sep).alias("p"), field_count("s", sep).alias("n"),
            has_arity("s", 2, sep).alias("a2"), has_arity("s", 3, sep).alias("a3"),
            has_arity("s", 6, sep).alias("a6")).collect()}
        for i, s in enumerate(lines):
            want = java_split(s, sep)
            n = len(want)
            assert got[i] == (want, n, n == 2, n == 3, n == 6), (s, sep)


_text = st.text(st.characters(blacklist_categories=("Cs",)), max_size=15)


@settings(**SETTINGS)
@given(st.lists(_text, min_size=20, max_size=40))
def test_url_encode_matches_quote(spark, words):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = {r.i: r.u for r in df.select("i", url_encode_path("w").alias("u")).collect()}
    assert all(got[i] == quote(w) for i, w in enumerate(words))


_seg_chars = "ab c的北京数加油了Ｄ_1-"


@settings(**SETTINGS)
@given(st.lists(st.text(alphabet=_seg_chars, max_size=20), min_size=20, max_size=40),
       st.lists(st.text(alphabet=_seg_chars.replace(" ", ""), min_size=1, max_size=4), min_size=1, max_size=6))
def test_regex_and_joined_segmentation_agree(spark, texts, dictionary):
    from moodwatch.operators.segmenter import segment_with_dictionary
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    a = {r.i: r.x for r in df.select("i", tokens("text", dictionary=dictionary).alias("x")).collect()}
    d = spark.createDataFrame([(w,) for w in dictionary], "w string")
    b = {r.i: r.tokens for r in segment_with_dictionary(df, d, "i").collect()}
    assert a == b

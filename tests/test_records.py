"""Hand-made edge rows for the wire codecs."""

import datetime as dt

from pyspark.sql import functions as F

from moodwatch.functions.lines import jvm_split
from moodwatch.functions.text import strip_tags
from moodwatch.functions.timefmt import hour_bucket, parse_created_at
from moodwatch.operators import records


def test_arity_follows_jvm_split(spark):
    rows = ["a|b|c|d|e|f", "a|b|c|d|e|", "a|b|c|d|e|f|", "a|b|c|d|e|f|g", "a|b||d|e|f", "a|b|c|d|e|f|\n"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    kept = [r.value for r in records.arity_filter(df).collect()]
    assert sorted(kept) == sorted(["a|b|c|d|e|f", "a|b|c|d|e|f|", "a|b||d|e|f"])


def test_jvm_split_edges(spark):
    df = spark.createDataFrame([("",), ("|||",), ("a||",), ("|a",)], "v string")
    got = {r.v: r.p for r in df.select("v", jvm_split("v").alias("p")).collect()}
    assert got == {"": [""], "|||": [], "a||": ["a"], "|a": ["", "a"]}


def test_created_at_and_hours(spark):
    df = spark.createDataFrame([("Sat Jan 18 20:03:51 +0800 2020",), ("garbage",)], "c string")
    got = [r.t for r in df.select(parse_created_at("c").alias("t")).collect()]
    assert got == [dt.datetime(2020, 1, 18, 12, 3, 51), None]


def test_clock12_folds_am_pm(spark):
    ts = [dt.datetime(2024, 1, 5, h, m) for h, m in ((0, 30), (8, 10), (12, 0), (20, 3))]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    h24 = {r.h for r in df.select(hour_bucket("t").alias("h")).collect()}
    h12 = {r.h for r in df.select(hour_bucket("t", clock12=True).alias("h")).collect()}
    assert len(h24) == 4
    assert h12 == {dt.datetime(2024, 1, 5, 0), dt.datetime(2024, 1, 5, 8)}


def test_decode_and_rejects(spark):
    good = "7|m1|Sat Jan 18 20:03:51 +0800 2020|3|42|hello world"
    bad_date = "8|m1|garbage|3|42|x"
    bad_arity = "9|m1|Sat Jan 18 20:03:51 +0800 2020|3|42|x|y"
    df = spark.createDataFrame([(good,), (bad_date,), (bad_arity,)], "value string")
    out = records.decode_comments(df).collect()
    assert [(r.comment_id, r.monitor_id, r.user_id, r.text, r.hour) for r in out] == [
        ("7", "m1", "42", "hello world", dt.datetime(2020, 1, 18, 12))]
    rej = {r.value: r.reason for r in records.comment_rejects(df).collect()}
    assert rej == {bad_date: "created_at", bad_arity: "arity"}


def test_encode_writes_none_for_nulls(spark):
    df = spark.createDataFrame([(1, None, "t")], "a bigint, b string, c string")
    assert records.encode_lines(df, ["a", "b", "c"]).first().value == "1|None|t"


def test_decode_users_reads_none_as_null(spark):
    df = spark.createDataFrame([("5|bob|None|None|1|2",), ("5|bob|m",)], "value string")
    rows = records.decode_users(df).collect()
    assert len(rows) == 1 and rows[0].gender is None and rows[0].follow_count == 1


def test_strip_tags_keeps_comments_and_bare_lt(spark):
    df = spark.createDataFrame([('a<b>x</b> 1 < 2 <a href="u">y</a><!-- c -->',)], "h string")
    assert df.select(strip_tags("h").alias("t")).first().t == "ax 1 < 2 y<!-- c -->"


def test_comment_json_guards(spark):
    raws = ['{"ok": 1}', '{"data": {}}', '{"data": {"data": []}}',
            '{"data": {"data": [{"id": 3, "text": "<b>hi</b>", "like_count": 2, "user": {"id": 9, "gender": "f"}}]}}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "monitor_id int, raw string")
    out = records.extract_comments(df).collect()
    assert [(r.monitor_id, r.comment_id, r.text, r.user_id) for r in out] == [(3, "3", "hi", "9")]


def test_post_json_and_author_union(spark):
    raw = ('{"data": {"cards": [{"mblog": {"id": 1, "mid": 1, "text": "<p>x</p>", "user": {"id": 5}}},'
           ' {"other": 1}]}}')
    posts = records.extract_posts(spark.createDataFrame([(0, raw)], "monitor_id int, raw string"))
    rows = posts.collect()
    assert [(r.post_id, r.text, r.user_id) for r in rows] == [("1", "x", "5")]
    com = records.extract_comments(spark.createDataFrame([(0, '{"data": {"data": [{"id": 2, "user": {"id": 6}}]}}')],
                                                         "monitor_id int, raw string"))
    users = sorted(r.user_id for r in records.author_union(posts, com).collect())
    assert users == ["5", "6"]


def test_ids_as_numbers_or_text(spark):
    raws = ['{"data": {"cards": [{"mblog": {"id": 7, "mid": "m-7", "text": "a", "user": {"id": "9"}}}]}}',
            '{"data": {"cards": [{"mblog": {"id": "x8", "mid": 8, "text": "b", "user": {"id": 9}}}]}}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "monitor_id int, raw string")
    rows = records.extract_posts(df).orderBy("monitor_id").collect()
    assert [(r.post_id, r.mid, r.user_id) for r in rows] == [("7", "m-7", "9"), ("x8", "8", "9")]


def test_rejects_for_every_reason(spark):
    day = "Sat Jan 18 20:03:51 +0800 2020"
    lines = [f"1|m|{day}|2|3|ok", f"None|m|{day}|2|None|absent ids", f"x|m|{day}|2|3|text id", f"1|m|{day}|2|u|text user", "1|m|never|2|3|bad day", "1|2"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert {(r.comment_id, r.user_id, r.text) for r in records.decode_comments(df).collect()} == {
        ("1", "3", "ok"), (None, None, "absent ids"), ("x", "3", "text id"), ("1", "u", "text user")}
    assert {r.value: r.reason for r in records.comment_rejects(df).collect()} == {
        lines[4]: "created_at", lines[5]: "arity"}
    users = ["5|n|m|d|1|2", "q|n|m|d|1|2", "5|n"]
    df = spark.createDataFrame([(x,) for x in users], "value string")
    assert [r.user_id for r in records.decode_users(df).collect()] == ["5", "q"]
    assert {r.value: r.reason for r in records.user_rejects(df).collect()} == {users[2]: "arity"}

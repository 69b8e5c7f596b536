"""DuckDB SQL twins of the batch query set.

Each entry runs on the driver's tables registered as views and must return the
same columns (names and values) as the Spark query of the same name.  The SQL
is written independently from the Spark code: fixture views are inlined as
CTEs, patterns are RE2, and words, folding and labels are stated here again.
"""

from __future__ import annotations

from moodwatch.plans import batch as B


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# dictionary words (the longest first), runs of letters and digits outside Han, single Han characters
SEG_RE = r"北京加油|数加|牛逼|(?:[^\P{L}\p{Han}]|[^\P{N}\p{Han}])+|\p{Han}"
# full-width forms U+FF01 to U+FF5E and the wide blank
WIDE, NARROW = "".join(map(chr, range(0xFF01, 0xFF5F))) + chr(0x3000), "".join(map(chr, range(0x21, 0x7F))) + " "


def tokens(col: str) -> str:
    return (f"list_filter(regexp_extract_all(lower(translate({col}, {_q(WIDE)}, {_q(NARROW)})), "
            f"{_q(SEG_RE)}), lambda t: t NOT IN ('的', '了', '过'))")


HAN_SQL = "['北京加油了', '数加的ABC牛逼', '过年好，北京 加油', 'ｑｑ数加', '牛逼北京加油数加过了的']"


def jvm_split(col: str, sep_re: str, sep: str) -> str:
    s = f"regexp_replace({col}, '(?:{sep_re})+\\z', '')"
    return f"CASE WHEN {s} = '' AND {col} <> '' THEN []::VARCHAR[] ELSE string_split_regex({s}, '{sep_re}') END"


def user_key(n: str) -> str:
    return f"CASE WHEN {n} % 5 = 0 THEN concat('u', {n}) ELSE CAST({n} AS VARCHAR) END"


USERS = f"""users AS (
  SELECT {user_key('c_custkey')} AS user_id, c_custkey AS user_number, c_name AS user_name,
         CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'm'
              WHEN c_mktsegment IN ('FURNITURE','HOUSEHOLD') THEN 'f' END AS gender,
         c_mktsegment AS description, CAST(c_nationkey AS BIGINT) AS follow_count,
         CAST(floor(abs(c_acctbal)) AS BIGINT) AS followers_count
  FROM customer WHERE c_custkey % 7 <> 0)"""

COMMENTS = f"""comments AS (
  SELECT CASE WHEN d.doc_id % 3 = 0 THEN concat('c', d.doc_id) ELSE CAST(d.doc_id AS VARCHAR) END AS comment_id, d.source AS monitor_id, e.ts AS created_at,
         CAST(floor(abs(e.value)) AS BIGINT) AS like_count, {user_key('e.user_id')} AS user_id, d.text AS text
  FROM documents d JOIN events e ON d.doc_id = e.event_id)"""

LINES = """lines AS (
  SELECT comment_id, concat_ws('|', coalesce(comment_id, 'None'), coalesce(monitor_id, 'None'),
         coalesce(strftime(created_at, '%a %b %d %H:%M:%S +0000 %Y'), 'None'),
         coalesce(CAST(like_count AS VARCHAR), 'None'), coalesce(user_id, 'None'),
         coalesce(text, 'None')) AS value
  FROM comments)"""

FIELDS = f"""fields AS (
  SELECT value, {jvm_split('value', '[|]', '|')} AS f FROM lines)"""

DECODED = """decoded AS (
  SELECT nullif(f[1], 'None') AS comment_id, f[2] AS monitor_id, f[3] AS created_at,
         make_timestamp(epoch_us(try_strptime(substr(f[3], 5), '%b %d %H:%M:%S %z %Y'))) AS ts,
         TRY_CAST(f[4] AS BIGINT) AS like_count, nullif(f[5], 'None') AS user_id, f[6] AS text
  FROM fields WHERE len(f) = 6),
valid AS (
  SELECT *, date_trunc('hour', ts) AS hour,
         date_trunc('day', ts) + to_hours(hour(ts) % 12) AS hour12
  FROM decoded WHERE ts IS NOT NULL)"""

SEGMENTED = f"""segmented AS (
  SELECT comment_id, monitor_id, {tokens('text')} AS tokens FROM valid),
words AS (SELECT monitor_id, unnest(tokens) AS word FROM segmented),
word_counts AS (SELECT monitor_id, word, count(*) AS n FROM words GROUP BY monitor_id, word)"""

SCORED = """scored AS (
  SELECT event_id AS comment_id, event_type AS monitor_id, ts AS created_at,
         CAST(event_id % 101 AS DOUBLE) / 100.0 AS p0, 1.0 - CAST(event_id % 101 AS DOUBLE) / 100.0 AS p1
  FROM events),
banded AS (
  SELECT comment_id, monitor_id, date_trunc('hour', created_at) AS hour,
         date_trunc('day', created_at) + to_hours(hour(created_at) % 12) AS hour12,
         CAST(CASE WHEN abs(p0 - p1) < 0.3 THEN 2.0 WHEN p1 > p0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label
  FROM scored),
wide AS (
  SELECT monitor_id, hour,
         count(*) FILTER (WHERE label = 0.0) AS positive,
         count(*) FILTER (WHERE label = 1.0) AS negative,
         count(*) FILTER (WHERE label = 2.0) AS neutral
  FROM banded GROUP BY monitor_id, hour)"""

MONITORS = """monitors AS (
  SELECT c.c_custkey AS monitor_id, c.c_name AS name,
         concat_ws(',', n.n_name, r.r_name, c.c_mktsegment) AS words, DATE '2024-01-01' AS created
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
keywords AS (
  SELECT monitor_id, CAST(unnest(range(len(l))) AS INTEGER) AS keyword_pos, unnest(l) AS keyword
  FROM (SELECT monitor_id, __SPLIT__ AS l FROM monitors)),
frontier AS (
  SELECT monitor_id, keyword_pos, keyword, CAST(p.page AS INTEGER) AS page,
         replace(replace('__TEMPLATE__', '$1', replace(url_encode(keyword), '%2F', '/')), '$2', CAST(p.page AS VARCHAR)) AS url
  FROM keywords, range(0, 10) p(page))"""

TAG_RE = r"</?[\p{L}\p{N}_]+[^>]*>"


def strip(col: str) -> str:
    return f"regexp_replace({col}, '{TAG_RE}', '', 'g')"


POSTS = f"""posts AS (
  SELECT CAST(floor(p.page_id / 10) AS BIGINT) AS monitor_id, p.page_id AS post_id, p.page_id AS mid,
         CAST(NULL AS VARCHAR) AS created_at, {strip('p.html')} AS text, p.url AS source,
         CAST(length(p.html) AS BIGINT) AS reposts_count, CAST(length(p.url) AS BIGINT) AS comments_count,
         p.page_id AS attitudes_count, u.user_id, u.user_name, u.gender, u.description, u.follow_count,
         u.followers_count
  FROM pages p LEFT JOIN users u ON p.page_id = u.user_number)"""

CONV_COMMENTS = f"""conv_comments AS (
  SELECT c.conv_id AS monitor_id, c.conv_id * 1000 + c.turn AS comment_id,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(c.turn), '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
         c.turn AS like_count, u.user_id, {strip('c.text')} AS text,
         u.user_name, u.gender, u.description, u.follow_count, u.followers_count
  FROM conversations c LEFT JOIN users u ON c.conv_id + c.turn = u.user_number)"""

LABELLED = """labelled AS (
  SELECT d.doc_id, d.text, CAST(l.toxic AS DOUBLE) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _model_terms(src: str, name: str) -> str:
    """tokens -> whitespace tokenizer (empty text -> one empty token) -> tf rows."""
    return f"""{name}_tok AS (
  SELECT doc_id, {tokens('text')} AS t FROM {src}),
{name}_tf AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(CASE WHEN len(t) = 0 THEN [''] ELSE t END) AS term FROM {name}_tok)
  GROUP BY doc_id, term)"""


IDF = """idf AS (
  SELECT term, ln(((SELECT count(*) FROM labelled) + 1.0) / (count(*) + 1.0)) AS idf
  FROM lab_tf GROUP BY term)"""

NB = """lab_x AS (
  SELECT t.doc_id, l.label, t.term, t.tf * i.idf AS x
  FROM lab_tf t JOIN idf i USING (term) JOIN labelled l USING (doc_id)),
priors AS (
  SELECT ln(count(*) FILTER (WHERE label = 0.0) + 1.0) - ln(count(*) + 2.0) AS prior0,
         ln(count(*) FILTER (WHERE label = 1.0) + 1.0) - ln(count(*) + 2.0) AS prior1
  FROM labelled),
class_tot AS (
  SELECT sum(x) FILTER (WHERE label = 0.0) AS s0, sum(x) FILTER (WHERE label = 1.0) AS s1 FROM lab_x),
theta AS (
  SELECT i.term,
         ln(coalesce(sum(x.x) FILTER (WHERE x.label = 0.0), 0.0) + 1.0)
           - ln((SELECT s0 FROM class_tot) + (SELECT count(*) FROM idf)) AS theta0,
         ln(coalesce(sum(x.x) FILTER (WHERE x.label = 1.0), 0.0) + 1.0)
           - ln((SELECT s1 FROM class_tot) + (SELECT count(*) FROM idf)) AS theta1
  FROM idf i LEFT JOIN lab_x x USING (term)
  GROUP BY i.term),
doc_scores AS (
  SELECT t.doc_id, sum(t.tf * i.idf * th.theta0) AS d0, sum(t.tf * i.idf * th.theta1) AS d1
  FROM all_tf t JOIN idf i USING (term) JOIN theta th USING (term)
  GROUP BY t.doc_id),
pair AS (
  SELECT d.doc_id, (SELECT prior0 FROM priors) + coalesce(s.d0, 0.0) AS r0,
         (SELECT prior1 FROM priors) + coalesce(s.d1, 0.0) AS r1
  FROM (SELECT DISTINCT doc_id FROM all_tok) d LEFT JOIN doc_scores s USING (doc_id))"""


# MurmurHash3 (32 bits, seed 42) of a term's UTF-8 bytes, modulo 2^18: the public algorithm in
# unsigned arithmetic.  ``blocks`` holds the whole little-endian words, ``tail`` the rest.
_M = "4294967295::UBIGINT"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) & {_M} | (({x}) >> {32 - r}))"


def _mix_word(words: str) -> str:
    a = f"list_transform({words}, lambda w: (w * 3432918353::UBIGINT) & {_M})"
    return f"list_transform(list_transform({a}, lambda w: {_rotl('w', 15)}), lambda w: (w * 461845907::UBIGINT) & {_M})"


def hashed_terms(*sources: str) -> str:
    byte = "lambda i: ((strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1)::UBIGINT"
    word = "lambda j: b[4 * j + 1] | (b[4 * j + 2] << 8) | (b[4 * j + 3] << 16) | (b[4 * j + 4] << 24)"
    final = "h"
    steps = []
    for k, (shift, factor) in enumerate(((16, 2246822507), (13, 3266489909), (16, None))):
        mixed = f"xor({final}, {final} >> {shift})"
        steps.append(f"f{k} AS (SELECT term, {mixed if factor is None else f'({mixed} * {factor}::UBIGINT) & {_M}'} AS h FROM {f'f{k - 1}' if k else 'sums'})")
    return f"""term_hex AS (
  SELECT DISTINCT term, hex(encode(term)) AS x FROM ({' UNION ALL '.join(f'SELECT term FROM {s}' for s in sources)})),
term_bytes AS (SELECT term, list_transform(range(len(x) // 2), {byte}) AS b FROM term_hex),
term_words AS (
  SELECT term, len(b)::UBIGINT AS n, list_transform(range(len(b) // 4), {word}) AS blocks,
         list_reduce(list_prepend(0::UBIGINT, list_transform(range(len(b) % 4), lambda i: b[len(b) // 4 * 4 + i + 1] << (8 * i))), lambda p, q: p | q) AS tail
  FROM term_bytes),
sums AS (
  SELECT term, xor(xor(list_reduce(list_prepend(42::UBIGINT, {_mix_word('blocks')}),
               lambda h, k: ({_rotl('xor(h, k)', 13)} * 5::UBIGINT + 3864292196::UBIGINT) & {_M}), {_mix_word('[tail]')}[1]), n) AS h
  FROM term_words),
{', '.join(steps)},
buckets AS (SELECT term, h % 262144 AS bucket FROM f2)"""


# the model over hashed terms: an unseen bucket has no document, so its idf is ln(N + 1)
HASHED_NB = """lab_h AS (SELECT doc_id, bucket, sum(tf) AS tf FROM lab_tf JOIN buckets USING (term) GROUP BY ALL),
all_h AS (SELECT doc_id, bucket, sum(tf) AS tf FROM all_tf JOIN buckets USING (term) GROUP BY ALL),
size AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 0.0) AS n0, count(*) FILTER (WHERE label = 1.0) AS n1 FROM labelled),
bucket_x AS (
  SELECT bucket, ln((any_value(n) + 1.0) / (count(*) + 1.0)) AS idf,
         coalesce(sum(tf) FILTER (WHERE label = 0.0), 0.0) * ln((any_value(n) + 1.0) / (count(*) + 1.0)) AS x0,
         coalesce(sum(tf) FILTER (WHERE label = 1.0), 0.0) * ln((any_value(n) + 1.0) / (count(*) + 1.0)) AS x1
  FROM lab_h JOIN labelled USING (doc_id), size GROUP BY bucket),
class_sum AS (SELECT ln(sum(x0) + 262144.0) AS s0, ln(sum(x1) + 262144.0) AS s1 FROM bucket_x),
pair AS (
  SELECT a.doc_id,
         any_value(ln(n0 + 1.0) - ln(n + 2.0)) + sum(a.tf * coalesce(b.idf, ln(n + 1.0)) * (ln(coalesce(b.x0, 0.0) + 1.0) - s0)) AS r0,
         any_value(ln(n1 + 1.0) - ln(n + 2.0)) + sum(a.tf * coalesce(b.idf, ln(n + 1.0)) * (ln(coalesce(b.x1, 0.0) + 1.0) - s1)) AS r1
  FROM all_h a LEFT JOIN bucket_x b USING (bucket), size, class_sum GROUP BY a.doc_id)"""


def _queries() -> dict[str, str]:
    base = [COMMENTS, LINES]
    dec = base + [FIELDS, DECODED]
    seg = dec + [SEGMENTED]
    frontier_tpl = (MONITORS.replace("__TEMPLATE__", B_TEMPLATE)
                    .replace("__SPLIT__", jvm_split("words", ",", ",")))
    q = {}
    q["record_encode"] = _with(*base) + "SELECT comment_id, value FROM lines"
    q["record_filter"] = _with(*base, FIELDS) + "SELECT value FROM fields WHERE len(f) = 6"
    q["record_decode"] = _with(*dec) + ("SELECT comment_id, monitor_id, created_at, like_count, user_id, text "
                                        "FROM valid")
    rejected = """SELECT value, CASE WHEN len(f) <> 6 THEN 'arity' ELSE 'created_at' END AS reason
FROM fields
WHERE len(f) <> 6 OR try_strptime(substr(f[3], 5), '%b %d %H:%M:%S %z %Y') IS NULL"""
    q["record_rejects"] = _with(*dec) + rejected
    q["created_at_parse"] = _with(*dec) + "SELECT comment_id, ts FROM valid"
    q["hour_bucket"] = _with(*dec) + "SELECT comment_id, hour FROM valid"
    q["hour_bucket_12h"] = _with(*dec) + "SELECT comment_id, hour12 AS hour FROM valid"
    q["segment"] = _with(*seg) + ("SELECT comment_id, monitor_id, array_to_string(tokens, ' ') AS comment_text, "
                                  "CAST(len(tokens) AS INTEGER) AS n_tokens FROM segmented")
    number = "CAST(ltrim(comment_id, 'c') AS BIGINT)"
    han_text = f"concat(text, {HAN_SQL}[{number} % 5 + 1], ' ', {HAN_SQL}[CAST(floor({number} / 7) AS BIGINT) % 5 + 1], {number})"
    han = dec + [f"""han AS (SELECT * REPLACE ({han_text} AS text) FROM valid),
segmented AS (SELECT comment_id, monitor_id, {tokens('text')} AS tokens FROM han)"""]
    q["segment_han"] = _with(*han) + ("SELECT comment_id, monitor_id, array_to_string(tokens, ' ') AS comment_text, "
                                      "CAST(len(tokens) AS INTEGER) AS n_tokens FROM segmented")
    q["word_counts_han"] = _with(*han) + """SELECT monitor_id, word, count(*) AS n
FROM (SELECT monitor_id, unnest(tokens) AS word FROM segmented) GROUP BY monitor_id, word"""
    q["segment_dict"] = q["segment"]
    letters = "".join(chr(0x4E00 + i) for i in range(26))
    q["segment_coarse"] = rf"""WITH RECURSIVE han AS (
  SELECT doc_id, regexp_extract_all(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', '{letters}'), '[\p{{L}}\p{{N}}]+') AS runs FROM documents),
placed AS (SELECT doc_id, unnest(runs) AS run, generate_subscripts(runs, 1) AS place FROM han),
dictionary AS (SELECT DISTINCT run AS word FROM placed WHERE regexp_full_match(run, '\p{{Han}}{{2,4}}')),
elements AS (
  SELECT run, regexp_extract_all(run, '(?:[^\P{{L}}\p{{Han}}]|[^\P{{N}}\p{{Han}}])+|\p{{Han}}') AS e FROM (SELECT DISTINCT run FROM placed)),
stretches AS (
  SELECT run, i, n, array_to_string(e[i:i + n - 1], '') AS word
  FROM (SELECT run, e, unnest(range(1, len(e) + 1)) AS i FROM elements), (VALUES (2), (3), (4)) k(n) WHERE i + n - 1 <= len(e)),
hits AS (SELECT run, i, list(n ORDER BY n) AS ns FROM stretches JOIN dictionary USING (word) GROUP BY run, i),
-- from the right: best[k] is the least (tokens, -length of the first word) from place i + k - 1 on
folded(run, i, best) AS (
  SELECT run, len(e) + 1, [(0, 0)] FROM elements
  UNION ALL
  SELECT f.run, f.i - 1, list_prepend(list_min(list_prepend((f.best[1][1] + 1, -1),
           list_transform(coalesce(h.ns, []::INTEGER[]), lambda n: (f.best[n][1] + 1, -n)))), f.best)
  FROM folded f LEFT JOIN hits h ON h.run = f.run AND h.i = f.i - 1 WHERE f.i > 1),
walked(run, i, tokens) AS (
  SELECT run, 1, []::VARCHAR[] FROM elements
  UNION ALL
  SELECT w.run, w.i - c.best[w.i][2], list_append(w.tokens, array_to_string(e.e[w.i:w.i - c.best[w.i][2] - 1], ''))
  FROM walked w JOIN elements e USING (run) JOIN folded c ON c.run = w.run AND c.i = 1 WHERE w.i <= len(e.e)),
cut AS (SELECT w.run, w.tokens FROM walked w JOIN elements e USING (run) WHERE w.i > len(e.e)),
whole AS (SELECT doc_id, list_filter(flatten(list(tokens ORDER BY place)), lambda t: t NOT IN ('的', '了', '过')) AS tokens
          FROM placed JOIN cut USING (run) GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(tokens, ' '), '') END AS comment_text,
       CASE WHEN text IS NOT NULL THEN coalesce(len(tokens), 0) END::INTEGER AS n_tokens FROM documents LEFT JOIN whole USING (doc_id)"""
    q["word_counts"] = _with(*seg) + "SELECT monitor_id, word, n FROM word_counts"
    q["word_cloud"] = _with(*seg) + (f"SELECT monitor_id, word AS name, n AS value FROM word_counts "
                                     f"WHERE monitor_id = {_q(B.WORD_CLOUD_MONITOR)}")
    q["word_cloud_top"] = _with(*seg) + """SELECT monitor_id, name, value FROM (
  SELECT monitor_id, word AS name, n AS value,
         row_number() OVER (PARTITION BY monitor_id ORDER BY n DESC, word) AS rn FROM word_counts)
WHERE rn <= 20"""
    q["word_lookup"] = _with(*seg) + (f"SELECT monitor_id, word, n FROM word_counts WHERE monitor_id = "
                                      f"{_q(B.WORD_CLOUD_MONITOR)} AND word = {_q(B.LOOKUP_WORD)}")
    q["word_split_count"] = (f"SELECT word, count(*) AS n FROM (SELECT unnest({jvm_split('text', ',', ',')}) AS word "
                             f"FROM documents) GROUP BY word")
    q["neutral_band"] = _with(SCORED) + """SELECT comment_id, monitor_id, hour, label,
       CASE label WHEN 0.0 THEN 'positive' WHEN 1.0 THEN 'negative' WHEN 2.0 THEN 'neutral' END AS label_name
FROM banded"""
    q["sentiment_counts"] = _with(SCORED) + ("SELECT monitor_id, hour, label, count(*) AS n FROM banded "
                                             "GROUP BY monitor_id, hour, label")
    q["trend_wide"] = _with(SCORED) + "SELECT monitor_id, hour, positive, negative, neutral FROM wide"
    q["trend_wide_12h"] = _with(SCORED) + """SELECT monitor_id, hour12 AS hour,
       count(*) FILTER (WHERE label = 0.0) AS positive,
       count(*) FILTER (WHERE label = 1.0) AS negative,
       count(*) FILTER (WHERE label = 2.0) AS neutral
FROM banded GROUP BY monitor_id, hour12"""
    q["trend_pack"] = _with(SCORED) + """SELECT monitor_id, hour,
       concat_ws('|', CASE WHEN positive > 0 THEN '0.0:' || positive END,
                      CASE WHEN negative > 0 THEN '1.0:' || negative END,
                      CASE WHEN neutral > 0 THEN '2.0:' || neutral END) AS packed
FROM wide"""
    q["trend_unpack"] = q["trend_wide"]
    last50 = """last50 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY hour DESC) AS rn FROM wide)
  WHERE rn <= 50)"""
    q["trend_last50"] = _with(SCORED, last50) + "SELECT monitor_id, hour, positive, negative, neutral FROM last50"
    q["trend_last50_one"] = _with(SCORED) + f"""SELECT monitor_id, hour, positive, negative, neutral
FROM wide WHERE monitor_id = {_q(B.TREND_MONITOR)} ORDER BY hour DESC LIMIT 50"""
    q["trend_series"] = _with(SCORED, last50) + """SELECT monitor_id,
       string_agg(strftime(hour, '%Y-%m-%d %H'), ',' ORDER BY hour) AS x,
       string_agg(CAST(positive AS VARCHAR), ',' ORDER BY hour) AS y1,
       string_agg(CAST(negative AS VARCHAR), ',' ORDER BY hour) AS y2,
       string_agg(CAST(neutral AS VARCHAR), ',' ORDER BY hour) AS y3
FROM last50 GROUP BY monitor_id"""
    q["trend_series_12h"] = _with(SCORED) + """, wide12 AS (
  SELECT monitor_id, hour12 AS hour,
         count(*) FILTER (WHERE label = 0.0) AS positive,
         count(*) FILTER (WHERE label = 1.0) AS negative,
         count(*) FILTER (WHERE label = 2.0) AS neutral
  FROM banded GROUP BY monitor_id, hour12),
last50 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY hour DESC) AS rn FROM wide12)
  WHERE rn <= 50)
SELECT monitor_id,
       string_agg(strftime(hour, '%Y-%m-%d %I'), ',' ORDER BY hour) AS x,
       string_agg(CAST(positive AS VARCHAR), ',' ORDER BY hour) AS y1,
       string_agg(CAST(negative AS VARCHAR), ',' ORDER BY hour) AS y2,
       string_agg(CAST(neutral AS VARCHAR), ',' ORDER BY hour) AS y3
FROM last50 GROUP BY monitor_id"""
    q["profile_latest"] = """SELECT user_id, updated_at, seq, description, followers_count, props FROM (
  SELECT user_id, ts AS updated_at, event_id AS seq, event_type AS description,
         CAST(floor(abs(value)) AS BIGINT) AS followers_count, props,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""
    gj = dec + [USERS, """joined AS (
  SELECT v.comment_id, v.monitor_id, v.user_id, u.gender FROM valid v LEFT JOIN users u ON v.user_id = u.user_id),
gcounts AS (SELECT monitor_id, gender, count(*) AS n FROM joined GROUP BY monitor_id, gender),
breakdown AS (
  SELECT monitor_id, CASE gender WHEN 'm' THEN '男' WHEN 'f' THEN '女' ELSE '其它' END AS name,
         CAST(sum(n) AS BIGINT) AS value
  FROM gcounts GROUP BY ALL)"""]
    q["gender_join"] = _with(*gj) + "SELECT comment_id, monitor_id, user_id, gender FROM joined"
    q["gender_counts"] = _with(*gj) + "SELECT monitor_id, gender, n FROM gcounts"
    q["gender_counts_split"] = q["gender_counts"]
    q["gender_counts_bucketed"] = q["gender_counts"]
    q["gender_breakdown"] = _with(*gj) + "SELECT monitor_id, name, value FROM breakdown"
    q["gender_share"] = _with(*gj) + """SELECT monitor_id, name, value,
       round(value * 100.0 / sum(value) OVER (PARTITION BY monitor_id), 6) AS share FROM breakdown"""
    q["keyword_explode"] = _with(frontier_tpl) + "SELECT monitor_id, keyword_pos, keyword FROM keywords"
    typed = MONITORS.replace("concat_ws(',', n.n_name", "concat_ws(', ', n.n_name").replace(
        "__TEMPLATE__", B_TEMPLATE)
    q["keyword_explode_typed"] = _with(typed.replace("__SPLIT__", jvm_split("words", ",", ","))) + (
        "SELECT monitor_id, keyword_pos, keyword FROM keywords")
    q["keyword_explode_multi"] = _with(typed.replace("__SPLIT__", jvm_split("words", "[, ]+", ","))) + (
        "SELECT monitor_id, keyword_pos, keyword FROM keywords")
    q["url_frontier"] = _with(frontier_tpl) + "SELECT monitor_id, keyword, page, url FROM frontier"
    q["url_owner"] = _with(frontier_tpl) + ("SELECT url, arg_max(monitor_id, (monitor_id, keyword_pos)) AS monitor_id "
                                            "FROM frontier GROUP BY url")
    q["url_owner_all"] = _with(frontier_tpl) + "SELECT DISTINCT url, monitor_id FROM frontier"
    q["monitor_list"] = _with(frontier_tpl) + "SELECT monitor_id, name, words, created FROM monitors"
    q["monitor_page"] = _with(frontier_tpl) + f"""SELECT monitor_id, name, words, created FROM monitors
WHERE contains(CAST(monitor_id AS VARCHAR), {_q(B.PAGE_SEARCH)}) OR contains(name, {_q(B.PAGE_SEARCH)})
   OR contains(words, {_q(B.PAGE_SEARCH)}) OR contains(CAST(created AS VARCHAR), {_q(B.PAGE_SEARCH)})
ORDER BY monitor_id LIMIT {B.PAGE_SIZE} OFFSET {(B.PAGE_NUMBER - 1) * B.PAGE_SIZE}"""
    q["monitor_page_sorted"] = q["monitor_page"].replace(
        "ORDER BY monitor_id LIMIT", "ORDER BY name DESC, monitor_id LIMIT")
    q["monitor_append"] = f"""SELECT CAST((SELECT max(c.c_custkey) FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
               JOIN region r ON n.n_regionkey = r.r_regionkey) + row_number() OVER (ORDER BY s.s_name) AS BIGINT)
         AS monitor_id, s.s_name AS name, n.n_name AS words, DATE {_q(B.APPEND_DATE)} AS created
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""
    q["table_get"] = _with(USERS) + f"SELECT * EXCLUDE (user_number) FROM users WHERE user_id = {_q(B.TABLE_GET_KEY)}"
    q["html_strip"] = f"SELECT page_id, {strip('html')} AS text FROM pages"
    q["json_posts"] = _with(USERS, POSTS) + """SELECT monitor_id, CAST(post_id AS VARCHAR) AS post_id, CAST(mid AS VARCHAR) AS mid, created_at, text, source, reposts_count,
       comments_count, attitudes_count, user_id FROM posts"""
    q["json_posts_files"] = q["json_posts"]
    q["json_comments"] = _with(USERS, CONV_COMMENTS) + """SELECT monitor_id, CAST(comment_id AS VARCHAR) AS comment_id, created_at, like_count, user_id, text
FROM conv_comments"""
    q["author_union"] = _with(USERS, POSTS, CONV_COMMENTS) + """SELECT user_id, user_name, gender, description, follow_count, followers_count
FROM posts WHERE user_id IS NOT NULL
UNION ALL
SELECT user_id, user_name, gender, description, follow_count, followers_count
FROM conv_comments WHERE user_id IS NOT NULL"""
    none = "'None'"
    q["post_lines"] = _with(USERS, POSTS) + f"""SELECT CAST(post_id AS VARCHAR) AS post_id, concat_ws('|', coalesce(CAST(post_id AS VARCHAR), {none}),
       coalesce(CAST(monitor_id AS VARCHAR), {none}), coalesce(CAST(user_id AS VARCHAR), {none}),
       coalesce(source, {none}), coalesce(CAST(reposts_count AS VARCHAR), {none}),
       coalesce(CAST(comments_count AS VARCHAR), {none}), coalesce(CAST(attitudes_count AS VARCHAR), {none}),
       coalesce(text, {none})) AS value
FROM posts"""
    q["user_lines"] = _with(USERS, POSTS, CONV_COMMENTS) + f"""SELECT concat_ws('|', coalesce(CAST(user_id AS VARCHAR), {none}),
       coalesce(user_name, {none}), coalesce(gender, {none}), coalesce(description, {none}),
       coalesce(CAST(follow_count AS VARCHAR), {none}), coalesce(CAST(followers_count AS VARCHAR), {none})) AS value
FROM (SELECT user_id, user_name, gender, description, follow_count, followers_count FROM posts WHERE user_id IS NOT NULL
      UNION ALL
      SELECT user_id, user_name, gender, description, follow_count, followers_count FROM conv_comments
      WHERE user_id IS NOT NULL)"""
    url = ("replace(replace('__TEMPLATE__', '$1', replace(url_encode(n.n_name), '%2F', '/')), '$2', "
           "CAST(p.monitor_id % 10 AS VARCHAR))").replace("__TEMPLATE__", B_TEMPLATE)
    q["ingest_lines"] = _with(USERS, POSTS, CONV_COMMENTS, frontier_tpl, f"""owner AS (
  SELECT url, arg_max(monitor_id, (monitor_id, keyword_pos)) AS owner_id FROM frontier GROUP BY url),
tposts AS (
  SELECT p.*, o.owner_id FROM posts p JOIN nation n ON n.n_nationkey = p.monitor_id % 25 JOIN owner o ON o.url = {url}),
tcom AS (
  SELECT c.* EXCLUDE (monitor_id), t.owner_id FROM conv_comments c
  JOIN (SELECT DISTINCT post_id, owner_id FROM tposts) t ON c.monitor_id = t.post_id),
authors AS (
  SELECT user_id, user_name, gender, description, follow_count, followers_count FROM tposts WHERE user_id IS NOT NULL
  UNION ALL
  SELECT user_id, user_name, gender, description, follow_count, followers_count FROM tcom WHERE user_id IS NOT NULL)""") + f"""
SELECT 'wz' AS topic, concat_ws('|', CAST(post_id AS VARCHAR), CAST(owner_id AS VARCHAR), coalesce(CAST(user_id AS VARCHAR), {none}),
       coalesce(source, {none}), coalesce(CAST(reposts_count AS VARCHAR), {none}),
       coalesce(CAST(comments_count AS VARCHAR), {none}), coalesce(CAST(attitudes_count AS VARCHAR), {none}),
       coalesce(text, {none})) AS value FROM tposts
UNION ALL
SELECT 'user', concat_ws('|', CAST(user_id AS VARCHAR), coalesce(user_name, {none}), coalesce(gender, {none}),
       coalesce(description, {none}), coalesce(CAST(follow_count AS VARCHAR), {none}),
       coalesce(CAST(followers_count AS VARCHAR), {none})) FROM authors
UNION ALL
SELECT 'com', concat_ws('|', CAST(comment_id AS VARCHAR), CAST(owner_id AS VARCHAR), coalesce(created_at, {none}),
       coalesce(CAST(like_count AS VARCHAR), {none}), coalesce(CAST(user_id AS VARCHAR), {none}), coalesce(text, {none})) FROM tcom"""
    q["comment_frontier"] = _with(USERS, POSTS) + """SELECT DISTINCT CAST(post_id AS VARCHAR) AS post_id, CAST(mid AS VARCHAR) AS mid,
       concat('https://search.example.org/api/comments?id=', post_id, '&mid=', mid) AS url FROM posts"""
    q["monitor_table"] = q["monitor_list"] + "\nUNION ALL\n(" + q["monitor_append"] + ")"
    q["monitor_register"] = q["monitor_list"] + f"""
UNION ALL
SELECT CAST((SELECT max(c_custkey) FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
         + row_number() OVER (ORDER BY (length(s.s_name) + ascii(right(s.s_name, 1))) % 2, s.s_name) AS BIGINT),
       s.s_name, n.n_name, DATE {_q(B.APPEND_DATE)}
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""
    q["table_put"] = _with(USERS) + """SELECT user_id, user_name, CASE WHEN user_number % 2 = 0 THEN NULL ELSE gender END AS gender,
       description, follow_count, followers_count FROM users"""
    q["comment_dedup"] = _with(*dec) + "SELECT comment_id, monitor_id, like_count + 1 AS like_count, user_id, text FROM valid"
    q["tfidf"] = _with(LABELLED, _model_terms("labelled", "lab"), IDF) + """SELECT t.doc_id, t.term, t.tf, round(t.tf * i.idf, 6) AS tfidf
FROM lab_tf t JOIN idf i USING (term)"""
    q["nb_vocab_score"] = _with(LABELLED, _model_terms("labelled", "lab"), IDF,
                                _model_terms("documents", "all"), NB) + """SELECT doc_id,
       CAST(CASE WHEN r1 > r0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction,
       round(1.0 / (1.0 + exp(r1 - r0)), 6) AS p0,
       round(1.0 / (1.0 + exp(r0 - r1)), 6) AS p1
FROM pair"""
    comment_docs = "cdocs AS (SELECT comment_id AS doc_id, text, monitor_id, hour FROM valid)"
    q["sentiment_trend_vocab"] = _with(*dec, LABELLED, _model_terms("labelled", "lab"), IDF, comment_docs,
                                       _model_terms("cdocs", "all"), NB) + """, scored AS (
  SELECT c.monitor_id, c.hour,
         1.0 / (1.0 + exp(p.r1 - p.r0)) AS p0, 1.0 / (1.0 + exp(p.r0 - p.r1)) AS p1,
         CASE WHEN p.r1 > p.r0 THEN 1.0 ELSE 0.0 END AS prediction
  FROM pair p JOIN cdocs c USING (doc_id)),
banded AS (
  SELECT monitor_id, hour, CASE WHEN abs(p0 - p1) < 0.3 THEN 2.0 ELSE prediction END AS label FROM scored)
SELECT monitor_id, hour,
       count(*) FILTER (WHERE label = 0.0) AS positive,
       count(*) FILTER (WHERE label = 1.0) AS negative,
       count(*) FILTER (WHERE label = 2.0) AS neutral
FROM banded GROUP BY monitor_id, hour"""
    q["stream_trend_vocab"] = q["sentiment_trend_vocab"]
    hashed = _with(*dec, LABELLED, _model_terms("labelled", "lab"), comment_docs, _model_terms("cdocs", "all"),
                   hashed_terms("lab_tf", "all_tf"), HASHED_NB) + """, scored AS (
  SELECT c.doc_id, c.monitor_id, c.hour,
         1.0 / (1.0 + exp(p.r1 - p.r0)) AS p0, 1.0 / (1.0 + exp(p.r0 - p.r1)) AS p1,
         CAST(CASE WHEN p.r1 > p.r0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
  FROM pair p JOIN cdocs c USING (doc_id)),
banded AS (
  SELECT *, CAST(CASE WHEN abs(p0 - p1) < 0.3 THEN 2.0 ELSE prediction END AS DOUBLE) AS label FROM scored)
"""
    q["sentiment_score"] = hashed + """SELECT doc_id AS comment_id, monitor_id, hour, prediction, label,
       CASE label WHEN 0.0 THEN 'positive' WHEN 1.0 THEN 'negative' ELSE 'neutral' END AS label_name
FROM banded"""
    q["sentiment_loaded"] = q["sentiment_score"]
    q["sentiment_trend"] = hashed + """SELECT monitor_id, hour,
       count(*) FILTER (WHERE label = 0.0) AS positive,
       count(*) FILTER (WHERE label = 1.0) AS negative,
       count(*) FILTER (WHERE label = 2.0) AS neutral
FROM banded GROUP BY monitor_id, hour"""
    q["stream_trend"] = q["sentiment_trend"]
    # streams: the latest view of each sink equals the batch result
    q["stream_word_counts"] = q["word_counts"]
    q["stream_gender_counts"] = q["gender_counts"]
    q["stream_gender_counts_delta"] = q["gender_counts"]
    q["stream_word_counts_delta"] = q["word_counts"]
    q["stream_word_cloud_compacted"] = _with(*seg) + "SELECT monitor_id, word, n * 2 AS n FROM word_counts"
    q["stream_gender_arrival"] = _with(*gj) + """SELECT v.monitor_id, CASE WHEN CAST(ltrim(v.comment_id, 'c') AS BIGINT) % 2 = 1 THEN u.gender END AS gender, count(*) AS n
FROM valid v LEFT JOIN users u ON v.user_id = u.user_id GROUP BY ALL"""
    mangled = LINES.replace("lines AS (", "whole AS (") + """,
lines AS (
  SELECT comment_id, CASE CAST(ltrim(comment_id, 'c') AS BIGINT) % 7
           WHEN 1 THEN array_to_string(string_split(value, '|')[1:5], '|') WHEN 2 THEN replace(value, '+0000', 'noon')
           WHEN 3 THEN '' ELSE value END AS value FROM whole)"""
    q["stream_rejects"] = _with(COMMENTS, mangled, FIELDS, DECODED, SEGMENTED) + f"""SELECT monitor_id, word, NULL::VARCHAR AS reason, n FROM word_counts
UNION ALL
SELECT NULL, value, reason, count(*) FROM ({rejected}) GROUP BY ALL"""
    q["stream_ingest_lines"] = q["ingest_lines"]
    q["stream_word_lookup"] = q["word_lookup"]
    q["stream_trend_series"] = q["trend_series"]
    q["stream_late_rows"] = q["trend_wide"]
    q["stream_trend_delta"] = q["trend_wide"]
    q["stream_trend_scored"] = q["trend_wide"]
    q["stream_trend_windowed"] = q["trend_wide"]
    q["stream_profiles"] = _with(USERS) + ("SELECT user_id, user_name, gender, description, follow_count, "
                                           "followers_count FROM users")
    q["stream_comment_dedup"] = _with(*dec) + "SELECT comment_id, monitor_id, like_count, user_id, text FROM valid"
    q["stream_comment_dedup_within"] = q["stream_comment_dedup"]
    q["stream_comment_dedup_ledger"] = q["stream_comment_dedup"]
    q["stream_gender_heavy"] = q["gender_counts"]
    q["stream_heavy_users"] = _with(*dec) + """SELECT user_id, count(*) AS n FROM valid WHERE user_id IS NOT NULL
GROUP BY user_id HAVING count(*) >= (SELECT count(user_id) FROM valid) * 0.01::DOUBLE"""
    q["stream_model"] = q["nb_vocab_score"]
    q["stream_line_word_count"] = (f"SELECT word, count(*) AS n FROM (SELECT unnest({jvm_split('line', ',', ',')}) "
                                   f"AS word FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) "
                                   f"GROUP BY word")
    return q


B_TEMPLATE = __import__("moodwatch.functions.constants", fromlist=["x"]).DEFAULT_SEARCH_TEMPLATE


def oracle_sql() -> dict[str, str]:
    return _queries()

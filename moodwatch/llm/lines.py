"""Line dedup by a log-template tree, with DataFrame functions only.

A line is split into tokens; tokens with a digit are variable fields (``<*>``).  The tree
has a fixed depth: the number of tokens, then the leading tokens.  In a leaf a token is
constant at its place if a share of the leaf's lines have it there; every other place
generalises to ``<*>``.  A second template of the same line takes a token as constant if
``MIN_DOCS`` lines of the leaf have it at its place, however large the leaf is.  Lines with
too few constant tokens have no template.

A template recurs if it stands in ``MIN_DOCS`` different documents, however many copies of
them there are; or in ``MIN_DOCS`` documents between different neighbours in at least half of
them.  What a document has of its own are the lines whose first and last tokens stand in
fewer than ``MIN_DOCS`` different texts; the least digest of these lines is what it is counted
by, so copies count once.  Documents with little of their own are near copies of each
other, and all of them count as one.  Lines of recurring templates are dropped wherever
they stand; the lines of copied documents stay, for the operators for copies.

Lines are masked and cut into tokens once.  What the counts need is written in columns of
fixed width, next to the masked lines, which are read again for recurring leaves alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwatch.llm.common import hot_join, stored

FIELD = "<*>"
DEPTH, MIN_DOCS = 3, 5
#: a token is constant at its place if this share of the leaf's lines have it there
SUPPORT = 0.2
#: constant tokens among those without digits; lines below are too variable for a template
LIKENESS = 0.7
#: tokens at either end that tell whether a line is shared, and the share of tokens a document has of its own
END, OWN_SHARE = 6, 0.2
#: prefix of columns that are added to the caller's for a while
OWN = "_line_dedup_"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _tokens(masked: Column) -> Column:
    return F.filter(F.split(masked, "[ \t\r]+"), lambda t: t != "")


def _masked(line: Column) -> Column:
    # only at the start of a token, and possessive: linear in the length of any line
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<![^ \t\r])[^ \t\r0-9]*+[0-9][^ \t\r]*+", FIELD)).otherwise(line)


def _digest(text: Column) -> Column:
    """60 bits of a text's MD5, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def line_table(docs: DataFrame) -> DataFrame:
    """(id, row, at, masked, leaf, around, copy, n, first, last, line) for each line with a token of
    (id, row, text).  copy is equal for texts that are equal but for fields; first and last
    are the tokens at the line's ends."""
    edge = F.array(F.lit(""))
    zipped = _let(F.transform(F.split("text", "\n"), _masked), lambda m: F.struct(F.xxhash64(m).alias("copy"), F.arrays_zip(
        m.alias("masked"), F.concat(edge, F.slice(m, 1, F.size(m) - 1)).alias("before"),
        F.concat(F.slice(m, 2, F.size(m)), edge).alias("after")).alias("lines")))
    cut = docs.select("id", "row", zipped.alias("z"))
    rows = cut.select("id", "row", F.col("z")["copy"].alias("copy"), F.posexplode(F.col("z")["lines"]).alias("at", "l"))
    parsed = _let(_tokens(F.col("l")["masked"]), lambda t: F.when(F.size(t) > 0, F.struct(
        F.size(t).alias("n"), F.xxhash64(F.size(t), F.slice(t, 1, DEPTH)).alias("leaf"),
        F.xxhash64(F.lit("first"), F.slice(t, 1, END)).alias("first"),
        F.xxhash64(F.lit("last"), F.slice(t, F.greatest(F.size(t) - END + 1, F.lit(1)), END)).alias("last"))))
    return (rows.select("id", "row", "copy", "at", F.col("l")["masked"].alias("masked"),
                        F.xxhash64(F.col("l")["before"], F.col("l")["after"]).alias("around"), parsed.alias("p"))
            .where("p is not null").select("id", "row", "copy", "at", "masked", "around", "p.*", _digest(F.col("masked")).alias("line")))


def _witnesses(lines: DataFrame) -> DataFrame:
    """(id, witness): the least digest of the lines that a document has of its own, or -1 if they are
    too little of it."""
    ends = lines.select("copy", F.explode(F.array("first", "last")).alias("end")).distinct()
    shared = stored(ends.groupBy("end").agg(F.count("*").alias("texts")).where(f"texts >= {MIN_DOCS}").select("end"), "line_ends")

    def flag(at: str) -> DataFrame:
        return shared.select(F.col("end").alias(at), F.lit(True).alias(f"{at}_shared"))

    marked = lines.select("id", "n", "line", "first", "last").join(flag("first"), "first", "left").join(flag("last"), "last", "left")
    own = F.col("first_shared").isNull() & F.col("last_shared").isNull()
    by_doc = marked.groupBy("id").agg(F.sum("n").alias("n"), F.sum(F.when(own, F.col("n"))).alias("own"),
                                      F.min(F.when(own, F.col("line"))).alias("line"))
    return stored(by_doc.select("id", F.when(F.col("own") >= OWN_SHARE * F.col("n"), F.col("line")).otherwise(-1).alias("witness")),
                  "witnesses")


def _recurring(lines: DataFrame, key: str, witnesses: DataFrame) -> DataFrame:
    """(key, lines) of the keys in enough different documents or between enough different
    neighbours.  Counted by document first, so a frequent key is spread by document, then summed."""
    by_doc = stored(lines.groupBy(key, "id").agg(F.min_by("around", "at").alias("around"), F.count("*").alias("n")), f"{key}_docs")
    often = by_doc.groupBy(key).agg(F.count("*").alias("docs")).where(f"docs >= {MIN_DOCS}").select(key)
    seen = F.array(F.struct(F.lit(False).alias("own"), F.col("around").alias("by")),
                   F.struct(F.lit(True).alias("own"), F.col("witness").alias("by")))
    by_seen = (by_doc.join(stored(often, f"{key}_often"), key).join(witnesses, "id").select(key, "n", F.inline(seen)).groupBy(key, "own", "by")
               .agg(F.count("*").alias("docs"), F.sum("n").alias("n")))
    sums = by_seen.groupBy(key).agg(F.expr("sum(docs) filter (where not own)").alias("docs"), F.expr("sum(n) filter (where not own)").alias("lines"),
                                    F.expr("count_if(not own)").alias("places"), F.expr("count_if(own)").alias("different"))
    return sums.where(f"different >= {MIN_DOCS} or places >= {MIN_DOCS} and 2 * places >= docs").select(key, "lines")


def _templates_by_share(found: DataFrame) -> DataFrame:
    """(id, row, at, around, template) of (id, row, at, masked, around, leaf, lines), with tokens constant
    by their share of the leaf."""
    lines = found.withColumn("tokens", _tokens(F.col("masked"))).drop("masked")
    counts = (lines.select("leaf", "lines", F.posexplode("tokens").alias("place", "token"))
              .groupBy("leaf", "place", "token").agg(F.count("*").alias("n"), F.first("lines").alias("lines")))
    constant = F.when((F.col("n") >= MIN_DOCS) & (F.col("n") >= SUPPORT * F.col("lines")), F.col("token"))
    # at most 1 / SUPPORT tokens a place
    places = counts.groupBy("leaf", "place").agg(F.collect_list(constant).alias("tokens"))
    trees = places.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("place", "tokens"))).alias("tree"))
    template = F.transform("tokens", lambda t, i: F.when(F.array_contains(F.col("tree")[i]["tokens"], t), t).otherwise(FIELD))
    literal = F.size(F.filter("template", lambda t: t != FIELD))
    fixed = F.size(F.filter("tokens", lambda t: t != FIELD))
    return (lines.join(trees, "leaf").withColumn("template", template).where((literal > 0) & (literal >= LIKENESS * fixed))
            .select("id", "row", "at", "around", F.xxhash64("leaf", "template").alias("template")))


def _templates_by_count(found: DataFrame) -> DataFrame:
    """The same with tokens constant by their number alone.  Equal lines are one row until the end."""
    line = F.xxhash64("leaf", "masked")
    tokens = (found.groupBy("leaf", "masked").agg(F.count("*").alias("n"))
              .select("leaf", line.alias("line"), "n", F.posexplode(_tokens(F.col("masked"))).alias("place", "token"))
              .where(F.col("token") != FIELD))
    often = (tokens.groupBy("leaf", "place", "token").agg(F.sum("n").alias("n")).where(f"n >= {MIN_DOCS}")
             .select("leaf", "place", "token", F.lit(True).alias("often")))
    shapes = (tokens.join(often, ["leaf", "place", "token"], "left").groupBy("line")
              .agg(F.count("*").alias("fixed"), F.count("often").alias("literal"),
                   F.array_sort(F.collect_list(F.when(F.col("often"), F.struct("place", "token")))).alias("shape"))
              .where(f"literal > 0 and literal >= {LIKENESS} * fixed")
              .select("line", F.xxhash64("shape").alias("shape")))
    return found.withColumn("line", line).join(shapes, "line").select(
        "id", "row", "at", "around", F.xxhash64("leaf", F.lit("by count"), "shape").alias("template"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(id, row, gone) of (id, row, text): the numbers of the lines to drop, for each row with any."""
    lines = stored(line_table(docs), "lines")
    witnesses = _witnesses(lines)
    # what follows runs on the lines of recurring leaves alone
    leaves = _recurring(lines, "leaf", witnesses)
    found = stored(hot_join(lines.select("id", "row", "at", "masked", "around", "leaf"), leaves, "leaf", "lines"), "leaf_lines")
    shaped = stored(_templates_by_share(found).unionByName(_templates_by_count(found)), "templates")
    gone = hot_join(shaped, _recurring(shaped, "template", witnesses), "template", "lines")
    return stored(gone.groupBy("id", "row").agg(F.collect_set("at").alias("gone")), "gone_lines")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, ``text`` without the lines of recurring templates, and two
    more: n_lines, n_removed.

    A null text stays null (0 lines); lines without a token are kept; a text that loses all
    lines is empty.  Rows with the same id count as one document; a row with a null id is a
    document of its own, known by its text; equal rows lose equal lines."""
    number = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col))).otherwise(F.xxhash64(F.lit("no id"), F.col(text_col)))
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    gone = dropped_lines(docs.select(number.alias("id"), row.alias("row"), F.col(text_col).alias("text"))
                         .where("text is not null")).select(
        F.col("id").alias(f"{OWN}id"), F.col("row").alias(f"{OWN}row"), F.col("gone").alias(f"{OWN}gone"))
    whole = F.split(text_col, "\n")
    count = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(whole))
    kept = _let(whole, lambda w: F.concat_ws("\n", F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(w) - 1), F.col(f"{OWN}gone")), lambda i: w[i])))
    joined = (docs.withColumns({f"{OWN}id": number, f"{OWN}row": row}).join(gone, [f"{OWN}id", f"{OWN}row"], "left"))
    others = [F.col(c) for c in docs.columns if c not in (text_col, "n_lines", "n_removed")]
    out = joined.select(*others, F.when(F.col(f"{OWN}gone").isNull(), F.col(text_col)).otherwise(kept).alias(text_col),
                        count.alias("n_lines"), F.coalesce(F.size(f"{OWN}gone"), F.lit(0)).alias("n_removed"))
    return out.select(*[c for c in docs.columns if c not in ("n_lines", "n_removed")], "n_lines", "n_removed")


#: the same for ids that are unique and not null, on a table ``documents``; limits and widths are stated again
ORACLE_SQL = r"""
WITH doc_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL),
masked AS (
  SELECT doc_id, line_no, regexp_replace(line, '[^ \t\r]*[0-9][^ \t\r]*', '<*>', 'g') AS masked FROM doc_lines),
copies AS (SELECT doc_id, md5(string_agg(masked, chr(10) ORDER BY line_no)) AS copy FROM masked GROUP BY doc_id),
placed AS (
  SELECT doc_id, line_no, masked, list_filter(regexp_split_to_array(masked, '[ \t\r]+'), lambda x: x <> '') AS tokens,
         coalesce(lag(masked) OVER w, '') AS before, coalesce(lead(masked) OVER w, '') AS after
  FROM masked WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
lines AS (
  SELECT *, [len(tokens)::VARCHAR] || tokens[1:3] AS leaf, before || chr(10) || after AS around,
         ('0x' || left(md5(masked), 15))::BIGINT AS line, tokens[1:6] AS head, tokens[greatest(len(tokens) - 5, 1):] AS tail
  FROM placed WHERE len(tokens) > 0),
heads AS (SELECT head FROM lines JOIN copies USING (doc_id) GROUP BY head HAVING count(DISTINCT copy) >= 5),
tails AS (SELECT tail FROM lines JOIN copies USING (doc_id) GROUP BY tail HAVING count(DISTINCT copy) >= 5),
marked AS (
  SELECT l.doc_id, l.line, len(l.tokens) AS n, h.head IS NULL AND t.tail IS NULL AS own
  FROM lines l LEFT JOIN heads h ON h.head = l.head LEFT JOIN tails t ON t.tail = l.tail),
witnesses AS (
  SELECT doc_id, CASE WHEN coalesce(sum(n) FILTER (own), 0) >= 0.2 * sum(n) THEN min(line) FILTER (own) ELSE -1 END AS witness
  FROM marked GROUP BY doc_id),
leaf_docs AS (SELECT leaf, doc_id, arg_min(around, line_no) AS around, count(*) AS n FROM lines GROUP BY leaf, doc_id),
leaves AS (
  SELECT leaf, sum(n) AS lines FROM leaf_docs JOIN witnesses USING (doc_id) GROUP BY leaf
  HAVING count(DISTINCT witness) >= 5 OR count(DISTINCT around) >= 5 AND 2 * count(DISTINCT around) >= count(*)),
candidates AS (SELECT l.*, v.lines FROM lines l JOIN leaves v USING (leaf)),
exploded AS (
  SELECT leaf, lines, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place, doc_id, line_no FROM candidates),
counted AS (
  SELECT leaf, place, token, count(*) >= 0.2 * any_value(lines) AS by_share
  FROM exploded GROUP BY leaf, place, token HAVING count(*) >= 5),
shaped AS (
  SELECT e.leaf, e.doc_id, e.line_no, k.kind,
         list(CASE WHEN c.token IS NULL OR k.kind = 'share' AND NOT c.by_share THEN '<*>' ELSE e.token END ORDER BY e.place) AS template,
         count(*) FILTER (c.token IS NOT NULL AND e.token <> '<*>' AND (k.kind = 'count' OR c.by_share)) AS literal,
         count(*) FILTER (e.token <> '<*>') AS fixed
  FROM exploded e CROSS JOIN (VALUES ('share'), ('count')) k(kind)
  LEFT JOIN counted c ON c.leaf = e.leaf AND c.place = e.place AND c.token = e.token
  GROUP BY e.leaf, e.doc_id, e.line_no, k.kind),
templates AS (
  SELECT s.leaf, s.kind, s.template, s.doc_id, s.line_no, l.around
  FROM shaped s JOIN lines l USING (doc_id, line_no) WHERE literal > 0 AND literal >= 0.7 * fixed),
template_docs AS (
  SELECT leaf, kind, template, doc_id, arg_min(around, line_no) AS around FROM templates GROUP BY leaf, kind, template, doc_id),
recurring AS (
  SELECT leaf, kind, template FROM template_docs JOIN witnesses USING (doc_id) GROUP BY leaf, kind, template
  HAVING count(DISTINCT witness) >= 5 OR count(DISTINCT around) >= 5 AND 2 * count(DISTINCT around) >= count(*)),
gone AS (SELECT DISTINCT doc_id, line_no FROM templates JOIN recurring USING (leaf, kind, template)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (g.line_no IS NULL) AS text,
         count(*)::INTEGER AS n_lines, count(g.line_no)::INTEGER AS n_removed
  FROM doc_lines l LEFT JOIN gone g USING (doc_id, line_no) GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0)::INTEGER AS n_lines, coalesce(k.n_removed, 0)::INTEGER AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

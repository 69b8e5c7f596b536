"""Operator 12: license scans by diagonal voting.

Every rolling pair of neighbouring words of a document is hashed and joined with the places
of that pair in license templates.  A hit at word ``pos`` of the document and word ``at`` of
the template votes for the diagonal pos - at.  Votes are summed by diagonal; diagonals at
most ``SLACK`` words apart are merged into the strongest one of them (words inserted or left
out shift the diagonal); a span counts if the merged diagonals hold enough of the template's
pairs in a stretch of the template's length.

Phrases are templates too: all their pairs on one diagonal are a place where the words stand
consecutively.  Their places and labels are the base; spans of texts add labels of their own.

The templates are the only broadcast, ``MAX_PLACES`` pairs at most (checked); nothing grows
with the corpus.  A document's votes are at most its pairs times a pair's places; the votes
of one template and document are read in order of diagonal, and a merged span is four 63-bit
masks of template places, whatever the number of hits.

Defined results: a null or empty text has 0 words, score 0 and empty labels; repeated rows
and repeated or null ids are documents of their own; other columns are ignored; an empty
table gives an empty result.  Only A-Z are lower-cased, other letters stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodwatch.llm.common import stored

#: words in templates by label; phrases make the base columns
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
#: fixed values: openings of well-known license notices, in words
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc", "licensed under a creative commons attribution"),
    ("cc", "licensed under cc by"),
    ("cc", "licensed under the creative commons"),
    ("mit", "spdx license identifier mit"),
    ("apache", "spdx license identifier apache"),
    ("gpl", "spdx license identifier gpl"),
    ("bsd", "spdx license identifier bsd"),
]
#: pairs of these words alone say nothing about a license and don't vote for texts
COMMON = frozenset("a an and any are as at by can for from if in is it may not of on or that the this to was with without you".split())

#: words in a gram
K = 2
#: diagonals this far apart are merged
SLACK = 8
#: share of a template's pairs that a span needs
COVER = 0.7
#: a span may be so many times as long as its template, and SLACK more
STRETCH = 1.5
#: template places in a mask, masks, and places in all templates together
BITS, MASKS, MAX_PLACES = 63, 4, 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: what stands between words, once A-Z are lower-cased
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; none of a null one."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def grams(of: Column) -> Column:
    """Hash of each word and the next; the last word is hashed alone and meets no template."""
    return F.transform(of, lambda word, i: F.xxhash64(word, F.get(of, i + F.lit(1))))


def template_places(spark: SparkSession, phrases: list[tuple[str, str]] = PHRASES,
                    texts: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """Rows (template, label, phrase, length, pairs, at, gram): the voting pairs of all templates."""
    rows = []
    for number, (label, text, phrase) in enumerate([(*p, True) for p in phrases] + [(*t, False) for t in texts]):
        said = text.split()
        if len(said) < K or len(said) > BITS * MASKS:
            raise ValueError(f"a template has {K} to {BITS * MASKS} words: {text[:60]!r}")
        at = [i for i in range(len(said) - 1) if phrase or not {said[i], said[i + 1]} <= COMMON]
        rows += [(number, label, phrase, len(said), len(at), i, said[i], said[i + 1]) for i in at]
    if len(rows) > MAX_PLACES:
        raise ValueError(f"{len(rows)} template places; {MAX_PLACES} are broadcast at most")
    made = spark.createDataFrame(rows, "template int, label string, phrase boolean, length int, pairs int, at int, a string, b string")
    return made.withColumn("gram", F.xxhash64("a", "b")).drop("a", "b")


def hits(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows (row, doc_id, n_words, pos, and a template's columns): every pair of words that stands
    in a template, and at least one row a document."""
    cut = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("words"))
    rolled = cut.select("row", "doc_id", F.size("words").cast("long").alias("n_words"),
                        F.posexplode_outer(grams(F.col("words"))).alias("pos", "gram"))
    return (rolled.join(F.broadcast(templates), "gram", "left")
            .where("template is not null or pos is null or pos = 0").drop("gram"))


def votes(found: DataFrame) -> DataFrame:
    """Hits summed by document, template and diagonal; m0.. are masks of the template places hit."""
    masks = [F.bit_or(F.when(F.floor(F.col("at") / BITS) == k, F.expr(f"shiftleft(1L, at % {BITS})")).otherwise(F.lit(0).cast("long")))
             .alias(f"m{k}") for k in range(MASKS)]
    return (found.where("template is not null").withColumn("diagonal", F.col("pos") - F.col("at"))
            .groupBy("row", "template", "label", "phrase", "length", "pairs", "diagonal")
            .agg(F.count("*").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"), *masks))


def verified(voted: DataFrame) -> DataFrame:
    """Rows (row, template, label, phrase, first, last, cover): spans of phrases and texts, in words."""
    keep = ["row", "template", "label", "phrase", "first", "last", "cover"]
    phrases = (voted.where("phrase and votes = pairs")
               .select("row", "template", "label", "phrase", F.col("diagonal").alias("first"),
                       (F.col("diagonal") + F.col("length") - 1).alias("last"), F.lit(1.0).alias("cover")))
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-SLACK, SLACK)
    masks = [f"m{k}" for k in range(MASKS)]
    rank = F.struct("votes", (-F.col("diagonal")).alias("early"))
    merged = (voted.where("not phrase")
              .select("row", "template", "label", "phrase", "length", "pairs", rank.alias("rank"),
                      F.max(rank).over(near).alias("best"), F.min("first").over(near).alias("first"),
                      (F.max("last").over(near) + 1).alias("last"), *(F.bit_or(m).over(near).alias(m) for m in masks))
              .where("rank = best"))
    covered = sum((F.bit_count(m) for m in masks[1:]), F.bit_count(masks[0]))
    texts = (merged.withColumn("cover", covered / F.col("pairs"))
             .where((F.col("cover") >= COVER) & (F.col("last") - F.col("first") + 1 <= STRETCH * F.col("length") + SLACK)))
    return phrases.select(keep).unionByName(texts.select(keep))


def spans(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """The license spans of documents: (doc_id, label, phrase, first, last, cover)."""
    found = stored(hits(docs, template_places(docs.sparkSession) if templates is None else templates), "license_hits")
    ids = found.select("row", "doc_id").distinct()
    return verified(votes(found)).join(ids, "row").select("doc_id", "label", "phrase", "first", "last", "cover")


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """One row a document: its words, base places and labels."""
    found = stored(hits(docs, template_places(docs.sparkSession) if templates is None else templates), "license_hits")
    every = found.select("row", "doc_id", "n_words", *(F.lit(None).cast(t).alias(c) for c, t in (
        ("label", "string"), ("base", "string"), ("start", "long"), ("cover", "double")))).where("pos is null or pos = 0")
    where = verified(votes(found)).select(
        "row", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("long").alias("n_words"), "label",
        F.when(F.col("phrase"), F.col("label")).alias("base"), F.when(F.col("phrase"), F.col("first").cast("long")).alias("start"), "cover")

    def joined(label: str) -> Column:
        return F.array_join(F.sort_array(F.collect_set(label)), ",")

    return (every.unionByName(where).groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("base").alias("n_base"),
                 F.min("start").alias("first_word"), F.max("start").alias("last_word"), joined("base").alias("base_labels"),
                 joined("label").alias("labels"), F.coalesce(F.max("cover"), F.lit(0.0)).alias("score")).drop("row"))


def _values(kind: list[tuple[str, str]], phrase: bool, first: int) -> list[str]:
    return [f"({first + i}, '{label}', {phrase}, string_split('{text}', ' '))" for i, (label, text) in enumerate(kind)]


#: the same spans by joins of words, distinct places and no masks; thresholds are stated again
ORACLE_SQL = f"""
WITH templates(template, label, phrase, said) AS (VALUES {', '.join(_values(PHRASES, True, 0) + _values(TEXTS, False, len(PHRASES)))}),
common AS (SELECT unnest(string_split('{' '.join(sorted(COMMON))}', ' ')) AS w),
places AS (
  SELECT template, label, phrase, len(said) AS length, i AS place, said[i + 1] AS a, said[i + 2] AS b
  FROM (SELECT *, unnest(range(len(said) - 1)) AS i FROM templates)
  WHERE phrase OR said[i + 1] NOT IN (SELECT w FROM common) OR said[i + 2] NOT IN (SELECT w FROM common)),
sizes AS (SELECT template, count(*) AS pairs FROM places GROUP BY 1),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
found AS (
  SELECT r, pos, pos - place AS diagonal, p.* FROM (SELECT r, unnest(range(len(words) - 1)) AS pos, words FROM docs) d
  JOIN places p ON p.a = d.words[pos + 1] AND p.b = d.words[pos + 2]),
voted AS (SELECT r, template, label, phrase, length, diagonal, count(*) AS votes FROM found GROUP BY ALL),
base AS (SELECT r, label, diagonal AS start FROM voted JOIN sizes USING (template) WHERE phrase AND votes = pairs),
peaks AS (
  SELECT v.r, v.template, v.label, v.length, v.diagonal FROM voted v WHERE NOT phrase AND NOT EXISTS (
    SELECT 1 FROM voted o WHERE o.r = v.r AND o.template = v.template AND abs(o.diagonal - v.diagonal) <= 8
      AND (o.votes > v.votes OR o.votes = v.votes AND o.diagonal < v.diagonal))),
texts AS (
  SELECT p.r, p.label, count(DISTINCT f.place) / any_value(s.pairs) AS cover
  FROM peaks p JOIN found f ON f.r = p.r AND f.template = p.template AND abs(f.diagonal - p.diagonal) <= 8
  JOIN sizes s ON s.template = p.template
  GROUP BY p.r, p.template, p.label, p.length, p.diagonal
  HAVING cover >= 0.7 AND max(f.pos) + 1 - min(f.pos) + 1 <= 1.5 * p.length + 8),
own AS (
  SELECT r, count(base) AS n_base, min(start) AS first_word, max(start) AS last_word,
         coalesce(string_agg(DISTINCT base, ',' ORDER BY base), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
  FROM (SELECT r, label AS base, start, label, 1.0::DOUBLE AS cover FROM base
        UNION ALL SELECT r, NULL, NULL, label, cover FROM texts) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN own USING (r)
"""

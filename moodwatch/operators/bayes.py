"""Relational Naive Bayes (M1-M5 without a vocabulary on the driver).

The same arithmetic as the ML pipeline of :mod:`moodwatch.operators.model` with term counts
in place of hashed ones: tf, ``idf = ln((N + 1) / (df + 1))``, multinomial Naive Bayes with
add-one smoothing.  The fitted model is a table (term, idf, theta0, theta1) of any size and
two priors; scoring is an equi-join on the term, whose frequent terms AQE splits, after the
counts of a document were summed.

All that a fit needs of its rows are sums: documents by class, and by term the documents and
the counts by class.  :func:`increments` gives these sums of some rows, a change log adds them
up, and :func:`fit_log` makes the model of all rows so far without reading old ones again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwatch.functions.constants import LABEL_NEGATIVE, LABEL_POSITIVE
from moodwatch.operators.model import MODEL_INPUT, model_input
from moodwatch.operators.tfidf import whitespace_tokens
from moodwatch.session import materialize


#: terms whose weights are broadcast when rows are scored, and stand-in terms of what they gave
FREQUENT, STAND_INS = 10_000, 1 << 20


@dataclass(frozen=True)
class NaiveBayesTable:
    """``terms`` (term, idf, theta0, theta1), the log priors of both classes, and the place (idf, term)
    in ``terms`` of the last of the ``FREQUENT`` ones, found once a fit (none: there are no terms)."""

    terms: DataFrame
    prior0: float
    prior1: float
    last: tuple[float, str] | None = None

    def frequent(self) -> Column:
        """Whether a term is one of the ``FREQUENT`` of most documents."""
        if self.last is None:
            return F.lit(False)
        idf, term = self.last
        return (F.col("idf") < F.lit(idf)) | ((F.col("idf") == F.lit(idf)) & (F.col("term") <= F.lit(term)))


def term_counts(docs: DataFrame, keys: list[str], text: str = "text", **seg) -> DataFrame:
    """(keys..., term, tf): T1, T5 and the tokenizer; an empty text has one empty term."""
    # explode_outer + null filter: the segmentation runs once a row
    terms = (model_input(docs, text, **seg).select(*keys, F.explode_outer(whitespace_tokens(MODEL_INPUT)).alias("term"))
             .where(F.col("term").isNotNull()))
    return terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def _by_class(label: str, what) -> list:
    """Sums of ``what`` over the rows of each class: t0 and t1."""
    return [F.sum(F.when(F.col(label) == F.lit(value), what).otherwise(F.lit(0))).cast("bigint").alias(name)
            for value, name in ((LABEL_POSITIVE, "t0"), (LABEL_NEGATIVE, "t1"))]


def _documents(labelled: DataFrame, label: str) -> DataFrame:
    """(df, t0, t1) in one row: all documents, and those of each class."""
    return labelled.agg(F.count(F.lit(1)).alias("df"), *_by_class(label, F.lit(1)))


def _terms(labelled: DataFrame, doc_id: str, text: str, label: str, **seg) -> DataFrame:
    """(term, df, t0, t1): documents with the term, and its counts in each class."""
    counts = term_counts(labelled, [doc_id, label], text, **seg)
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), *_by_class(label, F.col("tf")))


def increments(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label", **seg) -> DataFrame:
    """(kind, term, df, t0, t1): what rows add to a model, for a change log with the keys ``LOG_KEYS``
    and the sums ``LOG_SUMS``.  A document counts in each set of rows that holds it."""
    documents = _documents(labelled, label).select(F.lit("documents").alias("kind"), F.lit("").alias("term"), *LOG_SUMS)
    return documents.unionByName(_terms(labelled, doc_id, text, label, **seg).select(F.lit("term").alias("kind"), "term", *LOG_SUMS))


LOG_KEYS, LOG_SUMS = ["kind", "term"], ["df", "t0", "t1"]


def fit_log(sums: DataFrame) -> NaiveBayesTable:
    """M5 from the totals of a log of :func:`increments`; equals one fit of all its rows."""
    n, n0, n1 = sums.where("kind = 'documents'").select(*LOG_SUMS).first() or (0, 0, 0)
    return _model(sums.where("kind = 'term'").drop("kind"), n, n0, n1)


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label", **seg) -> NaiveBayesTable:
    """M5 on rows (doc_id, text, label); label 0.0 positive, 1.0 negative."""
    return _model(_terms(labelled, doc_id, text, label, **seg), *_documents(labelled, label).first())


def _model(stats: DataFrame, n: int, n0: int, n1: int) -> NaiveBayesTable:
    idf = F.ln(F.lit(n + 1.0) / (F.col("df") + F.lit(1.0)))
    # the idf is the same in every document, so a class's sum of tf * idf is its sum of tf times idf
    stats = materialize(stats.select("term", idf.alias("idf"), (F.col("t0") * idf).alias("x0"), (F.col("t1") * idf).alias("x1")))
    size, s0, s1 = stats.agg(F.count(F.lit(1)), F.sum("x0"), F.sum("x1")).first()
    terms = stats.select("term", "idf", *[
        (F.ln(F.col(x) + F.lit(1.0)) - F.lit(math.log((s or 0.0) + size) if size else 0.0)).alias(name)
        for x, s, name in (("x0", s0, "theta0"), ("x1", s1, "theta1"))])
    first = stats.select("idf", "term").orderBy("idf", "term").limit(FREQUENT)
    last = first.orderBy(F.col("idf").desc(), F.col("term").desc()).first()
    return NaiveBayesTable(terms, *[math.log((k or 0.0) + 1.0) - math.log(n + 2.0) for k in (n0, n1)], last and tuple(last))


def score(model: NaiveBayesTable, df: DataFrame, key: str, text: str = "text", **seg) -> DataFrame:
    """M1-M4: adds ``prediction``, ``p0``, ``p1``.  ``key`` must be unique; terms that the model
    doesn't know count for nothing.

    The weights of the ``FREQUENT`` terms of most documents go to the rows, where they are
    summed by document; only the other terms of a document are dealt by term."""
    weights = model.terms.select("term", "idf", *((F.col("idf") * F.col(f"theta{k}")).alias(f"w{k}") for k in (0, 1)))
    # a filter tells both kinds apart: a score, of one batch of many, neither sorts nor joins the terms for it
    frequent = F.broadcast(weights.where(model.frequent()).drop("idf"))
    terms = (model_input(df, text, **seg).select(key, F.explode_outer(whitespace_tokens(MODEL_INPUT)).alias("term"))
             .where(F.col("term").isNotNull()))
    # what is summed already keeps a term of its own, so that it isn't dealt to one task
    done = F.concat(F.lit("\0"), F.pmod(F.xxhash64(key), F.lit(STAND_INS)).cast("string"))
    near = (terms.join(frequent, "term", "left").withColumn("term", F.when(F.col("w0").isNull(), F.col("term")).otherwise(done))
            .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"), F.sum("w0").alias("s0"), F.sum("w1").alias("s1")))
    rare = weights.where(~model.frequent()).drop("idf")
    both = near.join(rare, "term", "left")
    sums = both.groupBy(key).agg(*(F.sum(F.coalesce(f"s{k}", F.col("tf") * F.col(f"w{k}"))).alias(f"_d{k}") for k in (0, 1)))
    r0 = F.lit(model.prior0) + F.coalesce("_d0", F.lit(0.0))
    r1 = F.lit(model.prior1) + F.coalesce("_d1", F.lit(0.0))
    out = (df.join(sums, key, "left").withColumn("p0", F.lit(1.0) / (F.lit(1.0) + F.exp(r1 - r0)))
           .withColumn("p1", F.lit(1.0) / (F.lit(1.0) + F.exp(r0 - r1))))
    return out.withColumn("prediction", F.when(r1 > r0, F.lit(LABEL_NEGATIVE)).otherwise(F.lit(LABEL_POSITIVE))).drop("_d0", "_d1")

"""Relational TF-IDF (M1-M3 without a driver-side vocabulary).

Same arithmetic as Spark ML's ``Tokenizer -> term counts -> IDF``
(``idf = ln((N + 1) / (df + 1))``), as joins and aggregates: the document
frequency of a term is a partial aggregate, and the tf x idf join is a plain
equi-join that AQE splits if one term (``the``) dominates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.functions.lines import jvm_split
from moodwatch.session import materialize


def whitespace_tokens(col: str):
    """``Tokenizer``: lower case, split on single whitespace characters."""
    return jvm_split(F.lower(F.col(col)), r"\s", regex=True)


def tfidf(docs: DataFrame, doc_id: str = "doc_id", text: str = "comment_text", digits: int = 6) -> DataFrame:
    # explode_outer + null filter: no inferred filter that would re-run the segmentation
    terms = (docs.select(doc_id, F.explode_outer(whitespace_tokens(text)).alias("term"))
             .where(F.col("term").isNotNull()))
    # tf feeds both the document frequencies and the final join; materialise it
    # once instead of segmenting every text twice.
    tf = materialize(terms.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf")))
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("term", F.ln((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0))).alias("idf"))
    return (tf.join(idf, "term")
            .select(doc_id, "term", "tf", F.round(F.col("tf") * F.col("idf"), digits).alias("tfidf")))

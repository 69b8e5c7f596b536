"""Text operators (T1-T5): segmentation, dictionaries, token explode, re-join.

Segmentation is one ``regexp_extract_all`` over an alternation of dictionary
words, so the whole text of every row is segmented inside the JVM.  A large
dictionary (thousands of words) does not fit one regex well; pass it as a
DataFrame to :func:`moodwatch.operators.segmenter.segment_with_dictionary`, which finds
its words by joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.functions.constants import EXTENSION_WORDS, KEYWORD_SEPARATOR, STOP_WORDS
from moodwatch.functions.lines import jvm_split
from moodwatch.functions.text import tokens


def segment(df: DataFrame, text: str = "text", out: str = "tokens",
            dictionary: Iterable[str] = EXTENSION_WORDS, stop_words: Sequence[str] = STOP_WORDS,
            lowercase: bool = True) -> DataFrame:
    """Add ``out`` = tokens of ``text`` in order, duplicates kept."""
    return df.withColumn(out, tokens(text, dictionary, stop_words, lowercase))


def explode_tokens(df: DataFrame, keys: Sequence[str], tokens_col: str = "tokens",
                   out: str = "word") -> DataFrame:
    """One row per (keys..., token).

    ``explode`` makes the optimizer infer ``size(tokens) > 0`` and push it below
    the projection that computes ``tokens`` -- which inlines the whole
    segmentation regex into that filter and runs it a second time per row.
    ``explode_outer`` plus a null filter above the generator gives the same rows
    (tokens are never null) with the regex evaluated once.
    """
    exploded = df.select(*keys, F.explode_outer(tokens_col).alias(out))
    return exploded.where(F.col(out).isNotNull())


def remove_stop_words(words: DataFrame, stop: DataFrame, word: str = "word") -> DataFrame:
    """T2 for a large stop list held as a table: anti-join after the explode.

    The stop table is tiny next to the token stream; Spark broadcasts it when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
    otherwise.
    """
    return words.join(stop.select(F.col(stop.columns[0]).alias(word)), word, "left_anti")


def split_words(df: DataFrame, col: str = "value", sep: str = KEYWORD_SEPARATOR,
                keys: Sequence[str] = (), out: str = "word") -> DataFrame:
    """T4: ``a,b,c`` lines -> one row per word (JVM split: trailing empties dropped)."""
    exploded = df.select(*keys, F.explode_outer(jvm_split(col, sep)).alias(out))  # see explode_tokens
    return exploded.where(F.col(out).isNotNull())


def join_tokens(df: DataFrame, tokens_col: str = "tokens", out: str = "comment_text") -> DataFrame:
    """T5: tokens joined by one space -- the model's input text."""
    return df.withColumn(out, F.array_join(tokens_col, " "))

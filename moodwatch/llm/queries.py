"""Queries of the training-data operators: opN_<name> and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences of repeated spans."""
    from moodwatch.llm.substring import dedup
    return dedup(_table(spark, sf_dir, "documents"))


def op2_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth vector."""
    from moodwatch.llm.ann import nearest
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op3_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from moodwatch.llm.html import extract, learn
    pages = _table(spark, sf_dir, "pages")
    return extract(pages, learn(pages))


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    from moodwatch.llm.packing import pack_documents
    return pack_documents(_table(spark, sf_dir, "documents"))


def op5_edit_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that stand in documents."""
    from moodwatch.llm.decontam import matches
    return matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in ORC files, read back."""
    from moodwatch.llm.tokenfile import token_file_digest
    return token_file_digest(_table(spark, sf_dir, "documents"))


def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    from moodwatch.llm.neardup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 40 shards of near equal bytes."""
    from moodwatch.llm.sharding import shard
    return shard(_table(spark, sf_dir, "documents"))


def op9_log_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of recurring templates."""
    from moodwatch.llm.lines import dedup
    return dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    from moodwatch.llm.langid import identify, learn
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    from moodwatch.llm.prefixtrie import rebuilt_trie
    return rebuilt_trie(_table(spark, sf_dir, "conversations"))


def op12_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    from moodwatch.llm.licenses import scan
    return scan(_table(spark, sf_dir, "documents"))


def op13_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    from moodwatch.llm.lexical import rank_documents
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the stages of the corpus pipeline."""
    from moodwatch.llm.pipeline import run
    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n == "pipeline" or n.startswith("op") and n[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from moodwatch.llm import lexical, licenses, lines, prefixtrie
    return {"op9_log_templates": lines.ORACLE_SQL, "op11_prefix_trie": prefixtrie.ORACLE_SQL,
            "op12_license_diagonals": licenses.ORACLE_SQL, "op13_presence_masks": lexical.ORACLE_SQL}

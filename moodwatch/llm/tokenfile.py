"""Token ids in ORC files.

Documents are dealt by ranges of their id and sorted, so files and stripes hold
ascending ids.  ORC stores the ids with integer run-length encoding, keeps minima and
maxima for each stripe and row group, and a Bloom filter on ``doc_id``: a read of some
documents skips the other stripes by their metadata, and a read of all of them takes
stripes side by side.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwatch.llm.common import arrow_pass, partitions, slice_total
from moodwatch.llm.tokens import encoder, tokenizer_path
from moodwatch.session import fresh_dir

#: rows of an Arrow batch: its text is worked on in chunks anyway
WHOLE_BATCH = 10_000
TOKENIZER, END_ID = "byte_bpe_50k.json", 2
ORC_OPTIONS = {
    "orc.stripe.size": str(16 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}


def encode(docs: DataFrame, path: str, end_id: int = END_ID, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ids, n_tokens, *keep) of (doc_id, text, *keep); ``end_id`` closes each document."""
    kept = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep]

    def make():
        tokens = encoder(path, spaces=True)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat, at = tokens.column(batch.column(1))
            ids = np.insert(flat.view(np.int32), at[1:], end_id)
            at = at + np.arange(len(at))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(at.astype(np.int32), ids), pa.array(np.diff(at)), *batch.columns[2:]],
                ["doc_id", "ids", "n_tokens", *keep])

        return work

    return arrow_pass(docs, ["doc_id", "text", *keep],
                      ", ".join(["doc_id long, ids array<int>, n_tokens long", *kept]), make, keep="tokens", rows=WHOLE_BATCH)


def write_tokens(docs: DataFrame, target: str, path: str | None = None, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the token ids of all ``docs`` to the folder ``target`` in ascending id order.

    A null text is empty: its document is the end id alone.  Null ids come first; rows that
    repeat an id follow each other.  Other columns are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = (rows.repartitionByRange(partitions(docs.sparkSession), "doc_id")
             .withColumn("slice", F.spark_partition_id()).sortWithinPartitions("doc_id"))
    out = encode(dealt, path or tokenizer_path(TOKENIZER), end_id, ("slice",))
    out.write.options(**ORC_OPTIONS).orc(target)
    return target


def read_tokens(spark: SparkSession, target: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, slice) of all documents, or of ``doc_ids`` (pruned by the
    stripes' metadata)."""
    rows = spark.read.schema("doc_id long, ids array<int>, n_tokens long, slice int").orc(target)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin([int(d) for d in doc_ids]))


def token_digest(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows of :func:`read_tokens`: start counts the
    ids of all documents before."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column(2)
            at = ids.offsets.to_numpy()
            flat = ids.values.to_numpy().astype("<u4")
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            sizes = np.diff(at).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes), pa.array(sums, pa.int64())],
                ["slice", "doc_id", "n_tokens", "ids_crc32"])

        return work

    dug = arrow_pass(rows, ["slice", "doc_id", "ids"], "slice int, doc_id long, n_tokens long, ids_crc32 long", make)
    # the sums of slices come from the files' n_tokens column alone, without the ids
    return slice_total(dug, "slice", ["doc_id", "ids_crc32"], "n_tokens", "start", rows.select("slice", "n_tokens")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def token_file_digest(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a new folder of the shared folder and digest what is read back.
    An empty table gives no rows."""
    spark = docs.sparkSession
    return token_digest(read_tokens(spark, write_tokens(docs, fresh_dir(spark, "tokens"))))

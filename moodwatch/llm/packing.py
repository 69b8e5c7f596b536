"""Best-two-fit packing of documents into sequences.

A bin is filled greedily with the largest piece that still fits; then its smallest
piece is replaced by the two unpacked pieces that together fit its expanded gap more
tightly than it did.  Only lengths matter for this, and there are at most ``capacity``
of them, so the driver packs the histogram of lengths: one decision makes as many equal
bins as the counts allow (the next decision would be the same one until a length runs
out).  The pieces then take the places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodwatch.llm.common import arrow_pass, partitions, stored
from moodwatch.llm.tokens import encoder, tokenizer_path

CAPACITY = 4096
#: closes every document
END_ID = 1
TOKENIZER = "word_bpe_49k.json"


def best_two_fit(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Pack ``counts[n]`` pieces of each length n (up to ``len(counts) - 1``, the capacity).

    Returns bins as (how many alike, [(length, how many in the bin), ...])."""
    counts = counts.astype(np.int64).copy()
    capacity = len(counts) - 1
    lengths = np.arange(capacity + 1)
    out: list[tuple[int, list[tuple[int, int]]]] = []

    def largest(limit: int, used: dict[int, int]) -> int:
        """The largest length up to ``limit`` of which a piece is left."""
        while limit > 0:
            left = np.flatnonzero(counts[1:limit + 1])
            if not len(left):
                return 0
            limit = int(left[-1]) + 1
            if counts[limit] > used.get(limit, 0):
                return limit
            limit -= 1
        return 0

    while counts.any():
        used: dict[int, int] = {}
        gap = capacity
        while n := largest(gap, used):
            fit = min(gap // n, int(counts[n]) - used.get(n, 0))
            used[n] = used.get(n, 0) + fit
            gap -= n * fit
        if gap and sum(used.values()) > 1:
            small = min(used)
            wider = gap + small
            used[small] -= 1
            left = counts.copy()
            for n, k in used.items():
                left[n] -= k
            left[small] -= 1  # replaced by two others
            have = np.where(left > 0, lengths, 0)
            upto = np.maximum.accumulate(have)  # the largest length left up to each limit
            first = have[1:wider // 2 + 1]
            first = first[first > 0]
            if len(first):
                second = upto[wider - first]
                twice = (second == first) & (left[first] < 2)
                if twice.any():
                    second = np.where(twice, upto[np.maximum(first - 1, 0)], second)
                both = np.where(second > 0, first + second, 0)
                best = int(both.argmax())
                if both[best] > small:
                    for n in (int(first[best]), int(second[best])):
                        used[n] = used.get(n, 0) + 1
                    small = 0
            if small:
                used[small] += 1
        used = {n: k for n, k in used.items() if k}
        times = min(int(counts[n]) // k for n, k in used.items())
        for n, k in used.items():
            counts[n] -= k * times
        out.append((times, sorted(used.items(), reverse=True)))
    return out


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenized pieces: doc_id, piece, start, length, ids_crc32 (and ids).

    Every document is its tokens and ``end_id``; a null text has no tokens."""
    end = np.array([end_id], "<u4").tobytes()

    def make():
        tokens = encoder(path, spaces=False)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            for doc, coded in zip(ids, tokens.encode([t or "" for t in texts]), strict=True):
                coded += end
                for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                    part = coded[at:at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part),
                                 np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            n = len(names) if with_ids else len(names) - 1
            return pa.RecordBatch.from_arrays(columns[:n], names[:n])

        return work

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return arrow_pass(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                      ["doc_id", "text"], schema, make, keep="tokens")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to ``items`` (doc_id, piece, length and more columns).

    ``items`` is read twice and should be stored.  Lengths over ``capacity`` or under 1
    raise.  Equal rows are rows of their own; which of them goes where is open."""
    spark = items.sparkSession
    salts = partitions(spark)
    salted = items.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sums = stored(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "lengths")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in sums.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most one row a length
        if not 1 <= r.length <= capacity:
            raise ValueError(f"a piece of {r.length} tokens can't be packed into {capacity}")
        histogram[r.length] = r.n
    # the places of each length, in order of rank: (first rank, bins alike, first bin, offset)
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    taken, bins = [0] * (capacity + 1), 0
    for times, content in best_two_fit(histogram):
        offset = 0
        for length, many in content:
            places.setdefault(length, []).append((taken[length], times, bins, offset))
            taken[length] += times * many
            offset += length * many
        bins += times
    table = {n: np.array(rows, np.int64).T for n, rows in places.items()}
    below = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn("_base", F.coalesce(F.sum("_n").over(below), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = (salted.withColumn("_rank", F.row_number().over(inside) - 1)
              .join(bases, ["length", "_salt"])  # a row for each length and salt
              .withColumn("_rank", (F.col("_rank") + F.col("_base")).cast("long")).drop("_salt", "_base"))
    columns = ranked.columns

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            length = batch.column(columns.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(columns.index("_rank")).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                at = length == n
                firsts, times, bins_, offsets = table[int(n)]
                k = np.searchsorted(firsts, rank[at], "right") - 1
                turn = rank[at] - firsts[k]
                sequence[at] = bins_[k] + turn % times[k]
                offset[at] = offsets[k] + turn // times[k] * n
            keep = [i for i, c in enumerate(columns) if c != "_rank"]
            return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(sequence), pa.array(offset)],
                                              [*(columns[i] for i in keep), "sequence_id", "offset"])

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    return arrow_pass(ranked, columns, schema + ", sequence_id long, offset long", make)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Documents to packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is a document of its end id alone; a null id stays null; rows
    that repeat an id are packed as documents of their own; an empty table gives no rows."""
    return pack(stored(pieces(docs, path or tokenizer_path(TOKENIZER), capacity), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences from packed pieces that carry ``ids``: sequence_id, ids, doc_ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most a capacity of ids
    return (packed.groupBy("sequence_id").agg(parts.alias("_p"))
            .select("sequence_id", F.flatten("_p.ids").alias("ids"), F.col("_p.doc_id").alias("doc_ids")))

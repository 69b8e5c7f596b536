"""Substring dedup by sliding sentence spans.

A text is cut into sentences: after ``.``, ``!`` or ``?`` with white space behind it and at
line ends.  A sentence of more than ``PIECE`` words is cut further, at places that only
depend on the words around them, so that a passage is cut alike wherever it stands.  From
every sentence a span runs over at least ``SPAN`` sentences and ``WORDS`` words; its
normalised words are hashed.  Hashes are joined over the whole corpus, and the sentences
covered by a span that isn't the first of its kind are removed.  First is the smallest
(doc_id, position).
"""

from __future__ import annotations

import re
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.llm.common import arrow_pass, hot_join, stored

SPAN, WORDS = 3, 24
#: a sentence with more words is cut after words whose hash divides by CUT, at the latest here
PIECE, CUT = 12, 4
SENTENCES = re.compile(r"\S.*?(?:[.!?]+(?=\s)|$)", re.M)
WORD = re.compile(r"\w+")

Span = tuple[int, int, int]


def sentences(text: str) -> list[Span]:
    """(from, to, words) of each sentence; what lies between them is white space."""
    out: list[Span] = []
    for m in SENTENCES.finditer(text):
        found = list(WORD.finditer(text, m.start(), m.end()))
        if len(found) <= PIECE:
            out.append((m.start(), m.end(), len(found)))
            continue
        at, last = m.start(), 0
        for k, w in enumerate(found[:-1], 1):
            if k - last >= PIECE or k - last >= 3 and crc32(w[0].lower().encode()) % CUT == 0:
                out.append((at, found[k].start(), k - last))
                at, last = found[k].start(), k
        out.append((at, m.end(), len(found) - last))
    return out


def spans(text: str) -> list[tuple[int, int, int]]:
    """(hash, first sentence, sentences) of every span; 64 bits, signed."""
    cut = sentences(text)
    words = [" ".join(WORD.findall(text[a:b].lower())) for a, b, _ in cut]
    out, to, total = [], 0, 0
    for k in range(len(cut)):
        while to < len(cut) and (to - k < SPAN or total < WORDS):
            total += cut[to][2]
            to += 1
        if to - k < SPAN or total < WORDS:
            break
        h = xxhash.xxh64_intdigest(" ".join(words[k:to]))
        out.append((h - (1 << 64) if h >> 63 else h, k, to - k))
        total -= cut[k][2]
    return out


def span_table(docs: DataFrame) -> DataFrame:
    """(doc_id, row, span, at, n) of (doc_id, row, text): every span of every text."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            ids, rows, hashes, at, n = [], [], [], [], []
            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for h, k, m in spans(text or ""):
                    ids.append(doc)
                    rows.append(row)
                    hashes.append(h)
                    at.append(k)
                    n.append(m)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(hashes, pa.int64()), pa.array(at, pa.int32()),
                 pa.array(n, pa.int32())], ["doc_id", "row", "span", "at", "n"])

        return work

    return arrow_pass(docs, ["doc_id", "row", "text"], "doc_id long, row long, span long, at int, n int", make)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_removed, first_ids) for every row.

    ``text`` is the text without the removed sentences (unchanged if there are none; null
    stays null), ``first_ids`` the documents that hold the first copies, ascending.  A text
    too short for a span is left alone.  Rows with a null id are kept as they are and take no
    part.  Rows that repeat an id count as one place: a passage is a repeat only where it
    stands later in the text or in a document of larger id; each row loses the repeats of its
    own text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    table = stored(span_table(rows.where("doc_id is not null")), "spans")
    # partial minima before the shuffle: a span that fills a third of the rows is one row a task
    firsts = (table.groupBy("span").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("copies"))
              .where("copies > 1").select("span", "copies", F.col("first.doc_id").alias("first_id"), F.col("first.at").alias("first_at")))
    late = (hot_join(table, firsts, "span", "copies").where("doc_id > first_id or at > first_at")
            .groupBy("doc_id", "row").agg(F.collect_set(F.struct("at", "n")).alias("cuts"),
                                   F.array_sort(F.collect_set("first_id")).alias("first_ids")))
    both = rows.join(late, ["doc_id", "row"], "left")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, gone = [], []
            for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                drop: set[int] = set()
                if text and cuts:  # a sentence goes with the white space behind it
                    cut = sentences(text)
                    drop = {k for c in cuts for k in range(c["at"], min(len(cut), c["at"] + c["n"]))}
                    starts = [a for a, _, _ in cut] + [len(text)]
                    text = text[:starts[0]] + "".join(
                        text[starts[k]:starts[k + 1]] for k in range(len(cut)) if k not in drop)
                gone.append(len(drop))
                texts.append(text)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(gone, pa.int32()), batch.column(3)],
                ["doc_id", "text", "n_removed", "first_ids"])

        return work

    return arrow_pass(both, ["doc_id", "text", "cuts", "first_ids"],
                      "doc_id long, text string, n_removed int, first_ids array<long>", make)

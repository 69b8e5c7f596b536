"""Operator 13: ranked lexical search by presence masks.

One pass turns every document into the numbers and frequencies of its query terms, and gives
the corpus statistics.  A second pass takes these rows in blocks: each term has a bitmap of
the block's documents that hold it; an item's bitmaps, read across, are the documents' masks
of matched terms.  Documents of equal mask form a group whose score is at most the sum of
the mask's largest term scores in the block.  Groups are evaluated by descending bound
until the tenth best score is above the next one's bound; tasks keep their best ten by item
from block to block, and Spark ranks what the tasks give.

Items are taken in query blocks of at most ``BLOCK_TERMS`` different terms (or one item);
only a block's terms are on the driver and in the tasks.  A pass over the documents belongs
to each query block.  Memory of a task: bitmaps of ``ROWS`` documents for a block's terms.

Scores are 64-bit integers; weights are logarithms in doubles, made once on the driver.

Defined results: a null text or one without terms is no document of the corpus; an item
without terms has no rows; items are told apart by row, so repeated or null item ids are
items of their own; documents are rows too, equal scores rank by ascending doc_id, a null
doc_id last; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodwatch.llm.common import stored

TOP = 10
#: different terms of a query block
BLOCK_TERMS = 1 << 16
#: documents in a block of the second pass
ROWS = 4096
#: shares a ranking is cut into before its last step
SALTS = 32

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
#: A-Z to a-z, what stands between terms to blanks; bytes from 128 up belong to terms
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))

FOUND = "item long, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return text.encode().translate(_FOLD).split() if text else []


class QueryBlock:
    """Items of a block: their ids, and the numbers of each one's different terms."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.items = [number for number, _ in items]
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in items for t in ts}))}
        self.terms = [np.array(sorted(self.vocabulary[t] for t in set(ts)), np.int64) for _, ts in items]


def query_blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[QueryBlock]:
    """Blocks of items (item, text) in order, one on the driver at a time."""
    held: list[tuple[int, list[bytes]]] = []
    seen: set[bytes] = set()
    for row in items.toLocalIterator():
        own = list(dict.fromkeys(terms(row["text"])))
        if held and len(seen | set(own)) > most:
            yield QueryBlock(held)
            held, seen = [], set()
        if own:
            held.append((row["item"], own))
            seen.update(own)
    if held:
        yield QueryBlock(held)


# --- first pass ---------------------------------------------------------------------

def sparse_rows(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """Rows (doc_id, n, ids, tf): a document's number of terms, and its query terms with their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            size, ids, tf, ends, keep = [], [], [], [0], []
            for at, text in enumerate(batch.column(1)):
                said = terms(text.as_py())
                if said:
                    for term, count in Counter(said).items():
                        if (i := number(term)) is not None:
                            ids.append(i)
                            tf.append(count)
                    ends.append(len(ids))
                    size.append(len(said))
                    keep.append(at)
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))], ["doc_id", "n", "ids", "tf"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n long, ids array<int>, tf array<long>"))


def weights(rows: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Weights of a query block's terms, and the corpus' documents and terms."""
    n_docs, n_terms = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = np.zeros(size, np.int64)
    for term, df in rows.select(F.explode("ids").alias("id")).groupBy("id").count().toLocalIterator():  # one row a query term
        out[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return out, n_docs, n_terms


# --- second pass ---------------------------------------------------------------------

class Best:
    """An item's highest scores so far, ties to the smaller id, null ids last."""

    def __init__(self):
        self.held: list[tuple[int, int, int | None]] = []  # (-score, order of the id, id)

    @property
    def least(self) -> int:
        """A score below this can't enter."""
        return -self.held[-1][0] if len(self.held) == TOP else 1

    def offer(self, scores: Iterable[int], ids: Iterable[int | None]) -> None:
        self.held += [(-s, math.inf if i is None else i, i) for s, i in zip(scores, ids, strict=True) if s >= self.least]
        self.held = sorted(self.held, key=lambda x: x[:2])[:TOP]


class Postings:
    """A block of documents: term scores by document and by term, and a bitmap for each term."""

    def __init__(self, ends: np.ndarray, ids: np.ndarray, scores: np.ndarray, size: int):
        self.ends, self.ids, self.scores = ends, ids, scores
        count = len(ends) - 1
        doc = np.repeat(np.arange(count), np.diff(ends))
        order = np.argsort(ids, kind="stable")
        by_term = ids[order]
        self.present, first = np.unique(by_term, return_index=True)
        self.most = np.zeros(size, np.int64)
        if len(first):
            self.most[self.present] = np.maximum.reduceat(scores[order], first)
        self.row = np.full(size, -1, np.int64)
        self.row[self.present] = np.arange(len(self.present))
        self.bitmaps = np.zeros((len(self.present), (count + 7) // 8), np.uint8)
        np.bitwise_or.at(self.bitmaps, (self.row[ids], doc >> 3), (128 >> (doc & 7)).astype(np.uint8))

    def masks(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold any of the terms, and their masks: one bit a term in 64-bit words."""
        maps = self.bitmaps[self.row[wanted]]
        docs = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(maps, axis=0))[:len(self.ends) - 1])
        bits = np.unpackbits(maps, axis=1)[:, docs]
        words = np.zeros((-(-len(wanted) // 64) * 8, len(docs)), np.uint8)
        packed = np.packbits(bits, axis=0)
        words[:len(packed)] = packed
        return docs, np.ascontiguousarray(words.T).view(">u8")

    def exact(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores of ``docs`` over the wanted terms (a flag a term)."""
        lengths = self.ends[docs + 1] - self.ends[docs]
        stops = np.cumsum(lengths)
        at = np.repeat(self.ends[docs] - (stops - lengths), lengths) + np.arange(stops[-1])
        total = np.concatenate(([0], np.cumsum(np.where(wanted[self.ids[at]], self.scores[at], 0))))
        return total[stops] - total[stops - lengths]


def search(block: Postings, item: np.ndarray, ids: list[int | None], best: Best) -> int:
    """Offer the block's documents for an item; gives the number evaluated."""
    item = item[block.most[item] > 0]
    if not len(item):
        return 0
    docs, masks = block.masks(item)
    order = np.lexsort(masks.T)
    sorted_masks = masks[order]
    starts = np.flatnonzero(np.concatenate(([True], (sorted_masks[1:] != sorted_masks[:-1]).any(axis=1))))
    held = np.unpackbits(sorted_masks[starts].view(np.uint8).reshape(len(starts), -1), axis=1)[:, :len(item)]
    bound = held.astype(np.int64) @ block.most[item]
    ends = np.append(starts[1:], len(order))
    ranked = np.argsort(-bound, kind="stable")
    wanted = np.zeros(len(block.most), bool)
    wanted[item] = True
    at, step, evaluated = 0, 16, 0
    while at < len(ranked) and bound[ranked[at]] >= best.least:
        some = ranked[at:at + step]
        some = some[bound[some] >= best.least]
        chosen = docs[np.concatenate([order[starts[g]:ends[g]] for g in some])]
        best.offer(block.exact(chosen, wanted).tolist(), [ids[d] for d in chosen.tolist()])
        evaluated += len(chosen)
        at, step = at + len(some), step * 2
    return evaluated


def best_found(rows: DataFrame, queries: Broadcast, n_docs: int, n_terms: int) -> DataFrame:
    """Each task's best documents of every item; ``queries``: items, their terms, weights of terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, asked, w = queries.value
        best = [Best() for _ in items]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = part.column(1).to_numpy()
                ends = part.column(2).offsets.to_numpy().astype(np.int64)
                ids = part.column(2).values.to_numpy()[ends[0]:ends[-1]].astype(np.int64)
                tf = part.column(3).values.to_numpy()[ends[0]:ends[-1]]
                ends -= ends[0]
                m = np.repeat(100 - 90 + (90 * n * n_docs) // n_terms, np.diff(ends))
                postings = Postings(ends, ids, w[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m)), len(w))
                names = part.column(0).to_pylist()
                for query, top in zip(asked, best, strict=True):
                    search(postings, query, names, top)
        out = [(i, d, -s) for i, top in zip(items, best, strict=True) for s, _, d in top.held]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, FOUND)


def ranked(found: DataFrame) -> DataFrame:
    """The best documents of every item, first in shares, then over all."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    shares = Window.partitionBy("item", "salt").orderBy(*order)
    few = (found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
           .withColumn("rank", F.row_number().over(shares)).where(f"rank <= {TOP}"))
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(f"rank <= {TOP}").drop("salt")


def rank_documents(docs: DataFrame, items: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The best documents of every item (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    named = stored(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "search_items")
    out = spark.createDataFrame([], FOUND)
    for block in query_blocks(named.orderBy("item"), block_terms):
        vocabulary = spark.sparkContext.broadcast(block.vocabulary)  # a query block's terms at most
        rows = stored(sparse_rows(docs, vocabulary), "search_rows")
        vocabulary.destroy()
        weight, n_docs, n_terms = weights(rows, len(block.vocabulary))
        queries = spark.sparkContext.broadcast((block.items, block.terms, weight))
        out = out.unionByName(stored(best_found(rows, queries, n_docs, n_terms), "search_found"))
        queries.destroy()
    return ranked(out).join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


#: the same ranking by joining every term of a document with every item that holds it
ORACLE_SQL = r"""
WITH said AS (
  SELECT r, doc_id, t AS term, count(*) AS tf FROM (
    SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT row_number() OVER () AS r, * FROM documents)) GROUP BY ALL),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM said GROUP BY r),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
wanted AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM said, corpus GROUP BY term, n_docs),
part AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS s
  FROM said JOIN sizes USING (r) JOIN weight USING (term), corpus),
scored AS (
  SELECT i, item_id, r, doc_id, sum(s)::BIGINT AS score FROM wanted JOIN part USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""

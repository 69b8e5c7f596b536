"""Benchmark decontamination by pigeonhole edit matching.

A test item may stand in a document with up to ``budget`` edits (insertions, deletions,
replacements of characters).  Cut into budget + 1 pieces, at least one piece must stand
there unchanged.  All pieces of a block of items are looked for in one pass over each
text; every hit says where the item would begin, and Myers' bit-parallel distance
verifies the text around that place.

Items and texts are compared in lower case with single blanks.  The benchmark is read in
blocks of a bounded size, so a pass over the documents never holds more than one block.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.llm.common import arrow_pass, kept

#: edits allowed for each character of an item, and the shortest piece; shorter items must stand unchanged
RATE, PIECE = 0.08, 12
#: characters of items that one pass looks for
BLOCK_CHARS = 1_000_000

Item = tuple[int | None, str]

def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    return max(0, min(int(RATE * length), length // PIECE - 1))


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(smallest distance of ``pattern`` to any stretch of ``text``, where the first such stretch ends)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = ones, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & ones
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & ones  # a stretch may begin anywhere: no carry into the first row
        mh = mh << 1 & ones
        pv = mh | ~(xv | ph) & ones
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


def whole_words(text: str, a: int, b: int) -> bool:
    """Whether ``text[a:b]`` doesn't begin or end inside a word."""
    return not (a and text[a - 1].isalnum() and text[a].isalnum() or b < len(text) and text[b - 1].isalnum() and text[b].isalnum())


class Matcher:
    def __init__(self, items: list[Item]):
        import ahocorasick
        self.items = [(i, normalise(t)) for i, t in items]
        self.pieces = ahocorasick.Automaton()
        for k, (_, item) in enumerate(self.items):
            if not item:
                continue
            n = budget(len(item)) + 1
            cuts = [len(item) * j // n for j in range(n + 1)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                self.pieces.get(item[a:b], None) or self.pieces.add_word(item[a:b], [])
                self.pieces.get(item[a:b]).append((k, b))
        if len(self.pieces):
            self.pieces.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, distance, budget, where it ends in the normalised text) of each item in
        ``text``, at its closest place."""
        if not len(self.pieces) or not text:
            return []
        text = normalise(text)
        places: dict[int, list[int]] = {}
        for end, hits in self.pieces.iter(text):
            for k, b in hits:
                places.setdefault(k, []).append(end + 1 - b)
        out = []
        for k, begins in sorted(places.items()):
            ident, item = self.items[k]
            allowed = budget(len(item))
            if not allowed:  # a short item stands in a text as words of its own, not inside others
                begins = [b for b in begins if whole_words(text, b, b + len(item))]
            best = (allowed + 1, 0)
            begins.sort()
            at = 0
            while at < len(begins) and best[0]:
                # hits whose stretches overlap are verified together, up to a few lengths of the item
                to = bisect.bisect_right(begins, min(begins[at] + 2 * len(item), begins[-1]))
                low = max(0, begins[at] - allowed)
                distance, end = myers(item, text[low:begins[to - 1] + len(item) + allowed])
                best = min(best, (distance, low + end))
                at = to
            if best[0] <= allowed:
                out.append((ident, best[0], allowed, best[1]))
        return out


def _matcher(items: list[Item]) -> Matcher:
    """One matcher a worker for equal items."""
    return kept("decontam", hash(tuple(items)), lambda: Matcher(items))


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[Item]]:
    """The items in blocks of about ``BLOCK_CHARS`` characters, one collected at a time.  Items with a null or blank text are left out; equal texts are searched once
    each."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("trim(t) <> ''")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    for k in range(blocks):
        yield [(r.i, r.t) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).orderBy("i", "t").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, budget, end) for every item that stands in a document.

    Whole texts are searched.  Null and empty texts match nothing; a null id is reported as
    null; repeated rows and repeated items are each reported; an empty benchmark gives no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, distance int, budget int, end int"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)  # about BLOCK_CHARS

        def make(shared=shared):
            matcher = _matcher(shared.value)

            def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
                found = [(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                         for hit in matcher.find(text)]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)],
                                                  ["doc_id", "item_id", "distance", "budget", "end"]) if found else None

            return work

        out = out.unionByName(arrow_pass(rows, ["doc_id", "text"], schema, make, keep="decontam"))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which no item stands."""
    at = docs.columns.index(text_col)
    for items in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            matcher = _matcher(shared.value)

            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                return batch.filter(pa.array([not matcher.find(t) for t in batch.column(at).to_pylist()], pa.bool_()))

            return work

        docs = arrow_pass(docs, docs.columns, docs.schema, make, keep="decontam")
    return docs

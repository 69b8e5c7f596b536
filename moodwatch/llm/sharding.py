"""Sharding by minimax contiguous partition.

Documents with equal texts form one atomic group.  Groups are put in order of their
first document, and the smallest shard capacity for which a greedy walk needs no more
than the wanted shards is found by binary search; the walk's cuts are the shards.

The walk never sees the groups one by one.  It runs on a summary: for each stretch of
the running total the first and the last place where a group ends.  A capacity that
works with the pessimistic end of every stretch is enough, one that fails with the
optimistic end is not, and only the stretches in which a cut can still fall are read
again, 64 times finer, until every cut is a known group end.  The driver holds at most
some hundred thousand numbers at any size of input.

A group larger than an even share gets a shard of its own first, so that the others
stay near equal.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.llm.common import hot_join, running_total, stored

SHARDS = 40
#: bytes that a document counts besides its text
OVERHEAD = 16
STRETCHES, FINER = 1 << 14, 64


class _Ends:
    """Group ends, known as stretches [first, last]."""

    def __init__(self, stretches: list[tuple[int, int]]):
        self.stretches = sorted(stretches)
        self.first = [a for a, _ in self.stretches]

    def reach(self, place: int, capacity: int, hopeful: bool) -> int:
        """The last group end in ``capacity`` of ``place``; unsure ones count if hopeful."""
        limit = place + capacity
        i = bisect_right(self.first, limit) - 1
        if i < 0:  # the first end is always known
            return place
        first, last = self.stretches[i]
        if last <= limit:
            return max(place, last)
        return limit if hopeful and first < last else max(place, first)

    def walk(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        places = [0]
        for _ in range(shards):
            places.append(self.reach(places[-1], capacity, hopeful))
        return places[1:]

    def least(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        """The smallest capacity in [low, high] whose walk gets to the end; high does."""
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, hopeful)[-1] >= self.stretches[-1][1]:
                high = middle
            else:
                low = middle + 1
        return low


def _stretches(ends: DataFrame, width: int) -> list[tuple[int, int]]:
    rows = ends.groupBy(F.expr(f"`end` div {width}")).agg(F.min("end").alias("a"), F.max("end").alias("b"))
    return [(r.a, r.b) for r in rows.collect()]


def minimax_cuts(ends: DataFrame, total: int, shards: int) -> list[int]:
    """Running totals at which to cut groups with the running totals ``end`` (all different,
    the last is ``total``) into at most ``shards`` shards with the smallest largest shard."""
    width = max(1, total // STRETCHES)
    known = _Ends(_stretches(ends, width))
    while True:
        low = known.least(1, total, shards, True)
        high = known.least(low, total, shards, False)
        sure, hoped = known.walk(low, shards, False), known.walk(high, shards, True)
        if low == high and sure == hoped:
            return sorted({p for p in sure if p < total})
        reach = [(a + low, b + high) for a, b in zip([0, *sure], [0, *hoped], strict=True)]
        merged: list[list[int]] = []
        finer: set[tuple[int, int]] = set()
        for a, b in reach:
            i = max(0, bisect_right(known.first, a) - 1)
            while i < len(known.stretches) and known.first[i] <= b:
                if known.first[i] < known.stretches[i][1] and known.stretches[i][1] >= a:
                    finer.add(known.stretches[i])
                i += 1
        for first, last in sorted(finer):
            if merged and first <= merged[-1][1] + 2 * width:
                merged[-1][1] = last
            else:
                merged.append([first, last])
        width = max(1, width // FINER)
        wanted = F.lit(False)
        for first, last in merged:
            wanted = wanted | F.col("end").between(first, last)
        kept = [s for s in known.stretches if not any(a <= s[0] <= b for a, b in merged)]
        known = _Ends(kept + _stretches(ends.where(wanted), width))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, size, text_crc32, law, shard, slot, grown_shard), one per input row.

    A null text has no bytes; null texts form one group.  Rows that repeat an id are rows
    of their own.  A null id sorts first.  Other columns are not read.  An empty table
    gives no rows; with fewer groups than shards some shards stay empty."""
    content = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(F.encode(F.col(text_col), "UTF-8"), 256)), F.lit(bytearray())).alias("copy_key"))
    rows = stored(rows, "shard_rows")
    groups = stored(rows.groupBy("copy_key").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"),
                                                    F.count("*").alias("rows")),
                    "shard_groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    left, own = shards, []
    for r in groups.orderBy(F.desc("bytes"), "copy_key").limit(shards - 1).collect():
        if left < 2 or r.bytes * left <= total:
            break
        own.append(r.copy_key)
        left, total = left - 1, total - r.bytes
    rest = groups
    if own:
        rest = groups.where(~F.col("copy_key").isin(own))
    placed = stored(running_total(rest, ["first_id", "copy_key"], "bytes", "start")
                    .select("copy_key", "rows", "start", (F.col("start") + F.col("bytes")).alias("end")), "shard_places")
    cuts = minimax_cuts(placed.select("end"), total, left) if total else []
    # the place of the last cut at or before the start: cuts are fewer than the shards
    number = F.lit(0)
    for k, cut in enumerate(cuts):
        number = F.when(F.col("start") >= cut, F.lit(k + 1)).otherwise(number)
    placed = placed.select("copy_key", "rows", number.alias("shard"))
    for k, key in enumerate(own):
        one = groups.where(F.col("copy_key") == F.lit(key)).select("copy_key", "rows", F.lit(left + k).alias("shard"))
        placed = placed.unionByName(one)
    dealt = hot_join(rows, placed, "copy_key", "rows").select("doc_id", "size", "text_crc32", "shard", "copy_key")
    dealt = running_total(dealt, ["shard", "doc_id", "copy_key"], F.lit(1), "place")
    firsts = dealt.groupBy("shard").agg(F.min("place").alias("first_place"))
    return (dealt.join(F.broadcast(firsts), "shard")  # one row a shard
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                    (F.col("place") - F.col("first_place")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))

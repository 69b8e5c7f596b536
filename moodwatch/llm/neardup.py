"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct shingles of five words (64-bit hashes).  Equal sets
are one node.  The shingles fall into buckets; of the smallest hash of a bucket the number
of leading zeros and some mantissa bits are kept (a register).  Registers serve twice.  Bands of
three wide ones (6 + 10 bits) make nodes meet; there an empty bucket borrows the register of
another one, found by a fixed sequence.  512 narrow ones (5 + 3 bits, or a mark for empty)
estimate the Jaccard similarity from the buckets that aren't empty in both, corrected for
registers that are equal by chance.  Pairs with a high enough estimate are confirmed on the
full sets, recomputed from the texts.

A bucket of a band never yields all its pairs.  First every member of a block of the bucket
meets its most similar earlier member; confirmed links give components.  Then only pairs of
different components are left, of which those with a high estimate are confirmed too, so
no link between components is lost.  Buckets larger than a block are split by a hash, and
pairs of blocks meet in the second step.

Sets of fewer than six shingles (four at 80 %) can only reach the similarity by being equal,
so they don't enter the bands.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.llm.common import arrow_pass, components, partitions, stored

SHINGLE = 5
#: percent of the union that linked documents share, unless the caller says otherwise
SIMILARITY = 85
BUCKETS, BANDS, ROWS = 256, 20, 3
NARROW, EMPTY = 512, 255
#: two independent narrow registers are equal this often: leading zeros alike (0.4) times 1/8
CHANCE = 0.05
#: an estimate may fall this far below SIMILARITY: 3.75 deviations of 512 registers, for others as
#: many.  Smaller sets scatter less, since their buckets hold nearly all of their shingles
SLACK = 0.06
#: members of a bucket that meet in one step; a group of FEW yields all its likely pairs
BLOCK, FEW = 512, 8

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}
_word_hashes: dict[str, int] = {}

_TRIES: np.ndarray | None = None


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of the shingles of a text; one of all words if they are fewer."""
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return np.empty(0, np.uint64)
    known = _word_hashes
    if len(known) > 500_000:
        known.clear()
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    h = np.array([known[w] for w in words], np.uint64)
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = _mix(out + h[i:n + i])  # wraps around
    return np.unique(out)


def set_hash(found: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    h = xxhash.xxh3_64_intdigest(found.astype("<u8").tobytes())
    return h - (1 << 64) if h >> 63 else h


def _tries() -> np.ndarray:
    """For each bucket the sequence of buckets to borrow from."""
    global _TRIES
    if _TRIES is None:
        steps = np.arange(4 * BUCKETS, dtype=np.uint64)[:, None] * np.uint64(BUCKETS) + np.arange(BUCKETS, dtype=np.uint64)
        _TRIES = (_mix(steps + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64)
    return _TRIES


def _register(least: np.ndarray, bits: int, zeros_bits: int, mantissa_bits: int) -> np.ndarray:
    """Leading zeros and the bits after the first one of values of ``bits`` bits."""
    _, exponent = np.frexp(least.astype(np.float64))
    length = np.minimum(exponent, bits)  # bits of the value; 0 for 0
    zeros = np.minimum(bits - length, (1 << zeros_bits) - 1)
    shift = (bits - np.maximum(length, 1) + 1).astype(np.uint64)
    fraction = ((least << shift) & np.uint64((1 << bits) - 1)) >> np.uint64(bits - mantissa_bits)
    return (zeros.astype(np.uint64) << np.uint64(mantissa_bits)) | fraction


def _minima(found: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(smallest rest of the hashes in each bucket, whether it has any, bits of the rest)."""
    bits = 64 - (buckets.bit_length() - 1)
    first = np.searchsorted(found, np.arange(buckets, dtype=np.uint64) << np.uint64(bits))
    least = found[np.minimum(first, len(found) - 1)]
    have = (first < len(found)) & ((least >> np.uint64(bits)) == np.arange(buckets, dtype=np.uint64))
    return least & np.uint64((1 << bits) - 1), have, bits


def wide_registers(found: np.ndarray) -> np.ndarray:
    """Registers of a set that isn't empty, for the bands."""
    least, have, bits = _minima(found, BUCKETS)
    source = np.arange(BUCKETS)
    empty = np.flatnonzero(~have)
    for row in _tries():
        if not len(empty):
            break
        at = row[empty]
        full = have[at]
        source[empty[full]] = at[full]
        empty = empty[~full]
    if len(empty):
        source[empty] = np.flatnonzero(have)[0]
    return _register(least[source], bits, 6, 10)


def narrow_registers(found: np.ndarray) -> np.ndarray:
    """Registers of a set that isn't empty, for the estimate."""
    least, have, bits = _minima(found, NARROW)
    return np.where(have, np.minimum(_register(least, bits, 5, 3), EMPTY - 1), EMPTY).astype(np.uint8)


def band_keys(wide: np.ndarray) -> np.ndarray:
    """One 64-bit key a band."""
    key = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for r in wide[:BANDS * ROWS].reshape(BANDS, ROWS).T:
        key = _mix(key + r + np.uint64(1))
    return key.astype(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarities of the rows of ``a`` with the rows of ``b`` (narrow registers)."""
    none_a, none_b = (a == EMPTY).astype(np.float32), (b == EMPTY).astype(np.float32)
    neither = none_a @ none_b.T
    both = NARROW - none_a.sum(axis=1)[:, None] - none_b.sum(axis=1)[None, :] + neither
    equal = np.empty((len(a), len(b)), np.float32)
    for k in range(0, len(a), 16):
        equal[k:k + 16] = (a[k:k + 16, None, :] == b[None, :, :]).sum(axis=-1)
    return (equal - neither - CHANCE * both) / (1 - CHANCE) / (NARROW - neither)


def least_shingles(percent: int) -> int:
    """The smallest set that can be linked with another one: n of n + 1 shingles reach the similarity."""
    return -(-percent // (100 - percent))


def slack(percent: int) -> float:
    return SLACK * math.sqrt(percent * (100 - percent) / (SIMILARITY * (100 - SIMILARITY)))


def _likely(estimate: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that may be linked, by the sizes of the sets and the estimate."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (estimate >= percent / 100 - slack(percent))


def _meet(band: np.ndarray, node: np.ndarray, n: np.ndarray, regs: np.ndarray, keys: np.ndarray, _: np.ndarray,
          percent: int = SIMILARITY) -> list[tuple]:
    """First step, for one block: (a, b, open band or None) rows."""
    estimate = similarity(regs, regs)
    likely = np.triu(_likely(estimate, n[:, None], n[None, :], percent), 1)
    if len(node) <= FEW:
        return [(node[i], node[j], None) for i, j in zip(*np.nonzero(likely), strict=True)]
    order = np.argsort(-np.where(likely | likely.T, estimate, 0).sum(axis=1), kind="stable")
    ranked = np.where((likely | likely.T)[np.ix_(order, order)], estimate[np.ix_(order, order)], -1)
    ranked = np.where(np.tri(len(node), k=-1, dtype=bool), ranked, -1)
    best = ranked.argmax(axis=1)
    out = [(node[order[i]], node[order[j]], None) for i, j in enumerate(best) if ranked[i, j] > 0]
    return [*out, (None, None, band[0])] if likely.sum() > len(out) else out


def _cross(band: np.ndarray, node: np.ndarray, n: np.ndarray, regs: np.ndarray, keys: np.ndarray, extra: np.ndarray,
           percent: int = SIMILARITY) -> list[tuple]:
    """Second step, for a block or a pair of blocks: likely pairs of different components.  A pair
    that meets in several bands is given in the first of them alone; if that one isn't open, the
    first step has tested the pair."""
    label, part = extra[:, 0], extra[:, 1]
    out = []
    sides = [np.arange(len(node))] * 2 if len(set(part.tolist())) < 2 else [np.flatnonzero(part == p) for p in np.unique(part)]
    for at in range(0, len(sides[0]), 256):
        i, j = sides[0][at:at + 256], sides[1]
        likely = _likely(similarity(regs[i], regs[j]), n[i][:, None], n[j][None, :], percent) & (label[i][:, None] != label[j][None, :])
        x, y = np.nonzero(likely)
        x, y = i[x], j[y]
        if sides[0] is sides[1]:
            x, y = x[x < y], y[x < y]
        first = (keys[x] == keys[y]).argmax(axis=1)
        here = keys[x, first] == band[0]
        out += [(a, b, None) for a, b in zip(node[x[here]], node[y[here]], strict=True)]
    return out


def _grouped(rows: DataFrame, keys: list[str], extra: list[str], work: Callable[..., list[tuple]]) -> DataFrame:
    """Run ``work`` over the rows (band, node, n, regs, band keys, *extra) of each key; ``regs`` holds
    the narrow registers and then the band keys.  Rows are dealt and
    sorted by the keys, and a task holds one Arrow batch and the rows of one key."""
    keys = list(keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[np.ndarray, ...] | None = None

        def done(key: np.ndarray, columns: tuple[np.ndarray, ...]) -> pa.RecordBatch | None:
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
            out: list[tuple] = []
            for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
                out += work(*(c[a:b] for c in columns))
            if not out:
                return None
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["a", "b", "open"])

        for batch in batches:
            number = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            key = np.stack([number[k].to_numpy(zero_copy_only=False) for k in keys], axis=1)
            both = np.frombuffer(b"".join(number["regs"].to_pylist()), np.uint8).reshape(len(key), NARROW + 8 * BANDS)
            regs, bands = both[:, :NARROW], np.ascontiguousarray(both[:, NARROW:]).view(np.int64)
            own = [number[c].to_numpy(zero_copy_only=False) for c in ("band", "node", "n")]
            more = np.stack([number[c].to_numpy(zero_copy_only=False) for c in extra], axis=1) if extra else np.zeros((len(key), 0))
            new = (key, *own, regs, bands, more)
            kept = new if kept is None else tuple(np.concatenate(x) for x in zip(kept, new, strict=True))
            last = np.flatnonzero((kept[0] != kept[0][-1]).any(axis=1))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole and (made := done(kept[0][:whole], tuple(c[:whole] for c in kept[1:]))) is not None:
                yield made
            kept = tuple(c[whole:] for c in kept)
        if kept is not None and len(kept[0]) and (made := done(kept[0], kept[1:])) is not None:
            yield made

    columns = list(dict.fromkeys([*keys, "band", "node", "n", "regs", *extra]))
    dealt = (rows.select(*columns).repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "node"))
    return dealt.mapInArrow(run, "a long, b long, open long")


def _signed(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, row, n, node, bands) of (doc_id, text, row); node is null for an empty set or a null id,
    bands for a set too small to meet others."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            size, node, bands = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingles(text)
                size.append(len(found))
                node.append(set_hash(found) if len(found) and doc is not None else None)
                bands.append(band_keys(wide_registers(found)) if len(found) >= least and doc is not None else None)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "row", "n", "node", "bands"])

        return work

    return arrow_pass(docs, ["doc_id", "text", "row"], "doc_id long, row long, n long, node long, bands array<long>", make)


def _with_registers(rows: DataFrame) -> DataFrame:
    """(node, n, regs, text) of (node, text), where the text has that node; ``regs``: the narrow
    registers and then the band keys."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[tuple] = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingles(text)
                if len(found) and set_hash(found) == node:
                    own = narrow_registers(found).tobytes() + band_keys(wide_registers(found)).tobytes()
                    out.append((node, len(found), own, text))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                                              ["node", "n", "regs", "text"])

        return work

    return arrow_pass(rows, ["node", "text"], "node long, n long, regs binary, text string", make)


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs`` (a, b), on the full sets of both texts."""

    def make():
        last: dict[str, np.ndarray] = {}

        def found(text: str) -> np.ndarray:
            if text not in last:
                if len(last) > 64:
                    last.clear()
                last[text] = shingles(text)
            return last[text]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = found(one), found(two)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            return batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

        return work

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("two"))
    joined = pairs.join(left, "a").join(right, "b")
    return arrow_pass(joined, ["a", "b", "one", "two"], "a long, b long", make)


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _placed(docs: DataFrame, id_col: str, text_col: str, similarity: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, n, node, group) of the rows with shingles and an id, and (doc_id, row, n) of the
    others; ``row`` is a hash of the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("row"))
    signed = stored(_signed(rows, least_shingles(similarity)), "signed")
    named = signed.where("node is not null")
    exploded = named.where("bands is not null").select("node", F.explode("bands").alias("band"))
    shared = (exploded.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
              .where("lo <> hi").select("band"))
    members = stored(exploded.join(shared, "band").distinct(), "members")
    one = named.join(members.select("node").distinct(), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = stored(_with_registers(rows.join(one, "doc_id").select("node", "text")).dropDuplicates(["node"]), "family_texts")
    sizes = members.groupBy("band").agg(F.count("*").alias("m"))
    blocked = members.join(sizes, "band").select(
        "band", "node", F.ceil(F.col("m") / F.lit(float(BLOCK))).cast("long").alias("blocks")).withColumn(
        "block", F.pmod(F.xxhash64("node", "band"), F.col("blocks")))
    regs = texts.select("node", "n", "regs")
    first = stored(_grouped(blocked.join(regs, "node"), ["band", "block"], [], partial(_meet, percent=similarity)), "met")
    tested = stored(_pairs(first), "pairs")
    links = stored(_confirmed(tested, texts, similarity), "links")
    label = components(links)

    left = (blocked.join(first.where("open is not null").select(F.col("open").alias("band")).distinct().withColumn("_open", F.lit(True)), "band", "left")
            .where("_open or blocks > 1").drop("_open")
            .join(label, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"))
    mixed = left.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("band")
    # each row meets every block of its bucket once
    paired = (left.join(mixed, "band").join(regs, "node")
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))
    second = stored(_pairs(_grouped(paired, ["band", "lo", "hi"], ["label", "block"], partial(_cross, percent=similarity)))
                    .join(tested, ["a", "b"], "left_anti"), "cross_pairs")
    if second.isEmpty():
        final = label
    else:
        final = components(stored(links.unionByName(_confirmed(second, texts, similarity)), "all_links"))
    placed = named.select("doc_id", "row", "n", "node").join(final, "node", "left").withColumn("group", F.coalesce("component", "node"))
    return placed, signed.where("node is null").select("doc_id", "row", "n")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; documents are linked that share
    ``similarity`` percent of their shingles.

    A null or empty text has no shingles and is linked with nothing.  Rows with a null id
    are linked with nothing; their component is null and they are kept.  Rows that repeat an
    id and a text are the same document; other rows that repeat an id keep their own sets."""
    placed, others = _placed(docs, id_col, text_col, similarity)
    least = placed.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    linked = placed.join(least, "group").select("doc_id", "n", "component_id")
    alone = others.select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """One row of ``docs``, all columns as they are, of each group of near duplicates: that of the
    smallest id, and among the texts of that id the one of smallest hash.

    Rows are told apart by id and text, so a row stays if only another one of its id is a copy; of
    rows that repeat an id and a text one stays.  Rows with a null id all stay."""
    placed, others = _placed(docs, id_col, text_col, similarity)
    placed = stored(placed.select("doc_id", "row", "group"), "placed")
    key = F.struct("doc_id", "row")
    least = placed.groupBy("group").agg(F.min(key).alias("least"))
    gone = placed.join(least, "group").where(key != F.col("least")).select("doc_id", "row").distinct()
    repeated = stored(placed.select("doc_id", "row").unionByName(others.where("doc_id is not null").select("doc_id", "row"))
                      .groupBy("doc_id", "row").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "row"), "repeated")
    own = [F.col(id_col).cast("long").alias("_near_id"), F.xxhash64(text_col).alias("_near_row")]

    def on(keys: DataFrame) -> DataFrame:
        return keys.select(F.col("doc_id").alias("_near_id"), F.col("row").alias("_near_row"))

    keys = ["_near_id", "_near_row"]
    kept = docs.select("*", *own).join(on(gone), keys, "left_anti")
    if not repeated.isEmpty():
        kept = kept.join(on(repeated), keys, "left_anti").unionByName(
            kept.join(on(repeated), keys, "left_semi").dropDuplicates(keys))
    return kept.select(*docs.columns)

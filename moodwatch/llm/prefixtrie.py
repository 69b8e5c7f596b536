"""Operator 11: the trie of conversation prefixes, by padded turn-id matrices.

A conversation is the path of its turns; a turn's id is the 128-bit digest of its role and
text, so texts are read once and never shuffled.  Equal paths become one row with the
number and smallest id of its copies.  The different paths are dealt by range, so that a
shard holds neighbours in path order.  A task reads its shard in blocks of bounded size:
the paths of a block form a matrix of turn ids padded with -1, ``lexsort`` orders it,
OR-accumulated column changes mark where nodes start, and ``reduceat`` sums each depth.
All figures of a node are sums or minima over rows, also over its whole subtree, so a node
that crosses a block's edge has one part a block; only those parts are shuffled again.

Memory: a block has at most ``CELLS`` cells or one conversation; a conversation's ids and
lengths (20 bytes a turn) have to fit into a row.  Lists of members are hashed piece by
piece, never held whole.

Defined results: rows without a conv_id belong to no conversation; a null role or text is
empty; turns order by turn (null first), equal turns by digest; repeated rows are turns of
their own; other columns are ignored; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodwatch.llm.common import partitions, stored

#: cells of a block's matrix
CELLS = 1 << 20
#: ids in a piece of a member list
PIECE = 20_000
#: turns that conversations share are taken from the first conversation of this many ids, fewer than so many
FAMILY, SHARED = 100, 6
DIGEST = 16
NOBODY = hashlib.sha256(b"").hexdigest()

PARTS = ("block string, depth int, node_key binary, parent_key binary, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# --- paths ------------------------------------------------------------------------

def _turn_id(role: Column, text: Column) -> Column:
    """Hex digest of a turn; the role's length keeps (ab, c) and (a, bc) apart."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def conversations(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): the turns (digest, chars) of each conversation in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", _turn_id(role, text).alias("digest"),
                    F.length(text).alias("chars"))
    return (turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x.digest.alias("digest"), x.chars.alias("chars"))).alias("turns")))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations that share their first h turns with the first of their family, h being the
    CRC-32 of the id modulo 6, and go on with their own turns after those."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    heads = (convs.where(F.col("conv_id") % FAMILY == 0)
             .select(F.col("conv_id").alias("family"), F.slice("turns", 1, SHARED - 1).alias("head")))
    return (convs.withColumn("h", shared.cast("int")).withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
            .join(heads, "family", "left")
            .select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0)),
                                        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns")))


def paths(convs: DataFrame) -> DataFrame:
    """Rows (conv_id, path, chars): the digests one after the other, and the turns' lengths."""
    return convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: x.digest), "")).alias("path"),
                        F.col("turns.chars").alias("chars"))


# --- member lists ---------------------------------------------------------------------

def _runs(keys: pa.Array, n: int) -> np.ndarray:
    """Starts of runs of equal keys, and the end."""
    k = keys.to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [n])) if n else np.zeros(1, int)


def _pieces(piece: int) -> Callable:
    """(path_key, conv_id) in order to pieces of comma-joined ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            keys, ids = batch.column(0), batch.column(1).to_numpy()
            starts = _runs(keys, batch.num_rows).tolist()
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                for at in range(a, b, piece):
                    some = ids[at:min(at + piece, b)].tolist()
                    out.append((keys[a].as_py(), some[0], len(some), ",".join(map(str, some))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["path_key", "first_id", "n", "ids"])

    return run


def _hash_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one row a path: smallest id, number of ids, SHA-256 of the list."""
    names = ["path_key", "conv_id", "n", "ends"]
    key, state, low, n = None, None, 0, 0
    for batch in batches:
        out = []
        for k, first, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key:
                if state is not None:
                    out.append((key, low, n, state.hexdigest()))
                key, state, low, n = k, hashlib.sha256(), first, 0
            else:
                state.update(b",")
            state.update(ids.encode())
            n += count
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (key, low, n, state.hexdigest())], names)


def distinct_paths(seqs: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row a path: (conv_id smallest, n copies, ends SHA-256 of their ids, path, chars)."""
    n = partitions(seqs.sparkSession)
    keyed = seqs.select(F.md5("path").alias("path_key"), "conv_id")
    pieces = (keyed.repartitionByRange(n, "path_key", "conv_id").sortWithinPartitions("path_key", "conv_id")
              .mapInArrow(_pieces(piece), "path_key string, first_id long, n long, ids string"))
    lists = (pieces.repartition(n, "path_key").sortWithinPartitions("path_key", "first_id")
             .mapInArrow(_hash_lists, "path_key string, conv_id long, n long, ends string"))
    return lists.drop("path_key").join(seqs, "conv_id")


# --- blocks -----------------------------------------------------------------------------

class Rows:
    """Different paths in order: their turn digests one after the other, offsets, lengths, and
    the smallest id, number and list hash of the copies."""

    def __init__(self, path: list[bytes], chars: list[list[int]], conv: list[int], n: list[int], ends: list[str]):
        self.path, self.chars, self.conv, self.n, self.ends = path, chars, conv, n, ends
        self.depth = np.array([len(p) // DIGEST for p in path], np.int64)


def _common(a: bytes | None, b: bytes | None) -> int:
    """Turns that two paths share at their start; -1 if one is missing."""
    if a is None or b is None:
        return -1
    k = min(len(a), len(b)) // DIGEST
    if not k:
        return 0
    x, y = (np.frombuffer(s, np.uint8, k * DIGEST).reshape(k, DIGEST) for s in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if differ.size else k


def _turn_matrix(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of turn ids, padded with -1, and matrix of their lengths.  Ids ascend with the digests."""
    depth = rows.depth
    width = int(depth.max(initial=0))
    words = np.frombuffer(b"".join(rows.path), ">u8").reshape(-1, 2)
    order = np.lexsort((words[:, 1], words[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]).any(axis=1)
    ids = np.empty(len(order), np.int64)
    ids[order] = np.cumsum(new) - 1
    inside = np.arange(width) < depth[:, None]
    turns, chars = np.full(inside.shape, -1, np.int64), np.zeros(inside.shape, np.int64)
    turns[inside] = ids
    chars[inside] = np.fromiter((c for row in rows.chars for c in row), np.int64, len(ids))
    return turns, chars


def block_nodes(rows: Rows, before: bytes | None, after: bytes | None, block: str) -> pa.RecordBatch:
    """The nodes of a block of different paths; ``before`` and ``after`` are the paths next to it.

    Figures of a node that the neighbours share are this block's part of them, and carry the
    node's key; a node below such a node carries its parent's key."""
    turns, chars = _turn_matrix(rows)
    order = np.lexsort(turns.T[::-1]) if turns.shape[1] else np.arange(len(turns))
    turns, chars, depth = turns[order], chars[order], rows.depth[order]
    conv, n = np.array(rows.conv, np.int64)[order], np.array(rows.n, np.int64)[order]
    path, ends = [rows.path[i] for i in order], np.array(rows.ends, object)[order]
    count, width = turns.shape
    left, right = _common(before, path[0]), _common(path[-1], after)

    change = np.ones((count, width), bool)
    change[1:] = turns[1:] != turns[:-1]
    change = np.logical_or.accumulate(change, axis=1)  # from the first differing column on
    fresh = change & (turns >= 0)  # the node at this row and column starts here
    fresh[0] &= np.arange(width) >= left
    goes_on = np.empty(count, np.int64)  # turns shared with the next path
    goes_on[:-1] = width - change[1:].sum(axis=1)
    goes_on[-1] = right
    leaf = (goes_on < depth).astype(np.int64)
    weight = (n[:, None] - fresh) * chars
    weight = weight[:, ::-1].cumsum(axis=1)[:, ::-1]  # of this column and all after it

    keys: dict[tuple[int, int], bytes] = {}  # (row 0 or last, depth) to the shared node's key
    for row, most in ((0, left), (count - 1, right)):
        state = hashlib.md5()
        for d in range(most + 1):
            if d:
                state.update(path[row][(d - 1) * DIGEST:d * DIGEST])
            keys[row, d] = state.copy().digest()

    out: list[list] = [[] for _ in range(10)]
    above = np.zeros(1, np.int64)  # starts of the runs one column before
    above_conv = np.zeros(1, np.int64)
    for d in range(width + 1):
        if d:
            starts = np.flatnonzero(change[:, d - 1])
            valid = depth[starts] >= d
        else:
            starts, valid = np.zeros(1, np.int64), np.ones(1, bool)
        low = np.minimum.reduceat(conv, starts)
        figures = [np.add.reduceat(n, starts),
                   np.add.reduceat(fresh[:, d].astype(np.int64), starts) if d < width else np.zeros(len(starts), np.int64),
                   np.add.reduceat(leaf, starts),
                   np.add.reduceat(weight[:, max(d - 1, 0)], starts) if width else np.zeros(len(starts), np.int64)]
        here = np.flatnonzero(valid)
        shared: list[bytes | None] = [None] * len(starts)
        below: list[bytes | None] = [None] * len(starts)
        up = np.searchsorted(above, starts, "right") - 1
        parent = above_conv[up]
        known = np.ones(len(starts), bool) if d else np.zeros(1, bool)
        last = len(starts) - 1
        for row, run in ((count - 1, last), (0, 0)):
            if (row, d) in keys and valid[run]:
                shared[run] = keys[row, d]
            if d and (row, d - 1) in keys:  # children of a shared node
                mine = up == up[run]
                known &= ~mine
                for i in np.flatnonzero(mine & valid).tolist():
                    below[i] = keys[row, d - 1]
        stops = depth[starts] == d
        out[0].append(np.full(len(here), d, np.int32))
        out[1].extend(shared[i] for i in here)
        out[2].extend(below[i] for i in here)
        out[3].append(low[here])
        out[4].extend(int(p) if k else None for p, k in zip(parent[here].tolist(), known[here].tolist(), strict=True))
        for at, figure in enumerate(figures, 5):
            out[at].append(figure[here])
        out[9].extend(ends[i] if s else None for i, s in zip(starts[here].tolist(), stops[here].tolist(), strict=True))
        above, above_conv = starts, low
    flat = [np.concatenate(out[0]), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary()), np.concatenate(out[3]),
            pa.array(out[4], pa.int64()), *(np.concatenate(out[i]) for i in range(5, 9)), pa.array(out[9], pa.string())]
    size = len(flat[0])
    return pa.RecordBatch.from_arrays([pa.array([block] * size, pa.string()), *(pa.array(c) if isinstance(c, np.ndarray) else c for c in flat)],
                                      ["block", "depth", "node_key", "parent_key", "conv_id", "parent_conv_id", "n_convs",
                                       "n_children", "n_leaves", "saved_tokens", "ends_sha256"])


def _blocks(cells: int) -> Callable:
    """Shards in path order to nodes.  A shard's rows stand between two guests without copies:
    the last path of the shard before and the first one of the shard after."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block = TaskContext.get(), 0
        shard, before, held, widest = None, None, [], 0

        def flush(after: bytes | None) -> Iterator[pa.RecordBatch]:
            nonlocal before, held, widest, block
            if held:
                yield block_nodes(Rows(*map(list, zip(*held, strict=True))), before, after, f"{task.partitionId()}-{block}")
                before, block = held[-1][0], block + 1
            held, widest = [], 0

        for batch in batches:
            for at, path, chars, conv, n, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != shard:
                    yield from flush(None)
                    shard, before = at, None
                if not n:  # a guest
                    yield from flush(path)
                    before = path
                    continue
                if held and (len(held) + 1) * max(widest, len(chars)) > cells:
                    yield from flush(path)
                held.append((path, chars, conv, n, ends))
                widest = max(widest, len(chars))
        yield from flush(None)

    return run


# --- the trie -----------------------------------------------------------------------------

def _shards(uniq: DataFrame) -> DataFrame:
    """Paths dealt by range, with the neighbouring shards' nearest paths as guests."""
    spark = uniq.sparkSession
    n = partitions(spark)
    dealt = stored(uniq.repartitionByRange(n, "path").withColumn("shard", F.spark_partition_id()), "trie_paths")
    edges = dealt.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    numbered = edges.selectExpr("shard", "low", "high", "row_number() over (order by shard) as at")  # one row a shard
    pairs = numbered.alias("a").join(numbered.alias("b"), F.expr("b.at = a.at + 1"))

    def guests(shard: str, path: str) -> DataFrame:
        return pairs.selectExpr(f"{shard} as shard", f"{path} as path", "array() as chars", "-1L as conv_id", "0L as n", "'' as ends")

    rows = dealt.select("shard", "path", "chars", "conv_id", "n", "ends")
    guest = guests("b.shard", "a.high").unionByName(guests("a.shard", "b.low"))
    return (rows.unionByName(guest.withColumn("chars", F.col("chars").cast("array<int>")))
            .repartitionByRange(n, "shard").sortWithinPartitions("shard", "path"))


def trie(seqs: DataFrame, cells: int = CELLS, piece: int = PIECE) -> DataFrame:
    """The nodes of the trie over ``seqs`` (conv_id, path, chars)."""
    seqs = stored(seqs, "trie_seqs")
    parts = stored(_shards(distinct_paths(seqs, piece)).mapInArrow(_blocks(cells), PARTS), "trie_parts")
    edge = parts.where("node_key is not null")
    whole = (edge.groupBy("node_key", "depth")
             .agg(F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
                  *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
                  F.max("ends_sha256").alias("ends_sha256")))
    whole = stored(whole, "trie_edges")
    lows = whole.select("node_key", F.col("conv_id").alias("low"))
    parents = lows.withColumnRenamed("node_key", "parent_key")
    upper = whole.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("low"))
    # children of a shared node look its smallest member up by block: no node's children meet in one task
    inner = parts.where("node_key is null")
    near = edge.select("block", "node_key").distinct().join(lows, "node_key").withColumnRenamed("node_key", "parent_key")
    hung = (inner.where("parent_key is not null").join(near, ["block", "parent_key"], "left")
            .withColumn("parent_conv_id", F.col("low")))
    nodes = [x.select(NODE) for x in (inner.where("parent_key is null"), hung, upper)]
    return (nodes[0].unionByName(nodes[1]).unionByName(nodes[2])
            .withColumn("depth", F.col("depth").cast("long"))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOBODY))))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations of ``turns`` (conv_id, turn, role, text) as they stand."""
    return trie(paths(conversations(turns)))


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations after :func:`rebuilt`."""
    return trie(paths(rebuilt(stored(conversations(turns), "conversations"))))


#: the same nodes, by the turns themselves and without digests, shards or matrices
ORACLE_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
                          lambda a, _x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) r(i))),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS family,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
placed AS (
  SELECT i.conv_id, t.place, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.family AND t.place <= i.h
  UNION ALL
  SELECT i.conv_id, t.place, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place > i.h),
pos AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS d,
         md5(length(role) || ':' || role || text) AS turn, length(text) AS chars FROM placed),
pref AS (
  SELECT conv_id, d, chars, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY d) AS node,
         max(d) OVER (PARTITION BY conv_id) AS len FROM pos
  UNION ALL
  SELECT i.conv_id, 0, 0, '', coalesce(max(p.d), 0) FROM ids i LEFT JOIN pos p USING (conv_id) GROUP BY i.conv_id),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, max(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len = d), '')) AS ends
  FROM pref GROUP BY node, d),
linked AS (
  SELECT c.*, p.conv_id AS parent_conv_id, CASE WHEN c.d > 0 THEN left(c.node, 32 * (c.d - 1)::INT) END AS parent
  FROM nodes c LEFT JOIN nodes p ON p.d = c.d - 1 AND p.node = left(c.node, 32 * (c.d - 1)::INT)),
kids AS (SELECT parent AS node, count(*) AS k FROM linked WHERE parent IS NOT NULL GROUP BY 1),
sums AS (
  SELECT left(node, 32 * u.up::INT) AS node, sum((n - 1) * chars) AS saved, count(*) FILTER (WHERE k IS NULL) AS leaves
  FROM (SELECT * FROM nodes LEFT JOIN kids USING (node)) x, LATERAL (SELECT unnest(range(x.d + 1)) AS up) u GROUP BY 1)
SELECT l.conv_id, l.d AS depth, l.parent_conv_id, l.n AS n_convs, coalesce(k.k, 0) AS n_children,
       s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, l.ends AS ends_sha256
FROM linked l JOIN sums s USING (node) LEFT JOIN kids k ON k.node = l.node
"""

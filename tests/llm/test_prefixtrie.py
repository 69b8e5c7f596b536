import hashlib
import random
import zlib

import numpy as np
import pytest

from moodwatch.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    """{(conv_id, depth): the other columns} straight from the definition."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        seqs[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = {}
    for node, who in members.items():
        below = [x for x in members if x[:len(node)] == node]
        ends = sorted(c for c in who if seqs[c] == node)
        out[min(who), len(node)] = (
            min(members[node[:-1]]) if node else None, len(who), sum(len(x) == len(node) + 1 for x in below),
            sum(not any(y[:len(x)] == x and len(y) == len(x) + 1 for y in below) for x in below),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def nodes(df):
    got = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


def talk(n, seed, words=("a", "bb", "çé", "", None), most=7):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot", None]), rng.choice(words)) for c in range(n) for t in range(rng.randint(1, most))]


def test_rebuilt_trie_equals_brute_force(frame):
    rows = talk(230, 1)
    rows += [(5, None, "user", "first"), (7, 2, "x", "y"), (7, 2, "x", "y"), (7, 2, "z", "w"), (None, 0, "user", "lost"),
             (1001, 0, "user", "own family missing")]
    got = prefixtrie.rebuilt_trie(frame([(*r, 9) for r in rows], SCHEMA + ", depth int"))
    assert got.columns == prefixtrie.NODE
    assert nodes(got) == brute(rows)


@pytest.mark.parametrize("cells", [1, 12, 100])
def test_nodes_across_blocks_and_shards(frame, cells):
    rows = talk(120, cells, words=("a", "b"), most=6) + [(500 + c, t, "u", str(t)) for c in range(40) for t in range(c)]
    rows += [(900 + c, t, "u", "same") for c in range(30) for t in range(4)]  # copies
    turns = frame(rows, SCHEMA)
    convs = prefixtrie.conversations(turns)
    assert nodes(prefixtrie.trie(prefixtrie.paths(convs), cells)) == brute(rows, rebuild=False)


def test_member_lists_in_pieces(frame):
    rows = [(c, 0, "u", "copy") for c in range(100)]
    seqs = prefixtrie.paths(prefixtrie.conversations(frame(rows, SCHEMA)))
    assert prefixtrie.distinct_paths(seqs, piece=3).count() == 1
    got = nodes(prefixtrie.trie(seqs, piece=3))
    assert got == brute(rows, rebuild=False)
    assert got[0, 1][1] == 100


def test_turnless_and_empty(frame, spark):
    rows = [(c, 0, "u", "x") for c in range(101, 108)]  # the family's first conversation is missing
    got = nodes(prefixtrie.rebuilt_trie(frame(rows, SCHEMA)))
    assert got == brute(rows) and got[101, 0][1] == 7
    turnless = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6][:3]
    rows = [(c, 0, "u", "x") for c in turnless]
    got = nodes(prefixtrie.rebuilt_trie(frame(rows, SCHEMA)))
    assert list(got.values()) == [(None, 3, 0, 1, 0, hashlib.sha256(",".join(map(str, turnless)).encode()).hexdigest())]
    assert prefixtrie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversation(frame):
    rows = [(0, t, "u", "x") for t in range(3000)] + [(1, t, "u", "x") for t in range(2999)]
    got = nodes(prefixtrie.prefix_trie(frame(rows, SCHEMA)))
    assert len(got) == 3001
    assert got[0, 0] == (None, 2, 1, 1, 2999, prefixtrie.NOBODY)
    assert got[0, 2999][1:4] == (2, 1, 1) and got[0, 3000][1:4] == (1, 0, 1)


def test_block_matrix_is_padded_and_ordered():
    rows = prefixtrie.Rows([b"a" * 16, b"a" * 16 + b"c" * 16, b"b" * 16], [[1], [1, 2], [3]], [1, 2, 3], [1, 1, 1], ["", "", ""])
    turns, chars = prefixtrie._turn_matrix(rows)
    assert turns.tolist() == [[0, -1], [0, 2], [1, -1]]
    assert np.array_equal(chars, [[1, 0], [1, 2], [3, 0]])

import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from moodwatch.llm import sharding
from moodwatch.llm.common import running_total

SCHEMA = "doc_id long, text string"


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                used, at = used + 1, 0
            at += s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@given(st.lists(st.integers(1, 50), min_size=1, max_size=80), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_walk(sizes, shards):
    """The walk over stretches brackets the true capacity, and equals it once all are known."""
    ends, at = [], 0
    for s in sizes:
        at += s
        ends.append(at)
    true = least_capacity(sizes, shards)
    for width in (1, 7, 40):
        stretches = {}
        for e in ends:
            a, b = stretches.get(e // width, (e, e))
            stretches[e // width] = (min(a, e), max(b, e))
        known = sharding._Ends(list(stretches.values()))
        low = known.least(1, at, shards, True)
        assert low <= true <= known.least(low, at, shards, False)
        if width == 1:
            assert low == true


def test_shards(frame, prose, monkeypatch):
    monkeypatch.setattr(sharding, "STRETCHES", 16)  # several rounds of refinement
    rng = random.Random(1)
    rows = [(k, prose(rng.randint(1, 120), k)) for k in range(400)]
    rows += [(1000 + k, rows[rng.randint(0, 20)][1]) for k in range(60)]
    out = sharding.shard(frame([(*r, 3) for r in rows], SCHEMA + ", shard int"), shards=9).collect()
    size = {}
    shard_of = {}
    texts = dict(rows)
    for r in out:
        assert r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        assert shard_of.setdefault(texts[r.doc_id], r.shard) == r.shard
        size[r.shard] = size.get(r.shard, 0) + r.size
    groups = {}
    for d, t in sorted(rows):
        groups.setdefault(t, [d, 0])[1] += len(t.encode()) + 16
    assert max(size.values()) == least_capacity([b for _, b in sorted(groups.values())], 9)
    for s in size:
        mine = sorted((r.slot, r.doc_id) for r in out if r.shard == s)
        assert [a for a, _ in mine] == list(range(len(mine))) and [d for _, d in mine] == sorted(d for _, d in mine)


def test_group_larger_than_a_share(frame, prose):
    rows = [(k, "copy " * 30) for k in range(300)] + [(1000 + k, prose(20, k)) for k in range(100)]
    out = sharding.shard(frame(rows, SCHEMA), shards=10).collect()
    size = {}
    for r in out:
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert len(size) == 10
    rest = sorted(size.values())[:-1]
    assert max(rest) <= 1.4 * min(rest)


def test_edges(frame):
    rows = [(1, None), (2, ""), (3, None), (None, "x"), (4, "x"), (4, "x"), (5, "y" * 100_000)]
    out = sharding.shard(frame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    assert sorted((r.size, r.text_crc32) for r in out if r.doc_id in (1, 2, 3)) == [(16, 0)] * 3
    assert len({r.shard for r in out if r.size == 17}) == 1
    assert sharding.shard(frame([], SCHEMA)).collect() == []


def test_running_total(frame):
    rng = random.Random(1)
    rows = [(rng.randint(0, 10**6), k, rng.randint(0, 9)) for k in range(500)]
    out = running_total(frame(rows, "a long, b long, v long"), ["a", "b"], "v", "before").collect()
    at = 0
    for r in sorted(out, key=lambda r: (r.a, r.b)):
        assert r.before == at
        at += r.v

import random

import numpy as np
import pytest

from moodwatch.llm import neardup
from moodwatch.llm.common import components

SCHEMA = "doc_id long, text string"


def sets_of(text):
    words = neardup.WORDS.findall((text or "").translate(neardup.LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """component of each (id, set), by all pairs."""
    nodes = {(d, sets_of(t)) for d, t in rows if d is not None}
    parent = {s: s for _, s in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    all_sets = [s for s in parent if s]
    for i, a in enumerate(all_sets):
        for b in all_sets[:i]:
            if 100 * len(a & b) >= 85 * len(a | b):
                parent[root(a)] = root(b)
    least = {}
    for d, s in nodes:
        key = root(s) if s else (d,)
        least[key] = min(d, least.get(key, d))
    return {(d, s): least[root(s) if s else (d,)] for d, s in nodes}


def changed(text, n, rng):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randint(0, 10**9)}"
    return " ".join(words)


def verify(rows, out):
    true = brute(rows)
    assert len(out) == len(rows)
    expected = sorted((d, len(sets_of(t)), true[d, sets_of(t)]) for d, t in rows if d is not None)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in out if r.doc_id is not None)


def test_against_all_pairs(frame, prose):
    rng = random.Random(2)
    rows = [(k, prose(rng.choice([3, 6, 9, 20, 60, 200, 700]), k)) for k in range(120)]
    for k in range(120):
        n = len(rows[k][1].split())
        rows += [(1000 + 10 * k + j, changed(rows[k][1], max(1, int(n * f)), rng)) for j, f in enumerate((0.0, 0.015, 0.03, 0.06))]
    rows += [(9000 + k, rows[5 * k][1].upper()) for k in range(10)]
    out = neardup.near_duplicates(frame(rows, SCHEMA)).collect()
    verify(rows, out)


def test_hot_group(frame, prose, monkeypatch):
    """A large group of near copies, over several blocks of a bucket."""
    monkeypatch.setattr(neardup, "BLOCK", 32)
    rng = random.Random(4)
    base = prose(150, 1)
    rows = [(k, changed(base, rng.randint(0, 6), rng)) for k in range(300)] + [(1000 + k, prose(100, k)) for k in range(50)]
    verify(rows, neardup.near_duplicates(frame(rows, SCHEMA)).collect())


def test_edges(frame, prose):
    text = prose(40, 1)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (None, text), (7, text), (8, text),
            (8, text), (9, "É a b c d e"), (10, "é a b c d e"), (11, "w " * 50_000), (12, text + " x y z"), (12, "something else")]
    out = neardup.near_duplicates(frame([(*r, "c") for r in rows], SCHEMA + ", node string")).collect()
    verify(rows, out)
    assert [(r.component_id, r.kept, r.n_shingles) for r in out if r.doc_id is None] == [(None, True, 36)]
    assert neardup.near_duplicates(frame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [6, 40, 300, 3000])
def test_estimate(n):
    rng = np.random.default_rng(n)
    for share in (0.5, 0.85, 0.95):
        errors = []
        for _ in range(30):
            a = rng.integers(0, 2**63, n, np.uint64) * np.uint64(2)
            b = a.copy()
            k = int(n * (1 - share) / (1 + share))
            b[:k] = rng.integers(0, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1)
            a, b = np.unique(a), np.unique(b)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(float(neardup.similarity(neardup.narrow_registers(a)[None], neardup.narrow_registers(b)[None])[0, 0]) - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < (0.025 if share < 0.85 else 0.017)


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(150)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_similarity_is_a_parameter(frame, prose):
    """Pairs of sets that share 80 to 85 percent, the smallest ones too; op7's own similarity leaves them."""
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k, n in enumerate([4, 5, 9, 20, 41, 82, 200]):  # shingles; the second text has a fifth to a quarter less or more
        text = [f"{w}x{k}" for w in words[:n + 4]]
        rows += [(10 * k, " ".join(text)), (10 * k + 1, " ".join(text + [f"end{j}x{k}" for j in range(max(1, n * 24 // 100))]))]
    linked = {d for d, _ in rows if d % 10}
    for a, b in zip(rows[::2], rows[1::2], strict=True):
        x, y = sets_of(a[1]), sets_of(b[1])
        assert 80 * len(x | y) <= 100 * len(x & y) < 85 * len(x | y)
    df = frame(rows, SCHEMA)
    assert {r.doc_id for r in neardup.near_duplicates(df, similarity=80).collect() if not r.kept} == linked
    assert all(r.kept for r in neardup.near_duplicates(df).collect())

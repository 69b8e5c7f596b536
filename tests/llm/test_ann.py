import math

import numpy as np

from moodwatch.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_quantile():
    x = ann.chi_square_quantile(0.95, 8)
    assert abs(x - 15.507) < 1e-2


def brute(rows, query, k=10):
    own = np.array(query[1])
    found = sorted((math.sqrt(((np.array(v) - own) ** 2).sum()), i) for i, v in rows if i != query[0])
    return found[:k]


def test_recall_and_ties(frame):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 24))
    rows = [(i, (centres[i % 20] + 0.3 * rng.normal(size=24)).astype(np.float32).astype(float).tolist()) for i in range(1500)]
    rows += [(i, rows[0][1]) for i in range(2000, 2600)]  # one vector that many rows share
    df = frame([(i, v, 0) for i, v in rows], SCHEMA)
    out = ann.nearest(df, df.where("vec_id % 100 = 0")).collect()
    queries = [r for r in rows if r[0] % 100 == 0]
    assert len(out) == 10 * len(queries)
    hit = 0
    for q in queries:
        mine = sorted([r for r in out if r.query_id == q[0]], key=lambda r: r["rank"])
        true = brute(rows, q)
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hit += len({i for _, i in true} & {r.vec_id for r in mine})
        if q[0] >= 2000 or q[0] == 0:  # copies: distance 0, smallest ids first
            assert [(r.vec_id, r.score) for r in mine] == [(i, 0.0) for _, i in true]
    assert hit >= 0.9 * len(out)


def test_edges(frame):
    bad = [(100, None), (200, [0.0, 0.0]), (300, [1.0, None]), (400, [float("nan"), 1.0]), (500, [float("inf"), 1.0]),
           (None, [1.0, 1.0]), (600, [1.0, 2.0, 3.0]), (700, [])]
    good = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])]
    df = frame([(i, v, 1) for i, v in bad + good], SCHEMA).withColumnRenamed("label", "v")
    out = ann.nearest(df, df.where("vec_id % 100 = 0")).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in out] == [(0, 1, 3), (0, 2, 1), (0, 3, 2)]
    empty = frame([], SCHEMA)
    assert ann.nearest(empty, empty).collect() == []
    assert ann.nearest(df, empty).collect() == []


def test_each_length_among_its_own(frame):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4 if i % 3 else 7).tolist()) for i in range(400)]
    df = frame([(i, v, 0) for i, v in rows], SCHEMA)
    out = ann.nearest(df, df.where("vec_id % 50 = 0")).collect()
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]  # as stored, in single precision
    for i, v in (r for r in rows if r[0] % 50 == 0):
        mine = [r.vec_id for r in sorted((r for r in out if r.query_id == i), key=lambda r: r["rank"])]
        true = [j for _, j in brute([r for r in rows if len(r[1]) == len(v)], (i, v))]
        assert len(set(mine) & set(true)) >= 9 and all(j % 3 == 0 for j in mine) == (i % 3 == 0)

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from moodwatch.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            m = 100 - 90 + 90 * sum(bag.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in set(terms(text)) if t in bag)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("block_terms", [5, 1 << 16])
def test_ranking_equals_brute_force(frame, block_terms):
    docs = corpus(300, 1) + [(1000 + i, "w1 w2 W3, w4") for i in range(40)]  # ties
    items = [(i, " ".join(random.Random(i).choices([f"w{k}" for k in range(70)], k=12))) for i in range(25)]
    assert found(lexical.rank_documents(frame(docs, DOCS), frame(items, ITEMS), block_terms)) == brute(docs, items)


def test_more_terms_than_a_mask_word(frame):
    docs = [(i, " ".join(random.Random(i).sample([f"w{k}" for k in range(300)], 150))) for i in range(200)]
    items = [(1, " ".join(f"w{k}" for k in range(200))), (2, "w1 w299")]
    assert found(lexical.rank_documents(frame(docs, DOCS), frame(items, ITEMS))) == brute(docs, items)


def test_nulls_repeats_and_odd_texts(frame):
    docs = [(1, None), (2, ""), (3, "... !"), (4, "Çé naïve_Naïve ÇÉ"), (None, "naïve"), (None, "naïve"), (4, "naïve x"), (5, "x " * 30000),
            (6, "İstanbul 2024 K"), (7, "x\x00y\x1fz q")]
    items = [(1, "NAÏVE naÏve naïve"), (1, "x"), (None, "İSTANBUL k 2024"), (2, None), (3, "?!"), (4, "nothing here"), (5, "z q çé y")]
    got = lexical.rank_documents(frame([(*d, "s") for d in docs], DOCS + ", item_id string"), frame([(*i, 1) for i in items], ITEMS + ", doc_id int"))
    assert found(got) == brute(docs, items)


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], DOCS)
    assert lexical.rank_documents(none, frame([(1, "a")], ITEMS)).count() == 0
    assert lexical.rank_documents(frame([(1, "a")], DOCS), spark.createDataFrame([], ITEMS)).count() == 0
    assert lexical.rank_documents(frame([(1, None)], DOCS), frame([(1, "a")], ITEMS)).count() == 0


def test_masks_leave_documents_unread_and_keep_the_best():
    rng = np.random.default_rng(1)
    count, size = 3000, 40
    has = rng.random((count, size)) < 0.1
    scores = rng.integers(900, 1000, has.shape)
    ends = np.concatenate(([0], has.sum(axis=1).cumsum()))
    block = lexical.Postings(ends, np.nonzero(has)[1], scores[has], size)
    item, best = np.arange(0, 40, 3), lexical.Best()
    evaluated = lexical.search(block, item, list(range(count)), best)
    total = np.where(has, scores, 0)[:, item].sum(axis=1)
    assert [(-s, d) for s, _, d in best.held] == sorted(((int(s), d) for d, s in enumerate(total)), key=lambda x: (-x[0], x[1]))[:10]
    assert evaluated < count / 10

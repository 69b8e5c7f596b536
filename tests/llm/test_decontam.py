import random

from hypothesis import given, settings
from hypothesis import strategies as st

from moodwatch.llm import decontam

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def distance(pattern, text):
    row, best = list(range(len(pattern) + 1)), len(pattern)
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


@given(st.text("ab ", min_size=1, max_size=14), st.text("abc ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_myers(pattern, text):
    assert decontam.myers(pattern, text)[0] == distance(pattern, text)


def edited(text, edits, rng):
    out = list(text)
    for at in rng.sample(range(1, len(out) - 1), edits):
        out[at] = rng.choice("#@") if rng.random() < 0.5 else out[at] + "#"
    return "".join(out)


def test_matches(frame, prose):
    rng = random.Random(3)
    items = [(k, prose(20, k)) for k in range(12)] + [(50, None), (51, "  "), (52, "short one"), (53, prose(20, 0))]
    docs, true = [], set()
    for k in range(12):
        norm = decontam.normalise(items[k][1])
        allowed = decontam.budget(len(norm))
        assert allowed > 3
        for n, edits in enumerate((0, 2, allowed)):
            doc = 100 * k + n
            docs.append((doc, prose(60, 700 + doc) + "\n" + edited(norm, edits, rng).upper() + " " + prose(40, 800 + doc)))
            true.add((doc, k))
            if k == 0:
                true.add((doc, 53))
        docs.append((100 * k + 50, prose(80, 900 + k) + " " + norm[:len(norm) // 2]))
    docs += [(5000, None), (5001, ""), (None, items[3][1]), (5002, "a SHORT\n one"), (0, docs[0][1])]
    found = decontam.matches(frame([(*d, "x") for d in docs], DOCS + ", end string"), frame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == true | {(None, 3), (5002, 52)}
    assert len(found) == len(true) + 4
    assert all(r.distance <= r.budget for r in found)
    kept = decontam.keep_clean(frame(docs, DOCS), frame(items, ITEMS)).collect()
    assert {r.doc_id for r in kept} == {d for d, _ in docs} - {d for d, _ in true} - {None, 5002}


def test_blocks_and_empty(frame, prose, monkeypatch):
    items, docs = [(k, prose(15, k)) for k in range(8)], [(k, prose(15, k)) for k in range(10)]
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    found = decontam.matches(frame(docs, DOCS), frame(items, ITEMS))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(k, k) for k in range(8)}
    assert len(list(decontam.item_blocks(frame(items, ITEMS)))) > 1
    assert decontam.matches(frame(docs, DOCS), frame([], ITEMS)).collect() == []
    assert decontam.matches(frame([], DOCS), frame(items, ITEMS)).collect() == []
    assert decontam.keep_clean(frame(docs, DOCS), frame([], ITEMS)).count() == 10


def test_short_items_match_whole_words_only(frame):
    docs = [(1, "they concatenate"), (2, "a cat sat"), (3, "Cat."), (4, "cats"), (5, "the cat-flap, cat"), (6, "x 42 y"), (7, "x 421 y")]
    got = decontam.matches(frame(docs, "doc_id long, text string"), frame([(1, "cat"), (2, "42")], "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(2, 1), (3, 1), (5, 1), (6, 2)]


def test_all_pairs_against_plain_edit_distance(frame):
    """Every document with every item: an item stands where a stretch of the text is near enough."""
    rng = random.Random(9)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omega".split()
    items = [(k, " ".join(rng.choices(words, k=rng.randint(8, 14)))) for k in range(12)]
    docs = []
    for k in range(40):
        text = list(items[k % 12][1])
        for _ in range(rng.randint(0, 2 * decontam.budget(len(text)) + 1)):
            text[rng.randrange(len(text))] = rng.choice("xyz")
        docs.append((k, " ".join(rng.choices(words, k=10)) + " " + "".join(text) + " " + " ".join(rng.choices(words, k=10))))

    def least(item, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, x in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
            row = new
        return min(row)

    want = {(d, i): least(decontam.normalise(t), decontam.normalise(x)) for d, x in docs for i, t in items}
    want = {k: n for k, n in want.items() if n <= decontam.budget(len(decontam.normalise(items[k[1]][1])))}
    got = decontam.matches(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.distance for r in got.collect()} == want and len(want) > 10

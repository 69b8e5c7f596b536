from moodwatch.llm import substring

SCHEMA = "doc_id long, text string"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_sentences_cover_the_text():
    text = "One two three. Four five!\nSix " + "word, " * 50 + "end? Last"
    cut = substring.sentences(text)
    assert text.replace("\n", " ").split() == " ".join(text[a:b] for a, b, _ in cut).split()
    assert all(n <= substring.PIECE for _, _, n in cut)


def test_passage_goes_from_all_but_the_first(frame, prose):
    passage = prose(60, 1)
    rows = [(1, prose(80, 2) + " " + passage + " " + prose(70, 3)), (2, prose(50, 4) + " " + passage),
            (3, passage + " " + prose(90, 5)), (4, prose(120, 6)), (5, prose(30, 7) + " " + passage + " " + prose(20, 8) + " " + passage)]
    out = by_id(substring.dedup(frame(rows, SCHEMA)))
    assert out[1].text == rows[0][1] and out[4].text == rows[3][1]
    middle = " ".join(passage.split()[15:45])
    for k in (2, 3, 5):
        assert middle in rows[k - 1][1] and middle not in out[k].text
        assert out[k].n_removed > 0 and out[k].first_ids == [1]
    # what isn't covered stays
    assert rows[2][1][len(passage):].split()[20:] == out[3].text.split()[-len(rows[2][1][len(passage):].split()[20:]):]


def test_against_brute_force(frame, prose):
    shared = [prose(40, 100 + k) for k in range(3)]
    rows = [(k, " ".join([prose(30, k), shared[k % 3], prose(25, 50 + k)])) for k in range(20)] + [(30, prose(200, 3)), (31, prose(200, 3))]
    first, gone = {}, {}
    for doc, text in sorted(rows):
        for h, at, n in substring.spans(text):
            if first.setdefault(h, (doc, at)) != (doc, at):
                gone.setdefault(doc, set()).update(range(at, at + n))
    out = by_id(substring.dedup(frame(rows, SCHEMA)))
    assert {d: r.n_removed for d, r in out.items()} == {d: len(gone.get(d, ())) for d, _ in rows}


def test_edges(frame, prose):
    text = prose(100, 1)
    rows = [(1, None), (2, ""), (3, " \n "), (None, text), (None, text), (4, text), (4, text), (5, "x" * 100_000), (6, text)]
    out = substring.dedup(frame([(*r, 7) for r in rows], "doc_id long, text string, at int")).collect()
    assert len(out) == len(rows)
    assert sorted((r.doc_id, r.n_removed > 0) for r in out if r.doc_id is not None) == [
        (1, False), (2, False), (3, False), (4, False), (4, False), (5, False), (6, True)]
    assert [r.text for r in out if r.doc_id is None] == [text, text]
    assert substring.dedup(frame([], SCHEMA)).collect() == []


def test_rows_of_one_id_lose_their_own_repeats(frame, prose):
    p, q = prose(100, 1), prose(100, 2)
    out = substring.dedup(frame([(1, p), (5, p), (5, q), (5, q), (6, q)], SCHEMA)).collect()
    assert sorted((r.doc_id, r.text == q, r.n_removed > 0) for r in out) == [
        (1, False, False), (5, False, True), (5, True, False), (5, True, False), (6, False, True)]


def test_hot_spans_are_joined_where_they_lie(spark, frame, prose):
    passage = prose(60, 1)
    rows = [(k, prose(40, 100 + k) + " " + passage) for k in range(300)]
    out = by_id(substring.dedup(frame(rows, SCHEMA)))
    middle = " ".join(passage.split()[20:40])
    assert [k for k, r in out.items() if middle in r.text] == [0]


def brute_cuts(docs):
    """Sentences covered by a non-first span, from the definition and with its own hashing-free keys."""
    import re
    seen, gone = {}, {}
    for doc, text in sorted(docs):
        cut = substring.sentences(text)
        words = [tuple(re.findall(r"\w+", text[a:b].lower())) for a, b, _ in cut]
        for k in range(len(cut)):
            to = k
            while to < len(cut) and (to - k < substring.SPAN or sum(map(len, words[k:to])) < substring.WORDS):
                to += 1
            key = sum(words[k:to], ())
            if to - k < substring.SPAN or len(key) < substring.WORDS:
                continue
            if seen.setdefault(key, (doc, k)) != (doc, k):
                gone.setdefault(doc, set()).update(range(k, to))
    return {d: len(gone.get(d, ())) for d, _ in docs}


def test_against_spans_by_words(frame, prose):
    shared = [prose(40, 300 + k) for k in range(4)]
    rows = [(k, " ".join([prose(20 + k, k), shared[k % 4], prose(15, 50 + k), shared[(k + 1) % 4]])) for k in range(24)]
    out = by_id(substring.dedup(frame(rows, SCHEMA)))
    assert {d: r.n_removed for d, r in out.items()} == brute_cuts(rows)

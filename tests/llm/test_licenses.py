import re

import pytest

from moodwatch.llm import licenses

SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
MIT = licenses.TEXTS[0][1]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    """(words, places, first, last, labels) straight from the definition."""
    words = WORD.findall(lower(text))
    at = [(i, label) for label, phrase in licenses.PHRASES for p in [phrase.split()]
          for i in range(len(words)) if words[i:i + len(p)] == p]
    start = [i for i, _ in at]
    return (len(words), len(at), min(start, default=None), max(start, default=None), ",".join(sorted({x for _, x in at})))


def scanned(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan(df).collect()),
                  key=str)


def test_base_columns_equal_brute_force(frame, prose):
    texts = ["MIT License", "mit\n\nLICENSE mit license", "MIT-Licenſe", "The MİT License", "general public license general public\tlicense.",
             "general license public license", "mit", "", None, "mit license2 apache license", "kelvin: mit licenKe apache license",
             "Apache License, MIT License; GNU General Public License", prose(300, 1) + " Mit LICENSE. " + prose(50, 2), "éMIT license mit_license"]
    got = scanned(frame([(i, t, 1) for i, t in enumerate(texts)], SCHEMA + ", row int"))
    assert [(r[0], r[1:6]) for r in sorted(got)] == [(i, base(t)) for i, t in enumerate(texts)]
    assert all((r[7] == 1.0) >= (r[2] > 0) for r in got)


@pytest.mark.parametrize("change", ["as it is", "word left out", "words put in", "some other words", "upper case, commas"])
def test_changed_notice_is_found(frame, prose, change):
    w = MIT.split()
    text = {"as it is": w, "word left out": w[:20] + w[21:40] + w[42:], "words put in": w[:15] + ["or", "so"] + w[15:50] + ["x"] + w[50:],
            "some other words": ["thing" if i in (12, 30, 50) else x for i, x in enumerate(w)],
            "upper case, commas": [x.upper() + "," for x in w]}[change]
    at = 37
    doc = " ".join(WORD.findall(prose(at, 3))[:at] + text + [prose(80, 4)])
    (row,) = scanned(frame([(1, doc)], SCHEMA))
    assert row[6] == "mit" and row[2] == 0 and row[7] >= licenses.COVER
    (span,) = licenses.spans(frame([(1, doc)], SCHEMA)).collect()
    assert abs(span.first - at) <= 2 and abs(span.last - (at + len(text) - 1)) <= 2 and not span.phrase


def test_scattered_words_are_no_span(frame, prose):
    w = MIT.split()
    far = " ".join(x + " " + " ".join(prose(30, i).split()) for i, x in enumerate(w))  # no pair stands together
    half = " ".join(w[:20]) + " " + prose(30, 1)
    apart = " ".join(" ".join(w[i:i + 6]) + " " + prose(60, i) for i in range(0, len(w), 6))  # diagonals drift apart
    assert [r[6] for r in scanned(frame([(1, far), (2, half), (3, apart)], SCHEMA))] == ["", "", ""]


def test_copies_long_texts_and_repeats(frame, prose):
    many = " ".join([MIT] * 200)
    rows = [(1, many), (1, many), (None, "apache license"), (None, "apache license"), (2, "free of charge " * 5000)]
    got = scanned(frame(rows, SCHEMA))
    assert [r for r in got if r[0] is None] == [(None, 2, 1, 0, 0, "apache", "apache", 1.0)] * 2
    assert [r[6] for r in got if r[0] == 1] == ["mit", "mit"]
    assert [r[6] for r in got if r[0] == 2] == [""]
    assert licenses.spans(frame(rows[:1], SCHEMA)).count() == 200


def test_empty_table_and_template_limits(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        licenses.template_places(spark, [("x", "one")])
    with pytest.raises(ValueError):
        licenses.template_places(spark, [("x", " ".join(f"w{i}" for i in range(300)))])


def test_only_templates_are_broadcast(spark, frame):
    plan = licenses.hits(frame([(1, "x")], SCHEMA), licenses.template_places(spark))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan and plan.count("split(") == 1

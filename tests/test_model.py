"""Model invariants (the exact vocabulary-mode check is in the oracle tests)."""

from pyspark.sql import functions as F

from moodwatch.operators import model
from moodwatch.session import fresh_dir
from moodwatch.sources import fixtures as fx


def test_train_save_load_score(spark, sf_small):
    lab = fx.labelled(spark, sf_small)
    m = model.train(lab)
    docs = fx.table(spark, sf_small, "documents").select("doc_id", "text")
    s1 = model.neutral_band(model.score(m, docs))
    rows = s1.collect()
    assert len(rows) == docs.count()
    assert all(abs(r.p0 + r.p1 - 1.0) < 1e-9 for r in rows)
    assert {r.label for r in rows} <= {0.0, 1.0, 2.0}
    path = fresh_dir(spark, "model")
    m.write().overwrite().save(path)
    s2 = model.score(model.load(path), docs)
    a = {r.doc_id: round(r.p1, 9) for r in model.score(m, docs).collect()}
    b = {r.doc_id: round(r.p1, 9) for r in s2.collect()}
    assert a == b


def test_empty_text_still_scored(spark, sf_small):
    m = model.train(fx.labelled(spark, sf_small))
    df = spark.createDataFrame([(1, "的了过"), (2, "")], "doc_id int, text string")
    out = model.score(m, df).collect()
    assert len(out) == 2 and all(r.prediction in (0.0, 1.0) for r in out)


def test_hashing_scores_equal_brute_force(spark, sf_small):
    """sentiment_score has no SQL twin: recompute tf-idf and the Naive Bayes
    posterior in numpy from the fitted parameters and compare."""
    import numpy as np
    from pyspark.ml.feature import HashingTF

    from moodwatch.operators import text as T
    m = model.train(fx.labelled(spark, sf_small))
    tok, tf, idf, nb = m.stages
    docs = fx.table(spark, sf_small, "documents").select("doc_id", "text").orderBy("doc_id").limit(40)
    got = {r.doc_id: (r.prediction, r.p0, r.p1) for r in model.score(m, docs).collect()}
    rows = T.join_tokens(T.segment(docs), "tokens", "t").select("doc_id", "t").collect()
    hashing = HashingTF(numFeatures=tf.getNumFeatures())
    idf_v = idf.idf.toArray()
    theta, pi = nb.theta.toArray(), nb.pi.toArray()
    # hash indices of all distinct terms in one job (the hash HashingTF.indexOf uses)
    docs_terms = {r.doc_id: (r.t.lower().split(" ") if r.t else [""]) for r in rows}
    distinct = sorted({t for ts in docs_terms.values() for t in ts})
    one_hot = hashing.setInputCol("f").setOutputCol("v").transform(
        spark.createDataFrame([([t],) for t in distinct], "f array<string>"))
    index = {row.f[0]: int(row.v.indices[0]) for row in one_hot.collect()}
    for r in rows:
        counts: dict[int, float] = {}
        for term in docs_terms[r.doc_id]:
            i = index[term]
            counts[i] = counts.get(i, 0.0) + 1.0
        idx = np.array(sorted(counts))
        x = np.array([counts[i] for i in idx]) * idf_v[idx]
        raw = pi + theta[:, idx] @ x
        p = np.exp(raw - raw.max())
        p /= p.sum()
        pred, p0, p1 = got[r.doc_id]
        assert pred == float(np.argmax(raw))
        assert abs(p0 - p[0]) < 1e-9 and abs(p1 - p[1]) < 1e-9


def test_frequent_terms_are_told_apart_once_a_fit(spark, monkeypatch):
    """A score neither sorts nor anti-joins the terms, and the cut makes no difference."""
    from moodwatch.operators import bayes
    rows = [(i, " ".join(f"w{j}" for j in range(i % 9 + 1)), float(i % 2)) for i in range(40)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, label double")

    def scored():
        fitted = bayes.fit(labelled)
        s = bayes.score(fitted, labelled, "doc_id")
        plan = s._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan and "Sort" not in plan and "Limit" not in plan
        assert fitted.terms.where(fitted.frequent()).count() == min(bayes.FREQUENT, 9)
        return {r.doc_id: (r.prediction, round(r.p0, 9)) for r in s.collect()}

    every = scored()
    monkeypatch.setattr(bayes, "FREQUENT", 3)
    assert scored() == every
    empty = bayes.fit(labelled.limit(0))
    assert bayes.score(empty, labelled, "doc_id").count() == 40

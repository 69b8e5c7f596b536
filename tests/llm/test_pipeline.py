from moodwatch.llm import pipeline as corpus_pipeline
from moodwatch.llm import packing, queries
from moodwatch.llm.common import stored
from moodwatch.llm.tokens import Encoder, tokenizer_path
from moodwatch.session import fresh_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, docs, items):
    folder = fresh_dir(spark, "tables")
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def tables(prose):
    items = [(1, prose(30, 9001)), (2, prose(25, 9002))]
    docs = []
    for k in range(60):
        parts = [prose(20, 3 * k), prose(25, 3 * k + 1)]
        if k % 3 == 0:
            parts.insert(k % 2, "All rights reserved by the Example Foundation")
        if k in (7, 8):
            parts.append(items[k - 7][1])
        docs.append((k, "\n".join(parts), "en", "s"))
    docs += [(100, docs[4][1], "en", "s"), (101, docs[5][1].replace("a", "a", 1) + " end", "en", "s"), (102, "!!! 123", "en", "s"), (103, None, None, None)]
    return [(*d, len(d[1] or "")) for d in docs], items


def test_stages_against_plain_python(spark, prose):
    docs, items = tables(prose)
    folder = write(spark, docs, items)
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = now.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, folder), name)
        assert now.columns == columns
        seen[name] = {r.doc_id: r for r in now.collect()}
    assert set(seen["language_id"]) == set(range(60)) | {100, 101}
    for d, t, *_ in docs[:62]:
        want = "\n".join(x for x in t.split("\n") if "rights reserved" not in x)
        assert seen["line_dedup"][d].text == want and seen["line_dedup"][d].n_chars == len(want)
    assert set(seen["minhash_near_dedup"]) == set(range(60))
    assert set(seen["benchmark_decontamination"]) == set(range(60)) - {7, 8}

    packed = corpus_pipeline.run(spark, folder).collect()
    tokens = Encoder(tokenizer_path(packing.TOKENIZER), spaces=False).tokenizer
    lengths = {d: len(tokens.encode(r.text, add_special_tokens=False).ids) + 1 for d, r in seen["benchmark_decontamination"].items()}
    assert {r.doc_id: r.length for r in packed} == lengths
    assert len({r.sequence_id for r in packed}) == -(-sum(lengths.values()) // packing.CAPACITY)


def test_empty(spark):
    folder = write(spark, [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_nulls_and_extra_columns(spark, prose):
    docs, items = tables(prose)
    folder = write(spark, docs, items)
    extra = "kept boolean, band string, text_crc32 int"
    df = spark.createDataFrame([(*d, None, "b", k) for k, d in enumerate([*docs, (None, prose(30, 5), "en", "s", 1), (None, prose(30, 5), "en", "s", 1)])],
                               SCHEMA + ", " + extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stored(stage(spark, df, folder), "x")
    rows = df.collect()
    assert len([r for r in rows if r.doc_id is None]) == 2 and all(r.band == "b" for r in rows)


def test_registered():
    names = queries.queries()
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert set(queries.oracle_sql()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language_id" and len(corpus_pipeline.STAGES) == 5



def test_near_copies_from_80_percent(spark, prose):
    text = " ".join(f"word{k}" for k in range(104))
    near = text + " " + " ".join(f"end{k}" for k in range(22))  # 100 of 122 shingles
    df = spark.createDataFrame([(1, text, "en", "s", 1), (2, near, "en", "s", 1), (3, prose(40, 1), "en", "s", 1)], SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == {1, 3}


def test_near_dedup_decides_by_row(spark, prose):
    copied, unique, twice = prose(40, 11), prose(40, 12), prose(40, 13)
    rows = [(1, copied), (2, copied), (2, unique), (3, twice), (3, twice), (4, prose(40, 14)), (4, prose(40, 15)),
            (5, prose(40, 16)), (5, prose(40, 16) + " end"), (None, copied), (None, copied), (6, None), (7, ""), (8, "")]
    df = spark.createDataFrame([(d, t, "en", "s", k) for k, (d, t) in enumerate(rows)], SCHEMA).repartition(3)
    left = corpus_pipeline.near_dedup(spark, df, "").collect()
    out = sorted((r.doc_id or 0, r.text or "") for r in left)
    assert len([o for o in out if o[0] == 5]) == 1
    assert [o for o in out if o[0] != 5] == sorted([(1, copied), (2, unique), (3, twice), (4, rows[5][1]), (4, rows[6][1]),
                                                   (0, copied), (0, copied), (6, ""), (7, ""), (8, "")])

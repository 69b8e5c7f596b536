import random
import zlib

import numpy as np
import pyarrow as pa

from moodwatch.llm import tokenfile, tokens
from moodwatch.session import fresh_dir

SCHEMA = "doc_id long, text string"


def plain(text, name=tokenfile.TOKENIZER):
    t = tokens.Encoder(tokens.tokenizer_path(name), True).tokenizer
    return t.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "a  b   c", "tab\t\ttab \n\n x", "x \n\ny", "y\x1c!z", " lead", "trail \n", "ΑΣ ΑΣ.", "don't I'll",
       "<|endoftext|> a", "12 34,5", " wide", "é ́", "日本語 テキスト", "🙂 ok🙂"]


def test_units_are_the_whole_texts_ids():
    rng = random.Random(4)
    alphabet = "ab C\t\n.,'’é日🙂ß İ1²<>|�ﬁ́‍\xa0\x1cΣ\r"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(500)] + [None, "x" * 5000, "a b " * 3000]
    for name, spaces in ((tokenfile.TOKENIZER, True), ("word_bpe_49k.json", False)):
        encoder = tokens.Encoder(tokens.tokenizer_path(name), spaces)
        want = [plain(text, name) for text in texts]
        for _ in range(2):  # the second time from the cache
            assert [np.frombuffer(got, "<u4").tolist() for got in encoder.encode(texts)] == want


def test_columns_in_chunks(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 50)
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 5)
    encoder = tokens.Encoder(tokens.tokenizer_path(tokenfile.TOKENIZER), spaces=True)
    texts = pa.array(["skipped", *ODD, None, "word " * 100, "", "last"]).slice(1)
    ids, at = encoder.column(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [plain(t) for t in texts.to_pylist()]
    assert encoder.column(pa.array([], pa.string()))[1].tolist() == [0]


def test_new_units_are_encoded_without_separators_and_once(monkeypatch):
    encoder = tokens.Encoder(tokens.tokenizer_path(tokenfile.TOKENIZER), spaces=True)
    asked = []
    one_call = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda text: asked.append(text) or one_call(text))
    rng = random.Random(6)
    words = ["".join(rng.choices("aeoéßñrst", k=rng.randint(2, 12))) for _ in range(5000)]
    text = "Start " + " ".join(words)
    for _ in range(2):
        ids = np.frombuffer(encoder.encode([text])[0], "<u4")
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    # the first word stands alone, the others are one text for each TOGETHER of them, and none is asked for again
    assert sum(map(len, asked)) <= len(text) and len(asked) <= 2 + len(words) // tokens.TOGETHER
    assert not any(tokens.SEPARATOR in a for a in asked)
    # lengths that don't tell where units end: separators do
    other = tokens.Encoder(tokens.tokenizer_path(tokenfile.TOKENIZER), spaces=True)
    other.lengths = encoder.lengths + 1
    assert other.encode([text]) == encoder.encode([text])


def test_a_full_cache_lets_go_of_rare_units(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 100)
    encoder = tokens.Encoder(tokens.tokenizer_path(tokenfile.TOKENIZER), spaces=True)
    for k in range(20):
        text = "the same words " + " ".join(f"w{k}x{n}" for n in range(30)) + " " + "long" * 100
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text).ids
        assert len(encoder.known) <= 100 + 35 and len(encoder.flat) == encoder.sizes.sum()
    kept = encoder.known.to_pylist()
    assert {"the", " same", " words"} <= set(kept) and max(map(len, kept)) <= tokens.CACHE_BYTES


def test_round_trip(spark, frame, prose):
    rows = [(7 * k % 200, prose(10 + k, k)) for k in range(200)] + [(900, None), (901, ""), (None, "no id"), (902, "word " * 30_000)]
    rows += [(1000 + k, t) for k, t in enumerate(ODD)]
    out = tokenfile.token_file_digest(frame([(*r, 5) for r in rows], SCHEMA + ", slice int")).collect()
    at = 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*plain(text), 2]
        mine = [r for r in out if r.doc_id == doc]
        assert [(r.start, r.n_tokens, r.ids_crc32) for r in mine] == [(at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]
        at += len(ids)
    assert len(out) == len(rows)


def test_repeated_ids_and_empty(frame):
    out = tokenfile.token_file_digest(frame([(1, "a b"), (1, "a b"), (1, "c"), (2, "d")], SCHEMA)).collect()
    spans = sorted((r.start, r.n_tokens) for r in out)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert tokenfile.token_file_digest(frame([], SCHEMA)).collect() == []


def test_pruned_read(spark, frame, prose):
    target = tokenfile.write_tokens(frame([(k, prose(20, k)) for k in range(300)], SCHEMA), fresh_dir(spark, "tokens"))
    some = tokenfile.read_tokens(spark, target, [5, 250, 999])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "doc_id" in plan.split("PushedFilters")[1]
    assert {r.doc_id: r.ids[:-1] for r in some.collect()} == {k: plain(prose(20, k)) for k in (5, 250)}


def test_a_worker_keeps_one_object_a_name():
    from moodwatch.llm import common
    path = tokens.tokenizer_path(tokenfile.TOKENIZER)
    one = tokens.encoder(path, True)
    assert tokens.encoder(path, True) is one and tokens.encoder(path, False) is not one
    common.release("tokens")
    assert common._kept.keys() == {"tokens"}
    common.release()
    assert not common._kept


def test_other_work_lets_go_of_what_a_worker_kept(spark, frame):
    from moodwatch.llm import common

    def make():
        def work(batch):
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(common._kept)] * batch.num_rows, pa.int64())], ["doc_id", "n"])

        return work

    docs = frame([(k, "some words") for k in range(8)], SCHEMA).coalesce(1)
    tokenfile.encode(docs, tokens.tokenizer_path(tokenfile.TOKENIZER)).collect()
    assert all(r.n == 0 for r in common.arrow_pass(docs, ["doc_id"], "doc_id long, n long", make).collect())

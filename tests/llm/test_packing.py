import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodwatch.llm import packing
from moodwatch.llm.tokens import Encoder, tokenizer_path

SCHEMA = "doc_id long, text string"


def one_by_one(lengths, capacity):
    """The same rule, bin by bin."""
    left = sorted(lengths)
    bins = []
    while left:
        mine, gap = [], capacity
        while True:
            fit = [n for n in left if n <= gap]
            if not fit:
                break
            mine.append(fit[-1])
            left.remove(fit[-1])
            gap -= fit[-1]
        if gap and len(mine) > 1:
            small = min(mine)
            best = max(((a + b, i) for i, a in enumerate(left) for b in left[i + 1:] if a + b <= gap + small), default=(0, 0))
            if best[0] > small:
                pair = next((a, b) for i, a in enumerate(left) for b in left[i + 1:] if a + b == best[0])
                mine.remove(small)
                left.append(small)
                for n in pair:
                    left.remove(n)
                    mine.append(n)
                left.sort()
        bins.append(sorted(mine))
    return bins


@given(st.lists(st.integers(1, 20), max_size=60))
@settings(max_examples=150, deadline=None)
def test_best_two_fit(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=21)[:21]
    packed = packing.best_two_fit(counts)
    flat = [[n for n, k in content for _ in range(k)] for times, content in packed for _ in range(times)]
    assert sorted(n for b in flat for n in b) == sorted(lengths)
    assert all(sum(b) <= 20 for b in flat)
    assert len(flat) <= len(one_by_one(lengths, 20)) + 1


def check(rows, out, capacity):
    seen = {}
    for r in out:
        seen.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seen.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seen)


def test_pack_documents(frame, prose):
    tokens = Encoder(tokenizer_path(packing.TOKENIZER), spaces=False)
    rows = [(k, prose(5 + 13 * k % 90, k)) for k in range(120)] + [(200, None), (201, ""), (None, "a b"), (202, prose(3000, 1)),
                                                                 (1, prose(18, 1)), (203, "tab\tx y  Σίσυφος <|endoftext|> z")]
    out = packing.pack_documents(frame([(*r, 1) for r in rows], SCHEMA + ", length int"), capacity=256).collect()
    used = check(rows, out, 256)
    assert used <= -(-sum(r.length for r in out) // 256) + 1
    for doc, text in rows:
        if doc in (None, 1):
            continue
        ids = np.array([*tokens.tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id == doc)
        assert mine == [(k, a, len(ids[a:a + 256]), zlib.crc32(ids[a:a + 256].tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
    assert sum(r.doc_id is None for r in out) == 1
    assert packing.pack_documents(frame([], SCHEMA)).collect() == []


def test_hot_length_and_sequences(frame):
    rows = [(k, "same text here") for k in range(500)]
    path = tokenizer_path(packing.TOKENIZER)
    pieces = packing.stored(packing.pieces(frame(rows, SCHEMA), path, 16, with_ids=True), "p")
    packed = packing.pack(pieces, 16).cache()
    assert check(rows, packed.collect(), 16) == 125
    whole = packing.sequences(packed).collect()
    assert all(len(r.ids) == 16 and r.ids[3] == 1 for r in whole) and sum(len(r.doc_ids) for r in whole) == 500


def test_too_long(frame):
    with pytest.raises(ValueError):
        packing.pack(frame([(1, 0, 17)], "doc_id long, piece int, length long"), 16)

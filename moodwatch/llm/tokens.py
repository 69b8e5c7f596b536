"""Token ids by a public tokenizer, with a cache of the ids of words.

A text is cut after every run of non-space characters, and between an ASCII letter and a
sign such as a full stop.  Both vocabularies cut there too (no token of theirs holds a space
after a letter or sign, or a sign after a letter), so the ids of a text are the ids of its
units, one after the other.  Texts with rarer white space, with a
character whose lower case depends on its neighbours, or with a special token are
one unit.

The cuts are found in the bytes of a whole column and equal units by Arrow, also those that are
known from earlier columns; only new ones are encoded, many at a time, and the ids are gathered
with numpy.
"""

from __future__ import annotations

import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from moodwatch.llm.common import kept

#: white space other than blank, tab, line feed and carriage return; final sigma; special tokens
WHOLE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u3000\ufeff\u03a3]|<\\|")
#: bytes without which WHOLE finds nothing: controls, the sign of special tokens, and the first bytes of the
#: other characters in it
HINT = np.zeros(256, bool)
HINT[[0x0B, 0x0C, *range(0x1C, 0x20), ord("<"), 0xC2, 0xCE, 0xE1, 0xE2, 0xE3, 0xEF]] = True
#: kinds of bytes: a unit ends before a blank that stands behind anything else, and before a sign behind an
#: ASCII letter; the apostrophe of ``don't`` is no sign
BLANK, LETTER, SIGN = 1, 2, 4
KIND = np.zeros(256, np.uint8)
KIND[[9, 10, 13, 32]] = BLANK
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND[[ord(c) for c in ".,;:!?"]] = SIGN
ENDS = np.zeros(64, bool)
ENDS[[8 * BLANK + 0, 8 * BLANK + LETTER, 8 * BLANK + SIGN, 8 * SIGN + LETTER]] = True
#: units a worker keeps (about 50 bytes each): the less used half goes when there are more.  Longer units aren't kept
CACHE_ENTRIES, CACHE_BYTES = 400_000, 256
#: a special token of both vocabularies; no unit but a whole text holds it, and a text is cut there before anything else
SEPARATOR = "<|endoftext|>"
#: new units encoded as one text, and bytes of a column that are worked on at once (or one text)
TOGETHER, CHUNK = 1024, 4 << 20

def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts of a column begin (and the last one ends), and the bytes that this counts in."""
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return at, np.frombuffer(texts.buffers()[2] or b"", np.uint8)


def _gather(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` from ``first``, one after the other, and where each begins (and the last one ends)."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    kind = np.int32 if max(total[-1], len(flat)) < 1 << 31 else np.int64
    places = np.repeat((first - total[:-1]).astype(kind), sizes)
    places += np.arange(total[-1], dtype=kind)
    return flat[places], total


class Encoder:
    """Texts to token ids, unsigned 32-bit numbers.  ``spaces``: blanks are part of tokens (byte-level),
    else they only separate words."""

    def __init__(self, path: str, spaces: bool):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.spaces = spaces
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        #: the units kept, in how many chunks each was of late, where its ids begin in ``flat`` and how many they are
        self.known = pa.array([], pa.large_string())
        self.used = self.first = self.sizes = np.empty(0, np.int64)
        self.flat = np.empty(0, "<u4")

    @cached_property
    def lengths(self) -> np.ndarray:
        """The bytes of each token where blanks are part of tokens: a sign of such a vocabulary stands for a byte."""
        vocabulary = self.tokenizer.get_vocab()
        out = np.zeros(max(vocabulary.values()) + 1, np.int64)
        out[list(vocabulary.values())] = [len(token) for token in vocabulary]
        return out

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _apart(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, and how many each has: one text with separators between them."""
        ids = self._ids(SEPARATOR.join(units))
        own = ids != self.separator
        return ids[own], np.diff(np.append(np.flatnonzero(~own), len(ids)), prepend=-1) - 1

    def _joined(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for units from a blank to another sign: their text without separators is cut between them
        as any text is, and the bytes of its tokens tell where."""
        at, data = _buffers(units)
        ids = self._ids(data[at[0]:at[-1]].tobytes().decode())
        ends = np.cumsum(self.lengths[ids])
        last = np.searchsorted(ends, at[1:] - at[0])
        if not len(ends) or ends[-1] != at[-1] - at[0] or (ends[last] != at[1:] - at[0]).any():
            return self._apart(units.to_pylist())
        return ids, np.diff(last, prepend=-1)

    def _encode_units(self, units: pa.Array, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different units, in any order, where each one's begin and how many they are; many units
        are one call.  ``whole``: which of them are whole texts."""
        at, data = _buffers(units)
        plain = np.zeros(len(units), bool)
        if self.spaces:
            full = np.flatnonzero((np.diff(at) > 0) & ~whole)
            plain[full] = (KIND[data[at[full]]] == BLANK) & (KIND[data[at[full + 1] - 1]] != BLANK)
        flat, sizes, order = [np.empty(0, "<u4")], [np.empty(0, np.int64)], []
        for chosen, many in ((plain, TOGETHER), (~plain & ~whole, TOGETHER), (whole, 1)):
            places = np.flatnonzero(chosen)
            some = units.take(pa.array(places))
            order.append(places)
            for k in range(0, len(some), many):
                part = some.slice(k, many)
                if chosen is plain:
                    ids, n = self._joined(part)
                elif chosen is whole:
                    ids = self._ids(part[0].as_py())
                    n = np.array([len(ids)])
                else:
                    ids, n = self._apart(part.to_pylist())
                flat.append(ids)
                sizes.append(n)
        places, n = np.concatenate(order), np.concatenate(sizes)
        first, sizes = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        first[places], sizes[places] = np.cumsum(n) - n, n
        return np.concatenate(flat), first, sizes

    def _look_up(self, units: pa.Array, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where those of each unit begin and how many they are.  ``whole``: the places of whole texts."""
        if not (self.spaces or len(whole)):  # whole texts may begin with white space of other kinds
            units = pc.ascii_ltrim_whitespace(units)
        if len(self.known) > CACHE_ENTRIES:
            self._keep(np.sort(np.argsort(self.used, kind="stable")[-(CACHE_ENTRIES // 2):]))
            self.used //= 2
        n = len(self.known)
        # the known ones are different and come first, so that their codes are their places
        both = pa.concat_arrays([self.known, units]).dictionary_encode()
        codes = both.indices.to_numpy()[n:]
        new = both.dictionary.slice(n)
        odd = np.zeros(len(new), bool)
        odd[codes[whole][codes[whole] >= n] - n] = True
        ids, first, sizes = self._encode_units(new, odd)
        self.known, self.used = both.dictionary, np.append(self.used, np.zeros(len(new), np.int64))
        self.used[codes] += 1
        self.first, self.sizes = np.append(self.first, first + len(self.flat)), np.append(self.sizes, sizes)
        self.flat = np.append(self.flat, ids)
        out = self.flat, self.first[codes], self.sizes[codes]
        long = pc.binary_length(new).to_numpy() > CACHE_BYTES
        if long.any():
            self._keep(np.append(np.arange(n), n + np.flatnonzero(~long)))
        return out

    def _keep(self, places: np.ndarray) -> None:
        """Forget the units that aren't at ``places``."""
        self.flat, _ = _gather(self.flat, self.first[places], self.sizes[places])
        self.known, self.used, self.sizes = self.known.take(pa.array(places)), self.used[places], self.sizes[places]
        self.first = np.cumsum(self.sizes) - self.sizes

    def _chunk(self, data: np.ndarray, at: np.ndarray, odd: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts that begin and end at ``at`` in ``data``, and where each one's begin."""
        kind = KIND[data]
        # BLANK after any other kind, SIGN after LETTER
        ends = 8 * kind[1:] + kind[:-1]
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = ENDS[ends]
        for k in odd:
            begins[at[k]:at[k + 1]] = False
        begins[at] = True
        starts = np.flatnonzero(begins[:-1])
        offsets = np.append(starts, len(data))
        units = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        codes = units.indices.to_numpy()
        whole = np.unique(codes[np.searchsorted(starts, at[odd])])
        flat, first, sizes = self._look_up(units.dictionary, whole)
        ids, total = _gather(flat, first[codes], sizes[codes])
        return ids, total[np.searchsorted(starts, at)]

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column of texts, one after the other, and where each text's begin (and the
        last one's end).  A null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        at, data = _buffers(texts)
        hints = np.flatnonzero(HINT[data[at[0]:at[-1]]]) + at[0]
        rows = np.unique(np.searchsorted(at, hints, "right") - 1).tolist()  # empty texts end where they begin
        odd = [k for k in rows if WHOLE.search(texts[k].as_py())]
        out, starts, base, k = [], [np.zeros(1, np.int64)], 0, 0
        while k < len(texts):
            to = max(k + 1, int(np.searchsorted(at, at[k] + CHUNK, "right")) - 1)
            ids, own = self._chunk(np.ascontiguousarray(data[at[k]:at[to]]), at[k:to + 1] - at[k], [o - k for o in odd if k <= o < to])
            out.append(ids)
            starts.append(own[1:] + base)
            base, k = base + len(ids), to
        return np.concatenate(out) if out else np.empty(0, "<u4"), np.concatenate(starts)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian bytes."""
        ids, at = self.column(pa.array(texts, pa.large_string()))
        flat, at = ids.tobytes(), (4 * at).tolist()
        return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def encoder(path: str, spaces: bool) -> Encoder:
    """The worker's encoder for a vocabulary file, :func:`kept` as ``tokens``."""
    return kept("tokens", (path, spaces), lambda: Encoder(path, spaces))

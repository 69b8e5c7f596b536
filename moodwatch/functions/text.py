"""Text expressions: tag stripping, URL encoding, normalisation, segmentation.

Everything here is a Catalyst expression so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwatch.functions.constants import EXTENSION_WORDS, STOP_WORDS, TAG_PATTERN

# HTML tag as the crawler strips it.  ``(?U)`` makes ``\w`` Unicode-aware in
# Java, as it is in Python's ``re``.
TAG_REGEX = "(?U)" + TAG_PATTERN

# Letters and digits that are not Han characters: one class, possessive, so the
# matcher neither recurses nor backtracks over a run of any length.  No Han character
# is below U+2E80: the range is asked first, as a character's script is looked up in a table.
_RUN_CHAR = r"[A-Za-z0-9[\p{L}\p{N}&&[[\x{0}-\x{2E7F}][^\p{IsHan}]]]]"
_RUN = f"{_RUN_CHAR}++"
_HAN = r"[\x{2E80}-\x{10FFFF}&&\p{IsHan}]"

# Full-width ASCII (U+FF01..U+FF5E) and the ideographic space fold to ASCII,
# built from the code-point rule rather than listed.
_FULL_WIDTH = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_HALF_WIDTH = "".join(chr(0x21 + i) for i in range(94)) + " "
_WIDE_CHAR = r"[\x{FF01}-\x{FF5E}\x{3000}]"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_tags(col: str | Column) -> Column:
    return F.regexp_replace(_c(col), TAG_REGEX, "")


def url_encode_path(col: str | Column) -> Column:
    """Percent-encode like Python's ``urllib.parse.quote`` (safe ``/``).

    ``url_encode`` is form encoding; four substitutions turn it into path style.
    A ``+`` in its output can only come from a space (a literal ``+`` is ``%2B``).
    """
    e = F.url_encode(_c(col))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("%2F"), F.lit("/"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    return F.replace(e, F.lit("*"), F.lit("%2A"))


def normalize(col: str | Column, lowercase: bool = True) -> Column:
    """Character normalisation done by the segmenter before matching:
    full-width forms to ASCII and upper to lower case.  ``translate`` looks up every
    character, so it reads only texts that hold a full-width one."""
    c = _c(col)
    c = F.when(c.rlike(_WIDE_CHAR), F.translate(c, _FULL_WIDTH, _HALF_WIDTH)).otherwise(c)
    return F.lower(c) if lowercase else c


_FW_TABLE = str.maketrans(_FULL_WIDTH, _HALF_WIDTH)


def normalize_word(word: str, lowercase: bool = True) -> str:
    """:func:`normalize` for a dictionary word on the driver."""
    w = word.translate(_FW_TABLE)
    return w.lower() if lowercase else w


def _ends_in_run(word: str) -> bool:
    ch = word[-1]
    return ch.isalnum() and not ("\u3400" <= ch <= "\u9fff" or "\uf900" <= ch <= "\ufaff")


def segment_pattern(dictionary: Iterable[str] = EXTENSION_WORDS) -> str:
    """One alternation: dictionary words longest first, then runs of non-Han
    letters/digits, then single Han characters.  Regex alternation is
    leftmost-first, so the longest dictionary word at a position wins.  A word
    ending in a Latin letter or digit must also end the run (``of the`` does not
    match the start of ``of them``)."""
    words = sorted({w for w in dictionary if w}, key=lambda w: (-len(w), w))
    alts = [re.escape(w) + (f"(?!{_RUN_CHAR})" if _ends_in_run(w) else "") for w in words]
    return "(" + "|".join(alts + [_RUN, _HAN]) + ")"


def tokens(col: str | Column, dictionary: Iterable[str] = EXTENSION_WORDS,
           stop_words: Sequence[str] = STOP_WORDS, lowercase: bool = True) -> Column:
    """``text -> array<string>`` in text order, duplicates kept, stop words removed.

    ``array_except`` would de-duplicate, so stop words are removed with a
    higher-order ``filter`` instead.
    """
    words = [normalize_word(w, lowercase) for w in dictionary]
    found = F.regexp_extract_all(normalize(col, lowercase), F.lit(segment_pattern(words)), F.lit(1))
    stop = [w.lower() if lowercase else w for w in stop_words]
    if not stop:
        return found
    return F.filter(found, lambda t: ~t.isin(*stop))

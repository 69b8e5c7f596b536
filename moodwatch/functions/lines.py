"""Column expressions for the crawler's pipe-delimited wire records."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodwatch.functions.constants import FIELD_SEPARATOR, NULL_TEXT


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def encode_fields(cols: Sequence[str | Column], sep: str = FIELD_SEPARATOR) -> Column:
    """Join fields with ``sep`` and no escaping, like ``"%s|%s" % (...)``.

    ``concat_ws`` skips nulls, which would shift every later field left, so an
    absent value is written as Python's ``str(None)``.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_TEXT)) for c in cols]
    return F.concat_ws(sep, *parts)


def jvm_split(col: str | Column, sep: str = FIELD_SEPARATOR, regex: bool = False) -> Column:
    """``String.split(regex)`` of the JVM: trailing empty fields are removed.

    Spark's ``split`` keeps them, so the trailing run of separators is cut first
    (a one-character literal separator with ``rtrim``, no regex; otherwise with
    a regex anchored at ``\\z`` -- ``$`` would also match before a final
    newline).  A string made only of separators splits into nothing, an empty
    string into one empty field -- both as on the JVM.  ``sep`` is literal
    unless ``regex``.
    """
    c = _c(col)
    q = sep if regex else re.escape(sep)
    if not regex and len(sep) == 1:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, f"(?:{q})+\\z", "")
    return F.when((stripped == "") & (c != ""), F.array().cast("array<string>")).otherwise(F.split(stripped, q))


def field_count(col: str | Column, sep: str = FIELD_SEPARATOR) -> Column:
    """Number of fields :func:`jvm_split` yields, counted without splitting."""
    if len(sep) != 1:
        return F.size(jvm_split(col, sep))
    c = _c(col)
    stripped = F.rtrim(c, F.lit(sep))
    seps = F.length(stripped) - F.length(F.replace(stripped, F.lit(sep), F.lit("")))
    return (F.when(c == "", F.lit(1))
            .when(stripped == "", F.lit(0))
            .otherwise(seps + F.lit(1)))


def has_arity(col: str | Column, n: int, sep: str = FIELD_SEPARATOR) -> Column:
    """True when the line has exactly ``n`` fields under JVM split rules.

    For a one-character separator and ``n >= 2`` this is one anchored regex:
    ``n - 2`` separated fields, a separator, a non-empty last field, then only
    trailing separators (which the JVM drops).  The line is referenced once, so
    when the optimizer pushes this filter below the projection that builds the
    line, the line expression is inlined once, not once per sub-expression.
    """
    if len(sep) != 1 or n < 2:
        return field_count(col, sep) == F.lit(n)
    q = re.escape(sep)
    field = f"[^{q}]"
    pattern = f"^{field}*(?:{q}{field}*){{{n - 2}}}{q}{field}+(?:{q})*\\z"
    return _c(col).rlike(pattern)

"""Column expressions shared by the operators. All are JVM built-ins (no Python UDFs), so they
stay inside whole-stage code generation."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labormart.schema import ISO_SECONDS

_UPPER = string.ascii_uppercase
_LOWER = string.ascii_lowercase


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_nulls(arr: Column, element_type: str = "string") -> Column:
    """The array without its nulls, order kept. ``array_except`` with a one-null array has
    generated code (``array_compact`` runs as an interpreted lambda filter); it also removes
    duplicates, so use it on arrays whose non-null elements are distinct."""
    return F.array_except(arr, F.array(F.lit(None).cast(element_type)))


def lenient_bigint(c: str | Column, default: int | None = 0) -> Column:
    """Non-strict cast to a 64-bit integer; anything that does not parse becomes ``default``.

    Integer text is taken as is; decimal text and floats are truncated toward zero.
    """
    x = _c(c)
    parsed = F.coalesce(
        x.try_cast("bigint"),
        x.try_cast("double").try_cast("bigint"),
    )
    return parsed if default is None else F.coalesce(parsed, F.lit(default).cast("bigint"))


def ascii_lower(c: str | Column) -> Column:
    """Lower-case A-Z only; every other character (Cyrillic too) is left unchanged."""
    return F.translate(_c(c), _UPPER, _LOWER)


# Simple case folding pairs two more characters with ASCII letters: long s and the Kelvin sign. Dotless
# i and dotted capital I are letters of their own, though the engine's case-insensitive search takes
# them for i; they are moved out of its way, in the text and in the pattern alike.
_ASIDE_FROM = "\u0131\u0130"
_ASIDE_TO = "\ue131\ue130"
_FOLD_FROM = _UPPER + "\u017f\u212a"
_FOLD_TO = _LOWER + "sk"


def regex_ci(text: str | Column, pattern: str) -> Column:
    """Case-insensitive regex search by simple case folding, the keyword used unescaped, as given."""
    moved = pattern.translate(str.maketrans(_ASIDE_FROM, _ASIDE_TO))
    return F.translate(_c(text), _ASIDE_FROM, _ASIDE_TO).rlike("(?iu)" + moved)


def unicode_fold(c: str | Column) -> Column:
    """Text folded so that a literal ASCII substring test equals the :func:`regex_ci` search."""
    return F.translate(_c(c), _FOLD_FROM, _FOLD_TO)


def literal_regex_prefix(pattern: str) -> str | None:
    """The literal a pattern reduces to when it is plain letters/digits/spaces, optionally
    ending in a ``+`` or possessive ``++`` repeat of its last character (``C++``: one or more
    c, i.e. "contains c"); None when the pattern needs the regex engine."""
    import re

    m = re.fullmatch(r"([A-Za-z0-9 ]+?)(\+{1,2})?", pattern)
    return m.group(1) if m else None


def band(c: str | Column, bands: Sequence[tuple[int | None, str]]) -> Column:
    """CASE WHEN over ascending upper bounds; the last band takes the rest."""
    x = _c(c)
    expr = None
    for upper, label in bands:
        if upper is None:
            return expr.otherwise(F.lit(label)) if expr is not None else F.lit(label)
        expr = (F.when(x < upper, F.lit(label)) if expr is None
                else expr.when(x < upper, F.lit(label)))
    return expr


def iso_text(ts: str | Column) -> Column:
    """Timestamp as ``yyyy-MM-ddTHH:mm:ssZ`` text (session time zone, UTC in this library)."""
    return F.date_format(_c(ts), ISO_SECONDS)


def positive_or_null(c: str | Column) -> Column:
    """The value when it is > 0, else null: 0 stands for "not given"."""
    x = _c(c)
    return F.when(x > 0, x)


def n_unique(c: str | Column) -> Column:
    """Distinct values counting null as one value (aggregate expression)."""
    x = _c(c)
    return F.count_distinct(x) + F.max(x.isNull().cast("int"))


def area_fallback(flat: str | Column, nested: str | Column, default: str = "Unknown") -> Column:
    """Non-empty flat area name, else the nested name, else ``default``."""
    return F.coalesce(F.nullif(_c(flat), F.lit("")), _c(nested), F.lit(default))


def salary_fallback(flat: str | Column, nested: str | Column) -> Column:
    """Flat salary when it is non-zero, else the nested one, else 0."""
    return F.coalesce(F.nullif(lenient_bigint(flat, None), F.lit(0)),
                      lenient_bigint(nested, None), F.lit(0).cast("bigint"))

"""Scalar column functions (X1-X11) with the pandas semantics the indicator
jobs depend on, expressed as native Spark expressions so they stay inside
whole-stage codegen. Every function takes and returns a ``Column``; none
triggers an action, so all of them also work on streaming DataFrames.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must match the observed pandas / Python behaviour).
# Whitespace that Python's str.strip() / regex \s remove beyond ASCII,
# including the French thousands separators U+00A0 (NBSP) and U+202F (NNBSP).
WHITESPACE_CLASS = (
    r"[\x{0009}-\x{000D}\x{0020}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Decimal literal accepted by pandas.to_numeric after the clean-up steps.
NUMBER_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zfill(col, width: int) -> Column:
    """Left-pad with zeros, never truncate (``str.zfill``)."""
    c = _c(col)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def strip(col) -> Column:
    """Trim Unicode whitespace on both ends (``str.strip``)."""
    ws = WHITESPACE_CLASS
    return F.regexp_replace(_c(col), f"^{ws}+|{ws}+$", "")


def remove_all_whitespace(col) -> Column:
    return F.regexp_replace(_c(col), f"{WHITESPACE_CLASS}+", "")


def coerce_number(col) -> Column:
    """``to_numeric(errors="coerce")`` on already-clean text.

    ``try_cast`` alone accepts suffixes such as ``12d`` / ``1f`` that pandas
    rejects, so the literal is checked against a decimal pattern first.
    """
    c = _c(col).cast("string")
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def parse_number(col) -> Column:
    """Strip, drop inner blanks (incl. NBSP/NNBSP), comma -> dot, coerce."""
    cleaned = F.replace(remove_all_whitespace(_c(col).cast("string")), F.lit(","), F.lit("."))
    return coerce_number(cleaned)


def fill_missing(col, value) -> Column:
    """X4."""
    return F.coalesce(_c(col), F.lit(value))


def round_even(col, digits: int = 2) -> Column:
    """Numpy ``round`` = half-even on ``x * 10**d``."""
    scale = 10.0 ** digits
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def _accent_map() -> tuple[str, str]:
    """Signs whose canonical decomposition without marks is one other sign.

    Built by rule from the Unicode database: the translation equals NFD + drop
    category Mn for every listed sign (Hangul syllables decompose into letters,
    not marks, and stay)."""
    src, dst = [], []
    for cp in (*range(0x00C0, 0xAC00), *range(0xF900, 0x30000)):
        ch = chr(cp)
        if unicodedata.decomposition(ch):
            base = "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")
            if base != ch and len(base) == 1:
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


_ACCENT_FROM, _ACCENT_TO = _accent_map()


def _without_marks(c: Column) -> Column:
    """NFD without marks (Mn): ``translate`` for composed signs, ``\\p{Mn}``
    for marks that stand alone; a text of ASCII signs is left as it is."""
    bare = F.regexp_replace(F.translate(c, _ACCENT_FROM, _ACCENT_TO), r"\p{Mn}", "")
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(bare)


def remove_accents(col) -> Column:
    """Strip, then NFD and drop combining marks (Mn)."""
    return _without_marks(strip(col))


def normalize_place_name(col) -> Column:
    """Upper, no accents, ``-`` and ``'`` become blanks, trimmed."""
    return strip(F.translate(_without_marks(F.upper(_c(col))), "-'", "  "))


def if_else(cond: Column, a, b) -> Column:
    """X8."""
    return F.when(cond, a).otherwise(b)


def as_int(col) -> Column:
    """Counts to 64-bit int (truncation, like ``astype("int64")``); what
    no such number can hold (text, NaN, infinity, overflow) is NULL."""
    return _c(col).try_cast("bigint")


def as_text(col) -> Column:
    return _c(col).cast("string")


def contains_any(cols, marker: str) -> Column:
    """True when any of the cells contains the literal marker."""
    arr = F.array(*[_c(c).cast("string") for c in cols])
    return F.exists(arr, lambda x: F.coalesce(x.contains(marker), F.lit(False)))


def residual(y, y_hat) -> Column:
    """X11."""
    return _c(y) - _c(y_hat)


def row_sum_min_count(cols) -> Column:
    """Horizontal sum, NULL only when every input is NULL."""
    cs = [_c(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    return F.when(F.coalesce(*cs).isNotNull(), total)


def row_sum_zero(cols) -> Column:
    """Horizontal sum with missing counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0.0)) for c in cols])


def share(part, total, scale: float = 100.0) -> Column:
    """Guarded percentage, NULL when total <= 0 or missing."""
    t = _c(total)
    return F.when(t > 0, _c(part) / t * F.lit(scale))


def share_unguarded(part, total, scale: float = 100.0) -> Column:
    """G24 unguarded variant: NULL instead of inf/NaN on a zero total."""
    return F.try_divide(_c(part), _c(total)) * F.lit(scale)


def argmax_label(cols, labels=None) -> Column:
    """Name of the largest column, first one on ties.

    NULLs are skipped (``array_max`` ignores them); all NULL gives NULL.
    """
    labels = list(labels or cols)
    arr = F.array(*[_c(c).cast("double") for c in cols])
    pos = F.array_position(arr, F.array_max(arr))
    return F.when(pos > 0, F.element_at(F.array(*[F.lit(x) for x in labels]), pos.cast("int")))


def search_regex(col, pattern: str) -> Column:
    """Case-insensitive regex search, missing -> no match."""
    return F.coalesce(_c(col).rlike("(?i)" + pattern), F.lit(False))

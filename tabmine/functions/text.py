"""Scalar column expressions for text cleaning (all JVM-side built-ins).

``unicode=True`` prefixes patterns with ``(?U)`` so Java's ``\\s``/``\\S``
cover Unicode whitespace (what Python's ``str.split``/``re`` do); with
``unicode=False`` the ASCII classes match DuckDB's RE2, which is how the
oracle-checked queries run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _rx(pattern: str, unicode: bool) -> str:
    return ("(?U)" + pattern) if unicode else pattern


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c, unicode: bool = True) -> Column:
    """Trim leading/trailing whitespace."""
    return F.regexp_replace(_c(c), _rx(r"^\s+|\s+$", unicode), "")


def collapse_ws(c, unicode: bool = True) -> Column:
    """Collapse whitespace runs to one blank, then trim."""
    one = F.regexp_replace(_c(c), _rx(r"\s+", unicode), " ")
    return F.regexp_replace(one, r"^ | $", "")


def word_count(c, unicode: bool = True) -> Column:
    """Number of whitespace-separated words; 0 for '' and blanks (C11)."""
    return F.size(F.regexp_extract_all(_c(c), F.lit(_rx(r"\S+", unicode)), F.lit(0))).cast("int")


def char_count(c) -> Column:
    """Length in code points."""
    return F.char_length(_c(c)).cast("int")


def last_match_int(c, pattern: str, group: int = 1) -> Column:
    """Integer value of the LAST match of ``pattern`` (null when none)."""
    found = F.regexp_extract_all(_c(c), F.lit(pattern), F.lit(group))
    return F.try_element_at(found, F.lit(-1)).cast("int")


def null_above(c, bound) -> Column:
    """Null-out values above a bound."""
    return F.when(_c(c) <= F.lit(bound), _c(c))


# The CSV missing-value tokens of the pandas reader the studied
# pipeline used (its documented default list).
CSV_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                   "nan", "null")


def null_tokens(c, tokens=CSV_NULL_TOKENS) -> Column:
    """Map CSV missing-value tokens to null."""
    return F.when(~_c(c).isin(list(tokens)), _c(c))


def nan_to_null(c) -> Column:
    """NaN is missing: turn it into null so aggregates skip it (1.3-1)."""
    return F.when(~F.isnan(_c(c)), _c(c))


def right_closed_band(c, edges, labels) -> Column:
    """Label of the right-closed band (edges[i], edges[i+1]]; null outside."""
    x = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int."""
    return cond.cast("int")

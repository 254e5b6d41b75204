"""Text expressions. All of them are built-in column expressions, no Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as spreadsheets contain it: ASCII blanks, separators (incl. no-break space), controls.
_BLANK = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]+"


def strip_all(text: Column) -> Column:
    """Remove every kind of leading and trailing whitespace (``trim`` removes only spaces)."""
    return F.regexp_replace(text, rf"^{_BLANK}|{_BLANK}\z", "")


def normal_key(text: Column) -> Column:
    """Spelling used inside lookup lists: stripped and upper-cased."""
    return F.upper(strip_all(text))


def in_parentheses(text: Column) -> Column:
    """Text after the first ``(`` up to the next ``)``; empty when there is none."""
    return F.regexp_extract(text, r"\(([^)]+)", 1)


def after_colon(text: Column) -> Column:
    """Text after the first ``:``; empty when there is none."""
    return F.regexp_extract(text, r":(.*)", 1)


def suffix_from(text: Column, position: int) -> Column:
    """Text from the one-based ``position`` to the end."""
    return F.substring(text, position, 2147483647)


def contains_any_case(text: Column, needle: str) -> Column:
    """Case-insensitive containment."""
    return F.upper(text).contains(needle.upper())


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over code points; a missing text counts as empty."""
    return F.levenshtein(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def _longer(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(1), F.length(a), F.length(b))


def similarity_percent(a: Column, b: Column) -> Column:
    """100 for equal texts, 0 when every position has to change; two empty texts are equal."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return 100.0 * ((_longer(a, b) - F.levenshtein(a, b)) / _longer(a, b))


def similar_at_least(a: Column, b: Column, percent: int) -> Column:
    """``similarity_percent(a, b) >= percent`` in integers, for texts that are not NULL.

    Equal texts skip the distance, and the distance gives up at the largest number of edits
    that could still pass.
    """
    allowed = F.lit(100 - percent) * _longer(a, b)
    edits = F.call_function("levenshtein", a, b, F.floor(allowed / 100).cast("int"))
    return (a == b) | (edits >= 0)

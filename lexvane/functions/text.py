"""Column expressions for cleaning text, names and numbers.

All of them are built from JVM-side functions, so they stay inside generated
code and can be pushed around freely by the optimizer.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. Everything that is neither letter, digit nor underscore
# separates words; blanks are a subset of that, so one replacement both removes
# punctuation and collapses blanks.
NON_WORD = r"[^\p{L}\p{N}_]+"
BLANK = r"[\s\x1c-\x1f]"
NAME_SEPARATORS = r"(?U)[.\-_\s\x1c-\x1f]+"
OUTER_BLANKS = rf"(?U)^{BLANK}+|{BLANK}+\z"
# A decimal number as data files write it (no hex, no type suffixes).
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def fill_text(text: Column) -> Column:
    """Missing text becomes the empty string."""
    return F.coalesce(text.cast("string"), F.lit(""))


def clean_text(text: Column) -> Column:
    """Lower-case words separated by single spaces; underscores are kept."""
    return F.trim(F.regexp_replace(F.lower(fill_text(text)), NON_WORD, " "))


def normalize_name(name: Column) -> Column:
    """Lower-case name with dots, dashes, underscores and blanks as one space."""
    return F.trim(F.regexp_replace(F.lower(name.cast("string")), NAME_SEPARATORS, " "))


def strip(value: Column) -> Column:
    """Remove blanks of any script from both ends."""
    return F.regexp_replace(value, OUTER_BLANKS, "")


def span(text: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` (0-based) up to but excluding ``end``."""
    return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))


def span_is_valid(text: Column, start: Column, end: Column) -> Column:
    """True if ``0 <= start < end <= length(text)``; missing offsets are invalid."""
    inside = (start >= 0) & (start < end) & (end <= F.length(text))
    return F.coalesce(inside, F.lit(False))


def is_malware_label(label: Column) -> Column:
    """True for ``malware`` in any case, without trimming; missing is false."""
    return F.coalesce(F.lower(label) == "malware", F.lit(False))


def whole_number(value: Column) -> Column:
    """Number given as text, truncated to a bigint; null if it is not a number."""
    exact = value.try_cast("bigint")
    truncated = value.try_cast("double").try_cast("bigint")
    return F.when(value.rlike(NUMBER), F.coalesce(exact, truncated))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """1 if any of a short fixed list of words occurs anywhere in the text, else 0.

    Words that contain another listed word cannot change the answer and are
    left out of the generated condition.
    """
    given = list(dict.fromkeys(w for w in words if w))
    needed = [w for w in given if not any(o != w and o in w for o in given)]
    if not needed:
        return F.lit(0)
    hit = reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in needed))
    return F.coalesce(hit.cast("int"), F.lit(0))

"""Turning a free-text answer about aliases into clean dictionary terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexvane.functions.text import normalize_name, strip

# Phrases that mark an answer without aliases, and the opening
# that marks an item as an apology.
REFUSALS: tuple[str, ...] = (
    "i couldn't find",
    "i do not have information",
    "no known aliases",
    "not a malware",
    "here are some aliases:",
)
APOLOGY = "i don't"


def alias_terms(answer: Column, min_length: int = 4) -> Column:
    """Array of alias terms in a comma-separated answer.

    A refusal only voids an answer that holds no comma. A missing answer gives
    null (the lookup failed); a blank or refused one gives an empty array.
    """
    content = strip(answer)
    lowered = F.lower(content)
    refused = reduce(lambda a, b: a | b, (F.contains(lowered, F.lit(p)) for p in REFUSALS))
    void = (content == "") | (refused & ~F.contains(content, F.lit(",")))
    items = F.transform(F.split(content, ","), normalize_name)
    usable = F.filter(
        items, lambda a: (F.length(a) >= min_length) & ~F.startswith(a, F.lit(APOLOGY))
    )
    empty = F.array().cast("array<string>")
    return F.when(content.isNull(), F.lit(None)).when(void, empty).otherwise(usable)

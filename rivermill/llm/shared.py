"""Small expressions that several operators of this package use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of characters other than the six blanks.
BLANK_CLASS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, evaluated once per row however often `body` names it, and only where the result is needed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")

"""Text predicates and name building."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_like(text: Column, *patterns: str) -> Column:
    """True where ``text`` matches one of the LIKE patterns (``_`` is a wildcard)."""
    return reduce(lambda a, b: a | b, [text.like(p) for p in patterns])


def first_match(rules: Sequence[tuple[object, Column]], default: object = None) -> Column:
    """Ordered first-match classification: the value of the first true rule."""
    (value, condition), *rest = rules
    chain = F.when(condition, F.lit(value))
    for value, condition in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default)) if default is not None else chain


def lower_or_blank(col: Column) -> Column:
    return F.lower(F.coalesce(col, F.lit("")))


def email_key(col: Column) -> Column:
    """Join key of an e-mail address."""
    return F.lower(F.trim(col))


def strict_name(first: Column, last: Column) -> Column:
    """Full name, NULL when a part is NULL (used on the facts)."""
    return F.concat(first, F.lit(" "), last)


def lenient_name(first: Column, last: Column) -> Column:
    """Full name with NULL parts as blanks, untrimmed."""
    blank = F.lit("")
    return F.concat(F.coalesce(first, blank), F.lit(" "), F.coalesce(last, blank))


def display_name(first: Column, last: Column) -> Column:
    """Trimmed lenient name (used on the user dimension)."""
    return F.trim(lenient_name(first, last))

"""Columns that describe one election."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LEVEL_WORDS, NO_KEYWORD, OFFICE_WORDS, STATE_CODES


def election_day(year: Column, month: int | Column = 11) -> Column:
    """The Tuesday after the first Monday of a month."""
    month = month if isinstance(month, Column) else F.lit(month)
    first = F.make_date(year.cast("int"), month, F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "MON"), 1)


def _mentions(name: Column, words: tuple[str, ...]) -> Column:
    lowered = F.lower(name)
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(word)) for word in words])


def _first_label(name: Column, rules: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    hits = [F.when(_mentions(name, words), F.lit(label)) for label, words in rules]
    return F.coalesce(*hits, F.lit(NO_KEYWORD))


def is_primary(name: Column) -> Column:
    return _mentions(name, ("primary",))


def cycle_kind(year: Column) -> Column:
    return F.when(year % 4 == 0, "Presidential").when(year % 2 == 0, "Midterm").otherwise("Off-Year")


def election_type(name: Column, year: Column) -> Column:
    return (
        F.when(is_primary(name), "Primary")
        .when(_mentions(name, ("special",)), "Special")
        .otherwise(cycle_kind(year))
    )


def election_level(name: Column) -> Column:
    return _first_label(name, LEVEL_WORDS)


def office_type(name: Column) -> Column:
    return _first_label(name, OFFICE_WORDS)


def state_token(name: Column) -> Column:
    """The first word of the name that is a state code in any case ("in" gives IN)."""
    words = F.split(F.upper(name), r"(?U)\s+")
    return F.get(F.filter(words, lambda word: word.isin(*STATE_CODES)), F.lit(0))

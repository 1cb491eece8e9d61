"""Columns that describe one voter."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    AGE_GROUPS,
    CSV_MISSING,
    CYCLE_TYPES,
    ELECTION_CYCLES,
    SEGMENTS,
    TEXT_MISSING,
)

# Every blank character: those of ASCII, and all of them.
ASCII_BLANKS = "".join(c for c in map(chr, range(128)) if c.isspace())
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WHOLE_OR_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITE = r"(?i)^[+-]?inf(inity)?$"


def strip_blanks(text: Column) -> Column:
    """Trim blanks of any kind; plain ASCII text is only searched for ASCII blanks."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.btrim(text, F.lit(ASCII_BLANKS))).otherwise(F.btrim(text, F.lit(BLANKS)))


# --- cleaning ------------------------------------------------------------------------------------
def missing_to_null(text: Column) -> Column:
    """Cells a CSV reader takes as missing become null."""
    return F.when(~text.isin(*CSV_MISSING), text)


def clean_text(trimmed: Column) -> Column:
    """Trimmed texts that only say "missing" become null."""
    return F.when(~trimmed.isin(*TEXT_MISSING), trimmed)


def parse_age(trimmed: Column) -> Column:
    """Whole number from trimmed text such as ``45`` or ``45.0``; other text becomes null.

    A fraction or a number no int can hold fails the job, so that a file carrying one
    is never loaded in part.
    """
    number = trimmed.try_cast("double")
    fits = (number == F.floor(number)) & (F.abs(number) <= 2147483647.0)
    refuse = F.raise_error(F.concat(F.lit("age is not a whole number: "), trimmed)).cast("int")
    whole = F.when(fits, number.cast("int")).otherwise(refuse)
    return F.when(trimmed.rlike(WHOLE_OR_DECIMAL), whole).when(trimmed.rlike(INFINITE), refuse)


# A day, alone or with a time of day and an offset.
ISO_MOMENT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
)


def parse_iso_date(trimmed: Column) -> Column:
    """Date from ``yyyy-mm-dd`` with or without a time of day, which is dropped.

    Any other text, and days that do not exist, become null.
    """
    return F.when(trimmed.rlike(ISO_MOMENT), trimmed.substr(1, 10).try_cast("date"))


def normalize_email(email: Column) -> Column:
    return F.when(F.contains(email, F.lit("@")), F.lower(email))


def record_hash(*fields: Column) -> Column:
    """MD5 of the fields, each trimmed and lower-cased, null as empty, joined by ``|``."""
    parts = [F.lower(strip_blanks(F.coalesce(f.cast("string"), F.lit("")))) for f in fields]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


# --- engagement ----------------------------------------------------------------------------------
def elections_since_last_vote(last_voted: Column, days: list[date] | None = None) -> Column:
    """How many of the election days lie after the last vote; null for those who never voted."""
    days = days or [day for _, _, day in ELECTION_CYCLES]
    missed = [(last_voted < F.lit(day)).cast("int") for day in days]
    return reduce(lambda a, b: a + b, missed)


def elections_since(last_voted: Column, days: Column) -> Column:
    """The same count against an array column of election days."""
    return F.when(
        last_voted.isNotNull(), F.size(F.filter(days, lambda day: day > last_voted))
    )


def vote_cycle_type(last_voted: Column) -> Column:
    year = F.year(last_voted)
    presidential, midterm, other = CYCLE_TYPES
    return F.when(
        last_voted.isNotNull(),
        F.when(year % 4 == 0, presidential).when(year % 2 == 0, midterm).otherwise(other),
    )


def age_group(age: Column) -> Column:
    """Age band; null below 18."""
    young, middle, older, senior = AGE_GROUPS
    return F.when(age >= 65, senior).when(age >= 50, older).when(age >= 30, middle).when(age >= 18, young)


def engagement_segment(missed: Column) -> Column:
    """Label for a number of missed elections (null: never voted)."""
    current, last, occasional, infrequent, dormant, never = SEGMENTS
    return (
        F.when(missed.isNull(), never)
        .when(missed >= 7, dormant)
        .when(missed >= 4, infrequent)
        .when(missed >= 2, occasional)
        .when(missed == 1, last)
        .when(missed == 0, current)
    )


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def calendar_years_between(start: Column, end: Column) -> Column:
    """Difference of the year numbers: 2000-12-31 to 2001-01-01 is 1."""
    return F.year(end) - F.year(start)


# --- one election --------------------------------------------------------------------------------
def was_registered(registered: Column, election_day: Column) -> Column:
    return F.coalesce(registered <= election_day, F.lit(False))


def likely_voted(registered: Column, last_voted: Column, election_day: Column, window: int) -> Column:
    """Registered by then, with a vote recorded within ``window`` days of the election."""
    near = F.abs(F.datediff(last_voted, election_day)) <= window
    return was_registered(registered, election_day) & F.coalesce(near, F.lit(False))

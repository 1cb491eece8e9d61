import hashlib
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ballotlake.functions import elections as E
from ballotlake.functions import numeric as N
from ballotlake.functions import voters as V


def values(spark, column, rows, kind):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(column.alias("r")).collect()]


def test_round_half_up_works_on_the_scaled_value(spark):
    got = values(spark, N.round_half_up(F.col("v"), 2), [1.005, 2.675, 0.125, -0.125, None], "double")
    assert got == [1.0, 2.68, 0.13, -0.13, None]


def test_round_half_even(spark):
    got = values(spark, N.round_half_even(F.col("v"), 1), [0.25, 0.35, 0.05, 12.25], "double")
    assert got == [0.2, 0.4, 0.0, 12.2] or got == [0.2, 0.3, 0.0, 12.2]


def test_percent_of_nothing(spark):
    whole = F.col("v")
    assert values(spark, N.percent(F.lit(1), whole), [0, 3, None], "long") == [None, 33.33, None]
    assert values(spark, N.percent_or_zero(F.lit(1), whole), [0, 3, None], "long") == [0.0, 33.33, 0.0]


@pytest.mark.parametrize(
    "text, age",
    [("45", 45), (" 45 ", 45), ("45.0", 45), ("4e1", 40), ("x", None), ("45d", None), ("", None), (None, None), ("0x2D", None)],
)
def test_parse_age(spark, text, age):
    assert values(spark, V.parse_age(V.strip_blanks(F.col("v"))), [text], "string") == [age]


@pytest.mark.parametrize("text", ["45.5", "inf", "-Infinity", "1e12"])
def test_an_age_no_int_can_hold_fails_the_job(spark, text):
    with pytest.raises(Exception, match="age is not a whole number"):
        values(spark, V.parse_age(V.strip_blanks(F.col("v"))), [text], "string")


def test_dates_are_iso_only(spark):
    rows = ["2020-01-02", " 2020-01-02", "2020/01/02", "2020-02-30", "2020", "x", None]
    assert values(spark, V.parse_iso_date(V.strip_blanks(F.col("v"))), rows, "string") == [date(2020, 1, 2)] * 2 + [None] * 5


def test_clean_text(spark):
    rows = ["\u00a0 a \u3000", "\tb\x1f\n", "nan", " None ", "none", "NaN", "", "   ", "Nan", None]
    assert values(spark, V.clean_text(V.strip_blanks(F.col("v"))), rows, "string") == ["a", "b"] + [None] * 6 + ["Nan", None]


def test_record_hash_is_md5_of_normalized_fields(spark):
    row = spark.createDataFrame([("1", " Alice", "SMITH ", None)], "a string, b string, c string, d string")
    got = row.select(V.record_hash(*[F.col(c) for c in "abcd"])).first()[0]
    assert got == hashlib.md5(b"1|alice|smith|").hexdigest()
    assert len(got) == 32


def test_email(spark):
    assert values(spark, V.normalize_email(F.col("v")), ["A@B.c", "none", None], "string") == ["a@b.c", None, None]


def test_missed_elections_change_on_election_day(spark):
    days = [date(2024, 11, 5), date(2024, 11, 4), date(2022, 11, 8), date(2008, 11, 4), date(2008, 11, 3), date(1950, 1, 1), None]
    got = values(spark, V.elections_since_last_vote(F.col("v")), days, "date")
    assert got == [0, 1, 1, 8, 9, 9, None]


def test_segments(spark):
    got = values(spark, V.engagement_segment(F.col("v")), [None, *range(10)], "int")
    assert got == [
        "Never Voted", "Current Voter", "Missed Last Election", *["Occasional Voter"] * 2,
        *["Infrequent Voter"] * 3, *["Dormant Voter"] * 3,
    ]


def test_age_groups(spark):
    got = values(spark, V.age_group(F.col("v")), [17, 18, 29, 30, 49, 50, 64, 65, 120, None], "int")
    assert got == [None, "18-29", "18-29", "30-49", "30-49", "50-64", "50-64", "65+", "65+", None]


def test_cycle_types(spark):
    got = values(spark, V.vote_cycle_type(F.col("v")), [date(2020, 3, 1), date(2018, 1, 1), date(2019, 1, 1), None], "date")
    assert got == ["Presidential Year", "Midterm Year", "Off-Year/Primary", None]


def test_years_count_boundaries(spark):
    got = values(spark, V.calendar_years_between(F.col("v"), F.lit(date(2001, 1, 1))), [date(2000, 12, 31), date(2001, 1, 1)], "date")
    assert got == [1, 0]


def test_likely_voted_window(spark):
    day = date(2020, 11, 3)
    votes = [day + timedelta(d) for d in (-91, -90, 0, 90, 91)] + [None]
    likely = V.likely_voted(F.lit(date(2019, 1, 1)), F.col("v"), F.lit(day), 90)
    assert values(spark, likely, votes, "date") == [False, True, True, True, False, False]
    late = V.likely_voted(F.lit(date(2020, 11, 4)), F.col("v"), F.lit(day), 90)
    assert values(spark, late, [day], "date") == [False]


def test_election_day_for_every_start_of_month(spark):
    for month in (3, 11):
        years = list(range(1976, 2032))
        expected = []
        for year in years:
            monday = next(d for d in range(1, 8) if date(year, month, d).weekday() == 0)
            expected.append(date(year, month, monday + 1))
        assert values(spark, E.election_day(F.col("v"), month), years, "int") == expected


# name -> type (in 2026), level, office, primary, state
NAMES = {
    "Ohio Presidential Primary": ("Primary", "Federal", "President", True, None),
    "Special Senate Election": ("Special", "Federal", "Senate", False, None),
    "GOVERNOR Runoff": ("Midterm", "State", "Governor", False, None),
    "County Council or City Board": ("Midterm", "Local", "General", False, "OR"),
    "House Election in CA": ("Midterm", "General", "House", False, "IN"),
    "State Legislature, tx": ("Midterm", "State", "General", False, "TX"),
    "Runoff": ("Midterm", "General", "General", False, None),
    "Congress seat NY": ("Midterm", "Federal", "House", False, "NY"),
    " wy\tmunicipal ": ("Midterm", "Local", "General", False, "WY"),
}


def test_classification(spark):
    name = F.col("v")
    everything = F.struct(
        E.election_type(name, F.lit(2026)), E.election_level(name), E.office_type(name), E.is_primary(name), E.state_token(name)
    )
    assert [tuple(r) for r in values(spark, everything, list(NAMES), "string")] == list(NAMES.values())


def test_type_by_year(spark):
    got = values(spark, E.election_type(F.lit("Runoff"), F.col("v")), [2024, 2026, 2027], "int")
    assert got == ["Presidential", "Midterm", "Off-Year"]

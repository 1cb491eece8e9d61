"""Labels, dates, word lists and thresholds the results depend on."""

from __future__ import annotations

from datetime import date

# --- Fixed values: federal election cycles (year, kind, election day) ---------------------------
ELECTION_CYCLES = (
    (2008, "Presidential", date(2008, 11, 4)),
    (2010, "Midterm", date(2010, 11, 2)),
    (2012, "Presidential", date(2012, 11, 6)),
    (2014, "Midterm", date(2014, 11, 4)),
    (2016, "Presidential", date(2016, 11, 8)),
    (2018, "Midterm", date(2018, 11, 6)),
    (2020, "Presidential", date(2020, 11, 3)),
    (2022, "Midterm", date(2022, 11, 8)),
    (2024, "Presidential", date(2024, 11, 5)),
)
# Days between a recorded vote and an election day that still count as voting in it.
VOTE_WINDOW_DAYS = 90

# --- Fixed values: voter attributes --------------------------------------------------------------
PARTIES = ("Democrat", "Republican", "Independent")
GENDERS = ("M", "F")
AGE_GROUPS = ("18-29", "30-49", "50-64", "65+")
SEGMENTS = (
    "Current Voter",
    "Missed Last Election",
    "Occasional Voter",
    "Infrequent Voter",
    "Dormant Voter",
    "Never Voted",
)
CYCLE_TYPES = ("Presidential Year", "Midterm Year", "Off-Year/Primary")
TIERS = ("High Priority", "Medium Priority", "Low Priority", "Monitor Only")
LEANS = ("Highly Competitive", "Competitive", "Lean Democrat", "Lean Republican")

# --- Fixed values: outreach scoring --------------------------------------------------------------
# Weights of the opportunity score: recent lapse, medium lapse, tenure, segment size.
OPPORTUNITY_WEIGHTS = (40.0, 30.0, 20.0, 10.0)
# Segments below this size score 0.
MIN_SCORED_SEGMENT = 3
# (tier, lowest score, fewest voters), best tier first; anything else is the last of TIERS.
TIER_RULES = (
    ("High Priority", 25, 5),
    ("Medium Priority", 15, 3),
    ("Low Priority", 8, 2),
)
# Weights of a state's engagement score: recoverable, disengaged, never voted.
ENGAGEMENT_WEIGHTS = (0.6, 0.3, 0.1)
# Party gaps (percentage points) up to which a state is highly competitive / competitive.
COMPETITIVE_GAPS = (5, 15)

# --- Fixed values: voter files -------------------------------------------------------------------
VOTER_COLUMNS = (
    "id",
    "first_name",
    "last_name",
    "age",
    "gender",
    "state",
    "party",
    "email",
    "registered_date",
    "last_voted_date",
)
# Share of all-empty rows up to which a file is accepted.
EMPTY_ROW_THRESHOLD = 0.05
# Cell texts a CSV reader takes as missing.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Texts that mean "missing" once a text cell has been trimmed.
TEXT_MISSING = ("", "nan", "None", "NaN", "none")

# --- Fixed values: election calendars ------------------------------------------------------------
STATE_CODES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)
# Words in an election's name that tell its level / office; the first list with a hit wins.
LEVEL_WORDS = (
    ("Federal", ("federal", "presidential", "senate", "congress")),
    ("State", ("state", "governor", "legislature")),
    ("Local", ("county", "city", "local", "municipal")),
)
OFFICE_WORDS = (
    ("President", ("president",)),
    ("Senate", ("senate",)),
    ("House", ("house", "congress")),
    ("Governor", ("governor",)),
)
NO_KEYWORD = "General"
SOURCE_RESULTS = "MIT Election Lab"
SOURCE_CIVIC = "Google Civic Information API"
SOURCE_COMPUTED = "Calculated Federal Schedule"
CALENDAR_END_YEAR = 2030
CALENDAR_LATEST_START = 2022

"""Voters on the edges of the bands (ages, election days, leap days), and what follows for each."""

from datetime import date

AS_OF = date(2025, 6, 30)

# id, first, last, age, gender, state, party, email, registered, last voted
VOTERS = [
    ("1", "Ora", "Quill", 18, "F", "VT", "Independent", "ora@mail.test", date(2025, 6, 29), None),
    ("2", "Pim", "Rusk", 29, "M", "UT", "Democrat", "pim@mail.test", date(2024, 2, 29), date(2024, 11, 5)),
    ("3", "Quy", "Stead", 30, "F", "ME", "Republican", "quy@mail.test", date(2020, 2, 29), date(2024, 11, 4)),
    ("4", "Rae", "Tarn", 49, "M", "ND", "Democrat", "rae@mail.test", date(2000, 1, 1), date(2022, 11, 8)),
    ("5", "Sol", "Ude", 50, "F", "KS", "Republican", "sol@mail.test", date(1999, 12, 31), date(2022, 11, 7)),
    ("6", "Tao", "Voss", 64, "M", "NM", "Independent", "tao@mail.test", date(2012, 2, 29), date(2019, 5, 21)),
    ("7", "Uma", "Wirt", 65, "F", "RI", "Democrat", "uma@mail.test", date(1980, 7, 4), date(2018, 11, 5)),
    ("8", "Vic", "Xu", 99, "M", "AK", "Republican", "vic@mail.test", date(1944, 6, 6), date(2012, 11, 6)),
    ("9", "Wyn", "Yates", 41, "F", "DE", "Independent", "wyn@mail.test", date(2005, 10, 10), date(2010, 11, 3)),
    ("10", "Xan", "Zoll", 77, "M", "HI", "Democrat", "xan@mail.test", date(1970, 1, 1), date(2008, 11, 3)),
]
FIELDS = (
    "source_id string, first_name string, last_name string, age int, gender string, state string, "
    "party string, email string, registered_date date, last_voted_date date"
)

# id -> age group, years, missed elections, segment, cycle type
EXPECTED = {
    "1": ("18-29", 0, None, "Never Voted", None),
    "2": ("18-29", 1, 0, "Current Voter", "Presidential Year"),
    "3": ("30-49", 5, 1, "Missed Last Election", "Presidential Year"),
    "4": ("30-49", 25, 1, "Missed Last Election", "Midterm Year"),
    "5": ("50-64", 26, 2, "Occasional Voter", "Midterm Year"),
    "6": ("50-64", 13, 3, "Occasional Voter", "Off-Year/Primary"),
    "7": ("65+", 45, 4, "Infrequent Voter", "Midterm Year"),
    "8": ("65+", 81, 6, "Infrequent Voter", "Presidential Year"),
    "9": ("30-49", 20, 7, "Dormant Voter", "Midterm Year"),
    "10": ("65+", 55, 9, "Dormant Voter", "Presidential Year"),
}


def raw(spark, rows=VOTERS):
    return spark.createDataFrame(rows, FIELDS)


def voter(source_id, **changes):
    """The fourth voter with another id and some other values."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    values = dict(zip(names, VOTERS[3]), source_id=source_id, **changes)
    return tuple(values[n] for n in names)

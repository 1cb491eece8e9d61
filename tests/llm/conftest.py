import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

LONG = " ".join(f"word{k % 977} and\nline {k % 31}." for k in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns whose names clash."""
    rows = [
        (1, "Plain words stand here, one after the other, so that there is enough of them to be read by anyone at all today.", "en", "a"),
        (1, "Plain words stand here, one after the other, so that there is enough of them to be read by anyone at all today.", "en", "a"),
        (2, None, "en", "a"), (3, "", None, "b"), (4, " \t\n\n ", "de", None), (None, "no id here", "en", "b"),
        (None, None, None, None), (5, LONG, "en", "b"), (6, "x" * 300_000, "fr", "c"), (7, "same line\nsame line\nsame line", "en", "c"),
        (8, "ÄÖÜ ☃ 😀 \x00 1 2 3", "xx", "a"), (9, "a", "en", "b"), (10, "a", "en", "b"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ("words", "body", "_key", "_row", "_lines", "kept", "size", "target", "sid", "fp", "n_words", "window", "spans", "_removed")
    frame = frame.withColumn("n_chars", F.char_length("text").cast("long"))
    return frame.withColumns({name: F.lit(7) for name in names})

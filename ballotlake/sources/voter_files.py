"""Voter CSV files: listing, quality gate, schema check and scan.

A file is described by its header, so every line needs its own file's column order. Files are
read as lines, and so by as many tasks as they are large: one aggregated pass describes each file
(header, rows, all-empty rows), and a second one cuts the lines into cells and puts them in order by that
description. Batch runs and streams share both.

Where quotes span lines, lines are first joined into records. What a line does to "inside quotes or not"
is a function of that state; the functions are composed along each block of the file, then over the
blocks (a row each), which gives the state before every line. Only the lines of broken records move
to be joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import CSV_MISSING, EMPTY_ROW_THRESHOLD, VOTER_COLUMNS
from ..functions.literals import timestamp_literal
from ..functions.voters import clean_text, missing_to_null, parse_age, parse_iso_date, strip_blanks
from ..session import settled

TEXT_COLUMNS = ("first_name", "last_name", "gender", "state", "party", "email")
# Descriptions of up to so many files are sent to every task; more are joined by shuffling.
BROADCAST_FILES = 100_000

# A cell after its comma: quoted, with quotes doubled inside, or everything up to the next comma.
CELL = r',[ \t]*+("(?:[^"]++|"")*+"(?=,|$)|[^,]*+)'
QUOTED = r'"(?:[^"]++|"")*+"'

# A cell that ends in its line, whatever follows its quotes, and one whose quotes stay open.
CLOSED = r'[ \t]*+(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
OPEN = r'[ \t]*+"(?:[^"]++|"")*+'


class RejectedFiles(ValueError):
    """At least one input file failed the gate; nothing was loaded."""


def _address() -> Column:
    """The encoded address of a row's file."""
    return F.col("_metadata.file_path")


def _plain(address: Column) -> Column:
    """Local files are addressed as file:/ or file:///; both become the former."""
    return F.regexp_replace(address, "^file:/+", "file:/")


def exact_path(path: str) -> str:
    """The path as a pattern that matches nothing else."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _listing(spark: SparkSession, paths: str | list[str], since: datetime | None = None) -> DataFrame:
    """CSV files below a folder or at the paths; contents are not read. Files of no bytes give no row."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    if since is not None:
        reader = reader.option("modifiedAfter", since.isoformat(timespec="milliseconds"))
    return reader.load(paths).select(
        F.col("path").alias("file_path"),
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("file_bytes"),
        _address().alias("file_uri"),
    )


def scan_new_files(spark: SparkSession, folder: str, since: datetime | None = None) -> DataFrame:
    """The folder's CSV files changed after ``since``, oldest first."""
    files = _listing(spark, folder).drop("file_uri")
    if since is not None:
        files = files.where(F.col("modified_at") > timestamp_literal(since))
    return files.orderBy("modified_at", "file_path")


# --- lines ---------------------------------------------------------------------------------------
def file_lines(text: DataFrame) -> DataFrame:
    """Every line, with its file and its block of the file, from a text source."""
    return text.select(
        _plain(_address()).alias("file_uri"),
        # The name is percent-encoded, where a plus is a plus.
        F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("source_file"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def _said(units: DataFrame) -> DataFrame:
    """Lines or records that are not blank."""
    return units.where(F.trim("value") != "")


def _placed(lines: DataFrame) -> DataFrame:
    """The lines with their place in the file, which is the same whenever they are read."""
    return lines.withColumn("place", F.struct("block", F.monotonically_increasing_id().alias("line")))


def cells_of(line: Column) -> Column:
    """The cells of a CSV line, however many there are."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CELL), F.lit(1))

    def plain(cell: Column) -> Column:
        inside = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        return F.when(cell.rlike(f"^{QUOTED}$"), inside).otherwise(cell)

    return F.transform(cells, plain)


def _all_missing(line: Column) -> Column:
    """Whether every cell of a CSV line is a text that means "missing"."""
    words = "|".join(re.escape(word) for word in CSV_MISSING if word)
    cell = f'(?:(?:{words})|"(?:{words})?")?'
    return line.rlike(f"^(?:{cell},)*+{cell}$")


def _opens(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside."""
    return F.contains(line, F.lit('"')) & line.rlike(rf"^(?:{CLOSED},)*+{OPEN}\z")


def _stays(line: Column) -> Column:
    """Whether a line that begins inside quotes ends inside."""
    inside = rf'^(?:[^"]++|"")*+(?:"[^,]*+,(?:{CLOSED},)*+{OPEN})?+\z'
    return ~F.contains(line, F.lit('"')) | line.rlike(inside)


def _described(units: DataFrame) -> DataFrame:
    """One row per file from its lines or records: its header and where that stands, data rows, all-empty rows.

    The header comes first in the file. Finding it and counting are one partially aggregated pass, so a
    single huge file is no bottleneck. ``quoted`` tells whether quotes span lines.
    """
    seen = (
        _said(units).withColumn("empty", _all_missing(F.col("value")).cast("int"))
        .groupBy("file_uri", "source_file", "modified_at")
        .agg(
            F.min_by(F.struct("value", "empty", "place"), "place").alias("first"),
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("empty").alias("n_empty"),
            F.coalesce(F.max(_opens(F.col("value"))), F.lit(False)).alias("quoted"),
        )
    )
    header = cells_of(F.regexp_replace("first.value", "^﻿", ""))
    return seen.select(
        "file_uri", "source_file", "modified_at", "quoted",
        F.col("first.place").alias("header_place"),
        F.transform(header, lambda name: F.btrim(name)).alias("header"),
        (F.col("n_lines") - 1).alias("total_rows"),
        (F.col("n_empty") - F.col("first.empty")).alias("error_rows"),
    )


def _for_tasks(files: DataFrame) -> DataFrame:
    """Rows of files as one side of a join: sent to every task while they are few."""
    return F.broadcast(files) if files.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES else files


# --- records of several lines --------------------------------------------------------------------
def _state(fixed: Column, turns: Column, start: Column) -> Column:
    """Inside quotes (1) or not (0): after the last line that fixes it, or at the start, turned so often."""
    return (F.coalesce(fixed, start) + turns) % 2


def whole_records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """The records of the named files from their placed lines: a record has its first line's place.

    The lines of a block of a file come together, which is how they were read; of a record that goes on
    over lines, only those lines move again. A file of any size is many tasks' work.
    """
    of = ["file_uri", "source_file", "modified_at"]
    block = Window.partitionBy("file_uri", "block").orderBy("place")
    here, above = block.rowsBetween(Window.unboundedPreceding, 0), block.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file_uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = earlier.rowsBetween(Window.unboundedPreceding, 0)
    opens, stays = _opens(F.col("value")).cast("int"), _stays(F.col("value")).cast("int")
    # A line turns the state around, leaves it, or fixes it: a fixed one is kept less the turns so far.
    marked = (
        lines.join(_for_tasks(files.select("file_uri")), "file_uri", "left_semi")
        .select(*of, "block", "place", "value", opens.alias("opens"), stays.alias("stays"))
        .withColumn("turn", (F.col("opens") > F.col("stays")).cast("int"))
        .withColumn("turns", F.sum("turn").over(here))
        .withColumn("own", F.when(F.col("opens") == F.col("stays"), (F.col("opens") + F.col("turns")) % 2))
        .withColumn("fixed", F.last("own", ignorenulls=True).over(here))
        .withColumn("fixed_above", F.last("own", ignorenulls=True).over(above))
    )
    ends = marked.groupBy("file_uri", "block").agg(
        F.max_by("fixed", "place").alias("fixed"), F.max("turns").alias("turns"))
    total = F.sum("turns").over(upto)
    starts = (
        ends.withColumn("fixed", (F.col("fixed") + F.col("turns") + total) % 2)
        .select(
            "file_uri", "block",
            _state(F.last("fixed", ignorenulls=True).over(earlier), F.coalesce(F.sum("turns").over(earlier), F.lit(0)),
                   F.lit(0)).alias("start"))
    )
    keys = ["file_uri", "block"]
    known = marked.join(starts, keys).select(
        *of, "block", "place", "value",
        _state(F.col("fixed_above"), F.col("turns") - F.col("turn"), F.col("start")).alias("before"),
        _state(F.col("fixed"), F.col("turns"), F.col("start")).alias("after"),
    ).withColumn("first", F.when(F.col("before") == 0, F.col("place")))
    single = known.where("before = 0 AND after = 0").select(*of, "place", "value")
    # Lines of broken records; those at the head of a block go on with a record of an earlier one.
    broken = known.where("before = 1 OR after = 1").withColumn("first", F.max("first").over(here))
    heads = broken.groupBy(*keys).agg(F.max("first").alias("first")).select(
        *keys, F.max("first").over(earlier).alias("_carried"))
    parts = broken.join(heads, keys).withColumn("first", F.coalesce("first", "_carried"))
    joined = parts.groupBy(*of, "first").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("parts"))
    joined = joined.select(*of, F.col("first").alias("place"), F.array_join("parts.value", "\n").alias("value"))
    return _said(single.unionByName(joined))


def survey(lines: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """A row per file that has lines, settled, and the records of the files in which quotes span lines.

    Such files are counted by records, without those that have too many cells.
    """
    placed = _placed(lines)
    described = settled(_described(placed))
    broken = described.where("quoted").select("file_uri")
    if broken.isEmpty():
        return described, None
    records = settled(whole_records(placed, broken))
    recounted = _described(records).withColumn("quoted", F.lit(True)).drop("total_rows", "error_rows")
    cells = F.size(cells_of(F.col("value")))
    counts = (
        records.join(_for_tasks(recounted.select("file_uri", "header", "header_place")), "file_uri")
        .where((F.col("place") != F.col("header_place")) & (cells <= F.size("header")))
        .groupBy("file_uri")
        .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(_all_missing(F.col("value"))).alias("error_rows"))
    )
    recounted = recounted.join(counts, "file_uri", "left").fillna(0, ["total_rows", "error_rows"])
    return settled(described.where("NOT quoted").unionByName(recounted)), records


# --- gate ----------------------------------------------------------------------------------------
GATE_COLUMNS = (
    "source_file", "can_process", "error", "error_rate", "total_rows", "error_rows", "threshold",
    "header_columns", "extra_columns", "missing_columns",
)


def _gate_columns(described: DataFrame, threshold: float) -> DataFrame:
    """The gate's verdict on described files; a file without a line has no header."""
    names = F.coalesce(F.size("header"), F.lit(0))
    wanted = F.array(*[F.lit(c) for c in VOTER_COLUMNS])
    rate = F.col("error_rows") / F.when(F.col("total_rows") > 0, F.col("total_rows"))
    lacking = F.array_join(F.array_except(wanted, F.coalesce("header", F.array().cast("array<string>"))), ", ")
    return (
        described.withColumn("header_columns", F.when(F.col("header").isNull(), 0).otherwise(names))
        .withColumn("error_rate", F.coalesce(rate, F.lit(0.0)))
        .withColumn("threshold", F.lit(float(threshold)))
        .withColumn("missing_columns", lacking)
        .withColumn(
            "error",
            F.when(F.col("header_columns") < len(VOTER_COLUMNS), "too few header columns")
            .when(F.col("total_rows") == 0, "no data rows")
            .when(F.col("error_rate") > threshold, "too many empty rows")
            .when(lacking != "", F.concat(F.lit("missing columns "), lacking)),
        )
        .withColumn("extra_columns", F.greatest(F.col("header_columns") - len(VOTER_COLUMNS), F.lit(0)))
        .withColumn("can_process", F.col("error").isNull())
    )


def file_quality_gate(
    spark: SparkSession, paths: Iterable[str], threshold: float = EMPTY_ROW_THRESHOLD
) -> DataFrame:
    """One row per file, those of no bytes included: header, row counts and whether it may be loaded."""
    exact = [exact_path(path) for path in paths]
    return _gate(spark, exact, survey(file_lines(spark.read.text(exact)))[0], threshold)


def _gate(spark: SparkSession, exact: list[str], described: DataFrame, threshold: float) -> DataFrame:
    described = described.drop("source_file", "modified_at")
    listing = _listing(spark, exact)
    # The listing names every file, its rows only those with content.
    names = [
        (re.sub("^file:/+", "file:/", uri), unquote(uri.rsplit("/", 1)[1])) for uri in listing.inputFiles()
    ]
    gate = (
        spark.createDataFrame(names, "file_uri string, source_file string")
        .join(listing.drop("source_file").withColumn("file_uri", _plain(F.col("file_uri"))), "file_uri", "left")
        .join(described, "file_uri", "left")
        .withColumn("total_rows", F.coalesce("total_rows", F.lit(0)))
        .withColumn("error_rows", F.coalesce("error_rows", F.lit(0)))
    )
    return _gate_columns(gate, threshold)


def _reject(gate: DataFrame) -> None:
    """Raise when a file of the gate may not be loaded. Files that may do not reach the driver."""
    problems = gate.where(~F.col("can_process")).select("source_file", "error").collect()
    if problems:
        raise RejectedFiles("; ".join(sorted(f"{row.source_file}: {row.error}" for row in problems)))


# --- schema --------------------------------------------------------------------------------------
def schema_check(
    df: DataFrame, expected: Iterable[str] = VOTER_COLUMNS, text: Iterable[str] | None = None
) -> DataFrame:
    """One row per expected or extra column: present, expected, filled rows, and whether that passes.

    Only a missing column fails; extra columns and text columns without any value are
    reported as warnings.
    """
    expected = list(expected)
    text = set(expected if text is None else text)
    names = [*expected, *[c for c in df.columns if c not in expected]]
    present = [c for c in names if c in df.columns]
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in present])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in expected).alias("expected"),
            F.lit(c in present).alias("present"),
            (F.col(f"`{c}`") if c in present else F.lit(0).cast("bigint")).alias("filled_rows"),
            F.lit(c not in expected or c in present).alias("valid"),
            (
                F.lit("missing") if c not in present
                else F.lit("ignored") if c not in expected
                else F.when(F.col(f"`{c}`") == 0, "empty") if c in text
                else F.lit(None).cast("string")
            ).cast("string").alias("note"),
        )
        for c in names
    ]
    return counts.select(F.inline(F.array(*rows)))


# --- rows ----------------------------------------------------------------------------------------
def clean_voters(rows: DataFrame) -> DataFrame:
    """Typed, cleaned voter rows from all-text rows.

    Step by step, because each step looks at the one before several times over.
    """
    filled = rows.withColumns({c: missing_to_null(F.col(c)) for c in VOTER_COLUMNS})
    trimmed = filled.withColumns({c: strip_blanks(F.col(c)) for c in VOTER_COLUMNS[1:]})
    typed = {c: clean_text(F.col(c)) for c in TEXT_COLUMNS}
    typed["age"] = parse_age(F.col("age"))
    for c in ("registered_date", "last_voted_date"):
        typed[c] = parse_iso_date(F.col(c))
    return trimmed.withColumns(typed)


def unread_cells(text: dict[str, Column], cleaned: dict[str, Column]) -> Column:
    """How many of a row's cells had a text that says something and yet became null."""
    lost = [
        (clean_text(strip_blanks(missing_to_null(text[c]))).isNotNull() & cleaned[c].isNull()).cast("int")
        for c in ("age", "registered_date", "last_voted_date")
    ]
    return F.coalesce(reduce(lambda a, b: a + b, lost), F.lit(0))


def voter_rows(
    lines: DataFrame, files: DataFrame, records: DataFrame | None = None, columns: Iterable[str] = VOTER_COLUMNS
) -> DataFrame:
    """All-text voter rows of the lines by their files' descriptions; of quoted files, of the records.

    Short lines are padded with nulls, over-long lines dropped. Of columns that share a name the
    first one counts. ``file_order`` sorts the rows by the age of their file.
    """
    columns = list(columns)
    files = _for_tasks(files.select(
        "file_uri", "header", "header_place", "quoted",
        F.array(*[F.array_position("header", F.lit(c)).cast("int") - 1 for c in columns]).alias("positions"),
    ))
    names = ["file_uri", "source_file", "modified_at", "place", "value"]
    units = _said(_placed(lines)).select(*names).join(files, "file_uri").where(~F.col("quoted"))
    if records is not None:
        units = units.unionByName(records.select(*names).join(files, "file_uri"))
    rows = (
        units.where(F.col("place") != F.col("header_place"))
        .select("file_uri", "source_file", "modified_at", "header", "positions", cells_of(F.col("value")).alias("cells"))
        .where(F.size("cells") <= F.size("header"))
    )
    values = [F.get("cells", F.get("positions", F.lit(i))) for i in range(len(columns))]
    return rows.select(
        *[F.when(value != "", value).alias(c) for value, c in zip(values, columns)],
        "source_file",
        F.struct("modified_at", "file_uri").alias("file_order"),
    )


def new_file_paths(spark: SparkSession, folder: str, since: datetime | None = None) -> list[str]:
    """Addresses of the folder's CSV files changed after ``since``, empty files included."""
    return [unquote(address) for address in _listing(spark, folder, since).inputFiles()]


def read_voter_files(
    spark: SparkSession, paths: list[str], threshold: float = EMPTY_ROW_THRESHOLD
) -> DataFrame:
    """All-text voter rows of the files. Every file is checked first: one bad file rejects all."""
    exact = [exact_path(path) for path in paths]
    lines = file_lines(spark.read.text(exact))
    described, records = survey(lines)
    gate = settled(_gate(spark, exact, described, threshold))
    _reject(gate)
    return voter_rows(lines, gate, records)


def read_voter_lines(lines: DataFrame, threshold: float = EMPTY_ROW_THRESHOLD) -> DataFrame:
    """The same for the lines of whole files, as a stream's batch brings them."""
    described, records = survey(lines)
    gate = _gate_columns(described, threshold)
    _reject(gate)
    return voter_rows(lines, gate, records)


def scan_as_headed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All-text rows with the columns that the files' headers name, nothing checked or left out."""
    lines = file_lines(spark.read.text([exact_path(path) for path in paths]))
    described, records = survey(lines)
    names = described.select(F.explode("header").alias("name")).where("name != ''").distinct().orderBy("name")
    columns = [row.name for row in names.collect()]  # names of columns, not of files
    return voter_rows(lines, described, records, columns).select(*[F.col(f"`{c}`") for c in columns])


def scan_voter_csv(
    spark: SparkSession,
    folder: str,
    since: datetime | None = None,
    threshold: float = EMPTY_ROW_THRESHOLD,
) -> DataFrame | None:
    """All-text voter rows of the folder's new files; None when there is no new file."""
    paths = new_file_paths(spark, folder, since)
    return read_voter_files(spark, paths, threshold) if paths else None

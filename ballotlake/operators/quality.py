"""Declarative data checks.

Every check counts its failing rows. All row checks of a table run in one aggregate pass;
uniqueness needs one grouped pass per key; column-list checks read no data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Contract


@dataclass(frozen=True)
class RowCheck:
    """Fails on the rows where ``passes`` is false; where it is null the row passes."""

    name: str
    column: str
    passes: Column

    def failing(self) -> Column:
        return F.count_if(~F.coalesce(self.passes, F.lit(True)))


@dataclass(frozen=True)
class KeyCheck:
    """Fails once per value (or combination) that occurs in more than one row."""

    name: str
    columns: tuple[str, ...]
    ignore_nulls: bool = True


@dataclass(frozen=True)
class RowCountCheck:
    """Fails once when the table's row count is outside the bounds."""

    least: int
    most: int
    name: str = "row_count_between"


@dataclass(frozen=True)
class ColumnsCheck:
    """Fails once when the columns are not exactly these, in this order."""

    columns: tuple[str, ...]
    name: str = "columns_match"


Check = RowCheck | KeyCheck | RowCountCheck | ColumnsCheck


def _only(where: Column | None, passes: Column) -> Column:
    return passes if where is None else F.when(where, passes)


def not_null(*columns: str) -> list[RowCheck]:
    return [RowCheck("not_null", c, F.col(c).isNotNull()) for c in columns]


def accepted_values(column: str, values: Sequence, where: Column | None = None) -> RowCheck:
    return RowCheck("accepted_values", column, _only(where, F.col(column).isin(*values)))


def between(column: str, least, most, where: Column | None = None) -> RowCheck:
    return RowCheck("between", column, _only(where, F.col(column).between(F.lit(least), F.lit(most))))


def matches(column: str, regex: str) -> RowCheck:
    return RowCheck("matches_regex", column, F.col(column).rlike(regex))


def length_equals(column: str, length: int) -> RowCheck:
    return RowCheck("length_equals", column, F.length(column) == length)


def length_between(column: str, least: int, most: int) -> RowCheck:
    return RowCheck("length_between", column, F.length(column).between(least, most))


def at_least(column: str, other: str, where: Column | None = None) -> RowCheck:
    return RowCheck("at_least", f"{column}>={other}", _only(where, F.col(column) >= F.col(other)))


def unique(*columns: str) -> list[KeyCheck]:
    return [KeyCheck("unique", (c,)) for c in columns]


def unique_combination(*columns: str) -> KeyCheck:
    return KeyCheck("unique_combination", columns, ignore_nulls=False)


def _row(name: str, column: str, total: Column, failing: Column) -> Column:
    failing = failing.cast("bigint")
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(column).alias("column_name"),
        total.cast("bigint").alias("total_rows"),
        failing.alias("failing_rows"),
        (failing == 0).alias("passed"),
    )


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, column, rows looked at, failing rows, passed."""
    checks = list(checks)
    total = F.col("_total")
    aggregates = [F.count(F.lit(1)).alias("_total")]
    rows, reports = [], []
    for i, check in enumerate(checks):
        if isinstance(check, RowCheck):
            aggregates.append(check.failing().alias(f"_c{i}"))
            rows.append(_row(check.name, check.column, total, F.col(f"_c{i}")))
        elif isinstance(check, RowCountCheck):
            outside = (~total.between(check.least, check.most)).cast("int")
            rows.append(_row(check.name, "*", total, outside))
        elif isinstance(check, ColumnsCheck):
            differs = int(list(check.columns) != df.columns)
            rows.append(_row(check.name, "*", total, F.lit(differs)))
        else:
            # Values are counted, and the table's rows too, in the one grouped pass.
            keys = [F.col(f"`{c}`") for c in check.columns]
            counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            repeated = F.col("_n") > 1
            if check.ignore_nulls:
                for k in keys:
                    repeated = repeated & k.isNotNull()
            summed = counted.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"), F.count_if(repeated).alias("_repeated")
            )
            report = _row(check.name, ",".join(check.columns), F.col("_total"), F.col("_repeated"))
            reports.append(summed.select(F.inline(F.array(report))))
    if rows:
        reports.insert(0, df.agg(*aggregates).select(F.inline(F.array(*rows))))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


# --- contracts -----------------------------------------------------------------------------------
class ContractError(ValueError):
    """A table does not keep its contract."""


def check_columns(df: DataFrame, contract: Contract) -> None:
    """Fail unless names, order and types are the contract's. Reads no data."""
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in contract.schema]
    if have != want:
        differing = [f"{h} instead of {w}" for h, w in zip(have, want) if h != w]
        raise ContractError(
            f"{contract.name}: {'; '.join(differing) or f'{len(have)} columns instead of {len(want)}'}"
        )


def contract_checks(contract: Contract) -> list[Check]:
    return [ColumnsCheck(tuple(contract.columns)), *not_null(*contract.required), *unique(*contract.unique)]


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's constraints as a check report."""
    return run_checks(df, contract_checks(contract))


def enforce_contract(df: DataFrame, contract: Contract, waived: Sequence[str] = ()) -> DataFrame:
    """``df`` itself, or :class:`ContractError` naming the broken constraints.

    ``waived`` names columns whose null check is skipped.
    """
    check_columns(df, contract)
    broken = [
        f"{r.check_name}({r.column_name}): {r.failing_rows}"
        for r in contract_report(df, contract).where(~F.col("passed")).collect()
        if not (r.check_name == "not_null" and r.column_name in waived)
    ]
    if broken:
        raise ContractError(f"{contract.name}: {'; '.join(sorted(broken))}")
    return df

"""Row-level checks derived from a contract, as boolean columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.contract import Contract
from tidewatch.functions import is_blank, to_number, to_utc_timestamp
from tidewatch.operators.tables import Tables

BLANK = "blank"
INVALID_TIMESTAMP = "invalid_timestamp"
INVALID_NUMERIC = "invalid_numeric_value"
OUT_OF_RANGE = "numeric_out_of_range"
DATE_ORDER = "invalid_date_order"
MISSING_KEY = "missing_unique_key"
MISSING_VALUE = "missing_required_value"
DUPLICATE_KEY = "duplicate_unique_key"


@dataclass(frozen=True)
class Check:
    """One yes/no question about a row; a null ``condition`` means no."""

    kind: str
    field: str
    condition: Column


def blank_checks(tables: Tables) -> list[Check]:
    """Is the value null or whitespace only? For every column the tables really have."""
    return [
        Check(BLANK, name, tables.where_present(is_blank(F.col(name), tables.dtype(name)), name))
        for name in tables.all_columns()
    ]


def type_checks(tables: Tables, contract: Contract) -> list[Check]:
    """Unreadable timestamps and numbers, and numbers out of range, in contract order."""
    checks = []
    present = tables.all_columns()
    for rule in contract.columns:
        if rule.name not in present:
            continue
        column, dtype = F.col(rule.name), tables.dtype(rule.name)
        filled = ~is_blank(column, dtype)
        if rule.datatype == "datetime":
            checks.append(
                Check(INVALID_TIMESTAMP, rule.name,
                      to_utc_timestamp(column, dtype).isNull() & filled)
            )
        elif rule.datatype == "numeric":
            number = to_number(column, dtype)
            checks.append(Check(INVALID_NUMERIC, rule.name, number.isNull() & filled))
            limits = []
            if rule.minimum is not None:
                limits.append(number < F.lit(rule.minimum))
            if rule.maximum is not None:
                limits.append(number > F.lit(rule.maximum))
            if limits:
                outside = limits[0] if len(limits) == 1 else limits[0] | limits[1]
                checks.append(Check(OUT_OF_RANGE, rule.name, outside))
    return checks


def date_order_checks(tables: Tables, contract: Contract) -> list[Check]:
    """Both dates readable and the later one before the earlier one."""
    rule = contract.date_order
    if rule is None:
        return []
    typed = {r.name for r in contract.columns if r.datatype == "datetime"}
    if not {rule.earlier, rule.later} <= typed & set(tables.all_columns()):
        return []
    earlier = to_utc_timestamp(F.col(rule.earlier), tables.dtype(rule.earlier))
    later = to_utc_timestamp(F.col(rule.later), tables.dtype(rule.later))
    return [Check(DATE_ORDER, rule.field, later < earlier)]


def own_checks(tables: Tables, contract: Contract) -> list[Check]:
    """The contract's own row checks, on tables that have their column."""
    present = tables.all_columns()
    return [
        Check(check.name, check.column, tables.where_present(F.expr(f"({check.fails_when})"), check.column))
        for check in contract.checks if check.column in present
    ]


def required_fields(tables: Tables, contract: Contract) -> list[str]:
    """Present columns that may not be empty, without the key column."""
    present = tables.all_columns()
    return [
        rule.name
        for rule in contract.columns
        if not rule.nullable and rule.name != contract.key and rule.name in present
    ]


def row_rejections(tables: Tables, contract: Contract) -> list[Check]:
    """All reasons a row can be rejected for on its own, in issue order."""
    blanks = {check.field: check for check in blank_checks(tables)}
    reasons = type_checks(tables, contract)
    if contract.key in blanks:
        reasons.append(Check(MISSING_KEY, contract.key, blanks[contract.key].condition))
    reasons += date_order_checks(tables, contract)
    reasons += [
        Check(MISSING_VALUE, name, blanks[name].condition)
        for name in required_fields(tables, contract)
    ]
    reasons += own_checks(tables, contract)
    return reasons

"""The data contract: a small driver-side description whose values become literals in plans."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

#: Names of the findings that checks of the library make.
BUILT_IN_FINDINGS = frozenset((
    "blank", "missing_required_column", "unexpected_column", "invalid_timestamp", "invalid_numeric_value",
    "numeric_out_of_range", "invalid_date_order", "missing_unique_key", "missing_required_value",
    "duplicate_unique_key", "missingness_threshold_exceeded", "volume_anomaly", "category_drift", "unexpected_category",
))
DEFAULT_CONTRACT_PATH = Path(__file__).with_name("contracts") / "service_requests.yaml"


@dataclass(frozen=True)
class ColumnRule:
    name: str
    datatype: str | None = None
    nullable: bool = True
    max_missing: float | None = None
    minimum: float | None = None
    maximum: float | None = None


@dataclass(frozen=True)
class DateOrder:
    earlier: str
    later: str
    condition: str

    @property
    def field(self) -> str:
        return f"{self.later}/{self.earlier}"


@dataclass(frozen=True)
class RowCheck:
    """A check of the user's own: rows for which the SQL expression ``fails_when`` holds fail.

    It counts as a finding on ``column`` (tables without that column skip it), rejects the row and
    takes ``penalty`` points from the score. A null result is no failure.
    """

    name: str
    column: str
    fails_when: str
    penalty: int = 10


@dataclass(frozen=True)
class Contract:
    columns: tuple[ColumnRule, ...] = ()
    required: tuple[str, ...] = ()
    key: str | None = None
    allow_unexpected: bool = True
    date_order: DateOrder | None = None
    dataset_id: str = "unknown"
    # Texts read as missing by the CSV source, next to null and blank.
    na_tokens: tuple[str, ...] = field(default=())
    checks: tuple[RowCheck, ...] = ()

    def __post_init__(self) -> None:
        names = [c.name for c in self.checks]
        clash = {n for n in names if names.count(n) > 1 or n in BUILT_IN_FINDINGS}
        if clash:
            raise ValueError(f"names of row checks must be new: {sorted(clash)}")

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> Contract:
        """Build from the declarative form. Keys without a meaning here are ignored."""
        rules = tuple(
            ColumnRule(
                name=name,
                datatype=rule.get("datatype"),
                nullable=bool(rule.get("nullable", True)),
                max_missing=_number(rule.get("max_missing_percentage")),
                minimum=_number(rule.get("minimum")),
                maximum=_number(rule.get("maximum")),
            )
            for name, rule in ((n, r or {}) for n, r in (raw.get("columns") or {}).items())
        )
        order = (raw.get("rules") or {}).get("date_order") or {}
        date_order = None
        if order.get("earlier_column") and order.get("later_column"):
            date_order = DateOrder(
                order["earlier_column"],
                order["later_column"],
                order.get("condition", "closed_date must not be earlier than created_date"),
            )
        return cls(
            columns=rules,
            required=tuple(raw.get("required_columns") or ()),
            key=raw.get("unique_key_column"),
            allow_unexpected=bool(raw.get("allow_unexpected_columns", True)),
            date_order=date_order,
            dataset_id=str((raw.get("dataset") or {}).get("id", "unknown")),
            na_tokens=tuple(raw.get("na_tokens") or ()),
            checks=tuple(
                RowCheck(c["name"], c["column"], c["fails_when"], int(c.get("penalty", 10)))
                for c in raw.get("checks") or ()
            ),
        )

    def rule(self, name: str) -> ColumnRule | None:
        return next((rule for rule in self.columns if rule.name == name), None)


def _number(value: Any) -> float | None:
    return None if value is None else float(value)


def load_contract(path: str | Path = DEFAULT_CONTRACT_PATH) -> Contract:
    """Read a YAML (or JSON) contract; anything but a mapping is an error."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        raw = json.loads(text)
    else:
        import yaml

        raw = yaml.safe_load(text)
    if not isinstance(raw, Mapping):
        raise ValueError("A contract file must hold a mapping.")
    return Contract.from_mapping(raw)

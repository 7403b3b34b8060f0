"""Column-set checks. They look at metadata only and start no job."""

from __future__ import annotations

from collections.abc import Iterable

from tidewatch.contract import Contract


def missing_columns(present: Iterable[str], contract: Contract) -> list[str]:
    """Required columns that are absent, in contract order."""
    present = set(present)
    return [name for name in contract.required if name not in present]


def unexpected_columns(present: Iterable[str], contract: Contract) -> list[str]:
    """Columns the contract does not define, in table order; none if it allows extras."""
    if contract.allow_unexpected:
        return []
    defined = {rule.name for rule in contract.columns}
    return [name for name in present if name not in defined]

"""Plain descriptions that parameterise the operators."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date, datetime

PERIOD_FORMATS = {"month": "%Y-%m", "day": "%Y-%m-%d"}
PARTITION_COLUMNS = ("processing_date", "granularity", "reference_period")


class ContractViolation(ValueError):
    """Input that breaks a declared contract."""


def exact_period(granularity: str, text: str) -> date:
    """First day of a period written exactly as its granularity demands."""
    if granularity not in PERIOD_FORMATS:
        raise ContractViolation(f"granularity must be day or month, not {granularity!r}")
    layout = PERIOD_FORMATS[granularity]
    try:
        day = datetime.strptime(text, layout)
    except (TypeError, ValueError) as error:
        raise ContractViolation(f"{text!r} is not a {granularity} period") from error
    if day.strftime(layout) != text:
        raise ContractViolation(f"{text!r} is not a zero-padded {granularity} period")
    return day.date()


@dataclass(frozen=True)
class Slice:
    """One processing run: all its periods, or a single one."""

    processing_date: str
    granularity: str
    reference_period: str | None = None

    def __post_init__(self):
        exact_period("day", self.processing_date)
        if self.granularity not in PERIOD_FORMATS:
            raise ContractViolation(f"granularity must be day or month, not {self.granularity!r}")
        if self.reference_period is not None:
            exact_period(self.granularity, self.reference_period)

    @property
    def folder(self) -> str:
        parts = [f"processing_date={self.processing_date}", f"granularity={self.granularity}"]
        if self.reference_period is not None:
            parts.append(f"reference_period={self.reference_period}")
        return "/".join(parts)

    def under(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.folder}"

    def at(self, period: str) -> "Slice":
        return Slice(self.processing_date, self.granularity, period)

    @classmethod
    def parse(cls, path: str, root: str | None = None) -> "Slice":
        """Read a slice off the end of a path; with ``root``, the path must lie under it."""
        found = re.search(
            r"(?P<root>.+?)/processing_date=(?P<d>[^/]+)/granularity=(?P<g>[^/]+)"
            r"(?:/reference_period=(?P<p>[^/]+))?$",
            path.rstrip("/"),
        )
        if not found:
            raise ContractViolation(f"{path} does not follow the partition layout")
        if root is not None and found["root"] != root.rstrip("/"):
            raise ContractViolation(f"{path} is outside {root}")
        return cls(found["d"], found["g"], found["p"])


@dataclass(frozen=True)
class ColumnSpec:
    """One output column of a typed projection."""

    name: str
    source: str
    kind: str = "text"  # text, upper, lower, int, date, timestamp


@dataclass(frozen=True)
class Rule:
    """A code raised on every row for which the SQL predicate is true."""

    code: str
    predicate: str


@dataclass(frozen=True)
class Flag:
    """A three-valued flag: true, else false, else unknown."""

    name: str
    true_when: str
    false_when: str


@dataclass(frozen=True)
class JunkDimension:
    """Attribute combinations under a hashed key."""

    table: str
    key: str
    attributes: tuple[str, ...]
    key_attributes: tuple[str, ...]
    unknown: dict = field(default_factory=dict)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class MonthlyView:
    """A monthly sum over the enriched cases: output name of a key to its input column."""

    name: str
    keys: dict
    measures: tuple[str, ...]


def require_columns(available, needed, dataset: str) -> None:
    missing = sorted(set(needed) - set(available))
    if missing:
        raise ContractViolation(f"Missing required {dataset} columns: {', '.join(missing)}")

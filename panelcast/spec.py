"""Declarative description of a daily panel.

A panel has one row per (entity, day) plus numeric measures. A ``PanelSpec`` names the
columns and the derived features once; feature building, training, scoring and the
reports all read the same spec, so training and serving cannot drift apart.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Lag:
    """Value of ``column`` on the row ``rows`` before this one."""

    column: str
    rows: int
    alias: str


@dataclass(frozen=True)
class Rolling:
    """``fn`` ("avg" or "sum") over the last ``rows`` rows, the current one included."""

    column: str
    fn: str
    rows: int
    alias: str


@dataclass(frozen=True)
class Delta:
    """Current value minus the previous row's value."""

    column: str
    alias: str


@dataclass(frozen=True)
class Target:
    """Value ``horizon`` rows ahead; with a threshold, the 0/1 flag ``value >= threshold``."""

    column: str
    horizon: int
    alias: str
    threshold: float | None = None


@dataclass(frozen=True)
class Roles:
    """Which measure plays which part in summaries, labels and reports."""

    level: str
    high: str
    low: str
    amount: str
    humidity: str
    wind: str
    pressure: str
    cover: str
    amount_total: str
    pressure_change: str


@dataclass(frozen=True)
class PanelSpec:
    entity: str
    day: str
    measures: tuple[str, ...]
    lags: tuple[Lag, ...]
    rollings: tuple[Rolling, ...]
    deltas: tuple[Delta, ...]
    targets: tuple[Target, ...]
    exclude: tuple[str, ...]
    roles: Roles
    threshold: float
    last_train_year: int
    cover_bands: tuple[float, float] = (70.0, 35.0)

    @property
    def key(self) -> list[str]:
        return [self.entity, self.day]

    @property
    def lookback(self) -> int:
        """Rows before the current one that any feature needs."""
        return max(
            [lag.rows for lag in self.lags]
            + [r.rows - 1 for r in self.rollings]
            + [1 for _ in self.deltas],
            default=0,
        )

    @property
    def horizon(self) -> int:
        """Rows after the current one that any target needs."""
        return max([t.horizon for t in self.targets], default=0)

    @property
    def value_target(self) -> Target:
        return next(t for t in self.targets if t.threshold is None)

    @property
    def flag_target(self) -> Target:
        return next(t for t in self.targets if t.threshold is not None)

    def schema(self) -> T.StructType:
        """Explicit reader schema: entity string, day date, measures double."""
        return T.StructType(
            [T.StructField(self.entity, T.StringType()), T.StructField(self.day, T.DateType())]
            + [T.StructField(m, T.DoubleType()) for m in self.measures]
        )

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> PanelSpec:
        raw = json.loads(text)
        raw["lags"] = tuple(Lag(**x) for x in raw["lags"])
        raw["rollings"] = tuple(Rolling(**x) for x in raw["rollings"])
        raw["deltas"] = tuple(Delta(**x) for x in raw["deltas"])
        raw["targets"] = tuple(Target(**x) for x in raw["targets"])
        raw["roles"] = Roles(**raw["roles"])
        for name in ("measures", "exclude", "cover_bands"):
            raw[name] = tuple(raw[name])
        return cls(**raw)

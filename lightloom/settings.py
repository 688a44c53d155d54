"""Settings of a run from TOML: groups of named values with defaults; an unknown name is an error."""

from __future__ import annotations

import dataclasses
import tomllib
from pathlib import Path
from typing import Any


@dataclasses.dataclass(frozen=True)
class Matching:
    arcsec: float = 1.0
    min_presence: float = 0.8


@dataclasses.dataclass(frozen=True)
class Reference:
    min_snr: float = 15.0
    isolation_arcsec: float = 5.0
    min_stars: int = 20
    max_dropped_share: float = 0.3


@dataclasses.dataclass(frozen=True)
class Search:
    durations_h: tuple[float, ...] = (0.4, 2.5)
    least_snr: float = 6.0
    too_deep: float = 0.3
    step_gain: float = 3.0


@dataclasses.dataclass(frozen=True)
class Periods:
    shortest: float = 0.02
    longest: float = 100.0
    most_frequencies: int = 200_000
    long: float = 1.0
    window: float = 0.05


@dataclasses.dataclass(frozen=True)
class Settings:
    matching: Matching = Matching()
    reference: Reference = Reference()
    search: Search = Search()
    periods: Periods = Periods()


def updated(group: Any, values: dict[str, Any], at: str = "") -> Any:
    """A group of settings with some of its values replaced, groups within it too; lists become tuples, whole numbers fit real ones."""
    known = {f.name: getattr(group, f.name) for f in dataclasses.fields(group)}
    changes = {}
    for name, v in values.items():
        if name not in known:
            raise ValueError(f"unknown setting {at}{name}; known are {', '.join(known)}")
        old = known[name]
        if dataclasses.is_dataclass(old):
            if not isinstance(v, dict):
                raise ValueError(f"{at}{name} is a group")
            changes[name] = updated(old, v, f"{at}{name}.")
            continue
        v = tuple(v) if isinstance(v, list) else float(v) if isinstance(old, float) and type(v) is int else v
        if type(v) is not type(old):
            raise ValueError(f"{at}{name} must be {type(old).__name__}, not {type(v).__name__}")
        changes[name] = v
    return dataclasses.replace(group, **changes)


def load(path: str | Path) -> Settings:
    with open(path, "rb") as f:
        return updated(Settings(), tomllib.load(f))


def as_dict(settings: Settings) -> dict[str, Any]:
    return dataclasses.asdict(settings)

"""Run settings: date window, fleets, sampling sizes."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from faremill.contract import FLEETS, TARGET


@dataclass(frozen=True)
class Settings:
    data_start: date
    train_end: date
    val_end: date
    data_end: date
    fleets: tuple[str, ...] = FLEETS
    grain: str = "month"
    zone_lookup: bool = False
    eda_sample_limit: int = 10_000
    eda_sample_seed: int = 42
    train_sample_limit: int | None = None  # None trains on every row of the split
    target: str = TARGET

    def __post_init__(self) -> None:
        if not self.data_start <= self.train_end < self.val_end < self.data_end:
            raise ValueError("dates must satisfy data_start <= train_end < val_end < data_end")
        unknown = [fleet for fleet in self.fleets if fleet not in FLEETS]
        if unknown or not self.fleets:
            raise ValueError(f"fleets must be taken from {', '.join(FLEETS)}; got {self.fleets}")
        if self.grain not in ("month", "week"):
            raise ValueError("grain must be month or week")
        if self.target != TARGET:
            raise ValueError(f"only the target {TARGET} is supported")

    @property
    def split_ranges(self) -> dict[str, tuple[date, date]]:
        day = date.resolution
        return {
            "train": (self.data_start, self.train_end),
            "validation": (self.train_end + day, self.val_end),
            "test": (self.val_end + day, self.data_end),
        }

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        set_values = {name: value for name, value in env.items() if value != ""}

        def positive(name: str, default: int | None) -> int | None:
            if name not in set_values:
                return default
            number = int(set_values[name])
            if number <= 0:
                raise ValueError(f"{name} must be positive")
            return number

        def flag(name: str) -> bool:
            word = set_values.get(name, "false").strip().lower()
            if word in ("1", "true", "yes", "y", "on"):
                return True
            if word in ("0", "false", "no", "n", "off"):
                return False
            raise ValueError(f"{name} must be a yes/no value")

        def day(name: str, default: str) -> date:
            return date.fromisoformat(set_values.get(name, default))

        wanted = [part.strip().lower() for part in set_values.get("TRIP_TYPE", "yellow").split(",")]
        return cls(
            data_start=day("DATA_START_DATE", "2025-01-01"),
            train_end=day("TRAIN_END_DATE", "2025-01-21"),
            val_end=day("VAL_END_DATE", "2025-01-27"),
            data_end=day("DATA_END_DATE", "2025-01-31"),
            fleets=tuple(dict.fromkeys(part for part in wanted if part)) or ("yellow",),
            grain=set_values.get("TRAINING_BATCH_GRAIN", "month").strip().lower(),
            zone_lookup=flag("ENABLE_ZONE_LOOKUP"),
            eda_sample_limit=positive("EDA_SAMPLE_LIMIT", 10_000),
            eda_sample_seed=positive("EDA_SAMPLE_SEED", 42),
            train_sample_limit=positive("TRAIN_SAMPLE_LIMIT", None),
            target=set_values.get("MODEL_TARGET", TARGET),
        )

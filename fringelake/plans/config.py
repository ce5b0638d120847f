"""Settings of a run, checked when they are made."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from hashlib import sha256


@dataclass(frozen=True)
class Settings:
    grid_size: float = 100.0
    filter_size: int = 32
    low_pass: float = 800.0
    wraps: float = 1.0
    percent_random: float = 20.0
    random_rows: int = 300_000
    weed_std: float = 1.2
    weed_max: float = 3.2
    weed_window: float = 730.0
    drop: tuple[int, ...] = ()
    reference_lon: float | None = None
    reference_lat: float | None = None
    reference_radius: float = float("inf")
    scn_wavelength: float = 100.0
    scn_window: float = 365.0
    wavelength: float = 0.05546576
    iterations: int = 25
    settled: float = 1e-4
    reject_deviation: float = 0.0
    reestimate: bool = True
    qc_share: float = 0.05

    def __post_init__(self):
        for name in ("grid_size", "wraps", "weed_window", "scn_wavelength", "scn_window", "wavelength", "reference_radius", "low_pass", "settled"):
            if not getattr(self, name) > 0:
                raise ValueError(f"{name} must be above zero")
        if not 0 < self.percent_random < 100:
            raise ValueError("percent_random must be between 0 and 100")
        if not 0 <= self.qc_share < 1:
            raise ValueError("qc_share must be from 0 to below 1")
        if self.iterations < 1 or self.filter_size < 8 or self.filter_size % 8:
            raise ValueError("iterations must be 1 at least, filter_size a multiple of 8")
        if self.reject_deviation < 0:
            raise ValueError("reject_deviation must not be below nought")

    @staticmethod
    def load(path: str | None = None, **given) -> Settings:
        """Given values over those of a JSON file over the defaults; unknown names are errors."""
        stored = {}
        if path:
            with open(path, encoding="utf-8") as file:
                stored = json.load(file)
        merged = stored | given
        unknown = set(merged) - {f.name for f in fields(Settings)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return Settings(**{k: tuple(v) if isinstance(v, list) else v for k, v in merged.items()})

    def fingerprint(self) -> str:
        return sha256(json.dumps(asdict(self), sort_keys=True, default=str).encode()).hexdigest()[:16]


@dataclass
class Report:
    """What a run did: stage, state (done, kept, planned), rows of its main table."""

    stages: list[tuple[int, str, int]] = field(default_factory=list)

    def add(self, stage: int, state: str, rows: int = -1) -> None:
        self.stages.append((stage, state, rows))

    def frame(self, spark):
        return spark.createDataFrame(self.stages, "stage int, state string, rows long")

"""Parameters of the engine, validated when they are made."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields


def _known(cls, values: dict):
    extra = set(values) - {f.name for f in fields(cls)}
    if extra:
        raise ValueError(f"{cls.__name__}: unknown {', '.join(sorted(extra))}")
    return cls(**values)


@dataclass(frozen=True)
class TimeControls:
    """Classes by estimated duration, base + increment_weight * increment, each up to its bound in seconds."""

    increment_weight: int = 40
    bounds: tuple[tuple[str, int], ...] = (("ultrabullet", 29), ("bullet", 179), ("blitz", 479), ("rapid", 1499), ("classical", 21599))
    supported: tuple[str, ...] = ("blitz", "rapid")
    collected: tuple[str, ...] = ("blitz", "rapid", "classical")

    def __post_init__(self):
        limits = [b for _, b in self.bounds]
        if limits != sorted(set(limits)):
            raise ValueError("class bounds must rise")
        names = {n for n, _ in self.bounds}
        if not set(self.supported) <= set(self.collected) <= names:
            raise ValueError("supported classes must be collected, and collected ones known")


@dataclass(frozen=True)
class Clock:
    premove_max_s: float = 0
    noise_tolerance_s: float = 1
    berserk_tolerance_s: float = 1
    low_clock_s: tuple[tuple[str, float], ...] = (("blitz", 10), ("rapid", 20), ("classical", 30))


@dataclass(frozen=True)
class Acceptability:
    tau_win_pct: float = 5.0
    win_pct_k: float = 0.00368208
    cp_ceiling: int = 1000

    def __post_init__(self):
        if self.tau_win_pct < 0 or self.win_pct_k <= 0 or self.cp_ceiling <= 0:
            raise ValueError("acceptability bounds must be positive")


@dataclass(frozen=True)
class Filter:
    min_elo: int = 400
    max_elo: int = 3500
    require_clock: bool = True
    min_month: str = "2019-01"
    exclude_titles: tuple[str, ...] = ("BOT",)
    exclude_terminations: tuple[str, ...] = ("Abandoned",)

    def __post_init__(self):
        if self.min_elo > self.max_elo or not re.fullmatch(r"\d{4}-\d{2}", self.min_month):
            raise ValueError("bad rating range or month")


@dataclass(frozen=True)
class Sampling:
    positions_per_game: int = 3
    min_ply: int = 10
    rating_band_width: int = 100
    ply_bucket_edges: tuple[int, ...] = (20, 40, 60)
    exclude_premove_suspect: bool = True
    exclude_berserk: bool = True
    endgame_max_pieces: int = 6
    opening_min_pieces: int = 11
    opening_max_ply: int = 30
    decisive_win_pct: float = 90.0
    target_positions: int = 200_000

    def __post_init__(self):
        edges = list(self.ply_bucket_edges)
        if edges != sorted(set(edges)) or (edges and edges[0] <= self.min_ply):
            raise ValueError("ply buckets must rise from above min_ply")
        if self.endgame_max_pieces >= self.opening_min_pieces:
            raise ValueError("an endgame has fewer pieces than an opening")


@dataclass(frozen=True)
class Categories:
    sharp_max_acceptable: int = 2
    many_min_acceptable: int = 4
    tactical_min_win_pct: float = 60
    defensive_max_win_pct: float = 40

    def __post_init__(self):
        if self.sharp_max_acceptable >= self.many_min_acceptable or self.defensive_max_win_pct >= self.tactical_min_win_pct:
            raise ValueError("category bounds overlap")


@dataclass(frozen=True)
class Budget:
    quantile: float = 0.5
    strict_quantile: float = 0.3
    clip_s: tuple[tuple[str, float, float], ...] = (("blitz", 3, 60), ("rapid", 3, 180))
    grid: tuple[int, int, int] = (400, 3000, 50)
    exclude_low_clock: bool = True
    min_successes: int = 200
    window_step: int = 50
    max_half_width: int = 400

    def __post_init__(self):
        if not 0 < self.strict_quantile < self.quantile < 1:
            raise ValueError("the strict quantile must be the smaller one")
        lo, hi, step = self.grid
        if step <= 0 or lo > hi:
            raise ValueError("empty rating grid")


@dataclass(frozen=True)
class Config:
    seed: int = 20261001
    time_controls: TimeControls = field(default_factory=TimeControls)
    clock: Clock = field(default_factory=Clock)
    acceptability: Acceptability = field(default_factory=Acceptability)
    filter: Filter = field(default_factory=Filter)
    sampling: Sampling = field(default_factory=Sampling)
    categories: Categories = field(default_factory=Categories)
    budget: Budget = field(default_factory=Budget)
    min_knodes: int = 1000
    multipv: int = 5
    puzzle_band_width: int = 200
    position_states: tuple[str, ...] = ("balanced",)
    rating_offset: int = 300
    default_rating: int = 1500

    def __post_init__(self):
        clipped = {c for c, _, _ in self.budget.clip_s}
        if missing := set(self.time_controls.supported) - clipped:
            raise ValueError(f"no clip bounds for {', '.join(sorted(missing))}")

    @classmethod
    def from_dict(cls, values: dict) -> Config:
        """A Config from nested plain values; unknown keys are refused."""
        nested = {f.name: f.default_factory for f in fields(cls) if f.default_factory.__class__ is type}
        out = dict(values)
        for name, kind in nested.items():
            if name in out:
                inner = {k: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v for k, v in out[name].items()}
                out[name] = _known(kind, inner)
        return _known(cls, out)

    @classmethod
    def from_json(cls, path: str) -> Config:
        import json

        with open(path) as f:
            return cls.from_dict(json.load(f))

    @classmethod
    def from_file(cls, path: str) -> Config:
        """YAML by its ending, which needs PyYAML, else JSON. An empty file has the defaults."""
        if not path.endswith((".yaml", ".yml")):
            return cls.from_json(path)
        import yaml

        with open(path) as f:
            return cls.from_dict(yaml.safe_load(f) or {})


@dataclass(frozen=True)
class Settings:
    """Paths, each overridden by TICKMILL_<NAME> in the environment."""

    raw: str = "data/raw"
    interim: str = "data/interim"
    processed: str = "data/processed"
    database: str = "data/app"
    evaluator: str = ""

    @classmethod
    def from_env(cls, env=os.environ) -> Settings:
        return cls(**{f.name: env[k] for f in fields(cls) if (k := f"TICKMILL_{f.name.upper()}") in env})

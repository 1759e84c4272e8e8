"""Experiment parameters: immutable, with defaults, overridden by name."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Params:
    channels: tuple[str, ...] = ("c1", "c2", "c3", "c4")
    rounds: int = 4
    morphology_round: int | None = None
    downsample: int = 2
    ties: str = "median"
    signal_percentile: float = 0.9
    clamp_percentile: float = 0.999
    max_hamming: int = 2
    puncta_size_min: int = 30
    puncta_size_max: int = 2000
    max_missing_rounds: int = 2
    least_matches: int = 20
    voxel: tuple[float, float, float] = (0.165, 0.165, 0.4)
    seed: int = 0

    @classmethod
    def override(cls, text: str = "", **values: object) -> Params:
        """Defaults with ``A=1,B=2`` pairs and keywords; unknown names raise."""
        kinds = {f.name: f.default for f in fields(cls)}
        for pair in filter(None, text.split(",")):
            name, raw = pair.split("=", 1)
            name = name.strip().lower()
            if name not in kinds:
                raise KeyError(name)
            kind = type(kinds[name])
            values[name] = int(raw) if kinds[name] is None else kind(raw) if kind in (int, float, str) else tuple(raw.split("|"))
        return replace(cls(), **values)

"""Settings of a run, from a mapping of names to texts such as the environment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

# Texts that are read as yes.
YES = ("1", "true", "yes", "y", "on")


def flag(text: str | None, default: bool) -> bool:
    return default if text is None or not text.strip() else text.strip().lower() in YES


def number(text: str | None, default, kind=int):
    try:
        return kind(text)
    except (TypeError, ValueError):
        return default


@dataclass(frozen=True)
class Config:
    n_answers: int = 4
    score_max_retries: int = 3
    gen_max_retries: int = 5
    gen_max_tokens: int = 1200
    qc_blind_votes: int = 2
    qc_tiebreak_votes: int = 1
    qc_max_rounds: int = 3
    qc_backtracks: int = 3
    refine_max_rounds: int = 3
    multiplier: float = 26.0
    n_min: int = 10
    n_max: int = 50
    balance: float = 0.3
    plan_use_full_scene_domains: bool = False
    run_validation: bool = True
    run_refinement: bool = True
    stage_force: bool = False

    @classmethod
    def read(cls, given: Mapping[str, str]) -> Config:
        """Each field from the name in capitals; what is missing or unreadable keeps its default."""
        read = {bool: flag, int: number, float: lambda t, d: number(t, d, float)}
        return cls(**{f.name: read[type(f.default)](given.get(f.name.upper()), f.default) for f in fields(cls)})

"""Settings of a run, checked before it starts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from numbers import Real

#: The weights of the signals, and the thresholds.
WEIGHTS = {"domain": 30.0, "favicon": 14.0, "ssl": 12.0, "page": 6.0, "domain_hash": 8.0, "keywords": 10.0}
SMOKE_TESTS = ("off", "fetch", "lexical", "score", "classify", "all")


def number(name: str, value, low: float = 0.0, high: float = float("inf")) -> float:
    if not isinstance(value, Real) or isinstance(value, bool) or not low <= value <= high:
        raise ValueError(f"{name} must be a number in [{low:g}, {high:g}]")
    return float(value)


def whole(name: str, value, least: int = 0) -> int:
    if int(number(name, value)) != value or value < least:
        raise ValueError(f"{name} must be a whole number of at least {least}")
    return int(value)


def one_of(name: str, value: str, allowed: Sequence[str]) -> str:
    text = str(value).strip().lower()
    if text not in allowed:
        raise ValueError(f"{name} must be one of {sorted(allowed)}")
    return text


@dataclass(frozen=True)
class Scoring:
    """Weights and thresholds of the scoring; what isn't given has its default, what can't be is refused."""

    weights: Mapping[str, float] = field(default_factory=dict)
    domain_similarity: float = 0.75
    high_confidence: float = 78.0
    medium_confidence: float = 68.0
    typo_top_k: int = 10
    typo_least: float = 0.75
    lexical_pass: float = 0.85

    def __post_init__(self):
        for name in ("domain_similarity", "typo_least", "lexical_pass"):
            number(name, getattr(self, name), high=1.0)
        for name in ("high_confidence", "medium_confidence"):
            number(name, getattr(self, name), high=100.0)
        if self.high_confidence < self.medium_confidence:
            raise ValueError("high_confidence must not be below medium_confidence")
        whole("typo_top_k", self.typo_top_k, 1)
        if unknown := sorted(set(self.weights) - set(WEIGHTS)):
            raise ValueError(f"unknown weights: {unknown}; known: {sorted(WEIGHTS)}")
        full = {n: number(f"weight {n}", w) for n, w in {**WEIGHTS, **self.weights}.items()}
        if sum(full.values()) <= 0:
            raise ValueError("the weights must not all be 0")
        object.__setattr__(self, "weights", full)

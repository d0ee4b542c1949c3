"""Settings of a collection run and the ranges that are accepted."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

#: Versions that take part in the profile, so that results of other versions are never reused.
PIPELINE, ALGORITHMS = "news-fragments-v1", {1: "word-overlap-v1", 2: "cluster-overlap-v1"}


def _within(name: str, value: int, low: int, high: int, step: int = 1) -> None:
    if not low <= value <= high or (value - low) % step:
        raise ValueError(f"{name} must be in {low}..{high}" + f" by {step}" * (step > 1))


@dataclass(frozen=True)
class Settings:
    types: tuple[int, ...] = (1, 2)
    type2_min_overlap: int = 4
    type2_max_position_gap: int = 10
    type2_search_budget: int = 20_000
    type2_best_effort: bool = False
    type2_best_effort_min_overlap: int = 2
    languages: tuple[str, ...] = ()
    domains: tuple[str, ...] = ()
    keep_artifacts: bool = False
    quarantine_invalid_metadata: bool = False
    threads: int = 0
    max_expanded_mib: int = 512
    max_line_bytes: int = 1 << 20
    max_fragments: int = 2_000_000
    max_article_fragments: int = 100_000
    max_fragment_units: int = field(default=256)

    def __post_init__(self) -> None:
        kinds = tuple(sorted(set(self.types)))
        if not kinds or not set(kinds) <= {1, 2}:
            raise ValueError("types must be a non-empty subset of 1 and 2")
        languages = tuple(sorted(set(self.languages)))
        if any(not x.strip() for x in languages):
            raise ValueError("a language must not be empty")
        domains = tuple(sorted({d.strip().rstrip(".").lower() for d in self.domains}))
        if any(not d or "/" in d or ":" in d for d in domains):
            raise ValueError("a domain is a host name without scheme, port or path")
        _within("type2_min_overlap", self.type2_min_overlap, 1, 256)
        _within("type2_max_position_gap", self.type2_max_position_gap, 0, 90, 10)
        _within("type2_search_budget", self.type2_search_budget, 0, 1_000_000)
        _within("type2_best_effort_min_overlap", self.type2_best_effort_min_overlap, 1, 256)
        _within("threads", self.threads, 0, 256)
        _within("max_expanded_mib", self.max_expanded_mib, 1, 65_536)
        _within("max_fragments", self.max_fragments, 1, 1 << 62)
        _within("max_article_fragments", self.max_article_fragments, 1, 2_000_000)
        for name, value in (("types", kinds), ("languages", languages), ("domains", domains)):
            object.__setattr__(self, name, value)

    def profile(self) -> str:
        """16 hex digits that name all settings and versions that results depend on; threads are no part of it."""
        known = {k: v for k, v in asdict(self).items() if k != "threads"}
        text = json.dumps([PIPELINE, ALGORITHMS, known], sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(text.encode()).hexdigest()[:16]


@dataclass(frozen=True)
class CollectSettings:
    downloads: int = 4
    attempts: int = 4
    max_download_mib: int = 128
    min_free_gib: int = 2

    def __post_init__(self) -> None:
        _within("downloads", self.downloads, 1, 32)
        _within("attempts", self.attempts, 1, 8)
        _within("max_download_mib", self.max_download_mib, 1, 4096)
        _within("min_free_gib", self.min_free_gib, 0, 65_536)

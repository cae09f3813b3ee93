"""Settings of a curation run: one frozen record, made from the environment or by hand, with the clock as a value."""

from __future__ import annotations

import datetime as dt
import math
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

STEPS = ("adult", "size", "dead", "normalize", "enrich", "dedupe")
MIB = 1024 * 1024


def read_env_file(text: str) -> dict[str, str]:
    """NAME=value lines; the first definition wins, ``export`` and quotes are dropped, as are comments after a blank."""
    out: dict[str, str] = {}
    for line in text.splitlines():
        m = re.match(r"\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*\Z", line)
        if not m:
            continue
        value = m[2]
        if value[:1] in "\"'" and value[:1] and value[0] in value[1:]:
            value = value[1 : value.index(value[0], 1)]
        else:
            value = re.sub(r"\s+#.*\Z", "", value)
        out.setdefault(m[1], value)
    return out


def as_bool(value: str | None, default: bool) -> bool:
    low = (value or "").strip().lower()
    return True if low in ("1", "true", "yes", "on", "si", "sí") else False if low in ("0", "false", "no", "off") else default


def as_int(value: str | None, default: int, low: int | None = None, high: int | None = None) -> int:
    return int(as_float(value, default, low, high))


def as_float(value: str | None, default: float, low: float | None = None, high: float | None = None) -> float:
    try:
        x = float(value) if value not in (None, "") else default
    except ValueError:
        x = default
    x = x if math.isfinite(x) else default
    x = x if low is None else max(x, low)
    return x if high is None else min(x, high)


def as_ratio(value: str | None, default: float) -> float:
    """A share; above 1 it is a percentage, below 0 the default."""
    x = as_float(value, default)
    x = x / 100 if x > 1 else x
    return default if x < 0 else min(x, 1.0)


def choose_steps(value: str | None) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(known steps in their own order, unknown names)."""
    asked = [s.strip().lower() for s in (value or "").split(",") if s.strip()]
    return tuple(s for s in STEPS if not asked or s in asked), tuple(s for s in asked if s not in STEPS)


@dataclass(frozen=True)
class Config:
    as_of: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    steps: tuple[str, ...] = STEPS
    unknown_steps: tuple[str, ...] = ()
    clean_title_column: str = "title_text"
    dry_run: bool = True
    log_samples: int = 5
    continue_on_error: bool = False
    max_delete_ratio: float = 0.95
    guard_min_rows: int = 10
    min_movie_bytes: int = 150 * MIB
    min_series_bytes: int = 30 * MIB
    size_covers_anime: bool = True
    size_includes_zero: bool = False
    stale_days: int = 30
    stale_includes_null: bool = False
    extra_keywords: tuple[str, ...] = ()
    overwrite_type: bool = False
    overwrite_episodes: bool = False
    merge_title_languages: bool = True
    type_confidence: float = 0.8
    max_lookups: int = 300
    min_similarity: float = 0.6
    tmdb_for_anime: bool = True
    has_tmdb: bool = True
    recheck_days: int = 14
    max_attempts: int = 3
    other_language_policy: str = "delete"
    unknown_language_as: str = "english"
    title_fallback: bool = True
    popularity_weight: float = 20.0
    audio_tie_margin: float = 10.0

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **fixed) -> Config:
        """Settings by upper-case names (``MAX_DELETE_RATIO``, ``STEPS``, ...); values out of range are clamped."""
        env = os.environ if env is None else env
        given: dict = {}
        for f in fields(cls):
            value = env.get(f.name.upper())
            if value is None or f.name in ("as_of", "steps", "unknown_steps"):
                continue
            d = f.default
            if f.name.endswith("_ratio") or f.name in ("min_similarity", "type_confidence"):
                given[f.name] = as_ratio(value, d)
            elif isinstance(d, bool):
                given[f.name] = as_bool(value, d)
            elif isinstance(d, int):
                given[f.name] = as_int(value, d, 0)
            elif isinstance(d, float):
                given[f.name] = as_float(value, d, 0.0)
            elif isinstance(d, tuple):
                given[f.name] = tuple(x.strip() for x in value.split(",") if x.strip())
            else:
                given[f.name] = value.strip()
        given["steps"], given["unknown_steps"] = choose_steps(env.get("STEPS"))
        return cls(**(given | fixed))

    def problems(self) -> list[str]:
        """What keeps the run from starting."""
        out = [f"unknown step: {s}" for s in self.unknown_steps]
        if not re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", self.clean_title_column):
            out.append(f"not a column name: {self.clean_title_column}")
        if self.other_language_policy not in ("delete", "keep"):
            out.append("other_language_policy is delete or keep")
        if self.unknown_language_as not in ("english", "spanish", "keep"):
            out.append("unknown_language_as is english, spanish or keep")
        return out

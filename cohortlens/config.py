"""Numbers and lists that are part of the semantics; every operator takes them as parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # Fixed values.
    recent_days: int = 180
    min_cohort: int = 25
    min_salaries: int = 10
    min_annual: float = 10_000
    max_annual: float = 1_000_000
    currencies: tuple[str, ...] = ("USD", "EUR", "GBP")
    full_text_min_chars: int = 1000
    aggregators: tuple[str, ...] = ("adzuna", "jsearch")
    excerpt_only: tuple[str, ...] = ("adzuna",)
    max_posting_chars: int = 12_000
    keep_chars: int = 1000
    max_attempts: int = 3
    max_years: int = 40
    max_skill_chars: int = 80
    chars_per_token: float = 4.8
    tokens_per_minute: int = 15_000
    requests_per_minute: int = 25
    daily_cap: int = 13_000
    golden_chars: int = 3500
    top_names: int = 400
    pivot_min_peak: float = 0.10
    pivot_limit: int = 20
    cohort_rows: int = 30
    comparison_rows: int = 22
    shared_floor: float = 0.25
    other: str = "other"
    unclear: str = "unclear"
    not_mentioned: str = "not_mentioned"


DEFAULT = Config()

"""Plain dataclasses that parameterize the stages.

Everything here becomes a literal in a Column expression (or a small rules
table); nothing in it grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

# Matching thresholds every stage has to agree on.
TITLE_MERGE_RATIO = 88.0
TITLE_AMBIGUOUS_RATIO = 80.0
VENUE_MATCH_RATIO = 85.0
LEDGER_TITLE_RATIO = 92.0
MAX_START_GAP_MINUTES = 90
UNKNOWN_SOURCE_PRIORITY = 1000
NATIVE_TYPE_POINTS = 4.0
URL_PATTERN_POINTS = 3.0
PINNED_BONUS = 100.0
DESCRIPTION_LIMIT = 400
GROUP_DESCRIPTION_TITLES = 3
MIN_PREFIX_KEYWORD_LENGTH = 5
RUN_LOG_KEEP = 30
DISABLE_AFTER_FAILURES = 5
DISABLE_DAYS = 7
DRIFT_MIN_PREVIOUS_COUNT = 10
ASSIST_MIN_DESCRIPTION = 200

# Day keys, Monday first.
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")

# The order in which score terms are added.
SCORE_TERMS = (
    "category_weight",
    "keyword_boosts",
    "free_bonus",
    "cheap_bonus",
    "same_district_bonus",
    "distance_penalty",
    "novelty_bonus",
    "soon_bonus",
    "weekday_weight",
    "pinned_bonus",
)


# The keys that each section of a configuration may hold; ""
# stands for the top level. Sections of free names (categories, sources) are
# checked one level deeper.
CONFIG_KEYS = {
    "": ("schedule", "fetch", "categories", "min_category_score", "fallback_category", "grouping", "recurrence", "night_shift", "newsletter", "llm", "delivery", "site", "home", "scoring", "filters", "sources"),
    "schedule": ("timezone", "horizon_days"),
    "grouping": ("collapse_by", "min_group_size", "max_per_venue"),
    "recurrence": ("series_threshold_days", "series_behavior", "run_behavior"),
    "night_shift": ("before_hour",),
    "newsletter": ("per_category_limit", "total_limit", "send_when_empty", "expiring_section", "ledger_records"),
    "newsletter.expiring_section": ("enabled", "within_days"),
    "llm": ("enabled", "provider", "model", "batch_size", "max_calls_per_run", "on_quota_error", "only_for"),
    "site": ("base_url", "base_path", "archive_keep_days"),
    "home": ("district", "lat", "lon"),
    "scoring": ("category_weights", "keyword_boosts", "free_bonus", "cheap_bonus", "proximity", "novelty_bonus", "soon_bonus", "weekday_weights"),
    "scoring.cheap_bonus": ("under_huf", "points"),
    "scoring.soon_bonus": ("within_days", "points"),
    "scoring.proximity": ("same_district_bonus", "penalty_cap_km", "distance_penalty_per_km"),
    "filters": ("categories", "max_price_huf", "blocked_keywords", "min_score", "geo"),
    "filters.geo": ("city", "allow_missing_city", "max_distance_km"),
    "categories.*": ("keywords", "venue_prior", "url_patterns", "native_types"),
}


def check_keys(data: Mapping[str, Any]) -> None:
    """Raises on any key that no section knows: a typo must not change results."""
    unknown = []
    for section, allowed in CONFIG_KEYS.items():
        found: list[Any] = [data]
        for step in filter(None, section.split(".")):
            found = [v for f in found if isinstance(f, Mapping) for v in (f.values() if step == "*" else [f.get(step)])]
        for f in found:
            if isinstance(f, Mapping):
                unknown += [f"{section}.{k}".lstrip(".") for k in f if k not in allowed]
    if unknown:
        raise ValueError(f"unknown configuration keys: {sorted(unknown)}")


@dataclass(frozen=True)
class CategoryRules:
    keywords: Mapping[str, float] = field(default_factory=dict)
    venue_prior: Mapping[str, float] = field(default_factory=dict)
    url_patterns: tuple[str, ...] = ()
    native_types: tuple[str, ...] = ()


@dataclass(frozen=True)
class Home:
    district: str
    lat: float
    lon: float


@dataclass(frozen=True)
class Scoring:
    category_weights: Mapping[str, float] = field(default_factory=dict)
    keyword_boosts: Mapping[str, float] = field(default_factory=dict)
    free_bonus: float = 0.0
    cheap_under: int | None = None
    cheap_points: float = 0.0
    # None switches both proximity terms off.
    distance_penalty_per_km: float | None = None
    same_district_bonus: float = 0.0
    penalty_cap_km: float | None = None
    novelty_bonus: float = 0.0
    soon_within_days: int | None = None
    soon_points: float = 0.0
    weekday_weights: Mapping[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        unknown = sorted(set(self.weekday_weights) - set(WEEKDAYS))
        if unknown:
            raise ValueError(f"unknown weekday keys: {unknown}")


@dataclass(frozen=True)
class Filters:
    categories: tuple[str, ...] | None = None
    max_price: int | None = None
    blocked_keywords: tuple[str, ...] = ()
    min_score: float = 0.0
    city: str | None = None
    allow_missing_city: bool = True
    max_distance_km: float | None = None


@dataclass(frozen=True)
class Settings:
    timezone: str = "Europe/Budapest"
    horizon_days: int = 14
    night_shift_hours: int = 5
    series_threshold_days: int = 7
    min_group_size: int = 4
    max_per_venue: int = 3
    categories: Mapping[str, CategoryRules] = field(default_factory=dict)
    min_category_score: float = 2.0
    fallback_category: str = "egyeb"
    home: Home | None = None
    scoring: Scoring = field(default_factory=Scoring)
    filters: Filters = field(default_factory=Filters)
    source_priorities: Mapping[str, int] = field(default_factory=dict)
    per_category_limit: int = 5
    total_limit: int = 25
    expiring_enabled: bool = True
    expiring_within_days: int = 3
    ledger_scope: str = "web"
    assist_batch_size: int = 35
    # None: every batch is called; a number only marks the batches beyond it.
    assist_max_calls: int | None = None
    archive_keep_days: int = 90

    def __post_init__(self) -> None:
        if self.ledger_scope not in ("web", "email"):
            raise ValueError("ledger_scope must be 'web' or 'email'")

    @property
    def category_order(self) -> list[str]:
        """Configured order with the fallback bucket forced last."""
        return [c for c in self.categories if c != self.fallback_category] + [
            self.fallback_category
        ]

    @property
    def category_weights(self) -> dict[str, float]:
        """Every configured category weighs 1 unless the profile says otherwise."""
        return {name: 1.0 for name in self.categories} | dict(self.scoring.category_weights)

    def replace(self, **changes: Any) -> Settings:
        return replace(self, **changes)

    @classmethod
    def from_mapping(cls, data: Mapping[str, Any]) -> Settings:
        """Build settings from an already parsed configuration mapping
        (the YAML or JSON reader is the caller's choice)."""
        check_keys(data)
        schedule = data.get("schedule") or {}
        grouping = data.get("grouping") or {}
        letter = data.get("newsletter") or {}
        expiring = letter.get("expiring_section") or {}
        assist = data.get("llm") or {}
        scoring = data.get("scoring") or {}
        filters = data.get("filters") or {}
        geo = filters.get("geo") or {}
        home = data.get("home")
        cheap = scoring.get("cheap_bonus")
        soon = scoring.get("soon_bonus")
        proximity = scoring.get("proximity")
        wanted = filters.get("categories")
        base = cls()
        return cls(
            timezone=schedule.get("timezone", base.timezone),
            horizon_days=schedule.get("horizon_days", base.horizon_days),
            night_shift_hours=(data.get("night_shift") or {}).get(
                "before_hour", base.night_shift_hours
            ),
            series_threshold_days=(data.get("recurrence") or {}).get(
                "series_threshold_days", base.series_threshold_days
            ),
            min_group_size=grouping.get("min_group_size", base.min_group_size),
            max_per_venue=grouping.get("max_per_venue", base.max_per_venue),
            categories={
                name: CategoryRules(
                    keywords=dict((rules or {}).get("keywords") or {}),
                    venue_prior=dict((rules or {}).get("venue_prior") or {}),
                    url_patterns=tuple((rules or {}).get("url_patterns") or ()),
                    native_types=tuple((rules or {}).get("native_types") or ()),
                )
                for name, rules in (data.get("categories") or {}).items()
            },
            min_category_score=data.get("min_category_score", base.min_category_score),
            fallback_category=data.get("fallback_category", base.fallback_category),
            home=Home(home["district"], home["lat"], home["lon"]) if home else None,
            scoring=Scoring(
                category_weights=dict(scoring.get("category_weights") or {}),
                keyword_boosts=dict(scoring.get("keyword_boosts") or {}),
                free_bonus=scoring.get("free_bonus", 0.0),
                cheap_under=cheap["under_huf"] if cheap else None,
                cheap_points=cheap["points"] if cheap else 0.0,
                distance_penalty_per_km=(
                    proximity.get("distance_penalty_per_km", 0.0)
                    if proximity is not None
                    else None
                ),
                same_district_bonus=(proximity or {}).get("same_district_bonus", 0.0),
                penalty_cap_km=(proximity or {}).get("penalty_cap_km"),
                novelty_bonus=scoring.get("novelty_bonus", 0.0),
                soon_within_days=soon["within_days"] if soon else None,
                soon_points=soon["points"] if soon else 0.0,
                weekday_weights=dict(scoring.get("weekday_weights") or {}),
            ),
            filters=Filters(
                categories=tuple(wanted) if wanted is not None else None,
                max_price=filters.get("max_price_huf"),
                blocked_keywords=tuple(filters.get("blocked_keywords") or ()),
                min_score=filters.get("min_score", 0.0),
                city=geo.get("city"),
                allow_missing_city=geo.get("allow_missing_city", True),
                max_distance_km=geo.get("max_distance_km"),
            ),
            source_priorities={
                name: spec["priority"]
                for name, spec in (data.get("sources") or {}).items()
                if isinstance((spec or {}).get("priority"), int)
            },
            per_category_limit=letter.get("per_category_limit", base.per_category_limit),
            total_limit=letter.get("total_limit", base.total_limit),
            expiring_enabled=expiring.get("enabled", True),
            expiring_within_days=expiring.get("within_days", base.expiring_within_days),
            ledger_scope=letter.get("ledger_records", base.ledger_scope),
            assist_batch_size=assist.get("batch_size", base.assist_batch_size),
            assist_max_calls=assist.get("max_calls_per_run", base.assist_max_calls),
            archive_keep_days=(data.get("site") or {}).get(
                "archive_keep_days", base.archive_keep_days
            ),
        )

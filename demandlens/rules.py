"""Business vocabulary: values that results depend on, kept in one place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SOURCE_SYSTEM = "postings_feed"
CREATED_BY = "batch_refresh"

# --- Fixed values -----------------------------------------------------------
# Role of a posting: the first rule with a keyword inside the lowercased title
# wins, otherwise OTHER_ROLE.
OTHER_ROLE = "other"
JOB_ROLE_RULES = (
    ("data_architect", (
        "data architect", "information architect", "analytics architect",
        "cloud data architect", "enterprise data architect",
    )),
    ("ai_engineer", (
        "ai engineer", "artificial intelligence engineer", "machine learning engineer",
        "ml engineer", "genai engineer", "generative ai engineer", "ai/ml engineer",
    )),
    ("data_engineer", (
        "data engineer", "analytics engineer", "etl developer", "etl engineer",
        "data platform engineer",
    )),
)
JOB_ROLE_LABELS = (
    ("data_engineer", "Data Engineer"),
    ("ai_engineer", "AI Engineer"),
    ("data_architect", "Data Architect"),
)

CONTINENT_CODES = {
    "North America": "NA", "South America": "SA", "Europe": "EU",
    "Asia": "AS", "Africa": "AF", "Oceania": "OC", "Antarctica": "AN",
}

# Days per date range; "all" is a fixed lookback without a preceding period.
RANGE_DAYS = {"30d": 30, "60d": 60, "90d": 90, "6m": 182, "1y": 365, "2y": 730}
ALL_RANGE = "all"
ALL_RANGE_DAYS = 3650

# Percentage points between the two halves of a window.
TRENDING_FROM_PP = 2.0
DECLINING_TO_PP = -2.0

# Percent of postings that name a certification.
HIGH_DEMAND_PCT = 15.0
MEDIUM_DEMAND_PCT = 5.0

ALL_INDUSTRIES = "all"
ALL_INDUSTRIES_LABEL = "All Industries"
UNKNOWN_INDUSTRY = "Unknown"
TECHNOLOGY = "technology"
METHODOLOGY = "methodology"
SORTS = ("occurrence", "trending")
MAX_ROWS = 50
# --- End of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Roles:
    """A role taxonomy: ordered keyword rules and the selectable labels."""

    rules: tuple[tuple[str, tuple[str, ...]], ...] = JOB_ROLE_RULES
    labels: tuple[tuple[str, str], ...] = JOB_ROLE_LABELS
    default: str = OTHER_ROLE

    @property
    def selectable(self) -> tuple[str, ...]:
        return tuple(value for value, _ in self.labels)

    @property
    def names(self) -> tuple[str, ...]:
        """Every value a posting can get; the size of the role dimension."""
        return (*self.selectable, self.default)


@dataclass(frozen=True)
class Term:
    """One entry of the extraction dictionary."""

    pattern: str
    name: str
    provider: str | None = None


def check_dictionary(terms: tuple[Term, ...]) -> None:
    """One spelling and one provider per entity, so names need no later merge."""
    seen: dict[str, tuple[str, str | None]] = {}
    for term in terms:
        known = seen.setdefault(term.name.strip().lower(), (term.name, term.provider))
        if known != (term.name, term.provider):
            raise ValueError(f"dictionary entity {term.name!r} has two spellings or providers")


def continent_code(name: Column, codes: dict[str, str] = CONTINENT_CODES) -> Column:
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.create_map(*pairs)[name]

"""Feature rules kept as data and turned into Columns.

A ``Bands`` value lists the arms of a threshold rule in ascending order. Every arm says whether its
upper edge belongs to it, so left-closed, right-closed and mixed rules share one generator.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Value = str | int | float


@dataclass(frozen=True)
class Arm:
    """Everything up to ``upper`` gets ``value``; ``closed`` includes ``upper`` itself."""

    upper: float
    value: Value
    closed: bool = False


@dataclass(frozen=True)
class Bands:
    """Ordered arms, the value beyond the last arm (and for NULL) and an optional open lower edge."""

    arms: tuple[Arm, ...]
    otherwise: Value
    above: float | None = None


def below(upper: float, value: Value) -> Arm:
    return Arm(upper, value, closed=False)


def up_to(upper: float, value: Value) -> Arm:
    return Arm(upper, value, closed=True)


def band(column: Column | str, bands: Bands) -> Column:
    """Turn a rule into one CASE expression. NULL input falls through to ``otherwise``."""
    c = F.col(column) if isinstance(column, str) else column
    conditions: list[tuple[Column, Value]] = []
    if bands.above is not None:
        conditions.append((c <= F.lit(bands.above), bands.otherwise))
    for arm in bands.arms:
        edge = F.lit(arm.upper)
        conditions.append((c <= edge if arm.closed else c < edge, arm.value))
    case = F.when(conditions[0][0], F.lit(conditions[0][1]))
    for condition, value in conditions[1:]:
        case = case.when(condition, F.lit(value))
    return case.otherwise(F.lit(bands.otherwise))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def yes(column: str) -> Column:
    return F.col(column) == F.lit("yes")


def contacted_before(column: str = "pdays") -> Column:
    """0 only for the never-contacted sentinel; an unknown value counts as contacted."""
    return F.when(F.col(column) == NEVER_CONTACTED, F.lit(0)).otherwise(F.lit(1))


def contacted_before_strict(column: str = "pdays") -> Column:
    """1 only for a known value other than the sentinel; an unknown value counts as not contacted."""
    return flag(F.col(column) != NEVER_CONTACTED)


def recency_inverse(column: str = "pdays") -> Column:
    """0 for the sentinel, else 1 / (days + 1); NULL stays NULL and a zero divisor gives NULL."""
    days = F.col(column).cast("double")
    return F.when(F.col(column) == NEVER_CONTACTED, F.lit(0.0)).otherwise(F.try_divide(F.lit(1.0), days + F.lit(1.0)))


def contact_ratio(campaign: str = "campaign", previous: str = "previous") -> Column:
    return F.try_divide(F.col(campaign).cast("double"), F.col(previous).cast("double") + F.lit(1.0))


def stress_tier(balance: str = "balance", housing: str = "housing", loan: str = "loan") -> Column:
    """Three levels from balance and two debts."""
    in_debt_twice = yes(housing) & yes(loan)
    in_debt_once = yes(housing) | yes(loan)
    return (
        F.when((F.col(balance) < 0) | in_debt_twice, F.lit("high"))
        .when(in_debt_once, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def stress_flag(housing: str = "housing", loan: str = "loan") -> Column:
    return flag(yes(housing) & yes(loan))


# Thresholds, labels and sentinels of the three rule sets.
NEVER_CONTACTED = -1
MINIMUM_AGE = 18

TIER_AGE = Bands((below(30, "young"), below(45, "adult"), below(60, "middle_age")), "senior")
TIER_BALANCE = Bands((below(0, "negative"), below(300, "low"), below(1000, "medium")), "high")
TIER_CAMPAIGN = Bands((up_to(1, "low"), up_to(3, "high")), "high")
TIER_RECENCY = Bands((up_to(30, 3), up_to(180, 2)), 1)
TIER_DURATION = Bands((below(120, "short"), below(300, "medium")), "long")

CUT_AGE = Bands((up_to(30, "young"), up_to(45, "adult"), up_to(60, "middle_age"), up_to(120, "senior")), "nan", above=0)
CUT_BALANCE = Bands(
    (up_to(0, "negative"), up_to(300, "low"), up_to(1000, "medium"), up_to(999999, "high")), "nan", above=-999999
)
CUT_CAMPAIGN = Bands((up_to(1, "low"),), "high")
CUT_DURATION = Bands((up_to(120, "short"), up_to(300, "medium"), up_to(999999, "long")), "nan", above=0)

RATIO_AGE = Bands((up_to(30, "young"), up_to(50, "middle"), up_to(65, "senior")), "elderly")
RATIO_BALANCE = Bands((below(0, "negative"), below(500, "low"), up_to(2000, "medium")), "high")
RATIO_DURATION = Bands((below(60, "very_short"), below(180, "short"), up_to(500, "medium")), "long")


def recency_tier(column: str = "pdays") -> Column:
    """Sentinel first, then the bands: other negative values are recent, not never contacted."""
    return F.when(F.col(column) == NEVER_CONTACTED, F.lit(0)).otherwise(band(column, TIER_RECENCY))


@dataclass(frozen=True)
class Preset:
    """A named rule set: required inputs, an optional row filter and the derived columns."""

    name: str
    inputs: Mapping[str, str]
    features: Mapping[str, Column]
    label: Column | None = None
    row_filter: Column | None = None
    feature_types: Mapping[str, str] = field(default_factory=dict)

    def apply(self, df: DataFrame, with_label: bool = True) -> DataFrame:
        """Filter, then add label and all features in one projection."""
        missing = [c for c in self.inputs if c not in df.columns]
        if missing:
            raise ValueError(f"preset {self.name} needs columns {missing}")
        kept = df.filter(self.row_filter) if self.row_filter is not None else df
        derived = dict(self.features)
        if with_label and self.label is not None:
            derived = {"y_flag": self.label, **derived}
        return kept.withColumns(derived)


FEATURE_NAMES = (
    "age_group",
    "balance_tier",
    "contact_intensity",
    "was_previously_contacted",
    "recency_score",
    "duration_bucket",
    "financial_stress",
)

_INPUTS = {
    "age": "int",
    "balance": "int",
    "housing": "string",
    "loan": "string",
    "duration": "bigint",
    "campaign": "int",
    "pdays": "int",
}


def presets() -> dict[str, Preset]:
    """The three rule sets. Built on call because Columns need a running session."""
    adults = F.col("age") >= MINIMUM_AGE
    label = flag(yes("y"))
    tier_types = dict.fromkeys(FEATURE_NAMES, "string") | {"was_previously_contacted": "int", "recency_score": "int"}
    ratio_types = dict.fromkeys(FEATURE_NAMES, "string") | {
        "contact_intensity": "double",
        "was_previously_contacted": "int",
        "recency_score": "double",
        "financial_stress": "int",
    }
    v1_tier = Preset(
        "v1_tier",
        _INPUTS | {"y": "string"},
        {
            "age_group": band("age", TIER_AGE),
            "balance_tier": band("balance", TIER_BALANCE),
            "contact_intensity": band("campaign", TIER_CAMPAIGN),
            "was_previously_contacted": contacted_before(),
            "recency_score": recency_tier(),
            "duration_bucket": band("duration", TIER_DURATION),
            "financial_stress": stress_tier(),
        },
        label,
        adults,
        tier_types,
    )
    v1_cut = Preset(
        "v1_cut",
        _INPUTS | {"y": "string"},
        {
            "age_group": band("age", CUT_AGE),
            "balance_tier": band("balance", CUT_BALANCE),
            "contact_intensity": band("campaign", CUT_CAMPAIGN),
            "was_previously_contacted": contacted_before(),
            "recency_score": recency_tier(),
            "duration_bucket": band("duration", CUT_DURATION),
            "financial_stress": stress_tier(),
        },
        label,
        adults,
        tier_types,
    )
    v2_ratio = Preset(
        "v2_ratio",
        _INPUTS | {"previous": "int"},
        {
            "age_group": band("age", RATIO_AGE),
            "balance_tier": band("balance", RATIO_BALANCE),
            "contact_intensity": contact_ratio(),
            "was_previously_contacted": contacted_before_strict(),
            "recency_score": recency_inverse(),
            "duration_bucket": band("duration", RATIO_DURATION),
            "financial_stress": stress_flag(),
        },
        None,
        None,
        ratio_types,
    )
    return {p.name: p for p in (v1_tier, v1_cut, v2_ratio)}

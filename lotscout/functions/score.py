"""Site scores, grades and the idle-area rule."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotscout.functions.text import names_match


@dataclass(frozen=True)
class ScoreWeights:
    # The published scoring rule.
    business: dict[str, float] = field(
        default_factory=lambda: {
            "일반음식점": 0.4,
            "제과점영업": 0.4,
            "휴게음식점": 0.1,
            "집단급식소": 0.0,
            "위탁급식영업": 0.0,
        }
    )
    name: float = 0.3
    register: float = 0.15
    register_code: str = "1"
    co_owner: float = 0.1
    co_owner_decay: float = 0.5
    single_representative: float = 0.05
    area_scale: float = 9.2
    parking: int = 3
    parking_best: int = 5


DEFAULT_WEIGHTS = ScoreWeights()


def idle_area(lot: Column, building: Column, outdoor_parking: Column) -> Column:
    """Free ground: the lot, or what the building leaves, at least the outdoor parking, at least 0."""
    left = F.greatest(lot - building, F.coalesce(outdoor_parking, F.lit(0.0)), F.lit(0.0))
    return F.when(building.isNull(), lot).otherwise(left)


def _case(branches: dict[object, tuple[Column, object]], otherwise: Column) -> Column:
    """CASE expression from (condition, value) pairs, first hit wins."""
    (condition, value), *rest = branches.values()
    out = F.when(condition, F.lit(value))
    for condition, value in rest:
        out = out.when(condition, F.lit(value))
    return out.otherwise(otherwise)


def business_score(kind: Column, weights: ScoreWeights = DEFAULT_WEIGHTS) -> Column:
    """Weight of the business type; unknown types count as zero."""
    return _case({name: (kind == name, w) for name, w in weights.business.items()}, F.lit(0.0))


def _flag_score(flag: Column, weight: float) -> Column:
    return F.when(flag, F.lit(weight)).otherwise(F.lit(0.0))


def score_parts(
    kind: Column,
    representative: Column,
    owner: Column,
    register_code: Column,
    co_owners: Column,
    representatives: Column,
    weights: ScoreWeights = DEFAULT_WEIGHTS,
) -> dict[str, Column]:
    """The five additive parts of a site's suitability, in order of addition."""
    decay = F.pow(F.lit(weights.co_owner_decay), co_owners.cast("double"))
    return {
        "business_score": business_score(kind, weights),
        "name_score": _flag_score(names_match(representative, owner), weights.name),
        "register_score": _flag_score(register_code == weights.register_code, weights.register),
        "co_owner_score": F.lit(weights.co_owner) * decay,
        "single_rep_score": _flag_score(representatives == 1, weights.single_representative),
    }


def suitability(parts: dict[str, Column]) -> Column:
    first, *rest = parts.values()
    for part in rest:
        first = first + part
    return first


def profitability(area: Column, weights: ScoreWeights = DEFAULT_WEIGHTS) -> Column:
    return F.log(area + 1) / F.lit(weights.area_scale)


def total_score(
    fit: Column, profit: Column, parking: Column, weights: ScoreWeights = DEFAULT_WEIGHTS
) -> Column:
    return fit * profit * (parking / F.lit(weights.parking_best)) * 100


# Lower bounds of the grades; parking points and their letters.
GRADE_BOUNDS = {"A": 0.8, "B": 0.6, "C": 0.4, "D": 0.2}
PARKING_LETTERS = {5: "A", 4: "B", 3: "C", 2: "D", 1: "E"}


def grade(score: Column) -> Column:
    """A to E from a 0..1 score, NULL for no score."""
    known = F.nanvl(score, F.lit(None).cast("double"))
    letter = _case({k: (known >= low, k) for k, low in GRADE_BOUNDS.items()}, F.lit("E"))
    return F.when(known.isNotNull(), letter)


def parking_grade(points: Column) -> Column:
    """Letter of a parking score (fractions cut off); other values give NULL."""
    whole = F.nanvl(points.cast("double"), F.lit(None).cast("double")).try_cast("int")
    no_letter = F.lit(None).cast("string")
    return _case({k: (whole == k, letter) for k, letter in PARKING_LETTERS.items()}, no_letter)


def parking_points(letter: Column, default: int = 3) -> Column:
    """Inverse of parking_grade; an unknown letter counts as the default."""
    return _case({k: (letter == name, k) for k, name in PARKING_LETTERS.items()}, F.lit(default))

"""Role standardisation and threshold labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role keywords, matched in this order on the upper-cased text; default Batter.
ROLE_KEYWORDS = [
    ("Wicketkeeper", ("WK", "KEEPER", "WICKET")),
    ("Batter", ("BAT", "BATS")),
    ("Allrounder", ("ALL", "AR", "ROUND")),
    ("Bowler", ("BOWL", "BWL")),
]
ROLES = [r for r, _ in ROLE_KEYWORDS]
# Selection quotas (min, max) per standard role.
ROLE_LIMITS = {"Wicketkeeper": (1, 4), "Batter": (3, 6), "Allrounder": (1, 4), "Bowler": (3, 6)}
# Credit adjustments by case-insensitive role substring.
CREDIT_ROLE_BONUS = [("All-rounder", 0.7), ("Wicketkeeper", 0.5), ("Bowler", -0.1), ("Batter", 0.0)]


def standardize_role(c: Column) -> Column:
    """Ordered any-substring classifier (Q24). A null role reads as the text 'NONE' -> Batter."""
    up = F.upper(F.coalesce(c.cast("string"), F.lit("NONE")))
    out = F.lit("Batter")
    for role, keys in reversed(ROLE_KEYWORDS):
        cond = F.lit(False)
        for k in keys:
            cond = cond | up.contains(k)
        out = F.when(cond, role).otherwise(out)
    return out


def credit_role_bonus(role: Column) -> Column:
    """Sum of the bonuses whose keyword the role contains (case-insensitive)."""
    low = F.lower(role)
    total = F.lit(0.0)
    for key, pts in CREDIT_ROLE_BONUS:
        total = total + F.when(F.coalesce(low.contains(key.lower()), F.lit(False)), F.lit(pts)).otherwise(F.lit(0.0))
    return total


def variance_quality(std: Column) -> Column:
    return F.when(std > 20, "Excellent").when(std > 15, "Good").when(std > 10, "Moderate").otherwise("Poor")


def range_quality(rng: Column) -> Column:
    return F.when(rng > 40, "Good").when(rng > 20, "Moderate").otherwise("Poor")


def team_variance_quality(std: Column) -> Column:
    return F.when(std > 8, "HIGH").when(std > 4, "MODERATE").otherwise("LOW")


def system_quality(std: Column) -> Column:
    return (F.when((std >= 10) & (std > 15), "EXCELLENT").when(std >= 10, "GOOD")
            .when(std > 5, "MODERATE").otherwise("POOR"))

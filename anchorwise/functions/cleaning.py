"""Cleaning and normalisation expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Result label vocabulary (lower-cased raw label -> canonical).
RESULT_LABELS = {
    "win": "won", "won": "won", "w": "won", "victory": "won",
    "loss": "lost", "lost": "lost", "l": "lost", "defeat": "lost",
}

# Canonical venue columns with their aliases (in priority order), types and defaults.
VENUE_SPEC: dict[str, tuple[tuple[str, ...], str, object]] = {
    "venue_id": (("ground_id", "stadium_id"), "long", 1),
    "average_runs_venue": (("avg_runs", "average_runs", "avg_score"), "double", 160),
    "runs_per_over_venue": (("runs_per_over", "rpo"), "double", 8.0),
    "total_matches_venue": (("total_matches", "matches_played", "games"), "long", 50),
    "highest_score_venue": (("highest_score", "max_score", "high_score"), "double", 180),
    "lowest_score_venue": (("lowest_score", "min_score", "low_score"), "double", 120),
    "total_boundaries_venue": (("total_boundaries", "boundaries", "total_fours_sixes"), "long", 800),
}
# Delivery and result column aliases.
DELIVERY_SPEC: dict[str, tuple[tuple[str, ...], str, object]] = {
    "batter_id": (("batter", "batsman", "striker"), "long", None),
    "batsman_runs": (("batter_runs", "runs_scored", "runs"), "int", None),
    "over": (("over_number", "over_num"), "int", None),
}
MATCHSTAT_SPEC: dict[str, tuple[tuple[str, ...], str, object]] = {
    "team_id": (("team", "team_name"), "long", None),
    "result": (("winning_team", "winner", "match_result"), "string", None),
}


def parse_date(c: Column) -> Column:
    """Polymorphic date parse (P1): ``yyyyMMdd`` numbers/text, ISO text; invalid -> null.

    ``try_to_date`` never raises under ANSI mode (``to_date`` would).
    """
    s = F.trim(c.cast("string"))
    compact = F.try_to_date(s, "yyyyMMdd")
    iso = F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.try_to_date(s, "yyyy/MM/dd"))
    return F.when(s.rlike(r"^[0-9]{8}$"), compact).otherwise(iso)


def normalize_result(c: Column) -> Column:
    """Result label -> won / lost / unknown."""
    low = F.lower(c.cast("string"))
    out = F.lit("unknown")
    for raw, canon in reversed(list(RESULT_LABELS.items())):
        out = F.when(low == raw, canon).otherwise(out)
    return out


def clean_key(c: Column) -> Column:
    """Dirty text id -> long (P5): trim, 'nan' -> null, numeric or null, then integral part."""
    s = F.trim(c.cast("string"))
    num = F.when(s == "nan", F.lit(None)).otherwise(s).try_cast("double")
    return F.when(num.isNotNull() & ~F.isnan(num), num.try_cast("long"))


def clean_name(c: Column) -> Column:
    """Trim and collapse inner whitespace (P20)."""
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """First of ``names`` that is a column of ``df``."""
    return next((n for n in names if n in df.columns), None)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from ``df``, in the given order."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str], what: str = "table") -> DataFrame:
    miss = missing_columns(df, required)
    if miss:
        raise ValueError(f"{what}: required columns missing: {miss}")
    return df


def number(c: Column, dtype: str) -> Column:
    """Text or number to a numeric type: '1.0' is a whole number; junk, NaN and infinities are null."""
    d = c.try_cast("double")
    d = F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)
    return d if dtype == "double" else F.coalesce(c.try_cast(dtype), d.try_cast(dtype))


def _typed(c: Column, dtype: str) -> Column:
    return c.try_cast(dtype) if dtype == "string" else number(c, dtype)


def conform(df: DataFrame, spec: Mapping[str, tuple[Sequence[str], str, object]]) -> DataFrame:
    """Alias -> canonical columns with types and defaults.

    When several aliases are present the first non-null in the listed order
    wins (canonical name first); an absent column gets its default.
    Columns outside the spec are kept as they are.
    """
    cols: list[Column] = []
    used: set[str] = set()
    for canon, (aliases, dtype, default) in spec.items():
        present = [n for n in (canon, *aliases) if n in df.columns]
        used.update(present)
        if present:
            expr = F.coalesce(*[_typed(F.col(f"`{n}`"), dtype) for n in present])  # junk -> null, never a failed job
        else:
            expr = F.lit(default).cast(dtype)
        cols.append(expr.alias(canon))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*cols, *rest)


def clip(c: Column, lo: float, hi: float) -> Column:
    """``np.clip``."""
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))

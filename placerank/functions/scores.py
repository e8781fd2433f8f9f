"""Score arithmetic and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from placerank import fixed
from placerank.functions.text import col


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, null for a zero divisor."""
    return F.try_divide(col(a), col(b))


def share(parts: Sequence[str | Column], total: str | Column) -> Column:
    """Sum of the parts (null counts as 0) over the total."""
    top = sum((F.coalesce(col(p), F.lit(0.0)) for p in parts[1:]), F.coalesce(col(parts[0]), F.lit(0.0)))
    return safe_ratio(top, total)


def bin_label(c: str | Column, bins: Sequence[tuple[float, str]], other: str, op: str = ">") -> Column:
    """Label of the first bin whose threshold holds; ``op`` is '>' or '<='."""
    value, label = col(c), None
    for threshold, name in bins:
        hit = value > threshold if op == ">" else value <= threshold
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return label.otherwise(F.lit(other))


def grade(c: str | Column) -> Column:
    return bin_label(c, fixed.GRADES, fixed.GRADE_OTHER)


def competition_label(c: str | Column) -> Column:
    return bin_label(c, fixed.COMPETITION_LABELS, fixed.COMPETITION_OTHER, op="<=")


def tier(c: str | Column) -> Column:
    return bin_label(c, fixed.TIERS, fixed.TIER_OTHER)


def scaled_int(c: str | Column, k: float) -> Column:
    return F.round(col(c) * k).cast("int")


def exceeds(c: str | Column, threshold: float) -> Column:
    """Above the threshold; null counts as false."""
    return F.coalesce(col(c) > threshold, F.lit(False))


def capped_bonus(base: Column, condition: Column, bonus: float, cap: float = 1.0) -> Column:
    return F.least(F.lit(cap), base + F.when(condition, F.lit(bonus)).otherwise(F.lit(0.0)))


def normalize(value: str | Column, lo: Column, hi: Column, degenerate: float) -> Column:
    """(value - lo) / (hi - lo); the degenerate value when lo and hi are equal or unknown."""
    return F.when(hi > lo, (col(value) - lo) / (hi - lo)).otherwise(F.lit(degenerate))


def invert(c: str | Column) -> Column:
    return 1.0 - col(c)


def weighted(terms: Mapping[str, float], factor: str | Column | None = None) -> Column:
    """Weighted sum in the given order, times an optional factor."""
    columns = [w * col(name) for name, w in terms.items()]
    total = sum(columns[1:], columns[0])
    return total if factor is None else total * col(factor)


def clip(c: Column, lo: float, hi: float) -> Column:
    """Bounded value; null stays null."""
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def size_factor(
    c: str | Column, default: float = fixed.COURTS_DEFAULT, lo: float = fixed.COURTS_MIN, cap: float = fixed.COURTS_MAX
) -> Column:
    """Size of a place in (0, 1]: clipped to [lo, cap] and divided by cap."""
    value = F.coalesce(F.nanvl(col(c).cast("double"), F.lit(default)), F.lit(default))
    return F.least(F.greatest(value, F.lit(lo)), F.lit(cap)) / cap


def nearest_of(*distances: str | Column) -> Column:
    """Smallest known distance, null when none is known."""
    return F.least(*[col(d) for d in distances])

"""Grouped averages, extremes, quantiles and centroids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def rollup(
    df: DataFrame, keys: Sequence[str], *, count: str = "n", labels: Mapping[str, str] | None = None,
    averages: Mapping[str, str] | None = None, maxima: Mapping[str, str] | None = None,
    quantiles: Mapping[str, tuple[str, float]] | None = None, accuracy: int = 10000,
    centroid: tuple[str, str] | None = None, centroid_names: tuple[str, str] = ("lat_center", "lon_center"),
    min_count: int = 0,
) -> DataFrame:
    """One row per group. Every aggregate combines before the shuffle, so a hot group stays cheap.

    ``labels``, ``averages`` and ``maxima`` map output to input names. A label is the smallest
    non-null value. Groups below ``min_count`` rows are left out.
    """
    aggs: list[Column] = [F.count("*").alias(count)]
    aggs += [F.min(c).alias(out) for out, c in (labels or {}).items()]
    aggs += [F.avg(F.col(c).cast("double")).alias(out) for out, c in (averages or {}).items()]
    aggs += [F.max(c).alias(out) for out, c in (maxima or {}).items()]
    aggs += [F.percentile_approx(c, q, accuracy).alias(out) for out, (c, q) in (quantiles or {}).items()]
    if centroid:
        aggs += [F.avg(c).alias(out) for c, out in zip(centroid, centroid_names)]
    out = df.groupBy(*keys).agg(*aggs)
    return out.filter(F.col(count) >= min_count) if min_count > 1 else out


def distinct_by(df: DataFrame, keys: Sequence[str], column: str, out: str = "n_distinct") -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(column).alias(out))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def state_by_group(df: DataFrame, key: str, item: str, amount: str, time: str) -> DataFrame:
    """Distinct items, null-safe sum and latest time per group."""
    return df.groupBy(key).agg(
        F.count_distinct(item).alias("n_active"),
        F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("n_total"),
        F.max(time).alias("last_time"),
    )

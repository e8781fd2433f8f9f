"""Equi-joins. No broadcast hints on tables: Spark broadcasts what it measures to be small
(spark.sql.autoBroadcastJoinThreshold, and again at run time), and shuffles the rest with skew splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail when a key repeats (an action); a repeated key on the right side multiplies rows."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"key {list(keys)} repeats: {twice[0].asDict()}")
    return df


def join_keys(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Equi-join on differently named keys; the right keys are dropped."""
    renamed = right.withColumnsRenamed({r: f"_key_{r}" for r in keys.values()})
    on = reduce(lambda a, b: a & b, [F.col(l) == F.col(f"_key_{r}") for l, r in keys.items()])
    return left.join(renamed, on, how).drop(*[f"_key_{r}" for r in keys.values()])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a null key equals a null key."""
    renamed = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_key_{k}" for k in keys])


def enrich(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Left join on equally named keys, then constants where nothing matched."""
    out = df.join(dim, [on] if isinstance(on, str) else list(on), "left")
    if defaults:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    return out


def enrich_all(df: DataFrame, dims: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Chain of left joins on one key; the partitioning of the first is reused by the rest."""
    return reduce(lambda a, b: enrich(a, b, on), dims, df)


def project_to_members(df: DataFrame, mapping: DataFrame, key: str, members: str, member: str) -> DataFrame:
    """A value per group becomes a value per member: inner join with the exploded mapping."""
    return df.join(mapping.select(key, F.explode(members).alias(member)), key, "inner")


def lookup(
    df: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object]
) -> DataFrame:
    """Attributes of a code. A text default holding '{}' gets the code put in its place."""
    out = df.join(dim, key, "left")
    fill = {}
    for c, v in defaults.items():
        if isinstance(v, str) and "{}" in v:
            before, after = v.split("{}", 1)
            value = F.concat(F.lit(before), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(after))
        else:
            value = F.lit(v)
        fill[c] = F.coalesce(F.col(c), value)
    return out.withColumns(fill)

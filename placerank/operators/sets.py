"""Unions, differences and distinct keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by column name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def coverage_check(df: DataFrame, key: str, expected: DataFrame) -> DataFrame:
    """Keys on one side only: (key, problem) with 'missing' from df or 'extra' in df."""
    have, want = df.select(key).distinct(), expected.select(key).distinct()
    missing = want.join(have, key, "left_anti").withColumn("problem", F.lit("missing"))
    extra = have.join(want, key, "left_anti").withColumn("problem", F.lit("extra"))
    return missing.unionByName(extra)


def assert_coverage(df: DataFrame, key: str, expected: DataFrame, show: int = 20) -> DataFrame:
    """Raise when keys are missing or extra (an action); the message shows some of them."""
    problems = coverage_check(df, key, expected).orderBy("problem", key).limit(show).collect()
    if problems:
        raise ValueError("incomplete mapping: " + ", ".join(f"{r['problem']} {r[key]}" for r in problems))
    return df

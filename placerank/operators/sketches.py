"""Quantile sketches kept as columns of a table: built per part, merged by key, asked later.

A row of a sketch table holds the keys, ``n`` (rows) and for each column its count of values, minimum, maximum and a KLL sketch.
Sketches merge: a finer table gives every coarser one, and a table of parts (files, days, batches) takes a new or replayed part
without a look at the others. A sketch has a bounded size, some ``k`` values a level, whatever the number of rows, and combines before
the shuffle, so one hot key is no hot task. Up to ``k`` values it is exact.

Nulls and NaN count as no value. A null key is a key. A group without values has null minimum, maximum and quantiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def rank_error(k: int) -> float:
    """How far the rank of an answer lies from the one asked for, as a share of all values: held by 99 of 100 sketches."""
    return 2.296 / k**0.9021  # the published bound of KLL for one-sided ranks


def _merged(col: str) -> list[Column]:
    return [F.sum(f"{col}_n").alias(f"{col}_n"), F.min(f"{col}_min").alias(f"{col}_min"), F.max(f"{col}_max").alias(f"{col}_max"),
            F.kll_merge_agg_double(F.when(F.col(f"{col}_n") > 0, F.col(f"{col}_kll"))).alias(f"{col}_kll")]


def sketch_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], k: int = 1000) -> DataFrame:
    """The sketch table of the columns per key, in one pass; no keys: one row, also for an empty table."""
    rows = df.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    aggs = [F.count("*").alias("n")]
    for c in cols:
        aggs += [F.count(c).alias(f"{c}_n"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.kll_sketch_agg_double(c, k).alias(f"{c}_kll")]
    return rows.groupBy(*keys).agg(*aggs)


def sketched_columns(sketches: DataFrame) -> list[str]:
    return [c.removesuffix("_kll") for c in sketches.columns if c.endswith("_kll")]


def merge_by(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketch table of coarser keys."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), *[a for c in sketched_columns(sketches) for a in _merged(c)])


def quantiles(sketches: DataFrame, qs: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Keys, n, and per column its count, minimum, maximum and '<column>_<name>' for each quantile asked for."""
    out = []
    for c in sketched_columns(sketches):
        out += [F.col(f"{c}_n"), F.col(f"{c}_min"), F.col(f"{c}_max")]
        # an empty sketch has no quantile to give
        out += [F.when(F.col(f"{c}_n") > 0, F.kll_sketch_get_quantile_double(f"{c}_kll", F.lit(float(q)))).alias(f"{c}_{name}") for name, q in qs.items()]
    return sketches.select(*keys, "n", *out)


def share_at_most(sketches: DataFrame, column: str, value: float | Column, name: str = "share") -> DataFrame:
    """Adds the share of a column's values that are at most ``value``; null without values."""
    bound = value if isinstance(value, Column) else F.lit(float(value))
    return sketches.withColumn(name, F.when(F.col(f"{column}_n") > 0, F.kll_sketch_get_rank_double(f"{column}_kll", bound)))


def write_part(df: DataFrame, path: str, part: str, keys: Sequence[str], cols: Sequence[str], k: int = 1000) -> None:
    """Sketch one part (a day, a batch) into its own folder of the table; a replayed part takes the place of its earlier run."""
    sketch_by(df, keys, cols, k).write.mode("overwrite").parquet(f"{path}/part={part}")


def write_parts(df: DataFrame, path: str, part: str, keys: Sequence[str], cols: Sequence[str], k: int = 1000) -> None:
    """Sketch all parts that a column tells apart, in one job; parts written before are replaced, others stay."""
    rows = sketch_by(df.withColumn("part", F.col(part).cast("string")), ["part", *keys], cols, k)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_merged(spark: SparkSession, path: str, keys: Sequence[str] = (), condition: Column | None = None) -> DataFrame:
    """The parts of a table merged by key; a condition on ``part`` reads the folders it names only."""
    parts = spark.read.parquet(path)
    return merge_by(parts if condition is None else parts.filter(condition), keys)

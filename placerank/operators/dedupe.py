"""Keep one row per key.

All of these are row_number() = 1 over a total order. Spark keeps one row per key and task before
the shuffle (WindowGroupLimit), so a key that holds a third of the table moves one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from placerank.functions.geo import round_key
from placerank.operators.sets import union_all


def best_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; end the order with a unique column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per(df: DataFrame, key: str, time: str, *ties: str) -> DataFrame:
    """The latest row of each key; an unknown time loses against any known one."""
    return best_per(df, [key], [F.col(time).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]])


def dedupe_spatial(df: DataFrame, lat: str, lon: str, digits: int, order: Sequence[Column]) -> DataFrame:
    """One row per position rounded to ``digits`` decimals."""
    lat_key, lon_key = round_key(lat, lon, digits)
    keyed = df.withColumns({"_lat_key": lat_key, "_lon_key": lon_key})
    return best_per(keyed, ["_lat_key", "_lon_key"], order).drop("_lat_key", "_lon_key")


def keep_last(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Concatenate and keep the copy from the last frame that has the key."""
    ranked = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    return best_per(union_all(ranked), keys, [F.desc("_source"), *order]).drop("_source")


def stable_id(*cols: str) -> Column:
    """A surrogate id that is the same on every run: a hash of the natural key."""
    return F.xxhash64(*cols)

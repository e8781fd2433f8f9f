"""Top-k and ranks without pulling a whole table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from placerank.operators.joins import null_safe_join
from placerank.session import cut_lineage


def head(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows: each task keeps its own k, one task merges them."""
    return df.orderBy(*order).limit(k)


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows with their rank; only those k rows meet in one task."""
    return head(df, order, k).withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_k_per(
    df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", branches: int = 32
) -> DataFrame:
    """The first k rows of each group with their rank, in two steps.

    Few groups over many tasks would send k rows of every task to a handful of reducers. So each
    group is first cut to k rows in ``branches`` parts, by the task a row comes from, and the parts
    are merged. Which part a row takes has no influence on the result.
    """
    parts = df.withColumn("_branch", F.spark_partition_id() % branches)
    first = Window.partitionBy(*part, "_branch").orderBy(*order)
    cut = parts.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= k)
    last = Window.partitionBy(*part).orderBy(*order)
    return (
        cut.drop("_rn", "_branch")
        .withColumn(rank, F.row_number().over(last))
        .filter(F.col(rank) <= k)
    )


def dual_rank(
    df: DataFrame, order: Sequence[Column], part: Sequence[str], overall: str = "rank_all", within: str = "rank_part"
) -> DataFrame:
    """Rank in the whole of a table of any size and rank within each part of it; end the order with a unique column.

    As in ``global_rank`` ranges are ordered apart and written first. A row's rank within its part is its place among the part's rows of
    its range plus the part's rows in the ranges before, so neither the table nor a hot part is ordered in one task.
    """
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range", *part).agg(F.count("*").alias("_size"))
    before = lambda *keys: Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, and one per part and range
    whole = sizes.groupBy("_range").agg(F.sum("_size").alias("_size"))
    whole = whole.select("_range", F.coalesce(F.sum("_size").over(before()), F.lit(0)).alias("_before_all"))
    parts = sizes.select("_range", *part, F.coalesce(F.sum("_size").over(before(*part)), F.lit(0)).alias("_before_part"))
    placed = ranged.withColumns(
        {
            overall: F.row_number().over(Window.partitionBy("_range").orderBy(*order)),
            within: F.row_number().over(Window.partitionBy("_range", *part).orderBy(*order)),
        }
    )
    return null_safe_join(placed, parts, ["_range", *part], "inner").join(whole, "_range").withColumns(
        {overall: (F.col(overall) + F.col("_before_all")).cast("int"), within: (F.col(within) + F.col("_before_part")).cast("int")}
    ).drop("_range", "_before_all", "_before_part")


def global_rank(df: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Rank every row of a table of any size; end the order with a unique column.

    Range partitioning puts the rows in order across tasks; the rank is the row's place in its range
    plus the sizes of the ranges before. The ranges are written to the checkpoint folder first, so
    that places and sizes stem from the same ranges even if executors are lost.
    """
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    # one row per range, so this window orders a few thousand rows at most
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_place", place)
        .join(offsets, "_range")
        .withColumn(rank, F.col("_before") + F.col("_place"))
        .drop("_range", "_place", "_before")
    )

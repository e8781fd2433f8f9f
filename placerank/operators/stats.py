"""Global and grouped statistics. One-row results stay lazy as scalar subqueries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from placerank.functions.scores import normalize
from placerank.operators.joins import null_safe_join
from placerank.session import cut_lineage


def one_row(df: DataFrame, **aggs: Column) -> dict[str, Column]:
    """Aggregates of the whole table as Columns usable in any other DataFrame, each mentioned once or twice."""
    row = df.agg(F.struct(*[a.alias(name) for name, a in aggs.items()]).alias("stats")).scalar()
    return {name: row[name] for name in aggs}


def with_stats(df: DataFrame, source: DataFrame | None = None, name: str = "_stats", **aggs: Column) -> DataFrame:
    """Add aggregates of the whole table (or of ``source``) as one struct column.

    Use this when several expressions need the statistics: the subquery then stands in the plan once,
    while every mention of a ``one_row`` Column is planned anew.
    """
    row = (df if source is None else source).agg(
        F.struct(*[a.alias(key) for key, a in aggs.items()]).alias("stats")
    )
    return df.withColumn(name, row.scalar())


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in cols for f in (F.min, F.max)])


def minmax(df: DataFrame, cols: Mapping[str, str], degenerate: float) -> DataFrame:
    """Min-max normalise several columns in one pass; ``cols`` maps input to output names."""
    aggs = {}
    for i, c in enumerate(cols):
        aggs[f"lo{i}"] = F.min(c).cast("double")
        aggs[f"hi{i}"] = F.max(c).cast("double")
    return with_stats(df, **aggs).withColumns(
        {
            out: normalize(c, F.col(f"_stats.lo{i}"), F.col(f"_stats.hi{i}"), degenerate)
            for i, (c, out) in enumerate(cols.items())
        }
    ).drop("_stats")


def median_by(df: DataFrame, keys: Sequence[str], column: str, accuracy: int = 10000,
              median: str = "median", count: str = "n") -> DataFrame:
    """Approximate median and row count per group, biggest groups first."""
    return (
        df.groupBy(*keys)
        .agg(F.percentile_approx(column, 0.5, accuracy).alias(median), F.count("*").alias(count))
        .orderBy(F.desc(count), *keys)
    )


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)


def count_and_label(df: DataFrame, key: str, label: str, count: str = "n") -> DataFrame:
    """Rows per key and one label; the smallest, so reruns agree."""
    return df.groupBy(key).agg(F.count("*").alias(count), F.min(label).alias(label))


def global_median(df: DataFrame, column: str, accuracy: int = 1000, exact: bool = False) -> DataFrame:
    """The lower median of the table, of a sketch or exactly."""
    if exact:
        return exact_quantiles(df, [column], {"q": 0.5}, interpolate=False).toDF("median")
    return df.agg(F.percentile_approx(column, 0.5, accuracy).alias("median"))


def quantile_profile(
    df: DataFrame, column: str, qs: Sequence[float] = (0.5, 0.9, 0.99), accuracy: int = 10000, exact: bool = False
) -> DataFrame:
    """Row count, min, max and quantiles, of a sketch or exactly; all 0.0 for an empty table."""
    sketch = [] if exact else [F.percentile_approx(column, list(qs), accuracy).alias("q")]
    row = df.agg(F.count("*").alias("n"), F.min(column).alias("min"), F.max(column).alias("max"), *sketch)
    if exact:
        found = exact_quantiles(df, [column], {str(i): q for i, q in enumerate(qs)}, interpolate=False)
        row = row.withColumn("q", found.select(F.array(*found.columns)).scalar())
    return row.select(
        "n",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("min", "max")],
        *[
            F.coalesce(F.get("q", i).cast("double"), F.lit(0.0)).alias(f"p{round(q * 100)}")
            for i, q in enumerate(qs)
        ],
    )


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], qs: Mapping[str, float], keys: Sequence[str] = (),
    accuracy: int = 10000, margin: float = 4.0, interpolate: bool = True,
) -> DataFrame:
    """Exact quantiles per group, named '<column>_<name>'; a null key is a group. Interpolated, or the smallest value that as large a share reaches.

    The built-in ``percentile`` keeps every distinct value of a group in one task's memory. Here a
    sketch first brackets each wanted rank, ``margin`` of its errors wide on each side; values outside the brackets are only counted
    (with map-side combine). The values between are ranked over ranges of all tasks, so neither a hot group nor a
    bracket of many values meets in one task. A rank that is not within its bracket ends the job with an error, whatever the
    sketch promises. The ranges are written to the checkpoint folder, as in ``global_rank``.
    """
    x, wide = F.col("_x"), margin / accuracy
    wanted, keys = list(qs.items()), list(keys)
    edges = [e for _, q in wanted for e in (max(0.0, q - wide), min(1.0, q + wide))]

    # one pass for all columns: the column's name becomes part of the key
    melted = df.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in cols])).alias("_m")
    ).select(*keys, "_m._col", F.nanvl("_m._x", F.lit(None)).alias("_x"))
    by = [*keys, "_col"]
    # written, so that Spark knows how small they are: else it deals the whole table by group, and a hot group is read by one task
    brackets = cut_lineage(melted.groupBy(*by).agg(
        F.struct(F.count(x).alias("n"), F.percentile_approx(x, edges, accuracy).alias("edges")).alias("_b")
    ))
    rows = null_safe_join(melted, brackets, by, how="inner")

    inside, segment = F.lit(False), F.lit(0)
    for i in range(len(wanted)):
        lo, hi = F.col("_b.edges")[2 * i], F.col("_b.edges")[2 * i + 1]
        inside = inside | x.between(lo, hi)
        segment = segment + (x >= lo).cast("int") + (x > hi).cast("int")
    # a segment is a contiguous range of values, so its smallest value places it in the order;
    # nulls count 0 and only keep their group alive
    runs = (
        rows.select(*by, "_b.n", "_x", segment.alias("_seg"), F.when(inside, x).alias("_v"))
        .groupBy(*by, "n", "_seg", "_v")
        .agg(F.count("_x").alias("_c"), F.min("_x").alias("_min"))
    )
    runs = _with_ends(runs, by, "_min", "_c", "_end")

    missed = F.raise_error(F.lit("a quantile lies outside the bracket of its sketch; raise accuracy or margin")).cast("double")
    picks, outs = [], []
    for name, q in wanted:
        # rounded, so that 0.07 * 100 is 7
        rank = F.lit(q) * (F.col("n") - 1) if interpolate else F.greatest(F.ceil(F.round(F.lit(q) * F.col("n"), 9)) - 1, F.lit(0))
        for side, index in (("f", F.floor(rank)), ("g", F.ceil(rank))):
            hit = (F.col("_end") > index) & (F.col("_end") - F.col("_c") <= index)
            picks.append(F.max(F.when(hit, F.when(F.col("_v").isNull(), missed).otherwise(F.col("_v")))).alias(f"_{name}_{side}"))
        low, high = F.col(f"_{name}_f"), F.col(f"_{name}_g")
        outs.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    picked = runs.groupBy(*by, "n").agg(*picks).select(*by, *outs)
    # without keys an empty table still gives its one row of nulls
    return picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_col") == c, F.col(name))).alias(f"{c}_{name}") for c in cols for name, _ in wanted]
    )


def _with_ends(runs: DataFrame, by: list[str], order: str, weight: str, end: str) -> DataFrame:
    """Adds ``end``: the sum of ``weight`` over the rows of the same keys up to each, in the order of a column.

    Ranges are summed apart; what a key has in earlier ranges is added, one number per key and range.
    """
    ranged = cut_lineage(runs.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(*by, "_range").agg(F.sum(weight).alias("_size"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn(end, F.sum(weight).over(inside))
    return null_safe_join(summed, offsets, [*by, "_range"], "inner").withColumn(end, F.col(end) + F.col("_before")).drop("_range", "_before")


def exact_median_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Exact medians of several columns per group, under the columns' own names."""
    out = exact_quantiles(df, cols, {"median": 0.5}, keys)
    return out.withColumnsRenamed({f"{c}_median": c for c in cols})


def color_range(df: DataFrame, column: str, lo: float = 0.02, hi: float = 0.98, pad: float = 0.02) -> DataFrame:
    """Exact low and high quantiles; a single value widens by ``pad`` within [0, 1], no value gives 0..1."""
    q = exact_quantiles(df, [column], {"lo": lo, "hi": hi}).toDF("lo", "hi")
    flat = F.col("lo") == F.col("hi")
    return q.select(
        F.coalesce(F.when(flat, F.greatest(F.lit(0.0), F.col("lo") - pad)).otherwise(F.col("lo")), F.lit(0.0)).alias("color_min"),
        F.coalesce(F.when(flat, F.least(F.lit(1.0), F.col("hi") + pad)).otherwise(F.col("hi")), F.lit(1.0)).alias("color_max"),
    )


def bounds(
    df: DataFrame, column: str, fallback: tuple[float, float] = (0.0, 1.0), widen: str = "unit"
) -> DataFrame:
    """Smallest and largest value. A single value widens: 'unit' adds 1 on top, 'relative' 1 % both ways."""
    row = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    eps = F.greatest(F.abs("lo") * 0.01, F.lit(1e-6))
    lo, hi = (F.col("lo"), F.col("lo") + 1.0) if widen == "unit" else (F.col("lo") - eps, F.col("hi") + eps)
    return row.select(
        F.coalesce(F.when(flat, lo).otherwise(F.col("lo")), F.lit(fallback[0])).alias("lo"),
        F.coalesce(F.when(flat, hi).otherwise(F.col("hi")), F.lit(fallback[1])).alias("hi"),
    )


def volumes(tables: Mapping[str, DataFrame], distinct: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """One row per name with the row count, or the distinct count of a column."""
    rows = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in tables.items()]
    rows += [
        df.agg(F.lit(name).alias("name"), F.count_distinct(c).alias("n"))
        for name, (df, c) in (distinct or {}).items()
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out

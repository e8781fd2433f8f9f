"""Site score of a cell: competition, access, property price, income and target share, times demand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from placerank import fixed
from placerank.functions.codes import commune_key3
from placerank.functions.scores import capped_bonus, invert, normalize, weighted
from placerank.operators.joins import join_keys
from placerank.operators.rank import top_k, top_k_per
from placerank.operators.rollup import rollup
from placerank.operators.spatial import proximity_metrics
from placerank.operators.stats import one_row, with_stats
from placerank.session import cut_lineage

Bounds = tuple[Column, Column]
TERMS = ("competition_score", "access_score", "property_score", "income_score", "target_share")


def competition_metrics(
    cells: DataFrame, clubs: DataFrame, *, cell_id: str = "cell_id", point: tuple[str, str] = ("lat", "lon"),
    club: tuple[str, str] = ("lat", "lon"), radius_km: float = fixed.CLUB_RADIUS_KM,
    deg: float = fixed.CLUB_GRID_DEG, span: int = fixed.CLUB_SPAN, exact: bool = False,
) -> DataFrame:
    """The cells with club_km (50 km when no club is seen) and n_clubs."""
    near = proximity_metrics(
        cells, clubs, point_id=cell_id, deg=deg, span=span, radius_km=radius_km, exact=exact,
        point=point, place=club, nearest="club_km", within="n_clubs",
    )
    return cells.join(near, cell_id, "left").withColumns(
        {
            "club_km": F.coalesce(F.col("club_km"), F.lit(fixed.CLUB_DISTANCE_FALLBACK_KM)),
            "n_clubs": F.coalesce(F.col("n_clubs"), F.lit(0)).cast("int"),
        }
    )


def _with_bounds(df: DataFrame, column: str, bounds: Bounds | None) -> tuple[DataFrame, Column, Column]:
    """The table with its own range of a column, unless the range is given."""
    if bounds:
        return df, *bounds
    ranged = with_stats(df, name="_range", lo=F.min(column).cast("double"), hi=F.max(column).cast("double"))
    return ranged, F.col("_range.lo"), F.col("_range.hi")


def competition_score(
    df: DataFrame, count: str = "n_clubs", distance: str = "club_km", bounds: Bounds | None = None,
    far_km: float = fixed.FAR_CLUB_KM, bonus: float = fixed.FAR_CLUB_BONUS,
) -> DataFrame:
    """Few clubs score high; a far nearest club adds a bonus, up to 1."""
    df, lo, hi = _with_bounds(df, count, bounds)
    base = invert(normalize(count, lo, hi, 0.5))
    return df.withColumn("competition_score", capped_bonus(base, F.col(distance) > far_km, bonus)).drop("_range")


def join_prices(
    cells: DataFrame, prices: DataFrame, *, code: str = "commune", pad: bool = False, accuracy: int = 1000,
) -> DataFrame:
    """Price of the cell's commune by (department, last three characters of the code), else the median price.

    prices: department, commune, price_m2, one row per commune.
    """
    median = one_row(prices, m=F.percentile_approx("price_m2", 0.5, accuracy))["m"]
    keyed = cells.withColumn("_commune3", commune_key3(code))
    by = prices.select(
        F.col("department").alias("_dep"),
        (F.lpad("commune", 3, "0") if pad else F.col("commune")).alias("_com"), "price_m2",
    )
    joined = join_keys(keyed, by, {"department": "_dep", "_commune3": "_com"}, "left").drop("_commune3")
    return joined.withColumn("price_m2", F.coalesce(F.col("price_m2"), median, F.lit(fixed.PRICE_FALLBACK)))


def property_score(
    df: DataFrame, price: str = "price_m2", cap: float = fixed.PRICE_CAP, bounds: Bounds | None = None
) -> DataFrame:
    """Cheap scores high. Normalised over all rows, then rows above the cap are left out."""
    df, lo, hi = _with_bounds(df, price, bounds)
    norm = normalize(price, lo, hi, 0.5)
    scored = df.withColumns({f"{price}_norm": norm, "property_score": invert(norm)}).drop("_range")
    return scored.filter(F.col(price) <= cap)


def join_demand(cells: DataFrame, demand: DataFrame, *, cell_id: str = "cell_id", accuracy: int = 1000) -> DataFrame:
    """Demand index of the cell, else the median index."""
    median = one_row(demand, m=F.percentile_approx("demand_index", 0.5, accuracy))["m"]
    joined = cells.join(demand.select(cell_id, "demand_index"), cell_id, "left")
    return joined.withColumn(
        "demand_index", F.coalesce(F.col("demand_index"), median, F.lit(fixed.DEMAND_FALLBACK)).cast("int")
    )


def demand_factor(df: DataFrame, index: str = "demand_index", bounds: Bounds | None = None) -> DataFrame:
    """Index normalised over the rows at hand."""
    df, lo, hi = _with_bounds(df, index, bounds)
    return df.withColumn(f"{index}_norm", normalize(index, lo, hi, 0.5)).drop("_range")


def composite(
    df: DataFrame, weights: Sequence[float] = fixed.WEIGHT_SETS["base"], terms: Sequence[str] = TERMS,
    factor: str = "demand_index_norm", score: str = "score",
) -> DataFrame:
    return df.withColumn(score, weighted(dict(zip(terms, weights)), factor))


def sensitivity(
    df: DataFrame, weight_sets: Mapping[str, Sequence[float]] = fixed.WEIGHT_SETS, k: int = fixed.TOP_PER_WEIGHT_SET,
    *, cell_id: str = "cell_id", terms: Sequence[str] = TERMS, factor: str = "demand_index_norm",
    digits: int | None = None,
) -> DataFrame:
    """(cell_id, stability): in how many weight sets a cell is among the first k.

    All sets are scored in one pass over the table. ``digits`` rounds the scores, so that equal
    scores are equal whatever the order of the sums.
    """
    def scored(weights: Sequence[float]) -> Column:
        value = weighted(dict(zip(terms, weights)), factor)
        return F.round(value, digits) if digits else value

    variants = F.array(
        *[F.struct(F.lit(name).alias("combo"), scored(w).alias("score")) for name, w in weight_sets.items()]
    )
    exploded = df.select(cell_id, F.explode(variants).alias("v")).select(cell_id, "v.combo", "v.score")
    best = top_k_per(exploded, ["combo"], [F.desc_nulls_last("score"), F.asc(cell_id)], k)
    return best.groupBy(cell_id).agg(F.count_distinct("combo").alias("stability"))


def with_stability(df: DataFrame, stability: DataFrame, *, cell_id: str = "cell_id") -> DataFrame:
    return df.join(stability, cell_id, "left").withColumn("stability", F.coalesce(F.col("stability"), F.lit(0)))


def gather_metrics(
    cells: DataFrame, clubs: DataFrame, prices: DataFrame, demand: DataFrame, *, cell_id: str = "cell_id",
    accuracy: int = 1000, cut: bool = True,
) -> DataFrame:
    """Cells with everything the score needs: clubs around, demand index, price.

    The joins on the cell id come first and share one shuffle of the cells. With ``cut`` they run
    once, their result being kept in the checkpoint folder; the normalisations then read single columns of it.
    """
    joined = competition_metrics(cells, clubs, cell_id=cell_id)
    joined = join_demand(joined, demand, cell_id=cell_id, accuracy=accuracy)
    joined = join_prices(joined, prices, accuracy=accuracy)
    return cut_lineage(joined) if cut else joined


def score_metrics(
    joined: DataFrame, weights: Sequence[float] = fixed.WEIGHT_SETS["base"], cap: float = fixed.PRICE_CAP
) -> DataFrame:
    """All sub-scores and the score of every cell within the price cap.

    Competition and price are normalised over all cells, demand over those within the cap, in one pass.
    """
    affordable = F.when(F.col("price_m2") <= cap, F.col("demand_index").cast("double"))
    ranged = with_stats(
        joined,
        n_lo=F.min("n_clubs").cast("double"), n_hi=F.max("n_clubs").cast("double"),
        p_lo=F.min("price_m2"), p_hi=F.max("price_m2"), d_lo=F.min(affordable), d_hi=F.max(affordable),
    )

    def bounds(c: str) -> Bounds:
        return F.col(f"_stats.{c}_lo"), F.col(f"_stats.{c}_hi")

    scored = competition_score(ranged, bounds=bounds("n"))
    scored = property_score(scored, cap=cap, bounds=bounds("p"))
    scored = demand_factor(scored, bounds=bounds("d"))
    return composite(scored.drop("_stats"), weights)


def score_cells(
    cells: DataFrame, clubs: DataFrame, prices: DataFrame, demand: DataFrame, *, cell_id: str = "cell_id",
    accuracy: int = 1000, weights: Sequence[float] = fixed.WEIGHT_SETS["base"], cap: float = fixed.PRICE_CAP,
    cut: bool = True,
) -> DataFrame:
    """Score cells that carry access_score, income_score and target_share already."""
    joined = gather_metrics(cells, clubs, prices, demand, cell_id=cell_id, accuracy=accuracy, cut=cut)
    return score_metrics(joined, weights, cap)


def top_cells(scored: DataFrame, k: int = fixed.TOP_CELLS, *, cell_id: str = "cell_id") -> DataFrame:
    return top_k(scored, [F.desc_nulls_last("score"), F.asc(cell_id)], k, rank="rank_score")


def zones(top: DataFrame, min_count: int = fixed.MIN_CELLS_PER_ZONE, keys: Sequence[str] = ("commune", "department")) -> DataFrame:
    """Communes with enough top cells: averages and centroid."""
    return rollup(
        top, keys, count="n_cells", centroid=("lat", "lon"), min_count=min_count,
        averages={
            f"{c}_avg": c for c in
            ("score", "competition_score", "access_score", "property_score", "income_score", "target_share",
             "demand_index", "stability")
        },
    )

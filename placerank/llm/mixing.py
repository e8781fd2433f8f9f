"""Mixing sources to target weights by a time-varying curriculum.

Targets: the sources share `share` times all words by weight; a target stops at `most` times its source's size, and the
excess is shared again by weight among the others until none is above. That is a water level, found by rounds that
bring one row of sums to the driver each; the table of sources itself stays in Spark.

Curriculum: source i's weight at time t of 0..1 is target_i * (1 + slope_i * (2t - 1)). Integrated, its demand up to t
is target_i * (t + slope_i * (t*t - t)). A document's take starts where the words taken before it in its source (in the
order of a hash of doc_id) meet that demand: the demand is inverted to the time t, and the demand of all sources up to
t is the document's training position. Documents are then range-sorted by position.

A source's documents are taken whole, in hash order, once or twice around, and the one at the target in part, so the words taken
are the target rounded. Prefix sums are split by hash, so a source with a third of all rows is no hot task.

Defined results: null text has 0 words, takes none and has position null, as has any row that takes none. A null source is a
source of its own, last in order. Repeated rows are documents of their own. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from placerank.llm.common import WORD, cut_lineage, running_sum, spread

#: weights of the sources in code point order, repeating, and the slope of each weight over time
WEIGHTS, SLOPES = (5, 2, 1), (0.5, 0.0, -0.5)


def sized(docs: DataFrame) -> DataFrame:
    """Rows (row, doc_id, source, size): size is the number of words of the whole text."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame, share: float, most: float, weights=WEIGHTS, slopes=SLOPES) -> DataFrame:
    """Rows (source_key, has_source, source_size, weight, slope, target), one per source."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: the order of the sources, not of the documents, goes through this window
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    pick = lambda values: F.array(*[F.lit(float(v)) for v in values])[place.cast("int")]
    table = cut_lineage(sums.select(
        F.coalesce("source", F.lit("")).alias("source_key"), F.col("source").isNotNull().alias("has_source"), "source_size",
        pick(weights).alias("weight"), pick(slopes).alias("slope"),
    ))
    cap = F.lit(float(most)) * F.col("source_size")
    level, below = 0.0, -1
    while True:
        capped = F.col("weight") * F.lit(level) > cap if below >= 0 else F.lit(False)
        total, full, weight, count = table.agg(
            F.sum("source_size"), F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
            F.sum(F.when(capped, 1).otherwise(0)),
        ).first()
        if not weight or count == below:
            break
        level, below = (share * total - full) / weight, count
    return table.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS, slopes=SLOPES) -> DataFrame:
    """One row per row of docs: row, doc_id, source, size, source_size, target, takes (words of each time around), taken,
    positions (of each take, null where it is 0), position (of the first take)."""
    sizes = cut_lineage(sized(docs))
    targets = source_targets(sizes, share, most, weights, slopes)
    keyed = sizes.select(
        "*", F.coalesce("source", F.lit("")).alias("source_key"), F.col("source").isNotNull().alias("has_source"), spread(F.col("doc_id")).alias("_order")
    )
    placed = running_sum(keyed, ["source_key", "has_source"], "_order", ["doc_id", "row"], F.col("size")).join(targets, ["source_key", "has_source"])
    goal = F.round("target").cast("long")
    rounds = [
        F.greatest(F.lit(0), F.least(F.col("size"), goal - F.col("before") - k * F.col("source_size"))) for k in range(-(-int(most * 100) // 100))
    ]
    taken = sum(rounds[1:], rounds[0])
    everything = targets.agg(F.sum("target").alias("all_targets"), F.sum(F.col("target") * F.col("slope")).alias("all_slopes"))
    a = F.col("slope")

    def position(k: int) -> Column:
        """Where take k begins: t + a(t*t - t) = u, the root within 0..1."""
        u = F.try_divide(F.col("before") + k * F.col("source_size"), F.col("target"))
        t = F.least(F.when(a == 0, u).otherwise((a - 1 + F.sqrt((1 - a) * (1 - a) + 4 * a * u)) / (2 * a)), F.lit(1.0))
        demand = F.floor(F.col("all_targets") * t + F.col("all_slopes") * (t * t - t))
        return F.when(F.col("takes")[k] > 0, demand)

    return (
        placed.join(F.broadcast(everything))  # one row of sums
        .select("*", F.array(*rounds).alias("takes"), taken.alias("taken"))
        .select("row", "doc_id", "source", "size", "source_size", "target", "takes", "taken", F.array(*map(position, range(len(rounds)))).alias("positions"))
        .withColumn("position", F.col("positions")[0])
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """Range-sorted by the position of the first take; rows that take none come last."""
    return mixed.repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id"
    )

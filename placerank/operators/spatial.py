"""Nearest place, places within a radius and distance-decayed pressure.

Places stand in a tree of three levels: the buckets of a grid, ``fine`` times ``fine`` cells of a bucket, and as many parts of a
cell. A node knows how many places it holds and the box around them, as chords in space, so a bound on a distance is a few
multiplications and holds at the poles and across the 180th meridian too. Copies at one position are one row of a weight. A node lists at most
``fine`` squared others, so a bucket is one row of bounded size, however many places it holds.

Only the box and the counts of a place bucket are copied to the buckets around it, so what is copied does not grow with the places of a
bucket; a point meets the boxes of its whole surroundings as one row, by an equality join on two integers. It then goes to the buckets
themselves, which stay where they are: only to those that the circle cuts or that may hold a nearer place than the best one known, which the
cells of its own bucket tell closely. There it descends in the nodes by the same rule. A node within the circle is counted as a whole. What is left are
parts, one ``fine**4``-th of a bucket; one position is compared at once, and only parts with several are opened by a join. Each point's
comparisons grow with the nodes that its circle cuts, not with the places of its bucket, as long as places spread over its parts.
The depth is fixed, as rows are bounded by it: where parts hold many positions, take a smaller ``deg``. Results are those of all pairs.

A pressure needs each pair within the radius by itself. There no tree is descended and no pair goes between tasks: points and positions are dealt to
blocks, both of bounded size, and pairs are made and summed up where a block lies.

Without ``exact`` a place is seen when its bucket is at most ``span`` away on both axes, whatever the
distance. With ``exact`` the reach of the copies follows from the radius and the latitude, so that
every place within the radius is seen and none beyond it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from placerank import fixed
from placerank.functions.geo import grid_key, haversine_km
from placerank.functions.scores import clip, size_factor
from placerank.session import cut_lineage

KM_PER_DEGREE = math.pi * fixed.EARTH_RADIUS_KM / 180
_TIGHT = 1e-9


def expand_neighbors(df: DataFrame, span: int, lat_b: str = "lat_b", lon_b: str = "lon_b",
                     reach: Column | None = None) -> DataFrame:
    """One copy per neighbouring bucket; ``reach`` gives the longitude span per row, else ``span``."""
    side = F.lit(span) if reach is None else reach
    return (
        df.withColumn("_dlat", F.explode(F.sequence(F.lit(-span), F.lit(span))))
        .withColumn("_dlon", F.explode(F.sequence(-side, side)))
        .withColumns({lat_b: F.col(lat_b) + F.col("_dlat"), lon_b: F.col(lon_b) + F.col("_dlon")})
        .drop("_dlat", "_dlon")
    )


def _spans(radius_km: float, deg: float, lat: Column) -> tuple[int, Column]:
    """Bucket spans that reach every place within the radius, from the row's own latitude."""
    lat_span = math.ceil(radius_km / KM_PER_DEGREE / deg)
    # the widest parallel circle of the target is at most one radius nearer to the pole
    edge = F.least(F.abs(lat) + radius_km / KM_PER_DEGREE, F.lit(89.0))
    lon_span = F.ceil(radius_km / (KM_PER_DEGREE * F.cos(F.radians(edge))) / deg).cast("int")
    return lat_span, F.least(lon_span, F.lit(math.ceil(360 / deg)))


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))


#: pairs that one task makes, and more tasks than a driver should keep
PAIRS_PER_TASK, MOST_TASKS = 2_000_000, 20_000


def _dealt(left: DataFrame, right: DataFrame, how: str = "inner", most: int | None = None) -> DataFrame:
    """The join of rows that share a bucket (lat_b, lon_b), dealt to tasks by the pairs that it makes.

    The pairs of a bucket are known beforehand from the rows on both sides. Their sum gives the number of tasks; adaptive execution
    would go by the bytes that are read, and a few bytes make many pairs. A bucket of more than ``most`` pairs is cut into blocks, by a
    hash of the rows: a block of the left meets each block of the right once (an outer join cuts the left only).
    Dealt rows of such buckets are written to the checkpoint folder.
    """
    keys, most = ["lat_b", "lon_b"], most or PAIRS_PER_TASK
    spark = left.sparkSession
    sizes = [df.groupBy(*keys).agg(F.count("*").cast("double").alias(n)) for df, n in ((left, "_l"), (right, "_r"))]
    work = cut_lineage(sizes[0].join(sizes[1], keys).select(*keys, (F.col("_l") * F.col("_r")).alias("_pairs")))
    total, largest = (x or 0.0 for x in work.agg(F.sum("_pairs"), F.max("_pairs")).first())
    tasks = int(min(max(total / most, spark.sparkContext.defaultParallelism), MOST_TASKS))
    if largest <= most:
        return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys, how)

    blocks = F.col("_pairs") / most
    crowded = work.filter(F.col("_pairs") > most).select(*keys, F.ceil(F.sqrt(blocks) if how == "inner" else blocks).alias("_cut"))

    def cut(df: DataFrame, own: str, other: str, copied: bool) -> DataFrame:
        known = F.coalesce(F.col("_cut"), F.lit(1))
        # rows without a bucket meet nothing and need not meet each other
        parts = F.when(F.col("lat_b").isNull() | F.col("lon_b").isNull(), F.lit(tasks)).otherwise(known)
        place = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind]), parts)
        others = F.explode(F.sequence(F.lit(0).cast("long"), known - 1)) if copied else F.lit(0).cast("long")
        placed = df.join(crowded, keys, "left").withColumn(own, place if how == "inner" or own == "_i" else F.lit(0).cast("long"))
        return cut_lineage(placed.withColumn(other, others).drop("_cut")).repartition(tasks, *keys, "_i", "_j")

    return cut(left, "_i", "_j", how == "inner").join(cut(right, "_j", "_i", True), [*keys, "_i", "_j"], how).drop("_i", "_j")


def neighbor_join(
    points: DataFrame, places: DataFrame, deg: float, span: int, how: str = "left",
    point: tuple[str, str] = ("lat", "lon"), place: tuple[str, str] = ("place_lat", "place_lon"),
    distance: str = "distance_km",
) -> DataFrame:
    """Candidate pairs with their distance, for uses the aggregates below do not cover.

    ``how='left'`` keeps points without a candidate. The output has one row per pair.
    """
    a_lat, a_lon = grid_key(*point, deg)
    b_lat, b_lon = grid_key(*place, deg)
    left = points.withColumns({"lat_b": a_lat, "lon_b": a_lon})
    right = expand_neighbors(_located(places, *place).withColumns({"lat_b": b_lat, "lon_b": b_lon}), span)
    return (
        _dealt(left, right, how)
        .drop("lat_b", "lon_b")
        .withColumn(distance, haversine_km(*point, *place))
    )


#: rounding of a unit vector; boxes are wider by it on each side
_PAD = 1e-15
_AXES = ("x", "y", "z")


def _unit_vector(lat: str, lon: str) -> dict[str, str]:
    return {"x": f"cos(radians({lat})) * cos(radians({lon}))", "y": f"cos(radians({lat})) * sin(radians({lon}))", "z": f"sin(radians({lat}))"}


def _box(sums: list[str]) -> list[Column]:
    """Aggregates of a node: its box and its sums."""
    ends = [F.expr(f"{f}({a}{end}) AS {a}{end}") for a in _AXES for end, f in ((0, "min"), (1, "max"))]
    return ends + [F.expr(f"sum({c}) AS {c}") for c in sums]


def _low(node: str) -> str:
    """Least squared chord from the point (_px, _py, _pz) to the box of a node."""
    return "(" + " + ".join(f"pow(greatest({node}.{a}0 - _p{a}, _p{a} - {node}.{a}1, 0D), 2)" for a in _AXES) + ")"


def _high(node: str) -> str:
    return "(" + " + ".join(f"pow(greatest(_p{a} - {node}.{a}0, {node}.{a}1 - _p{a}), 2)" for a in _AXES) + ")"


def _chords(radius_km: float) -> tuple[float, float]:
    """Squared chords surely within and surely beyond the radius."""
    chord = (2 * math.sin(min(radius_km / (2 * fixed.EARTH_RADIUS_KM), math.pi / 2))) ** 2
    return chord * (1 - _TIGHT), chord * (1 + _TIGHT)


def _place_tree(positions: DataFrame, deg: float, fine: int, sums: list[str]) -> tuple[DataFrame, DataFrame]:
    """(one row per bucket with its tree in ``node`` and the boxes of its cells in ``_own``, the positions of parts that hold several) from rows (_lat, _lon, *sums).

    Positions are dealt by part, then parts by bucket, of which one has at most ``fine**4``: nodes and lists are made where their bucket lies and are not
    sent themselves. Whatever is read of the tree needs all columns that are dealt, so Spark deals them once for all its readers. The box of one
    position follows from the position and is not sent either.
    ``fine`` is a power of two: a part's number then gives its cell's and its bucket's, by a shift, without rounding.
    """
    bits = fine.bit_length() - 1
    if 1 << bits != fine:
        raise ValueError("fine must be a power of two")

    def part(y: str, x: str) -> list[str]:
        # never null, and known not to be: a join would else filter nulls below what is dealt, which its readers then could not share
        return [f"coalesce(CAST(floor({c} / {deg / fine**2!r}D) AS INT), 0) AS {name}" for c, name in (("_lat", y), ("_lon", x))]

    ends = {f"{a}{end}": f"{text} {sign} {_PAD!r}D" for a, text in _unit_vector("_lat", "_lon").items() for end, sign in ((0, "-"), (1, "+"))}
    box = [f"{a}{end}" for a in _AXES for end in (0, 1)]
    more = [F.expr(text) for text in ("count(*) AS k", "min(_lat) AS _lat", "min(_lon) AS _lon")]
    spots = positions.selectExpr("_lat", "_lon", *sums, *part("_py", "_px")).repartition("_py", "_px")
    counted = spots.selectExpr("_py AS _sy", "_px AS _sx", "_lat", "_lon", *sums, "count(*) OVER (PARTITION BY _py, _px) AS k")
    several = counted.filter("k > 1").drop("k")

    parts = spots.selectExpr("*", *[f"{ends[name]} AS {name}" for name in box]).groupBy("_py", "_px").agg(*_box(sums), *more)
    home = [f"shiftright({c}, {2 * bits}) AS {name}" for c, name in (("_py", "_hy"), ("_px", "_hx"))]
    sent = parts.selectExpr(*home, "_lat", "_lon", "k", *sums, f"CASE WHEN k > 1 THEN struct({', '.join(box)}) END AS _box")
    # as many tasks as the session deals to: adaptive execution would merge them by the bytes of parts, and the lists made of these are several times larger
    sent = sent.repartition(int(positions.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_hy", "_hx")
    # the vector first, by itself: the boxes are then short code
    at = _given(sent, **{f"_u{a}": text for a, text in _unit_vector("_lat", "_lon").items()})
    boxes = [f"CASE WHEN k > 1 THEN _box.{a}{end} ELSE _u{a} {sign} {_PAD!r}D END AS {a}{end}" for a in _AXES for end, sign in ((0, "-"), (1, "+"))]
    parts = at.selectExpr("_hy", "_hx", "_lat", "_lon", "k", *sums, *part("_sy", "_sx"), *boxes)

    def gathered(nodes: DataFrame, keys: list, **lists: list[str]) -> DataFrame:
        """Nodes of one level, each in the lists of the node above; a list has at most ``fine`` squared entries."""
        made = [F.expr(f"collect_list(struct({', '.join(kept)})) AS {name}") for name, kept in lists.items()]
        return nodes.groupBy("_hy", "_hx", *keys).agg(*_box(sums), *made)

    above = [F.expr(f"shiftright({c}, {bits}) AS {name}") for c, name in (("_sy", "_cy"), ("_sx", "_cx"))]
    cells = gathered(parts, above, parts=[*box, *sums, "k", "_lat", "_lon", "_sy", "_sx"])
    buckets = gathered(cells, [], cells=[*box, *sums, "parts"], _own=[*box, *sums])
    return buckets.selectExpr("_hy AS lat_b", "_hx AS lon_b", f"struct({', '.join([*box, *sums])}, cells) AS node", "_own"), several


class Tree(NamedTuple):
    """``near``: a row per bucket that sees places, with the boxes of all buckets around it in ``_near``; ``buckets``: the rows of ``_place_tree``."""

    near: DataFrame
    buckets: DataFrame


def _surroundings(buckets: DataFrame, around) -> Tree:
    held = [f"node.{name}" for name in buckets.schema["node"].dataType.names if name != "cells"]
    boxes = buckets.selectExpr("lat_b", "lon_b", f"struct({', '.join(held)}, lat_b AS _by, lon_b AS _bx) AS node")
    return Tree(around(boxes).groupBy("lat_b", "lon_b").agg(F.collect_list("node").alias("_near")), buckets)


def _given(df: DataFrame, drop: tuple[str, ...] = (), **values: str) -> DataFrame:
    """Columns from SQL, computed once: without the generator Spark would write them into every mention, also into one per list entry."""
    made = ", ".join(f"{text} AS {name}" for name, text in values.items())
    return df.selectExpr(*[c for c in df.columns if c not in values and c not in drop], f"inline(array(struct({made})))")


def _opened(points: DataFrame, tree: Tree, several: DataFrame, sums: list[str], *, nearest: bool, radius_km: float | None,
            count: str | None) -> DataFrame:
    """Rows of a point's columns with a position to compare (_lat, _lon, *sums), and ``_border``, whether the circle cuts its node.

    ``nearest`` keeps nodes that may hold a nearer place than the best known one. With ``count`` (one of ``sums``) nodes within the circle
    are counted as a whole: the sum of ``_inside`` over a point's rows is their total, in rows without a position, and other nodes are
    opened only if the circle cuts them; each point that sees a place has a row. Else, with a radius, every node within it or cut by it is opened.

    The sides of each join are dealt by its keys before Spark chooses the kind of join, by sizes it has measured: file sizes tell
    little of copies and lists.
    """
    inner, outer = _chords(radius_km) if radius_km is not None else (None, None)
    unknown = "CAST(NULL AS INT)"

    def near(node: str) -> str:
        kept = [f"{_low(node)} <= _best"] if nearest else []
        if radius_km is not None:
            cut = f"{_low(node)} <= {outer!r}D"
            if count:
                cut += f" AND {_high(node)} > {inner!r}D"
            kept.append(f"({cut})")
        return " OR ".join(kept)

    def best(nodes: str, known: str = "") -> dict[str, str]:
        found = f"array_min(transform({nodes}, n -> {_high('n')}))"
        return {"_best": f"least({known}, {found})" if known else found} if nearest else {}

    def within(nodes: str) -> str:
        """Weight of the nodes within the circle; what lies below a node that is counted is not asked."""
        return f"aggregate({nodes}, 0L, (s, n) -> s + CASE WHEN {_high('n')} <= {inner!r}D THEN n.{count} ELSE 0L END)" if count else "0L"

    def below(nodes: str, name: str) -> str:
        asked = f"filter({nodes}, n -> {_high('n')} > {inner!r}D)" if count else nodes
        return f"flatten(transform({asked}, n -> n.{name}))"

    def counted(rows: str, none: str) -> str:
        """The list with an entry for what is counted as a whole, if there is anything or the list is empty."""
        return f"concat(CASE WHEN _inside > 0 OR size({rows}) = 0 THEN array({none}) ELSE array() END, {rows})" if count else rows

    names = [c for c in points.columns if c not in ("lat_b", "lon_b")]
    held = [*names, "_best"] if nearest else names
    vector = [f"{text} AS _p{a}" for a, text in _unit_vector("_plat", "_plon").items()]
    lost = f"{-(2**31)} + pmod(hash({', '.join(names)}), {1 << 20})"

    # the boxes of the buckets around; the cells of a point's own bucket tell closely how near the nearest place is at most
    rows = points.repartition("lat_b", "lon_b").selectExpr("*", *vector).join(tree.near, ["lat_b", "lon_b"])
    if nearest:
        rows = rows.join(tree.buckets.select("lat_b", "lon_b", "_own"), ["lat_b", "lon_b"], "left").drop("lat_b", "lon_b")
        rows = _given(rows, ("_own",), _best=f"least(array_min(transform(_near, n -> {_high('n')})), array_min(transform(_own, n -> {_high('n')})))")
    whole = f"{_high('n')} <= {inner!r}D" if count else "false"
    seen = f"transform(filter(_near, n -> {near('n')}), n -> struct(n._by AS _by, n._bx AS _bx, 0L AS _inside, {whole} AS _whole))"
    rows = _given(rows, ("lat_b", "lon_b", "_near"), _seen=seen, _inside=within("_near"))
    pairs = rows.selectExpr(*held, f"inline({counted('_seen', f'struct({unknown} AS _by, {unknown} AS _bx, _inside, true AS _whole)')})")

    # the buckets themselves; what has none of them left gets keys of its own that nothing has, so that it is spread and not one key of nulls
    pairs = pairs.selectExpr(*held, f"coalesce(_by, {lost}) AS _by", f"coalesce(_bx, {-(2**31)}) AS _bx", "_inside", "_whole").repartition("_by", "_bx")
    cells = tree.buckets.selectExpr("lat_b AS _by", "lon_b AS _bx", "node.cells AS _nodes")
    rows = pairs.join(cells, ["_by", "_bx"], "left" if count else "inner").drop("_by", "_bx").selectExpr("*", *vector)
    if count:
        rows = rows.withColumn("_nodes", F.expr("coalesce(_nodes, array())"))
    if nearest:
        rows = _given(rows, **best("_nodes", "_best"))
    rows = _given(rows, ("_nodes", "_whole"), _kept=f"filter(_nodes, n -> {near('n')})",
                  _inside=f"_inside + CASE WHEN _whole THEN 0L ELSE {within('_nodes')} END")
    rows = _given(rows, ("_kept",), _nodes="flatten(transform(_kept, n -> n.parts))", _inside=f"_inside + {within(below('_kept', 'parts'))}")
    if nearest:
        rows = _given(rows, **best("_nodes", "_best"))
    border = f"{_low('n')} <= {outer!r}D AND {_high('n')} > {inner!r}D" if count else "false"
    fields = ["_sy", "_sx", "k", "_lat", "_lon", *sums]
    opened = f"transform(filter(_nodes, n -> {near('n')}), n -> struct({', '.join(f'n.{f} AS {f}' for f in fields)}, {border} AS _border, 0L AS _inside))"
    rows = _given(rows, ("_nodes",), _open=opened, _inside="_inside")
    kinds = {"_sy": "INT", "_sx": "INT", "k": "BIGINT", "_lat": "DOUBLE", "_lon": "DOUBLE", **{c: dict(several.dtypes)[c] for c in sums}}
    none = ", ".join(f"CAST(NULL AS {kinds[f]}) AS {f}" for f in fields)
    rows = rows.selectExpr(*names, f"inline({counted('_open', f'struct({none}, false AS _border, _inside)')})")
    # rows of one position or none likewise
    rows = rows.selectExpr(*names, "_inside", "_border", f"CASE WHEN k > 1 THEN _sy ELSE {lost} END AS _sy",
                           f"CASE WHEN k > 1 THEN _sx ELSE {-(2**31)} END AS _sx", "_lat", "_lon", *sums).repartition("_sy", "_sx")
    inner_rows = several.selectExpr("_sy", "_sx", *[f"{c} AS _in{c}" for c in ("_lat", "_lon", *sums)])
    chosen = [f"CASE WHEN _in_lat IS NOT NULL THEN _in{c} ELSE {c} END AS {c}" for c in ("_lat", "_lon", *sums)]
    return rows.join(inner_rows, ["_sy", "_sx"], "left").selectExpr(*names, "_inside", "_border", *chosen)


def _with_bucket(points: DataFrame, point_id: str, lat: str, lon: str, deg: float) -> DataFrame:
    lat_b, lon_b = grid_key(lat, lon, deg)
    return _located(points, lat, lon).filter(F.col(point_id).isNotNull()).select(
        point_id, F.col(lat).alias("_plat"), F.col(lon).alias("_plon"), lat_b.alias("lat_b"), lon_b.alias("lon_b")
    )


def _around(deg: float, span: int | None, radius_km: float | None, exact: bool):
    """Copies of bucket rows to all buckets from which they are seen."""

    def copies(buckets: DataFrame) -> DataFrame:
        if not exact:
            return expand_neighbors(buckets, span)
        edge = F.greatest(F.abs(F.col("lat_b") * deg), F.abs((F.col("lat_b") + 1) * deg))
        lat_span, reach = _spans(radius_km, deg, edge)
        return expand_neighbors(buckets, lat_span, reach=reach)

    return copies


def proximity_metrics(
    points: DataFrame, places: DataFrame, *, point_id: str, deg: float, span: int | None = None,
    radius_km: float | None = None, exact: bool = False,
    point: tuple[str, str] = ("lat", "lon"), place: tuple[str, str] = ("lat", "lon"),
    nearest: str | None = "nearest_km", within: str | None = "n_within", fine: int = 8,
) -> DataFrame:
    """Per point: distance to the nearest place and number of places within ``radius_km``.

    Points that see no place are absent; join back and impute as the use needs. ``point_id`` must be
    unique. With ``exact`` the nearest place is looked for within ``radius_km`` only.
    """
    if exact and radius_km is None:
        raise ValueError("exact needs radius_km")
    count = within is not None
    if count and radius_km is None:
        raise ValueError("counting needs radius_km")

    spots, sums = _located(places, *place).select(F.col(place[0]).alias("_lat"), F.col(place[1]).alias("_lon")), ["_w"] if count else []
    positions = spots.groupBy("_lat", "_lon").agg(F.count("*").alias("_w")) if count else spots.distinct()
    buckets, several = _place_tree(positions, deg, fine, sums)
    tree = _surroundings(buckets, _around(deg, span, radius_km, exact))
    asked = _with_bucket(points, point_id, *point, deg)
    if count:
        # a point that comes several times is looked up once
        asked = asked.groupBy(*asked.columns).agg(F.count("*").alias("_times"))
    rows = _opened(
        asked, tree, several, sums, nearest=nearest is not None,
        radius_km=radius_km if count else None, count="_w" if count else None,
    ).withColumn("_d", haversine_km("_plat", "_plon", "_lat", "_lon"))
    aggs = []
    if nearest is not None:
        aggs.append(F.min("_d").alias(nearest))
    if count:
        hit = F.col("_border") & (F.col("_d") <= radius_km)
        aggs.append(F.sum(F.when(hit, F.col("_w")).otherwise(F.lit(0))).alias("_hits"))
        aggs.append(F.sum("_inside").alias("_inside"))
        out = rows.groupBy(point_id, "_plat", "_plon", "_times").agg(*aggs)
        aggs = [F.min(nearest).alias(nearest)] if nearest is not None else []
        aggs += [F.sum(F.col("_hits") * F.col("_times")).alias("_hits"), F.max("_inside").alias("_inside")]
        out = out.groupBy(point_id).agg(*aggs)
    else:
        out = rows.groupBy(point_id).agg(*aggs)
    columns = [F.col(point_id)]
    if nearest is not None:
        columns.append((F.when(F.col(nearest) <= radius_km, F.col(nearest)) if exact else F.col(nearest)).alias(nearest))
    if count:
        columns.append((F.col("_hits") + F.col("_inside")).cast("long").alias(within))
    return out.select(*columns)


def nearest_distance(points: DataFrame, places: DataFrame, *, point_id: str, deg: float, span: int, **kw) -> DataFrame:
    """Distance to the nearest place seen, per point that sees any."""
    return proximity_metrics(points, places, point_id=point_id, deg=deg, span=span, within=None, **kw)


def count_within(
    points: DataFrame, places: DataFrame, *, point_id: str, place_id: str, radius_km: float, deg: float,
    span: int | None = None, exact: bool = False, point: tuple[str, str] = ("lat", "lon"),
    place: tuple[str, str] = ("lat", "lon"), within: str = "n_within", unique_ids: bool = False, **kw,
) -> DataFrame:
    """Number of distinct place ids within the radius, per point that sees any place.

    Ids with one position are counted by position. The few ids with several positions are compared
    by themselves, and counted once however many of their positions lie within the radius.
    ``unique_ids`` says that the places are keyed by the id already, which spares the search for those.
    """
    if unique_ids:
        return proximity_metrics(
            points, places.filter(F.col(place_id).isNotNull()), point_id=point_id, deg=deg, span=span,
            radius_km=radius_km, exact=exact, point=point, place=place, nearest=None, within=within, **kw,
        )
    known = _located(places, *place).select(
        F.col(place_id).alias("_id"), F.col(place[0]).alias("lat"), F.col(place[1]).alias("lon")
    ).filter(F.col("_id").isNotNull())
    spot = F.struct("lat", "lon")
    by_id = known.groupBy("_id").agg(F.min(spot).alias("_a"), F.max(spot).alias("_z"))
    fixed_ids = by_id.filter(F.col("_a") == F.col("_z")).select("_a.lat", "_a.lon")
    moving = known.join(by_id.filter(F.col("_a") != F.col("_z")).select("_id"), "_id", "left_semi").distinct()

    simple = proximity_metrics(
        points, fixed_ids, point_id=point_id, deg=deg, span=span, radius_km=radius_km, exact=exact,
        point=point, nearest=None, within="_simple", **kw,
    )
    lat_b, lon_b = grid_key("lat", "lon", deg)
    keyed = moving.withColumns({"lat_b": lat_b, "lon_b": lon_b})
    if exact:
        lat_span, reach = _spans(radius_km, deg, F.col("lat"))
        near = expand_neighbors(keyed, lat_span, reach=reach)
    else:
        near = expand_neighbors(keyed, span)
    multi = (
        _with_bucket(points, point_id, *point, deg).join(near, ["lat_b", "lon_b"])
        .withColumn("_d", haversine_km("_plat", "_plon", "lat", "lon"))
        .groupBy(point_id).agg(F.count_distinct(F.when(F.col("_d") <= radius_km, F.col("_id"))).alias("_multi"))
    )
    both = simple.toDF(point_id, within).union(multi)
    return both.groupBy(point_id).agg(F.sum(within).alias(within))


def within_radius_pairs(
    a: DataFrame, b: DataFrame, radius_km: float, deg: float, *, left: tuple[str, str], right: tuple[str, str],
    distance: str = "distance_km",
) -> DataFrame:
    """All pairs within the radius, exactly: the result itself is the list of pairs."""
    a_lat, a_lon = grid_key(*left, deg)
    b_lat, b_lon = grid_key(*right, deg)
    lat_span, reach = _spans(radius_km, deg, F.col(right[0]))
    near = expand_neighbors(
        _located(b, *right).withColumns({"lat_b": b_lat, "lon_b": b_lon}), lat_span, reach=reach
    )
    return (
        _dealt(_located(a, *left).withColumns({"lat_b": a_lat, "lon_b": a_lon}), near).drop("lat_b", "lon_b")
        .withColumn(distance, haversine_km(*left, *right))
        .filter(F.col(distance) <= radius_km)
    )


def within_radius_self_pairs(
    df: DataFrame, radius_km: float, deg: float, *, key: str, lat: str = "lat", lon: str = "lon",
    names: tuple[str, str] = ("a", "b"), distance: str = "distance_km",
) -> DataFrame:
    """(names[0], names[1], distance) of all pairs of rows within the radius, each once, the smaller ``key`` first.

    Half of a join: a row is copied only to its own bucket and to those that come later by latitude, then longitude, and within a bucket rows
    meet in the order of their keys; no pair is made twice or with itself. ``key`` must be unique; rows without it are left out.
    """
    lat_b, lon_b = grid_key(lat, lon, deg)
    rows = _located(df, lat, lon).filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), lat_b.alias("lat_b"), lon_b.alias("lon_b")
    )
    lat_span, reach = _spans(radius_km, deg, F.col("_lat"))
    home = [F.col("lat_b").alias("_hy"), F.col("lon_b").alias("_hx")]
    copies = expand_neighbors(rows.select("*", *home), lat_span, reach=reach)
    later = (F.col("lat_b") > F.col("_hy")) | ((F.col("lat_b") == F.col("_hy")) & (F.col("lon_b") >= F.col("_hx")))
    copies = copies.filter(later).withColumnsRenamed({"_k": "_k2", "_lat": "_lat2", "_lon": "_lon2"})
    at_home = (F.col("lat_b") == F.col("_hy")) & (F.col("lon_b") == F.col("_hx"))
    met = _dealt(rows, copies).filter(~at_home | (F.col("_k") < F.col("_k2")))
    return met.withColumn(distance, haversine_km("_lat", "_lon", "_lat2", "_lon2")).filter(F.col(distance) <= radius_km).select(
        F.least("_k", "_k2").alias(names[0]), F.greatest("_k", "_k2").alias(names[1]), distance
    )


#: points, and places, that a block holds at most
BLOCK = 8_000


def _compared(spots: DataFrame, positions: DataFrame, deg: float, fine: int, around, radius_km: float) -> DataFrame:
    """Rows of a spot (_plat, _plon, lat_b, lon_b) with a position (_lat, _lon, ...) and their distance ``_d``: all within the radius, none surely beyond it.

    The positions of a cell, one of ``fine`` times ``fine`` of a bucket, are copied to the buckets with a spot that may have them within the radius.
    Spots and positions of a bucket are cut into blocks, and each block of spots meets each block of positions in a task, so a task holds a bounded
    number of rows, however crowded the bucket is. What is dealt are rows of both sides; the pairs, which grow with the square of the density, arise
    behind the last deal, to be aggregated there. Both sides are read several times.
    """
    keys, cell, spark = ["lat_b", "lon_b"], ["_by", "_bx", "_cy", "_cx"], spots.sparkSession
    at = {name: value for side, names in ((deg, cell[:2]), (deg / fine, cell[2:])) for name, value in zip(names, grid_key("_lat", "_lon", side))}
    placed = positions.withColumns(at)
    ends = [f"{text} {sign} {_PAD!r}D AS {a}{end}" for a, text in _unit_vector("_lat", "_lon").items() for end, sign in ((0, "-"), (1, "+"))]
    box = [f"{a}{end}" for a in _AXES for end in (0, 1)]
    cells = placed.selectExpr(*cell, *ends).groupBy(*cell).agg(*_box([]), F.count("*").alias("k"))
    nodes = cells.selectExpr("_by AS lat_b", "_bx AS lon_b", f"struct({', '.join([*box, 'k', '_cy', '_cx'])}) AS node")

    # one row per bucket with spots: their box, and the numbers of blocks; written, as both sides need it, and its sum gives the number of tasks
    sides = spots.selectExpr(*keys, *[f"{text} AS {a}" for a, text in _unit_vector("_plat", "_plon").items()])
    asked = sides.groupBy(*keys).agg(F.count("*").alias("_asked"), *[F.expr(f"{f}({a}) AS _p{a}{end}") for a in _AXES for end, f in ((0, "min"), (1, "max"))])
    known = around(nodes.selectExpr(*keys, "node.k AS k")).groupBy(*keys).agg(F.sum("k").alias("_known"))
    blocks = [F.ceil(F.col(n) / BLOCK).cast("int").alias(cut) for n, cut in (("_asked", "_is"), ("_known", "_js"))]
    work = cut_lineage(asked.join(known, keys).select("*", *blocks))
    total = work.agg(F.sum(F.col("_asked").cast("double") * F.col("_known"))).first()[0] or 0.0
    tasks = int(min(max(total / BLOCK**2, spark.sparkContext.defaultParallelism), MOST_TASKS))

    gap = " + ".join(f"pow(greatest(n.{a}0 - _p{a}1, _p{a}0 - n.{a}1, 0D), 2)" for a in _AXES)
    far = f"{_chords(radius_km)[1] + _PAD!r}D"
    seen = _surroundings(nodes, around).near.join(work, keys).selectExpr(*keys, "_is", "_js", f"inline(filter(_near, n -> {gap} <= {far}))")
    block = "CAST(pmod(hash({0}lat, {0}lon), {1}) AS INT) AS {2}".format
    every = "explode(sequence(0, {} - 1)) AS {}".format
    left = spots.join(work.select(*keys, "_is", "_js"), keys).selectExpr(*keys, "_plat", "_plon", block("_p", "_is", "_i"), every("_js", "_j"))
    kept = [c for c in positions.columns if c not in cell]
    right = placed.join(seen.select(*keys, "_is", "_js", *cell), cell).selectExpr(
        "lat_b AS _ly", "lon_b AS _lx", *kept, block("_", "_js", "_rj"), every("_is", "_ri")
    )
    vector = [f"{text} AS _p{a}" for a, text in _unit_vector("_plat", "_plon").items()]
    left = left.repartition(tasks, *keys, "_i", "_j").selectExpr("*", *vector)
    vector = [f"{text} AS {a}" for a, text in _unit_vector("_lat", "_lon").items()]
    right = right.repartition(tasks, "_ly", "_lx", "_ri", "_rj").selectExpr("*", *vector)
    # each pair costs what stands here: products, as powers take longer than all else, and the distance from the chord, which has its sines already
    chord = " + ".join(f"(_p{a} - {a}) * (_p{a} - {a})" for a in _AXES)
    met = f"lat_b = _ly AND lon_b = _lx AND _i = _ri AND _j = _rj AND {chord} <= {far}"
    distance = f"{2 * fixed.EARTH_RADIUS_KM!r}D * asin(least(sqrt({chord}) / 2, 1D)) AS _d"
    return left.join(right, F.expr(met)).selectExpr("_plat", "_plon", *kept, distance)


def _power(x: str, exponent: float) -> str:
    """A column to the exponent; where that is some quarters, from roots, which take a fraction of the time of a power."""
    whole, quarters = divmod(round(exponent * 4), 4)
    if exponent != whole + quarters / 4 or not 0 < exponent <= 4:
        return f"pow({x}, {exponent!r}D)"
    return " * ".join([x] * whole + [f"sqrt({x})"] * (quarters // 2) + [f"sqrt(sqrt({x}))"] * (quarters % 2))


class Pressure(NamedTuple):
    """One class of competitors: which they are, their intensity, and the names of the results."""

    of: Column
    intensity: tuple[float, float]
    pressure: str
    nearest: str


def competition_pressures(
    targets: DataFrame, competitors: DataFrame, classes: Sequence[Pressure], *, target_id: str, competitor_id: str,
    lat: str = "lat", lon: str = "lon", size: str = "courts", radius_km: float = fixed.IMPACT_RADIUS_KM,
    exponent: float = fixed.IMPACT_EXPONENT, deg: float = fixed.IMPACT_GRID_DEG, cap: float = fixed.PRESSURE_MAX, fine: int = 8,
) -> DataFrame:
    """Per target and class: the sum over its competitors within the radius of (1 - d/radius)^exponent * intensity, and the nearest one.

    A competitor never presses on the target with its own id. Both sides are merged by position
    first; a target's own share, which sits at distance 0 with factor 1, is taken off afterwards. The classes share one join: a position
    has a load and a number per class. Only cells that reach into the radius are met, and pairs of positions are
    aggregated where they arise.
    """
    aggs, sums = [], []
    known = _located(competitors, lat, lon).select(
        F.col(competitor_id).alias("_cid"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"),
        *[F.when(c.of, c.intensity[0] + size_factor(size) * c.intensity[1]).otherwise(0.0).alias(f"_load{i}") for i, c in enumerate(classes)],
        *[c.of.cast("long").alias(f"_n{i}") for i, c in enumerate(classes)],
    )
    for i in range(len(classes)):
        sums += [f"_load{i}", f"_n{i}"]
    some = " OR ".join(f"_n{i} > 0" for i in range(len(classes)))
    # both sides are written, merged by position: they are read several times
    positions = cut_lineage(known.filter(some).groupBy("_lat", "_lon").agg(*[F.sum(c).alias(c) for c in sums]))
    spots = _located(targets, lat, lon).select(F.col(lat).alias("_plat"), F.col(lon).alias("_plon")).distinct()
    lat_b, lon_b = grid_key("_plat", "_plon", deg)
    spots = cut_lineage(spots.withColumns({"lat_b": lat_b, "lon_b": lon_b}))
    rows = _compared(spots, positions, deg, fine, _around(deg, None, radius_km, True), radius_km)
    # no filter by the distance: Spark would compute it once for the join and once more for the sums
    near = F.col("_d") <= radius_km
    pairs = rows.withColumn("_left", F.greatest(1.0 - F.col("_d") / radius_km, F.lit(0.0))).withColumns({
        "_decay": F.when(near, F.expr(_power("_left", float(exponent)))).otherwise(F.lit(0.0)),
        "_here": near & (F.col("_plat") == F.col("_lat")) & (F.col("_plon") == F.col("_lon")),
    })
    here = F.col("_here")
    for i in range(len(classes)):
        load, n = F.col(f"_load{i}"), F.col(f"_n{i}")
        aggs += [
            # the load at the very position is kept apart: a target's own share comes off it without rounding
            F.sum(F.when(here, F.lit(0.0)).otherwise(F.col("_decay") * load)).alias(f"_away{i}"),
            F.sum(F.when(here, load).otherwise(F.lit(0.0))).alias(f"_load_here{i}"),
            F.min(F.when(~here & (n > 0) & near, F.col("_d"))).alias(f"_nearest_away{i}"),
            F.sum(F.when(here, n).otherwise(F.lit(0))).alias(f"_n_here{i}"),
        ]
    own = known.groupBy(F.col("_cid").alias(target_id), F.col("_lat").alias("_plat"), F.col("_lon").alias("_plon")).agg(
        *[F.sum(c).alias(f"_own{c}") for c in sums]
    )
    out = (
        targets.select(target_id, F.col(lat).alias("_plat"), F.col(lon).alias("_plon"))
        .join(own, [target_id, "_plat", "_plon"], "left")
        .join(pairs.groupBy("_plat", "_plon").agg(*aggs), ["_plat", "_plon"], "left")
    )
    columns = [F.col(target_id)]
    for i, c in enumerate(classes):
        others = F.coalesce(F.col(f"_n_here{i}"), F.lit(0)) - F.coalesce(F.col(f"_own_n{i}"), F.lit(0))
        here_load = F.when(others > 0, F.col(f"_load_here{i}") - F.coalesce(F.col(f"_own_load{i}"), F.lit(0.0))).otherwise(F.lit(0.0))
        total = F.coalesce(F.col(f"_away{i}") + here_load, F.lit(0.0))
        columns.append(clip(total, 0.0, cap).alias(c.pressure))
        columns.append(F.when(others > 0, F.lit(0.0)).otherwise(F.col(f"_nearest_away{i}")).alias(c.nearest))
    return out.select(*columns)


def competition_pressure(
    targets: DataFrame, competitors: DataFrame, *, target_id: str, competitor_id: str,
    intensity: tuple[float, float], pressure: str = "pressure", nearest: str = "nearest_km", **kw,
) -> DataFrame:
    """The pressure of one class, that of all competitors."""
    classes = [Pressure(F.lit(True), intensity, pressure, nearest)]
    return competition_pressures(targets, competitors, classes, target_id=target_id, competitor_id=competitor_id, **kw)


def match_cell(
    places: DataFrame, cells: DataFrame, digits: int, order, *, place_id: str,
    place: tuple[str, str] = ("lat", "lon"), cell: tuple[str, str] = ("cell_lat", "cell_lon"),
) -> DataFrame:
    """Each place with the best cell that shares its rounded position; places without a cell stay.

    The best cell per key is found before the join, so a key with many cells sends one row per task,
    and no cell table is broadcast.
    """
    from placerank.functions.geo import round_key
    from placerank.operators.dedupe import best_per

    names = ("_key_lat", "_key_lon")
    best = best_per(cells.withColumns(dict(zip(names, round_key(*cell, digits)))), names, order)
    return places.withColumns(dict(zip(names, round_key(*place, digits)))).join(best, list(names), "left").drop(*names)

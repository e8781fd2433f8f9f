"""Near-duplicate vectors by product quantisation.

Equal vectors of one label are one class. k-means on a bounded sample gives coarse centroids; a class is listed in the
cell of its nearest centroid, with the code of its residual in each subspace and the length of the coding error. Every
class then queries the `probes` nearest cells. Within a cell, table look-ups give the distance from the query to the coded
vector; one is a candidate if that is at most the linking distance plus its own coding error, so the triangle inequality
loses none in a probed cell. Candidates are settled by the exact cosine in double precision.

Cells are split into blocks of `block` rows with their counts known beforehand, and their queries into blocks as well, so no task gathers an
unbounded list. A task returns sums of links per class and a star per group of linked classes, never the pairs.
A pair that both sides find is counted by each side for itself, one that only one side finds is counted for both.

Defined results: null label, null, zero or empty vector, or one with null or non-finite components links with nothing. Vectors
link only with vectors of the same number of components. A null vec_id gets a row, counts as a link and names no component unless it is
alone (then null). Repeated rows count as other vectors. An empty table gives an empty result; other columns are ignored.
The sample and the number of cells (about the square root of the classes) shape the index only; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import components, cut_lineage

SUBSPACES, CODES, QUERIES_AT_ONCE = 8, 256, 256
UNITS = "vec_id long, label long, dim int, unit binary"


def units(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, label, dim, unit): the normalised doubles, null where the vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, dims = [], []
            for v in batch.column("embedding").to_pylist():
                unit = None
                if v and None not in v:
                    a = np.array(v, np.float64)
                    top = np.abs(a).max()
                    if np.isfinite(top) and top > 0:
                        a /= top
                        unit = (a / np.sqrt(a @ a)).tobytes()
                made.append(unit)
                dims.append(0 if unit is None else len(unit) // 8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(made, pa.binary())], ["vec_id", "label", "dim", "unit"]
            )

    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    ).mapInArrow(run, UNITS)


# ------------------------------------------------------------- the index

def _nearest(x: np.ndarray, centres: np.ndarray, k: int = 1) -> np.ndarray:
    """Numbers of the k nearest centres of each row, nearest first."""
    out = np.empty((len(x), k), np.int64)
    norms = (centres * centres).sum(1)
    for i in range(0, len(x), 1024):
        d = norms - 2 * x[i:i + 1024] @ centres.T
        few = np.argpartition(d, k - 1, axis=1)[:, :k] if k < len(centres) else np.broadcast_to(np.arange(k), (len(d), k))
        out[i:i + 1024] = np.take_along_axis(few, np.argsort(np.take_along_axis(d, few, 1), axis=1, kind="stable"), 1)
    return out


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, centres)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        n = np.bincount(at, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _split(dim: int) -> list[tuple[int, int]]:
    parts = min(SUBSPACES, dim)
    return [(dim * i // parts, dim * (i + 1) // parts) for i in range(parts)]


def train(sample: np.ndarray, cells: int) -> dict:
    """Coarse centroids and a codebook per subspace of the residuals."""
    cells = max(1, min(cells, len(sample)))
    centres = kmeans(sample, cells)
    residual = sample - centres[_nearest(sample, centres)[:, 0]]
    books = [kmeans(residual[:, a:b], min(CODES, len(sample))) for a, b in _split(sample.shape[1])]
    return {"centres": centres, "books": books}


def encode(x: np.ndarray, cell: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(code per subspace, length of the coding error) of each row."""
    residual = x - model["centres"][cell]
    codes, error = np.empty((len(x), len(model["books"])), np.uint8), np.zeros(len(x))
    for s, ((a, b), book) in enumerate(zip(_split(x.shape[1]), model["books"])):
        codes[:, s] = _nearest(residual[:, a:b], book)[:, 0]
        error += ((residual[:, a:b] - book[codes[:, s]]) ** 2).sum(1)
    return codes, np.sqrt(error)


def _models(classes: DataFrame, sample: int, cells: int | None) -> dict[int, dict]:
    """A model per number of components, from at most `sample` classes in the order of their content's hash."""
    models = {}
    for dim, n in classes.groupBy("dim").count().collect():  # a row per number of components
        some = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("unit"), "unit").select("unit").limit(sample).toPandas()
        x = np.frombuffer(b"".join(some["unit"]), np.float64).reshape(-1, dim)
        models[dim] = train(x, cells or round(n ** 0.5))
    return models


def _placed(classes: DataFrame, models: dict[int, dict], probes: int) -> DataFrame:
    """Adds cell, code, error and the cells to probe to the classes."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for dim, g in pdf.groupby("dim"):
                x = np.frombuffer(b"".join(g["unit"]), np.float64).reshape(-1, dim)
                model = models[int(dim)]
                near = _nearest(x, model["centres"], min(probes, len(model["centres"])))
                codes, error = encode(x, near[:, 0], model)
                yield g.assign(cell=near[:, 0], code=[c.tobytes() for c in codes], error=error, probe=list(near))

    return classes.mapInPandas(run, "class_id long, label long, dim int, n long, unit binary, cell long, code binary, error double, probe array<long>")


# ------------------------------------------------------------- the search

def _pairs(mine: pd.DataFrame, theirs: pd.DataFrame, dim: int, model: dict, cell: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(query number, list number) of the pairs with at least this cosine."""
    q = np.frombuffer(b"".join(mine["unit"]), np.float64).reshape(-1, dim)
    x = np.frombuffer(b"".join(theirs["unit"]), np.float64).reshape(-1, dim)
    codes = np.frombuffer(b"".join(theirs["code"]), np.uint8).reshape(len(x), -1)
    reach = (np.sqrt(max(0.0, 2 - 2 * cosine)) + theirs["error"].to_numpy() + 1e-9) ** 2
    found_q, found_x = [], []
    for i in range(0, len(q), QUERIES_AT_ONCE):
        some = q[i:i + QUERIES_AT_ONCE] - model["centres"][cell]
        distance = np.zeros((len(some), len(x)))
        for s, ((a, b), book) in enumerate(zip(_split(dim), model["books"])):
            part = some[:, a:b]
            table = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)
            distance += table[:, codes[:, s]]
        a, b = np.nonzero(distance <= reach)
        same = np.einsum("ij,ij->i", q[i + a], x[b]) >= cosine
        found_q.append(i + a[same])
        found_x.append(b[same])
    return np.concatenate(found_q), np.concatenate(found_x)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the least node it is linked to: (node, least), by repeated minima over the links."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[:len(a)], place[len(a):]
    least = np.arange(len(nodes))
    while True:
        low = least.copy()
        np.minimum.at(low, i, least[j])
        np.minimum.at(low, j, least[i])
        low = low[low]
        if (low == least).all():
            return nodes, nodes[least]
        least = low


def search(classes: DataFrame, models: dict[int, dict], cosine: float, probes: int, block: int) -> DataFrame:
    """Rows (class_id, links, root): links found for a class in one block, and a class it is linked to there."""
    placed = cut_lineage(_placed(classes, models, probes))
    home = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    asked = placed.select("*", F.explode("probe").alias("to"))
    visits = asked.groupBy("label", "dim", F.col("to").alias("cell")).agg(F.ceil(F.count("*") / (4 * block)).cast("int").alias("parts"))
    shape = cut_lineage(home.join(visits, ["label", "dim", "cell"]))
    spot = F.pmod(F.xxhash64("class_id"), F.lit(1 << 30))
    keys = ["label", "dim", "cell", "at", "part"]
    # a list block goes to every part of its queries, and a part of the queries to every block of the list
    lists = placed.join(shape, ["label", "dim", "cell"]).withColumn("at", (spot % F.col("blocks")).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *[F.col(c).alias(c) for c in [*keys, "class_id", "n", "unit", "code", "error", "probe"]])  # columns of its own, apart from the queries'
    queries = asked.withColumn("own", F.col("cell")).drop("cell").withColumnRenamed("to", "cell").join(shape, ["label", "dim", "cell"]).withColumn(
        "part", (spot % F.col("parts")).cast("int")).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*keys, "class_id", "n", "unit", "own")

    def run(key, mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        columns = ["class_id", "links", "root"]
        if not len(mine) or not len(theirs):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
        a, b = _pairs(mine, theirs, int(key[1]), models[int(key[1])], int(key[2]), cosine)
        ids, others = mine["class_id"].to_numpy("int64"), theirs["class_id"].to_numpy("int64")
        other = ids[a] != others[b]
        a, b = a[other], b[other]
        n, m = mine["n"].to_numpy("int64"), theirs["n"].to_numpy("int64")
        own = mine["own"].to_numpy("int64")
        probe = np.stack(theirs["probe"].to_numpy()) if len(theirs) else np.zeros((0, 1), np.int64)
        one_sided = np.zeros(len(a), bool)
        for i in range(0, len(a), 1 << 16):
            s = slice(i, i + (1 << 16))
            one_sided[s] = ~(probe[b[s]] == own[a[s]][:, None]).any(axis=1)
        mine_links = np.bincount(a, m[b], len(ids)).astype(np.int64)
        their_links = np.bincount(b[one_sided], n[a[one_sided]], len(others)).astype(np.int64)
        nodes, roots = _stars(ids[a], others[b]) if len(a) else (np.zeros(0, np.int64),) * 2
        near, far = np.flatnonzero(mine_links), np.flatnonzero(their_links)
        return pd.DataFrame({
            "class_id": np.concatenate([ids[near], others[far], nodes]),
            "links": np.concatenate([mine_links[near], their_links[far], np.zeros(len(nodes), np.int64)]),
            "root": np.concatenate([ids[near], others[far], roots]),
        })

    return queries.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInPandas(run, "class_id long, links long, root long")


def near_duplicates(rows: DataFrame, cosine: float = 0.93, probes: int = 16, sample: int = 20_000, cells: int | None = None, block: int = 2048) -> DataFrame:
    """One row per row of the table: vec_id, n_links, component_id, kept."""
    made = cut_lineage(units(rows))
    links = F.col("label").isNotNull() & F.col("unit").isNotNull()
    grouped = made.filter(links).groupBy("label", "dim", "unit").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = cut_lineage(grouped.withColumn("class_id", F.monotonically_increasing_id()))
    models = _models(classes, sample, cells)
    found = cut_lineage(search(classes.select("class_id", "label", "dim", "n", "unit"), models, cosine, probes, block))
    near = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    joined = classes.join(near, "class_id", "left").join(
        linked.select(F.col("node").alias("class_id"), F.col("component").alias("root")), "class_id", "left"
    ).withColumn("root", F.coalesce("root", "class_id"))
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    named = joined.join(least, "root").select("label", "dim", "unit", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "least")
    return (
        made.join(named, ["label", "dim", "unit"], "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )

"""Near-duplicates by SimHash fingerprints, linked through multi-index hashing.

A fingerprint is cut into segments. If two differ in at most `distance` bits, then in some segment they differ in few:
with 3 segments and 4 bits, by at most 1 in the first or the second, or not at all in the third. So each fingerprint
is listed under its exact segment values, enumerates the small Hamming balls around its own values, fetches the
matches of the tables and verifies the whole distance. Equal fingerprints are one entry, whatever their number.

A segment value with more than `crowd` fingerprints would make pairs with the square of their number. Its
fingerprints, and those that probe it, are linked in another exact way: two of them are within `distance` bits if and
only if some centre lies within half of it from both (an odd distance leaves one bit to one side). Each is listed under the
centres of its ball, and a centre's list, which is no longer than the ball, is linked to its first entry: for an even distance all in
it are within reach of one another. So the work grows with the number of fingerprints, not with its square.

Components come from alternating stars. Defined results: null and empty texts have fingerprint zero and link to each other; null
doc_ids get rows but name no component unless all of it is null (then null); repeated rows get a row each; an empty table gives an empty
result; other columns are ignored. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from placerank.llm.common import components, cut_lineage, texts

BITS, SEED = 64, 42


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The signed 64-bit fingerprint of a text: XXH64 of each shingle, the majority of each bit."""
    import xxhash

    hash_of, parts = xxhash.xxh64_intdigest, text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(parts) - shingle + 1)
    starts, ends = (ends - lengths)[:n].tolist(), ends[-n:].tolist()
    hashes = np.fromiter((hash_of(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n)
    set_bits = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):
        rows = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """Rows (doc_id, fp), one per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([fingerprint(t, shingle) for t in texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def segment_plan(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment: any two within `distance` agree up to the radius in one of them."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    radius, extra = divmod(distance, segments)
    return [(a, b - a, radius if i <= extra else radius - 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if i <= extra or radius]


def ball(width: int, radius: int) -> list[int]:
    """All masks of up to `radius` of `width` bits."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _key(number: int, fp: Column, shift: int, width: int, mask: Column) -> Column:
    """(segment number, segment value) in one long."""
    value = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(_signed((1 << width) - 1))).bitwiseXOR(mask)
    return F.xxhash64(F.lit(number), value) if width > 56 else value + F.lit(_signed(number << 57))


def links(fps: DataFrame, distance: int = 4, segments: int = 3, crowd: int = 256) -> DataFrame:
    """Edges (a, b) between distinct fingerprints fp within `distance` bits, enough to connect all that are.

    Use 2 segments from about a billion fingerprints on: the balls are larger and the segment values rarer.
    """
    plan = segment_plan(distance, segments)
    fps = cut_lineage(fps.select("fp").distinct())
    fp = F.col("fp")
    index = fps.select("fp", F.explode(F.array(*[_key(i, fp, s, w, F.lit(0).cast("long")) for i, (s, w, _) in enumerate(plan)])).alias("key"))
    probes = None
    for i, (shift, width, radius) in enumerate(plan):
        masks = F.array(*[F.lit(m).cast("long") for m in ball(width, radius)])
        part = fps.select("fp", F.explode(masks).alias("mask")).select("fp", _key(i, fp, shift, width, F.col("mask")).alias("key"))
        probes = part if probes is None else probes.unionByName(part)
    crowded = cut_lineage(index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("key"))
    some = not crowded.isEmpty()
    listed = index.join(crowded, "key", "left_anti") if some else index
    other = listed.select(F.col("fp").alias("other"), "key")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    edges = probes.join(other, "key").filter((fp < F.col("other")) & near).select(fp.alias("a"), F.col("other").alias("b"))
    if some:
        among = index.join(crowded, "key", "left_semi").select("fp").unionByName(probes.join(crowded, "key", "left_semi").select("fp")).distinct()
        edges = edges.unionByName(centre_links(among, distance))
    return edges.distinct()


def centre_links(fps: DataFrame, distance: int) -> DataFrame:
    """Edges that connect all of fps within an even `distance`, by the centres halfway between them."""
    if distance % 2:
        raise ValueError("the way for crowded segments needs an even distance")
    masks = [F.lit(_signed(m)).cast("long") for m in ball(BITS, distance // 2)]
    centres = fps.select("fp", F.explode(F.array(*masks)).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("centre"))
    # a list is no longer than the ball around its centre
    lists = centres.groupBy("centre").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return lists.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, segments: int = 3, crowd: int = 256) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = cut_lineage(fingerprints(docs, shingle))
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = components(links(rows, distance, segments, crowd)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    roots = first.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""What several operators share: words, packed blobs, prefix sums without a hot task, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window, functions as F

from placerank.session import cut_lineage, new_path, shared_dir  # noqa: F401  (re-exported)

#: a word, as a Java and as a DuckDB pattern
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32_mod(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(0))


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches joined or cut to about `most` bytes of `column`, one row at least.

    What a chunk's work has freed goes back to the system before the next: workers outlive their tasks, beside the executor's heap.
    """
    pool, held, size = pa.default_memory_pool(), [], 0
    pool.release_unused()
    for batch in batches:
        c = batch.column(column)
        if pa.types.is_primitive(c.type):
            lengths = np.zeros(batch.num_rows, np.int64)
        else:
            lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(c), 0)).astype(np.int64)
        start = 0
        for i, n in enumerate(lengths.tolist()):
            size += n + 16
            if size >= most:
                held.append(batch.slice(start, i + 1 - start))
                yield _joined(held)
                held, size, start = [], 0, i + 1
                pool.release_unused()
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield _joined(held)
    held.clear()
    pool.release_unused()


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column as UTF-8, null as empty."""
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def words(batch: pa.RecordBatch, column: str = "text") -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of a batch, dictionary encoded, and where each row's words start (one entry more than rows)."""
    c = pa.compute.fill_null(batch.column(column).cast(pa.large_binary()), b"").cast(pa.large_string())
    lists = pa.compute.ascii_split_whitespace(c)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.flatten()
    full = np.asarray(pa.compute.binary_length(flat)) > 0
    before = np.concatenate([[0], np.cumsum(full)])
    starts = before[offsets - offsets[0]]
    if not full.all():
        flat = flat.filter(pa.array(full))
    return flat.dictionary_encode(), starts


def word_hashes(encoded: pa.DictionaryArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash per dictionary entry, index per word)."""
    import xxhash

    h = xxhash.xxh64_intdigest
    entries = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    made = (h(w.lower()) for w in entries) if lower else map(h, entries)
    return np.fromiter(made, np.uint64, len(entries)), np.asarray(encoded.indices).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def running_sum(df: DataFrame, keys: list[str], order: str, ties: list[str], value: Column, name: str = "before") -> DataFrame:
    """Adds `name`: the sum of `value` over the earlier rows of the same keys.

    `order` is a whole non-negative number below 2**52, spread evenly (a hash). Its upper 12 bits split each key
    into 4096 parts that are summed apart, so one key with a third of all rows is no hot task.
    """
    part = df.withColumn("_part", F.shiftright(F.col(order), 40)).withColumn("_value", value.cast("long"))
    sums = part.groupBy(*keys, "_part").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_part").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        part.join(offsets, [*keys, "_part"])
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .drop("_part", "_value", "_offset")
    )


def spread(column: Column) -> Column:
    """An even, reproducible order for running_sum: 52 bits of the MD5 of the value as text."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of edges (a, b): component is the smallest node it is linked to.

    Alternating large and small stars: each round is two aggregations and two joins, written to the shared folder.
    No neighbourhood is gathered; a hub is split by the adaptive join. Rounds grow with the logarithm of the size.
    """
    pairs = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = cut_lineage(pairs)
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        large = cut_lineage(large)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        pairs = cut_lineage(small.filter(F.col("a") != F.col("b")).distinct())
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )

"""Exact de-duplication against a history, by a minimal perfect hash over its distinct digests.

The history's digests are grouped (largest doc_id wins) and dealt to shards by their first bytes. Each shard gets a
minimal perfect hash: at each level a key whose position no other key shares sets a bit and keeps that position, the
others go on to the next level; the rank of its bit is a key's slot. A slot holds the full 32-byte digest, the winner's
doc_id and the count. A new digest goes to one slot and is a repeat only if all bytes agree; nonmembers, which the hash
sends to arbitrary slots, form groups of their own.

Digests are combined per task before any shuffle, so a text that makes up a third of all rows is one row per task.

Defined results: null text counts as empty, any two empty texts are equal. A null doc_id never wins over another.
Repeated rows (same doc_id, equal text) count towards group_size and one of them is kept. An empty table or an empty
history gives an empty result or no members. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import cut_lineage, mix, texts

DIGESTS = "doc_id long, digest binary, prefix int"
GROUPS = "digest binary, prefix int, winner long, n long"
INDEX = "shard int, n long, levels array<binary>, rest binary, digests binary, winners binary, counts binary"
#: stands for a missing winner; the smallest long, so any doc_id beats it
NO_ID = -(1 << 63)
#: bits per key and level, and levels before the few that are left are listed
GAMMA, LEVELS = 2.0, 40


def digests(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, digest, prefix): SHA-256 of the whole text, A-Z lower-cased; prefix: its first three bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [hashlib.sha256(t.lower()).digest() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.binary()), pa.array([int.from_bytes(d[:3], "big") for d in made], pa.int32())],
                ["doc_id", "digest", "prefix"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, DIGESTS)


def grouped(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: the largest doc_id (NO_ID if all are null) and the number of rows."""
    return rows.groupBy("digest", "prefix").agg(
        F.coalesce(F.max("doc_id"), F.lit(NO_ID)).alias("winner"), F.sum("copies").alias("n")
    )


# ------------------------------------------------------------- the hash

def _keys(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of each 32-byte digest, which are even hashes themselves."""
    parts = np.ascontiguousarray(flat).view(np.uint64).reshape(-1, 4)
    return parts[:, 1].copy(), parts[:, 2].copy()


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(a + np.uint64(level) * (b | np.uint64(1))) % np.uint64(size)).astype(np.int64)


def build_hash(a: np.ndarray, b: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(bits of each level, slot of each key, the keys' numbers that no level could place)."""
    slots, left, levels, used = np.zeros(len(a), np.int64), np.arange(len(a)), [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, int(GAMMA * len(left)))
        place = _place(a[left], b[left], level, size)
        alone = np.bincount(place, minlength=size) == 1
        mine = alone[place]
        slots[left[mine]] = used + (np.cumsum(alone) - 1)[place[mine]]
        used += int(mine.sum())
        levels.append(np.uint32(size).tobytes() + np.packbits(alone).tobytes())
        left = left[~mine]
    slots[left] = used + np.arange(len(left))
    return levels, slots, left


def find_slots(a: np.ndarray, b: np.ndarray, levels: list[bytes]) -> np.ndarray:
    """The slot of each key by the levels alone, -1 where no level places it. Nonmembers get any slot."""
    out, left, used = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
    for level, raw in enumerate(levels):
        size = int(np.frombuffer(raw[:4], np.uint32)[0])
        alone = np.unpackbits(np.frombuffer(raw[4:], np.uint8), count=size).astype(bool)
        place = _place(a[left], b[left], level, size)
        mine = alone[place]
        out[left[mine]] = used + (np.cumsum(alone) - 1)[place[mine]]
        used += int(alone.sum())
        left = left[~mine]
    return out


def build_index(history: DataFrame, per_shard: int = 100_000) -> tuple[DataFrame, int]:
    """(the index, a row per shard; the number of shards) of a table of `grouped` digests.

    Digests are distinct and even, so a shard holds about `per_shard` of them however large the history grows.
    """
    shards = max(1, -(-history.count() // per_shard))

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        flat = np.frombuffer(b"".join(pdf["digest"]), np.uint8).reshape(-1, 32)
        levels, slots, left = build_hash(*_keys(flat))
        order = np.argsort(slots)
        winners = pdf["winner"].to_numpy("int64")
        row = (int(key[0]), len(pdf), levels, np.int64(len(left)).tobytes(), flat[order].tobytes(), winners[order].tobytes(), pdf["n"].to_numpy("int64")[order].tobytes())
        return pd.DataFrame([row], columns=["shard", "n", "levels", "rest", "digests", "winners", "counts"])

    with_shard = history.withColumn("shard", (F.col("prefix") % shards).cast("int"))
    return with_shard.groupBy("shard").applyInPandas(build, INDEX), shards


def lookup(index: DataFrame, shards: int, new: DataFrame) -> DataFrame:
    """Groups of history and new rows together: (digest, prefix, winner, n, member).

    member: the digest was in the history and rows of `new` repeat it.
    """

    def merge(key, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        digest = list(ours["digest"])
        winner = ours["winner"].to_numpy("int64").copy()
        n = ours["n"].to_numpy("int64").copy()
        member = np.zeros(len(ours), bool)
        rest_digest, rest_winner, rest_n = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(theirs):
            row = theirs.iloc[0]
            held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
            winners, counts = np.frombuffer(row["winners"], np.int64), np.frombuffer(row["counts"], np.int64)
            hit = np.zeros(len(held), bool)
            if len(ours):
                flat = np.frombuffer(b"".join(digest), np.uint8).reshape(-1, 32)
                slot = find_slots(*_keys(flat), list(row["levels"]))
                listed = int(np.frombuffer(row["rest"], np.int64)[0])
                if listed:  # the few keys that no level placed are compared one by one
                    tail = {held[i].tobytes(): i for i in range(len(held) - listed, len(held))}
                    for i in np.flatnonzero(slot < 0):
                        slot[i] = tail.get(digest[i], -1)
                at = np.maximum(slot, 0)
                member = (slot >= 0) & (held[at] == flat).all(axis=1)
                winner[member] = np.maximum(winner[member], winners[at[member]])
                n[member] += counts[at[member]]
                hit[at[member]] = True
            rest_digest, rest_winner, rest_n = [h.tobytes() for h in held[~hit]], winners[~hit], counts[~hit]
        out = pd.DataFrame({
            "digest": digest + rest_digest, "winner": np.concatenate([winner, rest_winner]), "n": np.concatenate([n, rest_n]),
            "member": np.concatenate([member, np.zeros(len(rest_digest), bool)]),
        })
        return out

    keyed = new.withColumn("shard", (F.col("prefix") % shards).cast("int")).groupBy("shard")
    return keyed.cogroup(index.groupBy("shard")).applyInPandas(merge, "digest binary, winner long, n long, member boolean")


def exact_dedup(docs: DataFrame, in_history=None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    in_history: a condition on doc_id that tells the rows already held from the new ones; every row takes part
    either way. By default every second doc_id.
    """
    condition = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False)) if in_history is None else in_history
    rows = cut_lineage(digests(docs).groupBy("doc_id", "digest", "prefix").agg(F.count("*").alias("copies")))
    index, shards = build_index(cut_lineage(grouped(rows.filter(condition))))
    groups = lookup(index, shards, grouped(rows.filter(~condition))).select(
        "digest", F.when(F.col("winner") != NO_ID, F.col("winner")).alias("keep_id"), F.col("n").alias("group_size")
    )
    return (
        rows.join(groups, "digest")
        .select("doc_id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("text_sha256"),
                F.posexplode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy", "_"))
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"), "text_sha256")
    )

"""Merkle manifest of a documents table, and a proof of every row by octopus multiproofs.

A leaf is the SHA-256 of doc_id, source, lang, n_chars and text; each lang has a binary tree over its leaves in the order of
doc_id, and the subroots, in the order of lang, have a tree of their own. A last run of one node is hashed alone.

Leaves are made where a document lies; only digests are shuffled. A range sort and counts per range number them. A tree is built
in tiers of `bits` levels: a leaf partition is an aligned run of 2**bits leaves and yields one node; partitions of these nodes yield
the levels above, and so on. A partition proves all its leaves at once: it names the union of the nodes that their proofs need and that
it cannot derive (`missing`), all partitions fetch theirs in one join, and each derives what its leaves share and writes each proof out.
Its nodes are folded from the leaf in question again to check it against the root.

Defined results: a null field is hashed as '-'. A null lang is a tree of its own, the first. Null doc_ids come first; rows of one lang
and doc_id are ordered by leaf, and rows equal in all five fields are interchangeable. A null doc_id is never tampered with. One
leaf is its own subroot, one subroot the root. Repeated rows get a row and a leaf each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from placerank.llm.common import cut_lineage

#: levels of a tier: 2**BITS leaves are a leaf partition
BITS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: the tree over the subroots; trees of langs count from 0
TOP = -1


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """SHA-256, as 32 bytes, of the five fields: '-' for null, else the number of bytes, ':' and the value."""
    text = [fields[name].cast("string") for name in FIELDS]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.unhex(F.sha2(F.concat(*framed).cast("binary"), 256))


def plus_one_of_seven(fields: dict[str, Column]) -> dict[str, Column]:
    """The tampering of the check: n_chars + 1 where 7 divides the crc32 of doc_id; elsewhere and for null n_chars the fields as they are."""
    hit = F.coalesce(F.crc32(fields["doc_id"].cast("string").cast("binary")) % 7 == 0, F.lit(False))
    n = fields["n_chars"].cast("decimal(20,0)")
    return {**fields, "n_chars": F.when(hit, n + 1).otherwise(n)}


def leaves(docs: DataFrame, tamper: Callable[[dict[str, Column]], dict[str, Column]] = plus_one_of_seven) -> DataFrame:
    """Rows (lang, doc_id, leaf, shown, salt): shown is the leaf after tampering, null where it is the same."""
    fields = {
        "doc_id": F.col("doc_id").cast("long"), "source": F.col("source"), "lang": F.col("lang"),
        "n_chars": F.col("n_chars").cast("long"), "text": F.col("text"),
    }
    changed = tamper(fields)
    names = [n for n in FIELDS if changed[n] is not fields[n]]
    differs = F.lit(False)
    for n in names:
        differs = differs | ~fields[n].cast("string").eqNullSafe(changed[n].cast("string"))
    return docs.select(
        F.col("lang").cast("string").alias("lang"), fields["doc_id"].alias("doc_id"), leaf_digest(fields).alias("leaf"),
        F.when(differs, leaf_digest(changed)).alias("shown"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    )


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with `idx`, from 0 among the rows of the keys in that order, and their number `n`; one row per keys with `n`).

    Ranges are sorted apart and counted; no key is gathered in one task.
    """
    sort = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    at = cut_lineage(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")  # the task, as monotonically_increasing_id says
    spans = cut_lineage(at.groupBy(part, *keys).agg(F.min("at").alias("first"), F.count("*").alias("span")))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("span").over(before), F.lit(0)))
    sizes = spans.groupBy(*keys).agg(F.sum("span").alias("n"))
    spans = spans.join(sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], "n"), _same(keys, "_")) if keys else spans.crossJoin(sizes)
    spans = spans.select("part", *[F.col(k).alias(f"_{k}") for k in keys], "first", "before", "n")
    found = at.withColumn("_part", F.shiftright("at", 33)).join(spans, (F.col("_part") == F.col("part")) & _same(keys, "_"))
    return found.select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("idx"), "n"), sizes


def _same(keys: list[str], prefix: str) -> Column:
    equal = F.lit(True)
    for k in keys:
        equal = equal & F.col(k).eqNullSafe(F.col(prefix + k))
    return equal


def level_sizes(n: int) -> list[int]:
    """Number of nodes of each level, leaves first, one node last."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 2))
    return sizes


def above(nodes: list[str]) -> list[str]:
    """The next level of an aligned run of nodes."""
    return [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]


def missing(known: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(level, index) of the least nodes that prove the leaves `known` (sorted) of a tree of n leaves: the siblings that are neither
    known nor derived from what is known."""
    needed = []
    for level, size in enumerate(level_sizes(n)[:-1]):
        siblings = known ^ 1
        absent = siblings[~np.isin(siblings, known) & (siblings < size)]
        needed += [(level, int(i)) for i in absent]
        known = np.unique(known >> 1)
    return needed


NODE = "tree long, level int, idx long, node binary"


def build(base: DataFrame, bits: int, whole: bool) -> list[DataFrame]:
    """Tables of the nodes of all trees from rows (tree, idx, n, node) of their leaves.

    Without `whole` the levels inside leaf partitions are left out, which derive them themselves.
    """

    def climb(tier: int, everything: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("idx")
            tree, first, n = int(pdf["tree"].iloc[0]), int(pdf["idx"].iloc[0]), int(pdf["n"].iloc[0])
            height, level, nodes, out = len(level_sizes(n)) - 1, tier * bits, [b.hex() for b in pdf["node"]], []
            while True:
                last = level == min((tier + 1) * bits, height)
                if (everything and level > tier * bits) or last or (whole and level == 0):
                    out += [(tree, level, first + i, bytes.fromhex(h)) for i, h in enumerate(nodes)]
                if last:
                    break
                level, first, nodes = level + 1, first >> 1, above(nodes)
            return pd.DataFrame(out, columns=["tree", "level", "idx", "node"])

        return run

    sizes = base.select("tree", "n").distinct()
    most = base.agg(F.max("n")).first()[0] or 0
    tables, rows, tier = [], base, 0
    while most:
        block = F.shiftright("idx", bits).alias("block")
        made = rows.groupBy("tree", block).applyInPandas(climb(tier, whole or tier > 0), NODE)
        tables.append(cut_lineage(made))
        tier += 1
        if most <= 1 << (bits * tier):
            break
        # only trees that go on: the others ended in this tier with one node
        on = sizes.filter(F.col("n") > (1 << (bits * tier)))
        rows = tables[-1].filter(F.col("level") == bits * tier).join(on, "tree")
    return tables


def octopus(blocks: DataFrame, bits: int, trees: int) -> DataFrame:
    """Coordinates (tree, level, idx) to fetch for each leaf partition (lang_no, block) of `blocks` (with n, the leaves of its lang)."""

    def run(parts):
        for pdf in parts:
            out = []
            for lang, block, n in zip(pdf["lang_no"], pdf["block"], pdf["n"]):
                known = np.arange(block << bits, min(n, (block + 1) << bits))
                ask = [(lang, *c) for c in missing(known, n)] + [(TOP, *c) for c in missing(np.array([lang]), trees)]
                ask += [(lang, len(level_sizes(n)) - 1, 0), (TOP, len(level_sizes(trees)) - 1, 0)]  # what is proved: subroot and root
                out += [(lang, block, *c) for c in ask]
            yield pd.DataFrame(out, columns=["lang_no", "block", "tree", "level", "idx"])

    return blocks.mapInPandas(run, "lang_no long, block long, tree long, level int, idx long")


def path(idx: int, n: int, have: dict[tuple[int, int], str]) -> list[tuple[str, str]]:
    """(what stands left, what stands right) of the path from leaf idx up, a level each; both empty where a node is hashed alone."""
    steps = []
    for level, size in enumerate(level_sizes(n)[:-1]):
        if idx & 1:
            steps.append((have[level, idx - 1], ""))
        else:
            steps.append(("", have[level, idx + 1] if idx + 1 < size else ""))
        idx >>= 1
    return steps


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(docs: DataFrame, tamper: Callable = plus_one_of_seven, bits: int = BITS, proofs: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; with `proofs` also the siblings.

    All columns but folded_root and verified are of the table as it is; these two are of its tampered rows.
    """
    rows, langs = numbered(cut_lineage(leaves(docs, tamper)), ["lang"], ["doc_id", "leaf", "salt"])
    langs, _ = numbered(langs.withColumnRenamed("n", "leaves"), [], ["lang"])
    langs = cut_lineage(langs.select(F.col("lang").alias("_lang"), F.col("idx").alias("lang_no"), F.col("n").alias("trees"), F.col("leaves").alias("n")))
    trees = (langs.agg(F.max("trees")).first()[0]) or 0
    rows = rows.drop("n").join(langs, F.col("lang").eqNullSafe(F.col("_lang")))
    rows = cut_lineage(rows.select("lang_no", "idx", "n", "doc_id", "leaf", "shown"))
    tables = build(rows.select(F.col("lang_no").alias("tree"), "idx", "n", F.col("leaf").alias("node")), bits, False)
    if not tables:
        return docs.sparkSession.createDataFrame([], RESULT + (", proof array<string>" if proofs else ""))
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.unionByName(t)
    tops = nodes.join(langs.select(F.col("lang_no").alias("tree"), "n"), "tree")
    tops = tops.filter(F.col("level") == _height(F.col("n"))).select(F.col("tree").alias("idx"), "node")
    top = build(tops.select(F.lit(TOP).cast("long").alias("tree"), "idx", F.lit(trees).cast("long").alias("n"), "node"), bits, True)
    for t in top:
        nodes = nodes.unionByName(t)

    block = F.shiftright("idx", bits).alias("block")
    blocks = langs.select("lang_no", "n", F.explode(F.sequence(F.lit(0), F.shiftright(F.col("n") - 1, 2 * bits))).alias("far"))
    # two bounded steps instead of one long sequence per lang
    blocks = blocks.withColumn("near", F.explode(F.sequence(F.lit(0), F.lit((1 << bits) - 1))))
    blocks = blocks.withColumn("block", F.shiftleft(F.col("far").cast("long"), bits) + F.col("near")).filter(F.shiftleft("block", bits) < F.col("n"))
    fetched = octopus(blocks.select("lang_no", "block", "n"), bits, trees).join(nodes, ["tree", "level", "idx"])

    def expand(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("idx")
        lang, n, first = int(left["lang_no"].iloc[0]), int(left["n"].iloc[0]), int(left["idx"].iloc[0])
        own, over = {}, {}
        for tree, level, idx, node in zip(right["tree"], right["level"], right["idx"], right["node"]):
            (over if tree == TOP else own)[level, idx] = node.hex()
        subroot, root = own[len(level_sizes(n)) - 1, 0], over[len(level_sizes(trees)) - 1, 0]
        level, at, run = 0, first, [b.hex() for b in left["leaf"]]
        kept = run
        for level in range(min(bits, len(level_sizes(n)) - 1)):  # the interiors that leaves share
            own.update(((level, at + i), h) for i, h in enumerate(run))
            at, run = at >> 1, above(run)
        high = path(lang, trees, over)
        out = []
        for doc_id, idx, leaf, shown in zip(left["doc_id"], left["idx"], kept, left["shown"]):
            steps = path(idx, n, own) + high
            folded = leaf if shown is None else shown.hex()
            for a, b in steps:
                folded = digest(a, folded, b)
            siblings = [a or b for a, b in steps]
            row = (doc_id, leaf, subroot, root, digest(*siblings), folded, folded == root)
            out.append((*row, [s for s in siblings if s]) if proofs else row)
        names = [c.split()[0] for c in RESULT.split(", ")] + (["proof"] if proofs else [])
        made = pd.DataFrame(out, columns=names)
        made["doc_id"] = pd.array([None if d is None else int(d) for d in left["doc_id"]], dtype="Int64")
        return made

    # ids as text: pandas would turn whole numbers beside nulls into floating point
    keyed = rows.withColumn("block", block).withColumn("doc_id", F.col("doc_id").cast("string"))
    return (
        keyed.groupBy("lang_no", "block").cogroup(fetched.groupBy("lang_no", "block"))
        .applyInPandas(expand, RESULT + (", proof array<string>" if proofs else ""))
    )


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves, in whole numbers."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1)))

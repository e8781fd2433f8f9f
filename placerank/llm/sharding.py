"""Shards of linked documents by balanced label propagation.

Documents with equal texts are linked. They start in the shard of their rank in a hash order, so counts are at most one
apart. In each round Spark joins tell every group where its members are; a member wants to the shard where most of them
are (of equal ones, that which a hash of group, shard and round puts first). Quotas per pair of shards say how many may go,
so that counts never change and the law `rows` holds after every round:

* wants that form a cycle of shards are granted to one another, so linked documents are exchanged for linked ones;
* what remains may enter in exchange for documents that lose nothing: unlinked ones, and whole groups of a smaller size class (powers of
  two) that lie in one shard. These go out to the shards that lost members; where a quota ends inside such a group, it is split.

Every granted want lowers the number of cut edges, only that split can raise it. So a round that does not lower their number is dropped, and the next
ones displace unlinked documents only. It ends when PATIENCE rounds in a row, each with another order of equal shards, find no move.

A group larger than a shard fills one shard after another. Links are never expanded into pairs: a group is a hub, of
which at most one count per shard is kept. Ranks are prefix sums split by hash. DataFrame operations only; the driver sees one
number per pair of shards and size class. Groups of LARGE members or more are not displaced, as a whole one is ranked in one task.

Defined results: null text counts as empty with size 1 and checksum 0, and any two are linked. Null doc_ids and repeated rows are documents of
their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from placerank.llm.common import cut_lineage, running_sum, spread


PATIENCE, LARGE = 4, 4096


def linked(docs: DataFrame) -> DataFrame:
    """Rows (row, doc_id, size, text_crc32, group, members): group is the SHA-256 of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("group"),
    ))
    several = rows.groupBy("group").agg(F.count("*").alias("members")).filter("members > 1")
    return rows.join(several, "group", "left").fillna({"members": 1})


def _literals(values: list[int]):
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _cycles(wants: list[list[int]]) -> list[list[int]]:
    """How many of the wants from shard to shard can be granted to one another: as many leave each shard as enter it."""
    n = len(wants)
    left, granted = [row[:] for row in wants], [[0] * n for _ in wants]

    def grant(cycle: list[int]) -> None:
        steps = list(zip(cycle, cycle[1:] + cycle[:1]))
        most = min(left[s][t] for s, t in steps)
        for s, t in steps:
            left[s][t] -= most
            granted[s][t] += most

    for s in range(n):
        for t in range(s):
            grant([s, t])
    done: set[int] = set()
    for start in range(n):  # a walk that meets itself has found a cycle; a shard without a way on is done
        path = [start]
        while path:
            to = next((t for t in range(n) if left[path[-1]][t] and t not in done), None)
            if to is None:
                done.add(path.pop())
            elif to in path:
                at = path.index(to)
                grant(path[at:])
                path = path[:at + 1]
            else:
                path.append(to)
    return granted


def quotas(wants: dict[tuple[int, int, int], int], free: dict[tuple[int, int], int], shards: int) -> dict[tuple[int, int, int], int]:
    """Members that may go, by (shard, to, class), of those that want to; free: documents that may be displaced, by (shard, class)."""
    sums = [[0] * shards for _ in range(shards)]
    for (s, t, _), n in wants.items():
        sums[s][t] += n
    cycles, granted, rest = _cycles(sums), {}, dict(free)
    for s, t, c in sorted(wants, key=lambda w: (-w[2], w)):  # large classes first
        n = min(wants[s, t, c], cycles[s][t])
        cycles[s][t] -= n
        more = wants[s, t, c] - n
        for below in range(c):
            some = min(more, rest.get((t, below), 0))
            if some:
                rest[t, below] -= some
                more -= some
        granted[s, t, c] = wants[s, t, c] - more
    return {k: n for k, n in granted.items() if n}


def _joined_quota(spark, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))  # at most one row per pair of shards and size class


def inner_links(nodes: DataFrame) -> int:
    """Sum over groups and shards of the squared number of members: twice the links within shards, and the documents."""
    here = nodes.groupBy("group", "shard").agg(F.count("*").cast("decimal(18,0)").alias("here"))
    return int(here.agg(F.sum(F.col("here") * F.col("here"))).first()[0] or 0)


def _round(table: DataFrame, shards: int, number: int, whole: bool) -> DataFrame | None:
    """The table after a round, None if no move is granted; whole: groups that lie in one shard may be displaced too."""
    spark, tie = table.sparkSession, F.xxhash64("group", "shard", F.lit(number))
    per = table.filter("members > 1").groupBy("group", "shard", "members").agg(F.count("*").alias("here"))
    size_class = F.floor(F.log2("members")).cast("int")
    lying = cut_lineage(per.select("group", "shard", "members", "here", size_class.alias("class")))
    split = lying.filter("here < members")
    free = {(r[0], 0): r[1] for r in table.filter("members = 1").groupBy("shard").count().collect()}
    if whole:
        for r in lying.filter((F.col("here") == F.col("members")) & (F.col("members") < LARGE)).groupBy("shard", "class").agg(F.sum("here")).collect():
            free[r[0], r[1]] = r[2]
    loose = {r[0]: r[1] for r in split.groupBy("shard").agg(F.sum("here")).collect()} if whole else {}
    # a shard is open to a group if something in it may go out: displaced, or a member of another group that is split
    top = max(c for _, c in [*free, (0, 0)]) + 1
    below = [[sum(free.get((s, c), 0) for c in range(k)) for k in range(top + 1)] for s in range(shards)]
    open_to = F.array(*[_literals([n + loose.get(s, 0) for n in below[s]]) for s in range(shards)])
    room = open_to[F.col("shard")][F.least("class", F.lit(top))] - (F.col("here") if whole else F.lit(0))
    place = F.struct("here", tie.alias("tie"), "shard")
    best = split.filter(room > 0).groupBy("group").agg(F.max(place).alias("best"))
    going = split.join(best, "group").filter(F.col("best") > place).select("group", "shard", "class", F.col("best.shard").alias("to"), "here")
    going = cut_lineage(going)
    wants = {tuple(r[:3]): r[3] for r in going.groupBy("shard", "to", "class").agg(F.sum("here")).collect()}
    granted = quotas(wants, free, shards)
    if not granted:
        return None
    limits = _joined_quota(spark, [(*k, n) for k, n in granted.items()], "shard int, to int, class int, quota long")
    movers = table.filter("members > 1").join(going.drop("here"), ["group", "shard"]).select("row", "_order", "shard", "to", "class")
    ranked = running_sum(movers, ["shard", "to", "class"], "_order", ["row"], F.lit(1), "rank")
    moves = ranked.join(limits, ["shard", "to", "class"]).filter("rank < quota").select("row", "to")
    gained, lost = [0] * shards, [0] * shards
    for (s, t, _), n in granted.items():
        gained[t] += n
        lost[s] += n
    surplus = [max(0, g - x) for g, x in zip(gained, lost)]
    ends = list(accumulate(max(0, x - g) for g, x in zip(gained, lost)))
    before = [0, *accumulate(surplus)]
    out = []  # (shard, class, documents of it that go, the number of the first)
    for s in range(shards):
        need, first = surplus[s], before[s]
        for c in sorted(c for t, c in free if t == s):
            n = min(need, free[s, c])
            if n:
                out.append((s, c, n, first))
                need, first = need - n, first + n
    if out:
        going_out = _joined_quota(spark, out, "shard int, class int, quota long, first long")
        fit = table.filter("members = 1").select("row", "_order", "shard", F.lit(0).alias("class"))
        if whole:
            whole_ones = lying.filter((F.col("here") == F.col("members")) & (F.col("members") < LARGE)).select("group", "class")
            by_group = F.shiftrightunsigned(F.xxhash64("group"), 12).alias("_order")  # a group stays together
            fit = fit.unionByName(table.filter("members > 1").join(whole_ones, "group").select("row", by_group, "shard", "class"))
        fillers = (
            running_sum(fit, ["shard", "class"], "_order", ["row"], F.lit(1), "rank").join(going_out, ["shard", "class"]).filter("rank < quota")
            .withColumn("number", F.col("rank") + F.col("first"))
            .select("row", F.size(F.filter(_literals(ends), lambda e: e <= F.col("number"))).alias("to"))
        )
        moves = moves.unionByName(fillers)
    moves = cut_lineage(moves)
    return cut_lineage(table.join(moves, "row", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"))


def propagate(nodes: DataFrame, shards: int = 16) -> DataFrame:
    """Adds shard to rows (row, doc_id, group, members)."""
    ordered = running_sum(nodes.withColumn("_order", spread(F.col("doc_id"))), [], "_order", ["row"], F.lit(1), "rank")
    table = cut_lineage(ordered.withColumn("shard", (F.col("rank") % shards).cast("int")).drop("rank"))
    inner, number, idle = inner_links(table), 0, 0
    while idle < PATIENCE:
        made = _round(table, shards, number, whole=idle % 2 == 0)
        number, better = number + 1, inner_links(made) if made is not None else inner
        if better > inner:
            table, inner, idle = made, better, 0
        else:
            idle += 1
    return table


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    placed = propagate(linked(docs), shards)
    return running_sum(placed, ["shard"], "_order", ["row"], F.lit(1), "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Rows hash to one of `cells` equal arcs of the ring; each arc belongs to the
next virtual node clockwise. A shard takes rows only up to its capacity; what
overflows a full shard continues clockwise to the next shard with room. Rows
in an arc are alike to the ring, so the walk runs on row counts by arc (at
most `cells` numbers, whatever the corpus), and each arc's rows, ranked by
hash, are then dealt to the shards that the walk gave it.

The law kept is `rows`: capacities are the row count split evenly, so shards
differ by one row at most. (Bounded loads cannot keep the `key` law, since a
row's shard then depends on the others.)

Only DataFrame functions touch rows. Repeated equal rows are first counted,
then numbered, so no window holds one hot key: the window that ranks rows is
per arc, and rows that differ anywhere spread over the arcs.

Defined results: a null text has no bytes, size 1 and CRC 0; null ids are
ordinary keys; equal rows each get their own slot; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from darkroom.llm.store import stored

SHARDS = 8
#: Virtual nodes of each shard.
VIRTUAL_NODES = 128
#: Arcs of the ring that rows are counted by (a power of two).
CELLS = 16384


def ring(shards: int, virtual_nodes: int, cells: int) -> list[list[int]]:
    """For each arc, the shards in clockwise order from it, each once."""
    nodes = sorted(
        (int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % cells, s)
        for s in range(shards) for v in range(virtual_nodes)
    )
    at = [cell for cell, _ in nodes]
    after = []
    for first in range(len(nodes)):
        seen: dict[int, None] = {}
        for k in range(len(nodes)):
            seen[nodes[(first + k) % len(nodes)][1]] = None
            if len(seen) == shards:
                break
        after.append(list(seen))
    return [after[bisect.bisect_left(at, cell) % len(nodes)] for cell in range(cells)]


def walk(counts: dict[int, int], order: list[list[int]], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """(cell, first rank, rows, shard): the dealing of each arc's rows.

    In rounds: every arc offers what it has left to the next shard clockwise
    that had room when the round began; a shard takes offers in ring order up
    to its capacity. Each round fills a shard or places everything."""
    left, next_rank, room, deals = dict(counts), dict.fromkeys(counts, 0), list(capacity), []
    while left:
        open_now = [r > 0 for r in room]
        if not any(open_now):
            raise ValueError("capacities hold fewer rows than there are")
        for cell in sorted(left):
            shard = next(s for s in order[cell] if open_now[s])
            n = min(left[cell], room[shard])
            if n:
                deals.append((cell, next_rank[cell], n, shard))
                room[shard] -= n
                next_rank[cell] += n
                left[cell] -= n
        left = {c: n for c, n in left.items() if n}
    return deals


def shard_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row per row."""
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.xxhash64(F.col(doc_id), F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"), key.alias("_key"), F.xxhash64(F.col(text), F.col(doc_id), F.lit(1)).alias("_more"),
    )
    same = ["_id", "size", "text_crc32", "_key", "_more"]
    rows = stored(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).withColumn("_cell", F.pmod(F.col("_key"), F.lit(cells)).cast("int")), "ring-rows")
    counts = {r["_cell"]: r["n"] for r in rows.groupBy("_cell").agg(F.sum("_n").alias("n")).collect()}
    total = sum(counts.values())
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    deals, base = [], [0] * shards
    for cell, first, n, shard in sorted(walk(counts, ring(shards, virtual_nodes, cells), capacity)):
        deals.append([cell, first, n, shard, base[shard]])
        base[shard] += n
    table = docs.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(deals)), "array<array<bigint>>")).alias("d"))
    table = table.select(*[F.col("d")[i].alias(c) for i, c in enumerate(("_deal_cell", "first", "n", "shard", "base"))])
    by_cell = table.groupBy("_deal_cell").agg(F.collect_list(F.struct("first", "n", "shard", "base")).alias("_deals"))
    order = Window.partitionBy("_cell").orderBy("_key", "_more", "_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    ranked = ranked.withColumn("_rank", F.explode(F.sequence(F.col("_before"), F.col("_before") + F.col("_n") - 1)))
    dealt = ranked.join(F.broadcast(by_cell), F.col("_cell") == F.col("_deal_cell"))
    deal = F.filter("_deals", lambda d: (F.col("_rank") >= d["first"]) & (F.col("_rank") < d["first"] + d["n"]))[0]
    dealt = dealt.withColumn("_deal", deal)
    return dealt.select(
        F.col("_id").alias(doc_id), "size", "text_crc32", F.lit("rows").alias("law"), F.col("_deal.shard").cast("int").alias("shard"),
        (F.col("_deal.base") + F.col("_rank") - F.col("_deal.first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into equal cells.  Each shard owns the arcs that end at its
virtual nodes, each row the cell that its key hashes to; of rows with the same key
each copy has its number in the key, so no key is bound to one cell.  A shard takes the rows
of its own arcs in ring order until it is full; rows beyond that go clockwise to
the next shards with room.  The room adds up to the number of rows, so in the
end all shards are full: row counts differ by one at most, whatever the arcs.

The walk needs only the number of rows per cell, a table whose size is set by
the parameters and not by the data.  Its result, which ranks of which cell go to
which places of which shard, meets the rows in one join on cell and rank.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm.common import checkpointed

CELLS = 1 << 13
NODES = 64  # virtual nodes per shard
COPIES = 1 << 16  # copies of a row that are numbered in one task


def _owners(shards: int, nodes: int, cells: int) -> tuple[list[int], list[int]]:
    """Cells of the virtual nodes clockwise, and the shard at each."""
    points: dict[int, tuple[bytes, int]] = {}
    for shard in range(shards):
        for node in range(nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=16).digest()
            cell = int.from_bytes(digest[:8], "big") % cells
            points[cell] = min(points.get(cell, (digest, shard)), (digest, shard))
    where = sorted(points)
    return where, [points[cell][1] for cell in where]


def plan_ring(counts: dict[int, int], shards: int, nodes: int, cells: int) -> list[tuple]:
    """``(cell, first, last, shard, slot)``: ranks ``first`` to ``last - 1`` of a cell go to a
    shard, the first of them to this slot."""
    total = sum(counts.values())
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    used = [0] * shards
    where, owner = _owners(shards, nodes, cells)
    plan, waiting = [], []

    def give(cell: int, first: int, last: int, shard: int) -> int:
        """Rows from ``first`` on as far as there is room; the rank where the rest begins."""
        taken = min(last - first, room[shard] - used[shard])
        if taken:
            plan.append((cell, first, first + taken, shard, used[shard]))
            used[shard] += taken
        return first + taken

    for cell in sorted(counts):
        at = bisect_left(where, cell) % len(where)
        first = give(cell, 0, counts[cell], owner[at])
        if first < counts[cell]:
            waiting.append((cell, first, at))
    for cell, first, at in waiting:
        while first < counts[cell]:
            at = (at + 1) % len(where)
            first = give(cell, first, counts[cell], owner[at])
    return plan


def _plan_table(spark: SparkSession, plan: list[tuple]) -> DataFrame:
    """The plan as one JSON literal: at most a row per cell and one per full shard more."""
    rows = "array<struct<a:bigint,b:bigint,c:bigint,d:int,e:bigint>>"
    text = json.dumps([dict(zip("abcde", row)) for row in plan])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), rows))).toDF(
        "cell", "first", "last", "shard", "start"
    )


def shard_rows(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    shards: int = 40,
    nodes: int = NODES,
    cells: int = CELLS,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, gapless from 0 in each shard.

    ``keys`` choose the cell, ``order`` the rank within it.  Rows equal in all of
    these are interchangeable.  NULLs are values like any other.  An empty table
    gives an empty result.
    """
    if shards < 1 or nodes < 1:
        raise ValueError("at least one shard and one virtual node")
    cell = F.pmod(F.xxhash64(*keys), F.lit(cells))
    placed = checkpointed(rows.withColumn("cell", cell))
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    plan = _plan_table(rows.sparkSession, plan_ring(counts, shards, nodes, cells))
    rank = F.row_number().over(W.partitionBy("cell").orderBy(*order)) - 1
    ranked = placed.withColumn("rank", rank)
    # Bounded by the parameters: cells plus shards rows of 36 bytes.
    return ranked.join(
        F.broadcast(plan),
        (ranked["cell"] == plan["cell"]) & F.col("rank").between(plan["first"], plan["last"] - 1),
    ).select(
        *rows.columns, "shard", (F.col("start") + F.col("rank") - F.col("first")).alias("slot")
    )


def numbered_copies(rows: DataFrame, block: int = COPIES) -> DataFrame:
    """``rows`` with ``copy``, from 0 among equal rows.

    Equal rows are counted, per task first, and written out again in blocks that
    go to different tasks; so no task sorts or holds all copies of a row.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count("*").alias("__n"))
    few = counted.filter(f"__n <= {block}").selectExpr(*names, "explode(sequence(0L, __n - 1)) AS copy")
    many = (
        counted.filter(f"__n > {block}")
        .selectExpr(*names, "__n", f"explode(sequence(0L, (__n - 1) DIV {block})) AS __block")
        .repartition("__block", *names)
        .selectExpr(
            *names,
            f"explode(sequence(__block * {block}, least(__n, (__block + 1) * {block}) - 1)) AS copy",
        )
    )
    return few.unionByName(many)


def shard_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = 40,
    nodes: int = NODES,
    cells: int = CELLS,
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row.

    Size is the text's UTF-8 bytes plus 16, a NULL text has none.  The law is
    ``rows``: counts of the shards are at most one apart.  Under it the other
    rows matter, so ``grown_shard`` is NULL.  Repeated ids are rows of their own,
    and id, size, checksum and copy choose the cell: neither many rows of one id
    nor rows without id crowd one.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(key),
        (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(F.encode(raw, "UTF-8")).alias("text_crc32"),
    )
    place = [key, "text_crc32", "size", "copy"]
    return shard_rows(numbered_copies(sized), place, place, shards, nodes, cells).select(
        key,
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

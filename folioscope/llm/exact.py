"""Exact duplicates by deterministic block naming.

Each text is cut into blocks of a fixed size.  The distinct blocks are sorted
and numbered, so a block's number is its name; then adjacent names are paired
and the distinct pairs numbered, again and again, until each document has one
name.  Two documents of equally many blocks get the same name if and only if
their texts are equal: names stand for content, not for a hash.

Only the distinct blocks travel with their content, once, after copies in one
task are merged.  Occurrences travel with a 128-bit address.  That no two
distinct blocks share an address is not assumed but counted; if some do, all
blocks are addressed anew with another seed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import ascii_lower, checkpointed

BLOCK = 4096
Address = Callable[[Column, int], list[Column]]


def two_hashes(block: Column, seed: int) -> list[Column]:
    """128 bits of address."""
    return [F.xxhash64(block, F.lit(2 * seed)), F.xxhash64(block, F.lit(2 * seed + 1))]


def _blocks(text: Column, size: int) -> Column:
    """The text in pieces of ``size`` characters; an empty text is one empty piece."""
    return F.when(F.length(text) <= size, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Sorted within partitions; the name is made of partition and place."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _block_names(normal: DataFrame, size: int, address: Address) -> tuple[DataFrame, int]:
    """``(x, y, name)`` for each distinct block, and the seed of the addresses."""
    seed = 0
    while True:
        block = normal.select(F.explode(_blocks(F.col("normal"), size)).alias("block"))
        x, y = address(F.col("block"), seed)
        distinct = block.select(x.alias("x"), y.alias("y"), "block").distinct()
        names = checkpointed(
            _numbered(distinct, ["block"])
            .groupBy("x", "y")
            .agg(F.min("name").alias("name"), F.count("*").alias("blocks"))
        )
        if names.filter("blocks > 1").isEmpty():
            return names.drop("blocks"), seed
        seed += 1


def identities(
    docs: DataFrame, key: str, text: str, size: int = BLOCK, address: Address = two_hashes
) -> DataFrame:
    """``(row, id, h, sha, blocks, name)`` per row; equal ``(blocks, name)`` means equal text."""
    normal = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(F.col(text)).alias("h"),
        ascii_lower(F.col(text)).alias("normal"),
    )
    names, seed = _block_names(normal, size, address)
    cut = normal.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "h",
        F.unhex(F.sha2("normal", 256)).alias("sha"),
        _blocks(F.col("normal"), size).alias("cut"),
    )
    block = cut.select("row", "id", "h", "sha", F.size("cut").alias("blocks"), F.posexplode("cut"))
    x, y = address(F.col("col"), seed)
    who = ["row", "id", "h", "sha", "blocks"]
    placed = checkpointed(block.select(*who, "pos", x.alias("x"), y.alias("y")))
    level = placed.join(names, ["x", "y"]).select(*who, "pos", F.col("blocks").alias("left"), "name")
    result = level.filter("left = 1").select(*who, "name")
    level = checkpointed(level.filter("left > 1"))
    while not level.isEmpty():
        pairs = level.groupBy(*who, "left", F.expr("pos DIV 2").alias("pos")).agg(
            F.max(F.expr("CASE WHEN pos % 2 = 0 THEN name END")).alias("first"),
            F.coalesce(F.max(F.expr("CASE WHEN pos % 2 = 1 THEN name END")), F.lit(-1)).alias("second"),
        )
        pairs = checkpointed(pairs)
        couples = checkpointed(_numbered(pairs.select("first", "second").distinct(), ["first", "second"]))
        level = pairs.join(couples, ["first", "second"]).select(
            *who, "pos", F.expr("(left + 1) DIV 2").alias("left"), "name"
        )
        result = result.union(level.filter("left = 1").select(*who, "name"))
        level = checkpointed(level.filter("left > 1"))
    return result


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = BLOCK,
    address: Address = two_hashes,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, text_hash)``, a row per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty.
    Of equal texts the row with the largest id stays; of rows that repeat text
    and id exactly one stays, a NULL id comes last.  An empty table gives an
    empty result.  ``text_hash`` is ``xxhash64`` of the text as it stands, to
    find the row again.
    """
    named = checkpointed(identities(docs, key, text, size, address))
    groups = named.groupBy("blocks", "name").agg(
        F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("group_size")
    )
    # Both sides of the join get a shuffle of its own by this key, so a large group may be split.
    same = F.struct("blocks", "name").alias("same")
    groups = groups.select(same, "keep", "group_size")
    return named.select("*", same).join(groups, "same").select(
        F.col("id").alias(key),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("h").alias("text_hash"),
    )
